"""Bars, decisions and audit counters from streams.

Every sink is an upsert by key inside ``foreachBatch``: a batch that is replayed after a
failure, or a day that is sent again, leaves the table as it was. Late days are not
dropped by a watermark; they rewrite the month they belong to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barlake.operators.quality import invalid_ohlc
from barlake.plans.paper import add_decisions
from barlake.schema import BAR_KEY, BAR_REQUIRED, DECISIONS, conform
from barlake.session import scratch_dir
from barlake.storage import delete_path, keep_last, upsert_bars


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, *, files_per_batch: int = 64
) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_batches(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process all data that is available now, in batches, and stop."""
    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_bars(
    bars: DataFrame, table: str, checkpoint: str, *, recency: tuple[str, ...], mode: str = "upsert"
) -> StreamingQuery:
    """Merge streamed bars into a monthly table.

    ``recency`` orders repeated keys inside a batch; batches themselves arrive in order,
    so a later batch wins. Each batch is written once and then merged from there.
    """
    spark = bars.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        staged = scratch_dir(spark, f"batch-{batch_id}")
        keep_last(batch, BAR_KEY, recency).write.parquet(staged)
        upsert_bars(spark, spark.read.parquet(staged), table, mode=mode)
        delete_path(spark, staged)

    return run_batches(bars, merge, checkpoint)


def append_decision_stream(decisions: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Add streamed decisions to the stored ones, the later one winning per key."""
    spark = decisions.sparkSession

    def append(batch: DataFrame, batch_id: int) -> None:
        staged = scratch_dir(spark, f"batch-{batch_id}")
        conform(batch, DECISIONS).write.parquet(staged)
        add_decisions(spark.read.parquet(staged), table)
        delete_path(spark, staged)

    return run_batches(decisions, append, checkpoint)


def flag_rows(bars: DataFrame) -> DataFrame:
    """Per row audit flags; stateless, so they work on a stream as on a table."""
    incomplete = F.lit(False)
    for name in BAR_REQUIRED:
        incomplete |= F.col(name).isNull()
    return bars.withColumns(
        {
            "bad_prices": invalid_ohlc(),
            "bad_volume": F.coalesce(F.col("volume") < 0, F.lit(False)),
            "bad_turnover": F.coalesce(F.col("turnover") < 0, F.lit(False)),
            "incomplete": incomplete,
        }
    )


def audit_stream(bars: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """One row of audit counters per batch; a replayed batch overwrites its own row."""
    def count(batch: DataFrame, batch_id: int) -> None:
        flags = ("bad_prices", "bad_volume", "bad_turnover", "incomplete")
        counters = flag_rows(batch).agg(
            F.count("*").alias("rows"),
            *[F.coalesce(F.sum(F.col(n).cast("bigint")), F.lit(0)).alias(n) for n in flags],
        )
        counters.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(table)

    return run_batches(bars, count, checkpoint)
