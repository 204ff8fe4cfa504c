from datetime import date

from pyspark.sql import functions as F

from barlake.schema import BARS, DECISIONS
from barlake.sources.tables import scan_decisions
from barlake.storage import read_months
from barlake.streaming import ingest as s


def drop_file(bars, folder, ordinal):
    bars.withColumn("seq", F.lit(ordinal).cast("long")).coalesce(1).write.mode("append").parquet(folder)


def streamed_schema(spark):
    return spark.createDataFrame([], BARS).withColumn("seq", F.lit(0).cast("long")).schema


def test_late_and_repeated_days(spark, make_bars, tmp_path):
    folder, table, offsets = (str(tmp_path / n) for n in ("in", "table", "offsets"))
    day, later = date(2026, 1, 5), date(2026, 2, 2)

    def run():
        stream = s.stream_files(spark, folder, streamed_schema(spark), files_per_batch=1)
        s.ingest_bars(stream, table, offsets, recency=("seq",)).awaitTermination()
        return {(r.symbol, r.date.month): r.close for r in read_months(spark, table).collect()}

    drop_file(make_bars([(day, "A", 1.0), (day, "B", 2.0)]), folder, 1)
    drop_file(make_bars([(later, "A", 3.0)]), folder, 2)
    assert run() == {("A", 1): 1.0, ("B", 1): 2.0, ("A", 2): 3.0}
    drop_file(make_bars([(day, "A", 9.0)]), folder, 3)  # an old day, sent again
    expected = {("A", 1): 9.0, ("B", 1): 2.0, ("A", 2): 3.0}
    assert run() == expected
    assert run() == expected  # nothing new
    replayed = s.stream_files(spark, folder, streamed_schema(spark), files_per_batch=1)
    s.ingest_bars(replayed, table, offsets + "2", recency=("seq",)).awaitTermination()
    assert read_months(spark, table).count() == 3  # all batches again: no duplicates


def test_decisions_and_audit(spark, make_bars, tmp_path):
    folder, table, offsets = (str(tmp_path / n) for n in ("in", "table", "offsets"))
    row = (date(2026, 1, 2), "s", "NSE", "I1", "A", 0.1, 1, None)
    for weight in (0.1, 0.4):
        frame = spark.createDataFrame([row[:5] + (weight,) + row[6:]], DECISIONS)
        frame.coalesce(1).write.mode("append").parquet(folder)
        stream = s.stream_files(spark, folder, DECISIONS, files_per_batch=1)
        s.append_decision_stream(stream, table, offsets).awaitTermination()
    (stored,) = scan_decisions(spark, table).collect()
    assert stored.target_weight == 0.4

    bars = make_bars([(date(2026, 1, 5), "A", 1.0, {"volume": -1}), (date(2026, 1, 5), "B", 5.0, {"high": 0.0})])
    bars.coalesce(1).write.parquet(str(tmp_path / "bars"))
    stream = s.stream_files(spark, str(tmp_path / "bars"), BARS)
    s.audit_stream(stream, str(tmp_path / "audit"), offsets + "a").awaitTermination()
    (counters,) = spark.read.parquet(str(tmp_path / "audit")).collect()
    assert (counters.rows, counters.bad_volume, counters.bad_prices, counters.incomplete) == (2, 1, 1, 0)
