"""Strategy decisions: contract, payload normalisation, selection and appending."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barlake.schema import DECISION_KEY, DECISION_ORDER, DECISIONS, ContractError, conform
from barlake.storage import keep_last


def decision_frame(df: DataFrame) -> DataFrame:
    """Project to the decision schema; a missing score is NULL, a further column an error."""
    required = [name for name in DECISIONS.names if name != "score"]
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ContractError(f"decisions are missing columns: {missing}")
    extra = [name for name in df.columns if name not in DECISIONS.names]
    if extra:
        raise ContractError(f"decisions have unexpected columns: {extra}")
    score = F.col("score").try_cast("double") if "score" in df.columns else F.lit(None)
    return conform(df.withColumn("score", score), DECISIONS)


def decision_violations(decisions: DataFrame) -> DataFrame:
    """One row of counters, in one aggregation by decision key."""
    def rows_where(condition):
        return F.sum(condition.cast("bigint"))

    per_key = decisions.groupBy(*DECISION_KEY).agg(
        F.count("*").alias("_rows"),
        rows_where(F.col("target_weight").isNull()).alias("null_weight"),
        rows_where(F.coalesce(F.col("target_weight") < 0, F.lit(False))).alias("negative_weight"),
        rows_where(F.col("rank").isNull()).alias("null_rank"),
    )
    counted = {
        "null_date": F.sum(F.when(F.col("date").isNull(), F.col("_rows"))),
        "null_weight": F.sum("null_weight"),
        "negative_weight": F.sum("negative_weight"),
        "null_rank": F.sum("null_rank"),
        "duplicate_rows": F.sum(F.when(F.col("_rows") > 1, F.col("_rows"))),
    }
    return per_key.agg(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in counted.items()])


def assert_decisions(df: DataFrame) -> DataFrame:
    """Contract-checked decisions; fails with the counts of what is wrong."""
    decisions = decision_frame(df)
    broken = {k: v for k, v in decision_violations(decisions).first().asDict().items() if v}
    if broken:
        raise ContractError(f"decisions break the contract: {broken}")
    return decisions


def sound_weights(decisions: DataFrame) -> DataFrame:
    """The same rows; a row without date, weight or rank, or with a negative weight, fails the plan."""
    bad = F.col("date").isNull() | F.col("target_weight").isNull() | F.col("rank").isNull() | (F.col("target_weight") < 0)
    broken = F.raise_error(F.concat(F.lit("decisions break the contract: "), F.to_json(F.struct(*decisions.columns))))
    return decisions.withColumn("target_weight", F.when(bad, broken.cast("double")).otherwise(F.col("target_weight")))


def in_decision_order(decisions: DataFrame) -> DataFrame:
    return decisions.orderBy(*DECISION_ORDER)


def fill_payload(
    payload: DataFrame, *, strategy_id: str | None = None, position: str = "position"
) -> DataFrame:
    """Complete a strategy's payload: default strategy, score and rank.

    ``position`` is the 1-based place of a row within its date; it becomes the rank
    where the strategy gave none.
    """
    needed = ("date", "exchange", "isin", "symbol", "target_weight", position)
    missing = [name for name in needed if name not in payload.columns]
    if missing:
        raise ContractError(f"decision payload is missing columns: {missing}")
    place = F.col(position).cast("bigint")
    filled = {"rank": F.coalesce(F.col("rank"), place) if "rank" in payload.columns else place}
    if "strategy_id" not in payload.columns:
        filled["strategy_id"] = F.lit(strategy_id)
    return decision_frame(payload.withColumns(filled).drop(position))


def top_n_by_price(
    bars: DataFrame,
    *,
    top_n: int = 3,
    strategy_id: str = "top_n_adj_close_v1",
    unique: bool = False,
) -> DataFrame:
    """Per date, the N highest adjusted closes of series EQ, equally weighted.

    All dates in one plan. The rank filter is applied before the shuffle by date, so each
    task sends at most N rows per date no matter how many bars a date has. Bars that
    were validated are ``unique`` per instrument and date; others are reduced to one row
    each first, which shuffles them.
    """
    priced = bars.where((F.col("series") == "EQ") & F.col("adj_close").isNotNull())
    instrument = ["date", "exchange", "isin", "symbol"]
    if unique:
        best = priced.select(*instrument, F.col("adj_close").alias("score"))
    else:
        best = priced.groupBy(*instrument).agg(F.max("adj_close").alias("score"))
    by_date = Window.partitionBy("date")
    ranking = by_date.orderBy(F.col("score").desc(), "symbol", "exchange", "isin")
    chosen = best.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= top_n)
    return chosen.select(
        "date",
        F.lit(strategy_id).alias("strategy_id"),
        "exchange",
        "isin",
        "symbol",
        (F.lit(1.0) / F.count("*").over(by_date)).alias("target_weight"),
        F.col("rank").cast("bigint").alias("rank"),
        "score",
    )


def append_decisions(existing: DataFrame, today: DataFrame) -> DataFrame:
    """Existing decisions and today's, today's winning per key; repeating it adds nothing."""
    both = decision_frame(existing).withColumn("_source", F.lit(0)).unionByName(
        decision_frame(today).withColumn("_source", F.lit(1))
    )
    return keep_last(both, DECISION_KEY, ["_source"]).drop("_source")
