"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import time
from datetime import date

from pyspark.sql import functions as F

from barlake.operators import quality as q
from barlake.operators.decisions import top_n_by_price
from barlake.operators.features import feature_frame
from barlake.operators.returns import forward_returns
from barlake.plans.backtest import chunk_plan, chunked_features
from barlake.plans.paper import write_decisions
from barlake.plans.performance import strategy_performance, write_performance
from barlake.queries import ALL
from barlake.queries.adapter import bars
from barlake.session import local_session, scratch_dir
from barlake.sources.bars import filter_bars, trading_dates
from barlake.sources.tables import scan_decisions
from barlake.storage import read_months, upsert_bars, write_months

def drain(df) -> None:
    """Compute every row without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    seconds: dict[str, float] = {}

    def timed(name, work):
        started = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - started, 3)
        return result

    # A first pass over a small query, so that JVM start-up is not charged to a query.
    drain(bars(spark, sf_dir).limit(10))
    timed("bars_from_lineitem", lambda: drain(bars(spark, sf_dir)))
    path = scratch_dir(spark, "bench")
    timed("partition_write", lambda: write_months(bars(spark, sf_dir), path))
    table = read_months(spark, path)
    rows = table.count()

    window = dict(start=date(1997, 1, 1), end=date(1997, 12, 31), exchanges="NSE")
    timed("scan_filtered", lambda: drain(filter_bars(table, **window, columns=["date", "close"])))
    timed("trading_dates", lambda: drain(trading_dates(table)))
    timed("topn_decisions", lambda: drain(top_n_by_price(table, top_n=5, unique=True)))
    timed("forward_return", lambda: drain(forward_returns(table)))
    timed("feature_frame", lambda: drain(feature_frame(table)))
    plan = chunk_plan(table.select("date"), chunk_size=252, warmup_days=120)
    timed("chunked_features", lambda: drain(chunked_features(table, plan)))
    stored = scratch_dir(spark, "decisions")
    timed("backtest_stored", lambda: write_decisions(top_n_by_price(table, top_n=5), stored))
    decided = scan_decisions(spark, stored).withColumn("target_weight", F.lit(0.002))

    def performance():
        write_performance(strategy_performance(decided, table), scratch_dir(spark, "performance"))

    timed("performance", performance)
    timed("partition_audit", lambda: drain(q.partition_audit(table)))
    timed("missing_weekdays", lambda: drain(q.missing_weekdays(table, ("exchange", "isin"))))
    newest = table.where((F.year("date") == 2001) & (F.month("date") == 6)).drop("year", "month")
    timed("upsert_month", lambda: upsert_bars(spark, newest.withColumn("close", F.col("close") + 1), path))
    for name in ("latest_as_of", "blackbox_scores", "stream_ingest", "doctor_report"):
        timed(name, lambda: drain(ALL[name][0](spark, sf_dir)))

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "bars": rows,
                "features_bars_per_second": round(rows / seconds["feature_frame"]),
            }
        )
    )


if __name__ == "__main__":
    main()
