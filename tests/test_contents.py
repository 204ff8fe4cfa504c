"""Digests of months and audits of what changed."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from barlake.operators import normalize
from barlake.operators.quality import partition_audit
from barlake.plans import history as h
from barlake.plans.contents import changed_months, compare_contents, incremental_audit, month_contents, refresh_states
from barlake.plans.publish import publish_history, publish_status
from barlake.schema import ContractError
from barlake.storage import read_months, write_months


def contents(spark, bars, path):
    write_months(bars, path, overwrite="static")
    return {(r.exchange, r.year, r.month): r.content for r in month_contents(read_months(spark, path)).collect()}


def test_contents_are_those_of_the_rows(spark, make_bars, tmp_path):
    bars = make_bars([(date(2026, m, d), s, 10.0 * d) for m in (1, 2) for d in (5, 6, 7) for s in "AB"]).cache()
    first = contents(spark, bars, str(tmp_path / "a"))
    assert len(first) == 2 and contents(spark, bars.orderBy(F.desc("symbol")), str(tmp_path / "b")) == first
    changes = {
        "value": bars.withColumn("close", F.when(F.dayofmonth("date") == 5, F.col("close") + 0.01).otherwise(F.col("close"))),
        "null": bars.withColumn("delivery_pct", F.lit(1.0)),
        "repeat": bars.unionByName(bars.where("symbol = 'A' AND dayofmonth(date) = 5")),
        "swap": bars.withColumns({"deliverable_qty": F.lit(7), "trades": F.lit(None).cast("bigint")}),
        "swapped": bars.withColumns({"deliverable_qty": F.lit(None).cast("bigint"), "trades": F.lit(7)}),
    }
    seen = [first[("NSE", 2026, 1)]]
    for i, changed in enumerate(changes.values()):
        seen.append(contents(spark, changed, str(tmp_path / f"c{i}"))[("NSE", 2026, 1)])
    assert len(set(seen)) == len(seen)


def test_only_changed_months_are_read_again(spark, make_bars, tmp_path):
    path, store = str(tmp_path / "bars"), str(tmp_path / "states")
    bars = make_bars([(date(2026, m, 5), s, float(m)) for m in (1, 2, 3) for s in "AB"])
    assert refresh_states(spark, path, store) is None
    write_months(bars, path)
    assert len(changed_months(spark, path, store)[1]) == 3

    def audits():
        partitions, total = incremental_audit(spark, path, store)
        plain, whole = h.audit_history(spark, path)
        assert partitions.columns == plain.columns and set(total.columns) == set(whole.columns)
        assert sorted(map(str, partitions.collect())) == sorted(map(str, plain.collect()))
        assert total.select(*whole.columns).collect() == whole.collect()
        return partitions

    audits()
    assert changed_months(spark, path, store)[1] == []
    # Nothing of the table is scanned, only the states.
    files = refresh_states(spark, path, store).inputFiles()
    assert files and all("/states/" in f for f in files)
    write_months(make_bars([(date(2026, 2, 9), "A", -1.0)]), path)
    assert changed_months(spark, path, store)[1] == [("NSE", 2026, 2)]
    audits()
    h.delete_path(spark, f"{path}/exchange=NSE/year=2026/month=3")
    assert audits().count() == 2
    # A row in a wrong folder: audited whole.
    stray = make_bars([(date(2026, 1, 9), "C", 1.0)])
    stray.drop("exchange").write.parquet(f"{path}/exchange=NSE/year=2026/month=4")
    audits()
    assert not incremental_audit(spark, path, store)[1].first().passed


def test_months_laid_out_anew_are_not_published_again(spark, make_bars, tmp_path):
    source, target = str(tmp_path / "bars"), str(tmp_path / "public")
    days = [(date(2026, m, d), s, float(d)) for m in (1, 2) for d in (5, 6) for s in "AB"]
    write_months(make_bars(days), source)
    fetched = spark.createDataFrame([("NSE", date(2026, 1, 5), "validated")], "exchange string, date date, status string")

    def publish():
        _, audit = h.audit_history(spark, source)
        return publish_history(spark, source, target, audit=audit, fetch_manifest=fetched, manifest=h.partition_manifest(spark, source))

    assert len(publish()) == 2
    rows = make_bars(days).withColumns({"year": F.year("date"), "month": F.month("date")})
    rows.repartition(3, "symbol", "date").write.mode("overwrite").partitionBy("exchange", "year", "month").parquet(source)
    manifest = h.partition_manifest(spark, source)
    assert {r.status for r in publish_status(spark, target, manifest).collect()} == {"STALE"}
    assert {r.status for r in publish_status(spark, target, manifest, source).collect()} == {"OK"}
    assert publish() == []
    # It is recorded, so files alone tell the next time.
    assert {r.status for r in publish_status(spark, target, manifest).collect()} == {"OK"}
    write_months(make_bars([(d, s, c + (d.month == 2)) for d, s, c in days]), source)
    assert publish() == [("NSE", 2026, 2)]
    sides = [month_contents(read_months(spark, p)) for p in (source, f"{target}/bars")]
    assert {r.status for r in compare_contents(*sides).collect()} == {"OK"}


def test_months_laid_out_anew_are_not_dealt_to_three_tasks(spark, make_bars, tmp_path):
    from barlake.queries.contents import _lay_out_anew

    bars = make_bars([(date(2026, m, d), f"S{s}", 10.0 + s) for m in range(1, 7) for d in range(1, 20) for s in range(40)])
    before = {n: spark.conf.get(n) for n in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        _lay_out_anew(bars, str(tmp_path / "anew"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    laid = spark.read.parquet(str(tmp_path / "anew"))
    files = laid.inputFiles()
    assert laid.count() == bars.count() and len(files) >= 18
    assert len({name.split("part-")[1][:5] for name in files}) > 3  # numbers of the tasks that wrote them


def test_prices_that_are_alike_come_back_to_the_bit(spark, make_bars, tmp_path):
    odd = [0.0, -0.0, None, float("nan"), 5.0, float("inf")]
    names = ["open", "high", "low", "close", "adj_open", "adj_close", "vwap"]
    rows = [
        (date(2026, 1, 1 + d), f"S{i}{d}", 7.0, {n: odd[(i * (k + 1) + d * k) % 6] for k, n in enumerate(names)} | {"volume": [0, 3, None][d], "turnover": [15.0, None, 0.0][i % 3]})
        for i in range(6) for d in range(3)
    ]
    bars = make_bars(rows)
    write_months(bars, str(tmp_path / "t"))
    back = read_months(spark, str(tmp_path / "t")).select(*bars.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, bars.collect()))


def test_keys_are_dealt_by_their_number(spark, make_bars, monkeypatch):
    """Tasks that check keys hold some of them, however few bytes these take."""
    monkeypatch.setattr(normalize, "KEYS_PER_TASK", 4)
    assert [normalize.key_tasks(n) for n in (0, 4, 5)] == [1, 1, 2]
    bars = make_bars([(date(2026, m, 5), s, float(m)) for m in (1, 2, 3) for s in "ABCD"])
    assert normalize.assert_bars(bars) is bars
    with pytest.raises(ContractError, match="2 rows with a duplicate"):
        normalize.assert_bars(bars.unionByName(bars.limit(1)))
    with pytest.raises(ContractError, match="isin"):
        normalize.assert_bars(bars.withColumn("isin", F.lit(None).cast("string")))
    holes = bars.unionByName(bars.where("symbol < 'C'")).withColumns(
        {"exchange": F.when(F.month("date") < 3, F.col("exchange")), "symbol": F.when(F.col("symbol") != "B", F.col("symbol"))}
    )
    plain, dealt = partition_audit(holes), partition_audit(holes, tasks=3)
    assert plain.columns == dealt.columns and sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect()))


def test_statistics_of_a_manifest_are_taken_once(spark, make_bars, tmp_path):
    source, target = str(tmp_path / "bars"), str(tmp_path / "public")
    write_months(make_bars([(date(2026, m, 5), s, 1.0) for m in (1, 2) for s in "AB"]), source)
    fetched = spark.createDataFrame([("NSE", date(2026, 1, 5), "validated")], "exchange string, date date, status string")
    taken = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def seen(rows):
        taken.add(1)
        return rows

    manifest = h.partition_manifest(spark, source).withColumn("row_count", seen.asNondeterministic()("row_count"))
    _, audit = h.audit_history(spark, source)
    assert len(publish_history(spark, source, target, audit=audit, fetch_manifest=fetched, manifest=manifest)) == 2
    assert taken.value == 2
