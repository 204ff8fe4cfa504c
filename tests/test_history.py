import hashlib
import shutil
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from barlake import storage
from barlake.operators import quality as q
from barlake.operators.manifest import build_fetch_manifest
from barlake.plans import history as h
from barlake.plans.publish import publish_history, publish_status
from barlake.schema import BARS, ContractError, FETCH_MANIFEST, conform
from barlake.sources import bars as scans
from barlake.sources.raw import read_raw
from barlake.sources.formats import formats, inspect_format, overlapping_formats
from barlake.sources.inventory import list_files, usage_by_prefix
from barlake.sources.tables import missing_sources, usable_sources
from barlake.storage import read_months, upsert_bars, write_months

NSE = "SYMBOL,SERIES,OPEN,HIGH,LOW,CLOSE,LAST,PREVCLOSE,TOTTRDQTY,TOTTRDVAL,TIMESTAMP,TOTALTRADES,ISIN"
UDIFF = (
    "TradDt,BizDt,Sgmt,Src,FinInstrmTp,FinInstrmId,ISIN,TckrSymb,SctySrs,OpnPric,HghPric,LwPric,"
    "ClsPric,PrvsClsgPric,TtlTradgVol,TtlTrfVal,TtlNbOfTxsExctd"
)
BSE = "SC_CODE,SC_NAME,SC_GROUP,OPEN,HIGH,LOW,CLOSE,PREVCLOSE,NO_TRADES,NO_OF_SHRS,NET_TURNOV"


def nse_row(symbol="ABC", day="02-JAN-2026", close="100.5", isin="INE1", series="EQ"):
    return f"{symbol},{series},100,101,99,{close},100,99.5,1000,100500,{day},10,{isin}"


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join([*lines, ""])
    if name.lower().endswith(".zip"):
        with zipfile.ZipFile(folder / name, "w") as archive:
            archive.writestr(name[:8] + ".csv", text)
    else:
        (folder / name).write_text(text)
    return str(folder)


def rows_of(spark, path, exchange="NSE", **options):
    return h.ingest_files(spark, path, exchange, **options).rows


def test_legacy_zip(spark, tmp_path):
    path = put(tmp_path, "cm02JAN2026bhav.csv.zip", NSE, nse_row())
    ingested = h.ingest_files(spark, path, "NSE")
    (row,) = ingested.rows.collect()
    assert (row.date, row.isin, row.symbol, row.series) == (date(2026, 1, 2), "INE1", "ABC", "EQ")
    assert [f.format_id for f in ingested.files.collect()] == ["nse_legacy_cm_bhavcopy_v1"]
    assert (row.vwap, row.adj_factor, row.adj_close, row.trades) == (100.5, 1.0, 100.5, 10)
    assert row.deliverable_qty is None


def test_old_file_without_isin_and_trades(spark, tmp_path):
    header = "SYMBOL,SERIES,OPEN,HIGH,LOW,CLOSE,PREVCLOSE,TOTTRDQTY,TOTTRDVAL,TIMESTAMP"
    path = put(tmp_path, "cm01APR1996bhav.csv", header, "ABC,EQ,1,2,1,2,1,10,20,1-APR-1996")
    (row,) = rows_of(spark, path).collect()
    assert (row.isin, row.date, row.trades) == ("ABC", date(1996, 4, 1), None)


def test_headers_may_differ_between_files_and_have_nameless_columns(spark, tmp_path):
    put(tmp_path, "cm02JAN2026bhav.csv", NSE, nse_row())
    fields = "SERIES,SYMBOL,,OPEN,HIGH,LOW,CLOSE,PREV CLOSE,TOT_TRD_QTY,TOTTRDVAL,TIMESTAMP,isin"
    put(tmp_path, "cm05JAN2026bhav.csv.zip", "", fields, "EQ,XYZ,x,1,2,1,2,1,10,20,05-JAN-2026,INE7")
    put(tmp_path, "cm06JAN2026bhav.csv", NSE)  # a header only
    path = put(tmp_path, "cm07JAN2026bhav.csv", "\ufeff" + fields, "EQ,XYZ,x,1,2,1,2,1,10,20,07-JAN-2026,INE7")
    rows = {(r.symbol, r.date.day): (r.close, r.isin) for r in rows_of(spark, path).collect()}
    assert rows == {("ABC", 2): (100.5, "INE1"), ("XYZ", 5): (2.0, "INE7"), ("XYZ", 7): (2.0, "INE7")}


def test_two_digit_year(spark, tmp_path):
    path = put(tmp_path, "cm13JUL2020bhav.csv", NSE, nse_row(day="13-JUL-20"))
    assert rows_of(spark, path).first().date == date(2020, 7, 13)


def test_bse_legacy_takes_date_from_name_and_code_as_identity(spark, tmp_path):
    path = put(tmp_path, "EQ010108_CSV.ZIP", BSE, "500325,RIL,A,1,2,1,2,1,5,10,20")
    (row,) = rows_of(spark, path, "BSE").collect()
    assert (row.date, row.isin, row.symbol, row.series) == (date(2008, 1, 1), "500325", "500325", "A")


def udiff_row(symbol, close="100", isin="INE9", volume="1000"):
    return f"2024-08-01,2024-08-01,CM,BSE,STK,1,{isin},{symbol},A,100,101,99,{close},99,{volume},100000,7"


def test_variant_symbol_gives_way_to_plain_one(spark, tmp_path):
    name = "BhavCopy_BSE_CM_0_0_0_20240801_F_0000.CSV"
    path = put(tmp_path, name, UDIFF, udiff_row("ASHOKLEY#", volume="5"), udiff_row("ASHOKLEY"), udiff_row("ONLY#", isin="INE8"))
    rows = {r.symbol: r.volume for r in rows_of(spark, path, "BSE").collect()}
    assert rows == {"ASHOKLEY": 1000, "ONLY#": 1000}


def test_ragged_blank_and_quoted_lines(spark, tmp_path):
    path = put(
        tmp_path, "cm02JAN2026bhav.csv", NSE, nse_row() + ",extra,more", "", ",,,,,,,,,,,,",
        '"X, Y",EQ,1,2,1,2,1,1,10,20,02-JAN-2026,1,INE2', "   ",
    )
    assert {r.symbol for r in rows_of(spark, path).collect()} == {"ABC", "X, Y"}


def test_short_row_and_bad_number_are_incomplete(spark, tmp_path):
    path = put(tmp_path, "cm02JAN2026bhav.csv", NSE, nse_row(), "ABC,EQ,1,2", nse_row(symbol="BAD").replace("100500", "n/a"))
    with pytest.raises(ContractError, match="2 incomplete market rows"):
        rows_of(spark, path)
    aside = str(tmp_path / "aside")
    assert rows_of(spark, path, quarantine=aside).count() == 1
    assert spark.read.parquet(aside).count() == 2
    assert rows_of(spark, path, quarantine=aside, strict=False).count() == 2


def test_missing_required_column_names_the_format(spark, tmp_path):
    path = put(tmp_path, "cm02JAN2026bhav.csv", NSE.replace("TOTTRDVAL", "OTHER"), nse_row())
    with pytest.raises(ContractError, match="nse_legacy_cm_bhavcopy_v1.*TOTTRDVAL"):
        rows_of(spark, path)


def test_no_files(spark, tmp_path):
    (tmp_path / "readme.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        rows_of(spark, str(tmp_path))


def test_empty_and_html_files_are_skipped_in_a_build_only(spark, tmp_path):
    raw = tmp_path / "raw" / "NSE"
    put(raw, "cm02JAN2026bhav.csv.zip", NSE, nse_row())
    (raw / "cm03JAN2026bhav.csv.zip").write_bytes(b"")
    (raw / "cm04JAN2026bhav.csv.zip").write_text("\n <!DOCTYPE html><p>blocked</p>")
    (raw / "cm05JAN2026bhav.CSV").write_text("<html>no</html>")
    found = h.ingest_files(spark, str(raw), "NSE", allow_skipped=True)
    reasons = {r.path.rsplit("/", 1)[1][:4]: r.reason for r in found.skipped.collect()}
    assert reasons == {"cm03": "empty", "cm04": "html", "cm05": "html"}
    with pytest.raises(ContractError, match="without data"):
        h.ingest_files(spark, str(raw), "NSE")
    manifest = h.build_history(spark, str(tmp_path / "raw"), str(tmp_path / "bars"), exchanges=("NSE",))
    (row,) = manifest.collect()
    assert (row.row_count, row.symbols, row.source_raw_count, row.status) == (1, 1, 1, "built")
    assert row.format_ids == ["nse_legacy_cm_bhavcopy_v1"] and len(row.md5) == 32
    assert row.source_md5s == [hashlib.md5((raw / "cm02JAN2026bhav.csv.zip").read_bytes()).hexdigest()]
    (text,) = h.as_json_lists(manifest).collect()
    assert text.format_ids == '["nse_legacy_cm_bhavcopy_v1"]'


def test_repeated_rows_merge_and_conflicts_fail(spark, tmp_path):
    put(tmp_path / "same", "cm02JAN2026bhav.csv", NSE, nse_row(), nse_row())
    summary = h.ingest_once(spark, str(tmp_path / "same"), "NSE", str(tmp_path / "flat")).first()
    assert (summary.rows, summary.exchanges, summary.missing_deliverable_qty) == (1, ["NSE"], 1)
    put(tmp_path / "clash", "cm02JAN2026bhav.csv", NSE, nse_row(), nse_row(close="99"))
    with pytest.raises(ContractError, match="duplicate"):
        h.ingest_once(spark, str(tmp_path / "clash"), "NSE", str(tmp_path / "flat2"))


def months(spark, path):
    rows = read_months(spark, path).groupBy("exchange", "year", "month").agg(F.sum("close").alias("c"))
    return {(r.exchange, r.year, r.month): r.c for r in rows.collect()}


def test_write_modes(spark, make_bars, tmp_path):
    path = str(tmp_path / "bars")
    jan, feb = date(2026, 1, 5), date(2026, 2, 5)
    bse = {"exchange": "BSE"}
    old = make_bars([(jan, "A", 1.0), (feb, "A", 2.0), (jan, "A", 5.0, bse)])
    new = make_bars([(jan, "A", 10.0), (date(2026, 3, 5), "A", 30.0)])
    h.store_bars(spark, old, path)
    with pytest.raises(FileExistsError):
        h.store_bars(spark, new, path)
    h.store_bars(spark, new, path, mode="only_missing")
    expected = {("NSE", 2026, 1): 1.0, ("NSE", 2026, 2): 2.0, ("NSE", 2026, 3): 30.0, ("BSE", 2026, 1): 5.0}
    assert months(spark, path) == expected
    before = {r.path: r.md5 for r in list_files(spark, path, digest=True).collect()}
    h.store_bars(spark, new, path, mode="repair", partition=("nse", 2026, 1))
    assert months(spark, path) == expected | {("NSE", 2026, 1): 10.0}
    after = {r.path: r.md5 for r in list_files(spark, path, digest=True).collect()}
    kept = {p for p in before if "exchange=NSE/year=2026/month=1/" not in p}
    assert {p: before[p] for p in kept if "_SUCCESS" not in p}.items() <= after.items()
    with pytest.raises(FileNotFoundError):
        h.store_bars(spark, new, path, mode="repair", partition=("NSE", 2020, 1))
    h.store_bars(spark, make_bars([(feb, "A", 7.0)]), path, mode="incremental")
    assert months(spark, path)[("NSE", 2026, 2)] == 7.0
    h.store_bars(spark, make_bars([(feb, "A", 8.0)]), path, mode="clean", exchanges=("NSE",))
    assert months(spark, path) == {("NSE", 2026, 2): 8.0, ("BSE", 2026, 1): 5.0}
    h.store_bars(spark, make_bars([(feb, "A", 9.0)]), path, mode="clean")
    assert months(spark, path) == {("NSE", 2026, 2): 9.0}


def test_build_fails_on_duplicate_keys(spark, make_bars, tmp_path):
    bars = make_bars([(date(2026, 1, 5), "A", 1.0), (date(2026, 1, 5), "A", 2.0)])
    with pytest.raises(ContractError, match="duplicate"):
        h.store_bars(spark, bars, str(tmp_path / "bars"))


def test_upsert_and_replace_day(spark, make_bars, tmp_path):
    path, day = str(tmp_path / "bars"), date(2026, 1, 5)
    write_months(make_bars([(day, "A", 1.0), (day, "B", 2.0), (date(2026, 2, 1), "A", 9.0)]), path)
    upsert_bars(spark, make_bars([(day, "A", 3.0), (day, "C", 4.0)]), path)

    def closes():
        return {(r.symbol, r.date.month): r.close for r in read_months(spark, path).collect()}

    expected = {("A", 1): 3.0, ("B", 1): 2.0, ("C", 1): 4.0, ("A", 2): 9.0}
    assert closes() == expected
    upsert_bars(spark, make_bars([(day, "A", 3.0), (day, "C", 4.0)]), path)
    assert closes() == expected
    upsert_bars(spark, make_bars([(day, "A", 5.0)]), path, mode="replace_day")
    assert closes() == {("A", 1): 5.0, ("A", 2): 9.0}


def test_the_later_file_wins_whatever_its_size(spark, make_bars, tmp_path):
    day = date(2026, 1, 5)
    small, large = make_bars([(day, "A", 1.0)]), make_bars([(day, "A", 2.0)] + [(day, f"X{i}", 9.0) for i in range(500)])
    for n, (first, second, expected) in enumerate(((small, large, 2.0), (large, small, 1.0))):
        table = str(tmp_path / f"bars{n}")
        for name, rows in (("1", first), ("2", second)):
            rows.coalesce(1).write.parquet(str(tmp_path / f"new{n}" / name))
        for order in (("1", "2"), ("2", "1")):
            given = spark.read.parquet(*[str(tmp_path / f"new{n}" / name) for name in order])
            upsert_bars(spark, given.repartition(3), table)
            assert [r.close for r in read_months(spark, table).where("symbol = 'A'").collect()] == [expected]
    # The caller's own order goes before that of files and rows.
    told = given.withColumn("sent", -F.col("close"))
    upsert_bars(spark, told, table, recency=("sent",))
    assert [r.close for r in read_months(spark, table).where("symbol = 'A'").collect()] == [1.0]


def test_upsert_keeps_the_last_of_repeated_keys_and_refuses_null_keys(spark, make_bars, tmp_path):
    path, day = str(tmp_path / "bars"), date(2026, 1, 5)

    def closes():
        return {(r.symbol, r.date.month): r.close for r in read_months(spark, path).collect()}

    twice = make_bars([(day, "A", 3.0), (day, "A", 4.0)]).coalesce(1)
    upsert_bars(spark, twice, path)
    assert closes() == {("A", 1): 4.0} and read_months(spark, path).count() == 1
    upsert_bars(spark, make_bars([(day, "A", 6.0), (day, "A", 5.0)]).coalesce(1), path)
    assert closes() == {("A", 1): 5.0} and read_months(spark, path).count() == 1
    with pytest.raises(ContractError, match="null"):
        upsert_bars(spark, make_bars([(day, "B", 1.0, {"isin": None})]), path)
    assert closes() == {("A", 1): 5.0} and not (tmp_path / "bars" / "_pending").exists()


def test_upsert_that_died_is_finished_by_the_next(spark, make_bars, tmp_path, monkeypatch):
    path, day = str(tmp_path / "bars"), date(2026, 1, 5)
    write_months(make_bars([(day, "A", 1.0), (date(2026, 2, 2), "A", 2.0)]), path)

    def die(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as broken:
        broken.setattr(storage, "_promote", die)
        with pytest.raises(RuntimeError):
            upsert_bars(spark, make_bars([(day, "A", 7.0)]), path)
    assert {r.close for r in read_months(spark, path).collect()} == {1.0, 2.0}
    # Dies again after the old month is gone and before the new one is in its place.
    shutil.rmtree(tmp_path / "bars" / "exchange=NSE" / "year=2026" / "month=1")
    upsert_bars(spark, make_bars([(date(2026, 2, 2), "A", 8.0)]), path)
    assert {r.close for r in read_months(spark, path).collect()} == {7.0, 8.0}


def test_missing_months_open_only_the_months_asked_for(spark, make_bars, tmp_path):
    path = str(tmp_path / "bars")
    write_months(make_bars([(date(2026, m, 5), "A", float(m)) for m in (1, 2, 4, 5)]), path)
    gaps = scans.missing_months(spark.read.parquet(path), "NSE", date(2026, 2, 10), date(2026, 4, 3))
    assert [(r.year, r.month) for r in gaps.collect()] == [(2026, 3)]
    plan = spark._jvm.PythonSQLUtils.explainString(gaps._jdf.queryExecution(), "simple")
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "year" in scan.split("PartitionFilters: ")[1].split("PushedFilters: ")[0]


def test_wide_and_header_like_lines_are_read_alike_from_csv_and_zip(spark, tmp_path):
    lead = [f"X{i}" for i in range(70)]
    header = ",".join([*lead, "SYMBOL", "SERIES", "OPEN", "HIGH", "LOW", "CLOSE", "PREVCLOSE", "TOTTRDQTY", "TOTTRDVAL", "TIMESTAMP"])
    row = ",".join(["0"] * 70 + ["ABC", "EQ", "1", "2", "1", "2", "1", "10", "20", "1-APR-1996"])
    body = "\n".join([header, row, header, row + ",extra", "\n"])
    (tmp_path / "plain").mkdir()
    (tmp_path / "zipped").mkdir()
    (tmp_path / "plain" / "cm01APR1996bhav.csv").write_text(body)
    with zipfile.ZipFile(tmp_path / "zipped" / "cm01APR1996bhav.csv.zip", "w") as archive:
        archive.writestr("cm01APR1996bhav.csv", body)
    seen = []
    for kind in ("plain", "zipped"):
        raw = read_raw(spark, str(tmp_path / kind), "NSE")
        assert [r.missing_fields for r in raw.files.collect()] == [[]]
        seen.append(sorted((r.symbol, r.close) for r in raw.rows.collect()))
    assert seen[0] == seen[1] == [("ABC", "2"), ("ABC", "2"), ("SYMBOL", "CLOSE")]


def test_monthly_scan_prunes_partitions(spark, make_bars, tmp_path):
    path = str(tmp_path / "bars")
    write_months(make_bars([(date(2026, m, 5), "A", float(m)) for m in range(1, 7)]), path)
    table = spark.read.parquet(path)
    narrow = scans.filter_bars(table, start=date(2026, 2, 1), end=date(2026, 3, 31), exchanges="NSE", columns=["date", "close"])
    assert sorted(r.close for r in narrow.collect()) == [2.0, 3.0]
    plan = table.sparkSession._jvm.PythonSQLUtils.explainString(narrow._jdf.queryExecution(), "simple")
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    partitions = scan.split("PartitionFilters: ")[1].split("PushedFilters: ")[0]
    assert all(name in partitions for name in ("exchange#", "year#", "month#"))
    assert "GreaterThanOrEqual(date" in scan and "struct<date:date,close:double>" in scan
    with pytest.raises(FileNotFoundError, match="2026, 7"):
        scans.scan_month_range(table, "NSE", date(2026, 5, 1), date(2026, 7, 2))
    with pytest.raises(FileNotFoundError):
        scans.scan_month(table, "NSE", 2025, 1)
    with pytest.raises(FileNotFoundError):
        scans.scan_history(table, "BSE", date(2026, 5, 1))
    everything = scans.scan_for_strategies(table, "NSE", date(2026, 6, 30), [5, None])
    assert everything.count() == 6
    recent = scans.scan_for_strategies(table, "NSE", date(2026, 6, 30), [30, 5])
    assert recent.count() == 1
    assert scans.months_between(date(2025, 11, 30), date(2026, 1, 1)) == [(2025, 11), (2025, 12), (2026, 1)]


def test_flat_paths_and_required_columns(spark, eight_bars, tmp_path):
    eight_bars.write.parquet(str(tmp_path / "a" / "x"))
    eight_bars.drop("adj_factor").write.parquet(str(tmp_path / "b"))
    assert scans.scan_paths(spark, [str(tmp_path / "a")]).count() == 8
    with pytest.raises(ContractError):
        scans.scan_bars(spark, str(tmp_path / "a" / "x"), columns=["nope"])
    eight_bars.drop("close").write.parquet(str(tmp_path / "c"))
    with pytest.raises(ContractError, match="close"):
        scans.scan_bars(spark, str(tmp_path / "c"))
    with pytest.raises(ValueError):
        scans.point_in_time(eight_bars, lookback_days=3)


def test_invalid_ohlc_fails_the_audit(spark, make_bars):
    bars = make_bars([(date(2026, 1, 5), "A", 95.0, {"high": 90.0, "low": 99.0}), (date(2026, 1, 5), "B", 5.0)])
    partitions = q.partition_audit(bars)
    row = q.global_audit(partitions, bars).first()
    assert (row.invalid_ohlc_count, row.passed, row.rows) == (1, False, 2)
    assert q.global_audit(q.partition_audit(bars), bars.withColumn("x", F.lit(1))).first().unexpected_columns == ["x"]


def test_audit_reports_and_publishing(spark, make_bars, tmp_path):
    source, target = str(tmp_path / "bars"), str(tmp_path / "public")
    bars = make_bars([(date(2026, m, 5), "A", float(m)) for m in (1, 2)])
    write_months(bars, source)
    _, audit = h.audit_history(spark, source, str(tmp_path / "report"))
    fetched = spark.createDataFrame([("NSE", date(2026, 1, 5), "failed")], "exchange string, date date, status string")
    resolved = fetched.withColumn("status", F.lit("validated"))

    def publish(manifest=None, fetch=resolved, audit=audit):
        manifest = manifest if manifest is not None else h.partition_manifest(spark, source)
        return publish_history(spark, source, target, audit=audit, fetch_manifest=fetch, manifest=manifest)

    with pytest.raises(ContractError, match="unresolved"):
        publish(fetch=fetched)
    with pytest.raises(ContractError, match="audit"):
        publish(audit=audit.withColumn("passed", F.lit(False)))
    assert publish() == [("NSE", 2026, 1), ("NSE", 2026, 2)]
    assert publish() == []
    upsert_bars(spark, make_bars([(date(2026, 2, 6), "A", 3.0)]), source)
    assert publish() == [("NSE", 2026, 2)]
    assert read_months(spark, f"{target}/bars").count() == 3

    # What lies at the target counts, not what was once recorded.
    at = tmp_path / "public" / "bars" / "exchange=NSE" / "year=2026"
    shutil.rmtree(at / "month=1")
    write_months(make_bars([(date(2026, 2, 9), "X", 1.0)]), f"{target}/bars")
    write_months(make_bars([(date(2026, 3, 9), "X", 1.0)]), f"{target}/bars")
    status = publish_status(spark, target, h.partition_manifest(spark, source)).collect()
    assert {r.object_key.split("/part")[0][-7:]: r.status for r in status} == {"onth=01": "MISSING", "month=2": "STALE", "month=3": "EXTRA"}
    with pytest.raises(ContractError, match="1 months differ"):
        publish(manifest=h.partition_manifest(spark, source).withColumn("row_count", F.when(F.col("month") == 1, 99).otherwise(F.col("row_count"))))
    assert not (at / "month=1").exists()
    assert publish() == [("NSE", 2026, 1), ("NSE", 2026, 2)] and publish() == []
    assert sorted(r.symbol for r in read_months(spark, f"{target}/bars").collect()) == ["A", "A", "A", "X"]


def test_formats(spark):
    boundaries = [("NSE", date(2024, 7, 7), "legacy"), ("NSE", date(2024, 7, 8), "udiff"),
                  ("BSE", date(2024, 7, 29), "legacy"), ("BSE", date(2024, 7, 30), "udiff")]
    for exchange, day, kind in boundaries:
        row = inspect_format(spark, exchange, day).first()
        assert kind in row.format_id and row.filename and row.urls
    with pytest.raises(ContractError):
        inspect_format(spark, "BSE", date(2006, 12, 31))
    assert overlapping_formats(formats(spark)).isEmpty()


def test_fetch_manifest_from_present_files(spark, tmp_path):
    path = put(tmp_path / "raw", "cm02JAN2024bhav.csv.zip", NSE, nse_row())
    days = spark.createDataFrame([("NSE", date(2024, 1, 2)), ("NSE", date(2024, 1, 3))], "exchange string, date date")
    manifest = build_fetch_manifest(days, formats(spark), list_files(spark, path, digest=True))
    assert manifest.columns == FETCH_MANIFEST.names
    rows = {r.date.day: r for r in manifest.collect()}
    assert (rows[2].status, rows[2].last_error, len(rows[2].sha256)) == ("downloaded", "", 64)
    assert rows[2].bytes > 0 and rows[3].status == "expected" and rows[3].bytes is None
    stored = str(tmp_path / "manifest")
    h.store_fetch_manifest(spark, manifest, stored)
    other = manifest.where(F.day("date") == 3).withColumns(
        {"exchange": F.lit("BSE"), "status": F.lit("failed")}
    )
    assert h.store_fetch_manifest(spark, other, stored).count() == 3
    again = h.store_fetch_manifest(spark, manifest.withColumn("attempts", F.lit(2)), stored)
    assert again.count() == 3
    assert {r.attempts for r in again.where("exchange = 'NSE'").collect()} == {2}
    sources = usable_sources(manifest, "NSE")
    assert missing_sources(sources.select(F.regexp_replace("local_path", "^file:/*", "/").alias("local_path")), list_files(spark, path)).isEmpty()
    gone = spark.createDataFrame([("/nowhere.csv",)], "local_path string")
    assert missing_sources(gone, list_files(spark, path)).count() == 1
    assert usage_by_prefix(list_files(spark, path), path).first().objects == 1


def test_rows_are_not_shuffled_to_their_header(spark, tmp_path):
    """Nearly all rows have one header: a shuffle by it would send them to one task."""
    put(tmp_path / "raw", "cm02JAN2026bhav.csv.zip", NSE, nse_row())
    (tmp_path / "raw" / "cm05JAN2026bhav.csv").write_text("\n".join([NSE, nse_row(), ""]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = read_raw(spark, str(tmp_path / "raw"), "NSE").rows
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert rows.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan


def test_refreshed_files_of_duplicates_are_written_by_many_tasks(spark):
    """A table sorted and written by one task holds all of it there."""
    from pathlib import Path

    from barlake.queries.jobs import upsert_duplicates

    before = {n: spark.conf.get(n) for n in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.checkpoint.dir")}
    shared = Path(before["spark.checkpoint.dir"])
    known = set(shared.glob("refreshed-*"))
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        upsert_duplicates(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before["spark.sql.adaptive.coalescePartitions.enabled"])
    (folder,) = set(shared.glob("refreshed-*")) - known
    assert all(len(list((folder / name).glob("part-*"))) > 1 for name in ("1", "2", "3"))


def test_upsert_leaves_other_days_with_their_files(spark, make_bars, tmp_path, monkeypatch):
    """Only bars of refreshed days are shuffled to be merged; a month that lies in many files is put together again."""
    path = str(tmp_path / "bars")
    days = [date(2026, 1, d) for d in range(1, 21)]
    write_months(make_bars([(day, symbol, 1.0) for day in days for symbol in "ABCDEFGHIJ"]), path)
    refreshed = make_bars([(days[-1], "A", 2.0), (days[-1], "Z", 3.0)])
    dealt, write = [], storage.write_months

    def watched(bars, *args, by_month=False, **kwargs):
        dealt.append(not by_month)
        write(bars, *args, by_month=by_month, **kwargs)

    monkeypatch.setattr(storage, "write_months", watched)
    expected = {(day, symbol): 1.0 for day in days for symbol in "ABCDEFGHIJ"} | {(days[-1], "A"): 2.0, (days[-1], "Z"): 3.0}
    for limit, whole in ((16, False), (0, True)):
        monkeypatch.setattr(storage, "MONTH_FILES", limit)
        upsert_bars(spark, refreshed, path)
        assert dealt.pop() is whole
        got = {(r.date, r.symbol): r.close for r in read_months(spark, path).collect()}
        assert got == expected and read_months(spark, path).count() == len(expected)


def test_raw_lines_are_not_written_before_they_are_parsed(spark, tmp_path):
    """Scratch has the headers and parsed rows without the columns that repeat others, and no copy of the lines."""
    lines = [nse_row(f"S{i}", isin=f"I{i}") for i in range(50)]
    ingested = h.ingest_files(spark, put(tmp_path / "raw", "cm02JAN2026bhav.csv.zip", NSE, *lines), "NSE")
    tables = [spark.read.parquet(path) for path in ingested.staged]
    assert sorted(table.count() for table in tables) == [1, 50]
    assert not any(name.startswith("adj_") for table in tables for name in table.columns)
    first = ingested.rows.orderBy("symbol").first()
    assert (first.adj_close, first.adj_open, first.adj_factor) == (first.close, first.open, 1.0)
    assert ingested.rows.columns == [*BARS.names, "path"]


def test_files_are_rendered_after_rows_are_dealt_by_day(spark, make_bars, tmp_path):
    """Prices that equal the open come back to the bit, with the sign of zeros and texts that are no numbers."""
    from barlake.queries.jobs import write_raw_files

    day = date(2026, 1, 2)
    prices = {"A": (5.0, 5.0, 5.0, 5.0), "B": (0.0, -0.0, 0.0, -0.0), "C": (None, None, 1.5, None)}
    fields = ("open", "high", "low", "close")
    bars = make_bars([(day, symbol, 1.0, dict(zip(fields, own)) | {"exchange": "BSE"}) for symbol, own in prices.items()])
    undated = make_bars([(None, "D", 2.0, {"exchange": "BSE"})])
    write_raw_files(spark, bars.unionByName(undated), str(tmp_path / "raw"))
    text = (tmp_path / "raw" / "BSE" / "BhavCopy_BSE_CM_0_0_0_20260102_F_0000.CSV").read_text().splitlines()
    written = {line.split(",")[0]: line.split(",")[2:6] for line in text[1:]}
    assert written == {symbol: ["" if v is None else str(v) for v in own] for symbol, own in prices.items()}
    assert len(list((tmp_path / "raw" / "BSE").iterdir())) == 2
    texts = bars.where("symbol = 'A'").withColumn("close", F.lit("n/a")).drop("adj_close")
    write_raw_files(spark, texts, str(tmp_path / "texts"))
    text = (tmp_path / "texts" / "BSE" / "BhavCopy_BSE_CM_0_0_0_20260102_F_0000.CSV").read_text().splitlines()
    assert text[1].split(",")[2:6] == ["5.0", "5.0", "5.0", "n/a"]
