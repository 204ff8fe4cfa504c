"""Every registered query against its SQL in DuckDB, at the smallest scale."""

from datetime import date

import pytest

import __spark_entry__ as registry
from barlake.queries.stored import file_order
from barlake.schema import BAR_ORDER
from tools.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, connection, name):
    assert compare(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) == ""


def test_every_query_has_an_oracle():
    assert set(registry.OWN) <= set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def test_order_in_files_is_that_of_a_plain_search(spark, make_bars, tmp_path):
    """Rows out of order are counted within batches, over their ends, and with NULLs first; ends alone are shuffled."""
    symbols = ["B", "A", None, "\u00e9", "Z", "A", "A", "C"]
    rows = [(date(2026, 1, 1 + (i // 5) % 3), "S", 1.0, {"symbol": symbols[i % 8], "isin": f"I{i % 3}"}) for i in range(40)]
    bars = make_bars(rows).coalesce(1)
    bars.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    keys = [(r[0], (symbols[i % 8] or "").encode(), r[3]["isin"]) for i, r in enumerate(rows)]
    expected = sum(after < before for before, after in zip(keys, keys[1:]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = file_order(stored)
        assert [tuple(r) for r in found.collect()] == [("NSE", 40, expected)] and 0 < expected < 39
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    bars.sortWithinPartitions(*BAR_ORDER).write.parquet(str(tmp_path / "o"))
    assert file_order(spark.read.parquet(str(tmp_path / "o"))).first().out_of_order == 0


def test_hash_symbols_are_derived_once(spark):
    plan = QUERIES["variant_symbol_drop"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "l_suppkey" not in plan
