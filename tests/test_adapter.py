"""Derived bars: line items are shuffled and read once."""

from pathlib import Path

import pytest

from barlake.operators.features import feature_frame
from barlake.operators.returns import forward_returns
from barlake.queries import adapter as a

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("make", [a.bars, a.bars_multi, a.bars_dirty, a.bars_hash])
def test_derived_bars_take_one_scan_and_one_shuffle(spark, make):
    text = plan(make(spark, SF))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_windows_over_instruments_keep_the_placement(spark):
    assert plan(forward_returns(a.bars(spark, SF), max_rows=None)).count("Exchange") == 1


@pytest.mark.parametrize("by", ["isin", "symbol"])
def test_derived_bars_are_sorted_once_and_hold_no_table_of_days(spark, by):
    text = plan(a.bars(spark, SF, by=by))
    assert text.count("Sort [") == 1 and "HashAggregate" not in text


def test_rows_learn_their_blocks_without_being_moved(spark):
    text = plan(forward_returns(a.bars(spark, SF), max_rows=2))
    # Line items by instrument (again for series that stay whole, if any), and the small table of blocks.
    assert text.count("FileScan parquet [l_") <= 2 and text.count("Exchange hashpartitioning") <= 4
    assert "SortMergeJoin" not in text


def test_a_split_frame_writes_nothing_wide(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    feature_frame(a.bars(spark, "/root/testdata/sf0.01", by="symbol"), max_rows=200).count()
    assert {path.name.split("-")[0] for path in set(shared.iterdir()) - before} == {"blocks"}


def test_all_passes_over_blocks_read_one_shuffle(spark):
    lines = plan(feature_frame(a.bars(spark, "/root/testdata/sf0.01", by="symbol"), max_rows=200)).split("\n")
    below = [lines[i + 1 : i + 3] for i, line in enumerate(lines) if "Exchange hashpartitioning(_block#" in line]
    rows = [found for found in below if "Project [date#" in found[0]]
    assert len(rows) > 2 and all("Filter isnotnull(_span#" in found[1] for found in rows)
