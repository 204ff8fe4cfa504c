"""A change that dies at any step leaves the old table or the new one."""

import shutil
from datetime import date

import pytest

from barlake import journal, storage
from barlake.plans.history import store_bars
from barlake.storage import read_months, upsert_bars

JAN, FEB, MAR = date(2026, 1, 5), date(2026, 2, 5), date(2026, 3, 5)


def closes(spark, path):
    return {(r.exchange, r.date.month, r.symbol): r.close for r in read_months(spark, path).collect()}


def changes(spark, make_bars, path):
    new = make_bars([(FEB, "A", 20.0), (MAR, "A", 30.0)])
    return {
        "clean": lambda: store_bars(spark, new, path, mode="clean"),
        "one exchange": lambda: store_bars(spark, new, path, mode="clean", exchanges=("NSE",)),
        "repair": lambda: store_bars(spark, new, path, mode="repair", partition=("NSE", 2026, 2)),
        "only_missing": lambda: store_bars(spark, new, path, mode="only_missing"),
        "incremental": lambda: store_bars(spark, new, path, mode="incremental"),
        "upsert": lambda: upsert_bars(spark, make_bars([(JAN, "B", 11.0), (FEB, "A", 20.0)]), path),
    }


OLD = {("NSE", 1, "A"): 1.0, ("NSE", 2, "A"): 2.0, ("BSE", 1, "A"): 5.0}
EXPECTED = {
    "clean": {("NSE", 2, "A"): 20.0, ("NSE", 3, "A"): 30.0},
    "one exchange": {("NSE", 2, "A"): 20.0, ("NSE", 3, "A"): 30.0, ("BSE", 1, "A"): 5.0},
    "repair": OLD | {("NSE", 2, "A"): 20.0},
    "only_missing": OLD | {("NSE", 3, "A"): 30.0},
    "incremental": OLD | {("NSE", 2, "A"): 20.0, ("NSE", 3, "A"): 30.0},
    "upsert": OLD | {("NSE", 1, "B"): 11.0, ("NSE", 2, "A"): 20.0},
}


class Died(Exception):
    pass


def dying_after(monkeypatch, steps):
    """Let ``steps`` moves and deletions happen and die at the next one."""
    left = [steps]

    def guarded(work):
        def step(*args, **kwargs):
            if left[0] == 0:
                raise Died
            left[0] -= 1
            return work(*args, **kwargs)
        return step

    for name in ("move_strictly", "delete_path", "write_text"):
        monkeypatch.setattr(journal, name, guarded(getattr(journal, name)))


@pytest.mark.parametrize("mode", EXPECTED)
def test_dies_at_every_step(spark, make_bars, tmp_path, monkeypatch, mode):
    first = str(tmp_path / "first")
    bse = {"exchange": "BSE"}
    store_bars(spark, make_bars([(JAN, "A", 1.0), (FEB, "A", 2.0), (JAN, "A", 5.0, bse)]), first)
    with monkeypatch.context() as broken:
        broken.setattr(storage, "_promote", lambda *_: None)
        changes(spark, make_bars, first)[mode]()
    assert closes(spark, first) == OLD  # journalled, no move begun
    for steps in range(100):
        path = str(tmp_path / f"table{steps}")
        shutil.copytree(first, path)
        try:
            with monkeypatch.context() as broken:
                dying_after(broken, steps)
                journal.settle(spark, path)
            break
        except Died:
            assert closes(spark, path) == (EXPECTED[mode] if steps else OLD)
            journal.settle(spark, path)
            assert closes(spark, path) == EXPECTED[mode]
            assert not (tmp_path / f"table{steps}" / "_pending").exists()
    assert steps > 3 and closes(spark, path) == EXPECTED[mode]


def test_refused_or_unfinished_changes_leave_the_table(spark, make_bars, tmp_path, monkeypatch):
    path = str(tmp_path / "bars")
    store_bars(spark, make_bars([(JAN, "A", 1.0)]), path)

    def die(*_, **__):
        raise Died

    with monkeypatch.context() as broken:
        broken.setattr(journal, "write_text", die)
        with pytest.raises(Died):
            store_bars(spark, make_bars([(JAN, "A", 2.0)]), path, mode="clean")
    assert closes(spark, path) == {("NSE", 1, "A"): 1.0} and not (tmp_path / "bars" / "_pending").exists()
    # A job that died before its journal leaves a folder that goes when it is old enough.
    (tmp_path / "bars" / "_pending" / "dead" / "new").mkdir(parents=True)
    journal.settle(spark, path)
    assert (tmp_path / "bars" / "_pending").exists()
    monkeypatch.setattr(journal, "ABANDONED_SECONDS", -1)
    journal.settle(spark, path)
    assert not (tmp_path / "bars" / "_pending").exists()
    # A folder without months is no table yet.
    empty = str(tmp_path / "empty")
    (tmp_path / "empty").mkdir()
    store_bars(spark, make_bars([(JAN, "A", 3.0)]), empty)
    assert closes(spark, empty) == {("NSE", 1, "A"): 3.0}


def test_a_second_hand_moves_nothing_away(spark, make_bars, tmp_path, monkeypatch):
    """Two settle one change; the slower one meets every state the faster one leaves."""
    path = str(tmp_path / "bars")
    store_bars(spark, make_bars([(JAN, "A", 1.0), (FEB, "A", 2.0)]), path)
    with monkeypatch.context() as broken:
        broken.setattr(storage, "_promote", lambda *_: None)
        store_bars(spark, make_bars([(JAN, "A", 10.0), (MAR, "A", 30.0)]), path, mode="incremental")
    move, inside = journal.move_strictly, []

    def slow(*args):
        if not inside:
            inside.append(1)
            journal.settle(spark, path)  # the other one overtakes
        return move(*args)

    monkeypatch.setattr(journal, "move_strictly", slow)
    journal.settle(spark, path)
    assert closes(spark, path) == {("NSE", 1, "A"): 10.0, ("NSE", 2, "A"): 2.0, ("NSE", 3, "A"): 30.0}
