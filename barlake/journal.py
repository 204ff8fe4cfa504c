"""Changes of a partitioned table as a whole: written beside it, journalled, then moved into place.

A change is a folder of the table's ``_pending`` (which scans pass over): new partitions, and a journal
that lists the partitions to put in place and those to drop. Until the journal exists, the change never
happened. From then on it will: any writer, or a reader that finds the moves begun, carries on
where the job that made it stopped. So a job that dies at any step leaves the old table or the
new one. There is one writer to a table at a time; readers and later writers may finish a change
together, as a move succeeds for one of them only. On a store that copies instead of renaming,
a move is not atomic, and a change that is not finished takes its time again.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from barlake.files import (
    delete_path,
    filesystem,
    folders,
    hadoop_path,
    move_strictly,
    partition_folders,
    path_exists,
    read_text,
    write_text,
)

PENDING, NEW, OLD, JOURNAL, STARTED = "_pending", "new", "old", "_JOURNAL", "_STARTED"
_DONE = "done-"
# Changes without a journal are those of jobs that run, or died; after this time they died.
ABANDONED_SECONDS = 24 * 3600
_READ_ATTEMPTS = 20


def _age(spark: SparkSession, path: str) -> float:
    files, target = filesystem(spark, path)
    return time.time() - files.getFileStatus(target).getModificationTime() / 1000


def _forget(spark: SparkSession, path: str, name: str) -> None:
    """Delete a change, and the folder of changes when it was the only one.

    The change loses its name first, in one move: whoever still carries it out finds nothing to move.
    """
    pending = f"{path}/{PENDING}"
    if not name.startswith(_DONE):
        move_strictly(spark, f"{pending}/{name}", f"{pending}/{_DONE}{name}")
        name = _DONE + name
    delete_path(spark, f"{pending}/{name}")
    files, root = filesystem(spark, pending)
    if files.exists(root) and not list(files.listStatus(root)):
        files.delete(root, True)


def prepare(
    spark: SparkSession, path: str, write: Callable[[str], object], check: Callable[[str], object], *,
    drop: Callable[[list[str], list[str]], Iterable[str]] = lambda present, new: (),
) -> list[str]:
    """Write new partitions beside a table, check them and journal the change; returns the partitions.

    ``write`` and ``check`` get the folder of the new partitions. ``drop`` gets the partitions that the
    table has and the new ones, and tells which of the former go. If any of them raises, the table
    stays as it was. ``settle`` carries the change out.
    """
    name = uuid.uuid4().hex
    change = f"{path}/{PENDING}/{name}"
    try:
        write(f"{change}/{NEW}")
        new = partition_folders(spark, f"{change}/{NEW}")
        check(f"{change}/{NEW}")
        present = partition_folders(spark, path)
        gone = sorted(set(drop(present, new)) - set(new))
        aside = sorted(set(present) & (set(new) | set(gone)))
        files, _ = filesystem(spark, path)
        for place in aside:
            files.mkdirs(hadoop_path(spark, change, OLD, place).getParent())
        write_text(spark, f"{change}/{JOURNAL}.tmp", json.dumps({"new": new, "aside": aside}))
    except BaseException:
        delete_path(spark, change)
        _forget(spark, path, name)
        raise
    if not move_strictly(spark, f"{change}/{JOURNAL}.tmp", f"{change}/{JOURNAL}"):
        raise OSError(f"cannot journal the change {change}")
    return new


def _carry_out(spark: SparkSession, path: str, name: str) -> None:
    """Move the partitions of a journalled change; can be repeated, and done by several at once."""
    change = f"{path}/{PENDING}/{name}"
    try:
        plan = json.loads(read_text(spark, f"{change}/{JOURNAL}"))
        write_text(spark, f"{change}/{STARTED}", "", in_folder=True)
    except Exception:
        if not path_exists(spark, f"{change}/{JOURNAL}"):
            return  # finished by another
        raise
    files, _ = filesystem(spark, path)
    new, aside = set(plan["new"]), set(plan["aside"])
    for place in sorted(new | aside):
        # What lies in the old place goes aside once: the place it goes to is taken after that.
        if place in aside:
            move_strictly(spark, f"{path}/{place}", f"{change}/{OLD}/{place}")
        if place in new:
            files.mkdirs(hadoop_path(spark, path, place).getParent())
            moved = move_strictly(spark, f"{change}/{NEW}/{place}", f"{path}/{place}")
            if not moved and path_exists(spark, f"{change}/{NEW}/{place}"):
                raise OSError(f"{path}/{place} was written by another job")
    _forget(spark, path, name)


def settle(spark: SparkSession, path: str, *, started_only: bool = False) -> None:
    """Carry out the changes of a table that were journalled, and forget those of jobs that died before.

    Readers need only those whose moves have begun: before, the table is whole.
    """
    for name in folders(spark, f"{path}/{PENDING}"):
        change = f"{path}/{PENDING}/{name}"
        if name.startswith(_DONE):
            if not started_only:
                _forget(spark, path, name)
        elif path_exists(spark, f"{change}/{JOURNAL}"):
            if not started_only or path_exists(spark, f"{change}/{STARTED}"):
                _carry_out(spark, path, name)
        elif not started_only and path_exists(spark, change) and _age(spark, change) > ABANDONED_SECONDS:
            _forget(spark, path, name)


def _moving(spark: SparkSession, path: str) -> bool:
    changes = [name for name in folders(spark, f"{path}/{PENDING}") if not name.startswith(_DONE)]
    return any(path_exists(spark, f"{path}/{PENDING}/{name}/{STARTED}") for name in changes)


def read_settled(spark: SparkSession, path: str, load: Callable[[], DataFrame]) -> DataFrame:
    """What ``load`` lists while no change of the table is being moved.

    Jobs that listed their files before a change and read them after it fail, as they do for any
    table that is overwritten; they do not see half of it.
    """
    for _ in range(_READ_ATTEMPTS):
        settle(spark, path, started_only=True)
        frame = load()
        if not _moving(spark, path):
            return frame
    raise OSError(f"{path} keeps changing")
