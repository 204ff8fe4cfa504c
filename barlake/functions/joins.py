"""Joins on keys that may be NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on equal keys, where NULL equals NULL; the keys of ``left`` are kept."""
    renamed = right.select(
        *[F.col(name).alias(f"_other_{name}") for name in keys],
        *[F.col(name) for name in right.columns if name not in keys],
    )
    same = reduce(
        lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_other_{name}")) for name in keys]
    )
    return left.join(renamed, same, how).drop(*[f"_other_{name}" for name in keys])
