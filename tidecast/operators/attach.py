"""Bring a small per-series table to the rows it belongs to."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where a null equals a null: a series without a name is a series."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_right_{k}`")) for k in keys])
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str] = (), how: str = "left") -> DataFrame:
    """Add the columns of ``small`` (one row per key) to ``df``.

    Without keys ``small`` is one row, taken as a scalar subquery.  With keys it is an ordinary
    equi-join: the planner broadcasts it only when its measured size allows, and a hot key on the
    row side can be split because nothing here needs the keys kept together.
    """
    extra = [c for c in small.columns if c not in keys]
    if keys:
        return join_on(df, small, keys, how)
    row = small.select(F.struct(*[F.col(f"`{c}`") for c in extra]).alias("_row"))
    packed = df.withColumn("_row", row.scalar())
    return packed.select(*[F.col(f"`{c}`") for c in df.columns],
                         *[F.col("_row").getField(c).alias(c) for c in extra])
