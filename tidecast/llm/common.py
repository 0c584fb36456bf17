"""What the operators share: words, row numbers, running sums over globally ordered rows, links to components."""

from __future__ import annotations

import sys
import types
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidecast.session import write_scratch

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, so that tasks on it share what was loaded."""
    home = sys.modules.setdefault("_tidecast_worker", types.ModuleType("_tidecast_worker"))
    return home.__dict__.setdefault(name, {})


def stored(df: DataFrame) -> DataFrame:
    """``df`` itself if its rows are those of files (filtered or projected at most), else a copy in the shared folder."""
    try:
        df.select(df.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        return write_scratch(df, "rows")
    return df


def with_row(df: DataFrame, name: str = "_row", columns: Sequence[str] | None = None) -> DataFrame:
    """The columns (all by default) and each row's file (hashed) and place in it, so that rows with equal ids stay apart.

    ``df`` comes from ``stored``.  However the files are split over tasks, every pass gives a row the same identity.
    """
    place = df.metadataColumn("_metadata")
    row = F.struct(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("row"))
    return df.select(*[F.col(f"`{c}`") for c in (columns or df.columns)], row.alias(name))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of the key columns that also matches nulls with nulls."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def with_running_sum(df: DataFrame, order: Sequence[str], value: str, groups: Sequence[str] = (),
                     name: str = "_before") -> DataFrame:
    """Add the sum of ``value`` over the rows that come earlier in ``order``, within each of ``groups``.

    The rows are cut into ranges of the order, so that a group of any size is spread over tasks; a small table
    with one row per range and group gives what precedes each range.  The cut rows are written, since ranges
    are found by sampling and must be the same for both.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in (*groups, *order)])
    ranged = write_scratch(ranged.withColumn("_range", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy(*groups, "_range").agg(F.sum(value).alias("_sum"))
    prior = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*groups, "_range", F.coalesce(F.sum("_sum").over(prior), F.lit(0)).alias("_base"))
    inside = (Window.partitionBy("_range", *groups).orderBy(*[F.col(c) for c in order])
              .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(sums, same_keys(local, sums, ["_range", *groups]), "left")
    return joined.select(*[local[c] for c in df.columns], (F.col("_base") + F.col("_local")).cast("long").alias(name))


def components(edges: DataFrame) -> DataFrame:
    """The smallest reachable node ``root`` of every ``node`` that has a link; ``edges`` has longs ``u`` and ``v``.

    Alternates two steps until nothing changes: every node hands its larger neighbours, then its smaller ones,
    to the smallest.  Each step is a partial minimum and a join; its links are written to the shared folder.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    edges, before = write_scratch(edges, "links"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = write_scratch(large.distinct(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = write_scratch(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
