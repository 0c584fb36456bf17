"""Order-dependent building blocks that never pull a whole series into one task.

Rows are sorted by series and time over all tasks and cut into buckets of at most ``BUCKET_ROWS`` rows, whatever
their density; an order may ask for clock buckets instead, which need no sort.  The counts of the buckets form a
small table whose running sum gives the position of the first row of every bucket, so that:

* a row's position is its bucket's start plus its rank inside the bucket;
* a cut at given positions only needs the rank of rows in the buckets the cut falls into;
* a sliding frame is evaluated in blocks of about ``block_rows`` rows, where a bucket is also copied to
  the neighbouring blocks whose frames reach it.

A chain of such operators stores the sorted rows once: ``order_index`` returns them with their bucket and an order that
holds the bucket table, and every operator given both starts from there.

Null keys are a series like any other and null times come first.  Rows of equal time and ties are in any order.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidecast.functions.timekeys import MICROS_PER_SECOND, col_of, epoch_days, micros
from tidecast.operators.attach import join_on
from tidecast.session import write_scratch

BLOCK_ROWS = 65_536
DAY = 86_400
#: Buckets of a sorted table hold two to this power rows.
BUCKET_BITS = 14
BUCKET_ROWS = 1 << BUCKET_BITS
#: Widths of clock buckets in seconds that are tried in turn.
WIDTHS = (30 * DAY, DAY, 3_600, 60, 1)


@dataclass(frozen=True)
class Order:
    """How the rows of a table are ordered: by ``time`` (then ``ties``) within each value of ``keys``.

    ``bucket_seconds`` asks for clock buckets of that width; by default rows are cut by their place in the order.
    ``layout`` may hold the bucket table of the rows, kept by ``with_layout`` or ``order_index`` so that several passes
    over the same rows count them once; further keys may repeat those rows afterwards.  Columns may be added to the
    rows; where rows are taken out, ``filtered`` drops the table and keeps the buckets.
    """

    time: str
    keys: tuple[str, ...] = ()
    ties: tuple[str, ...] = ()
    bucket_seconds: int | None = None
    layout: DataFrame | None = None
    layout_keys: tuple[str, ...] = ()
    longest: int | None = None
    series: int | None = None

    def bucket(self) -> Column:
        """The clock bucket of a row."""
        width = self.bucket_seconds * MICROS_PER_SECOND
        return F.floor(micros(self.time) / F.lit(width)).cast("long")

    def columns(self) -> list[Column]:
        return [F.col(f"`{c}`") for c in (self.time, *self.ties)]

    def key_columns(self) -> list[Column]:
        return [F.col(f"`{c}`") for c in self.keys]


def fit_bucket(df: DataFrame, order: Order, rows: int = BLOCK_ROWS) -> Order:
    """The widest bucket whose fullest instance holds at most ``rows`` rows, found by counting."""
    for seconds in WIDTHS:
        candidate = replace(order, bucket_seconds=seconds)
        largest = (df.groupBy(*order.key_columns(), candidate.bucket().alias("_bucket")).count()
                   .agg(F.max("count").alias("n")).first()["n"])
        if largest is None or largest <= rows:
            return candidate
    return candidate


def bucketed(df: DataFrame, order: Order) -> DataFrame:
    """Add ``_bucket``, a number that grows with the order of the rows of a series.

    Unless the order asks for clock buckets, the rows are cut into ranges of (series, time, ties), sorted there and
    numbered; the result is written, since ranges are found by sampling and must be the same for all readers.
    """
    if order.bucket_seconds is not None:
        return df.withColumn("_bucket", order.bucket())
    if "_bucket" in df.columns:  # rows of an order index
        return df
    if order.layout is not None:
        raise ValueError("the rows of an order index must keep their _bucket")
    place = [*order.key_columns(), *order.columns()]
    ranged = df.repartitionByRange(*place).sortWithinPartitions(*place)
    return write_scratch(ranged.withColumn("_bucket", F.shiftright(F.monotonically_increasing_id(), BUCKET_BITS)), "ranged")


def order_index(df: DataFrame, order: Order) -> tuple[DataFrame, Order]:
    """Sort and store the rows once for any number of ordered operators.

    Returns the stored rows with ``_bucket``, which the operators hand on, and the order with their bucket table.  The
    last one's result may drop the column.
    """
    if "_bucket" in df.columns:
        raise ValueError("the rows have a _bucket already")
    placed = bucketed(df, replace(without_layout(order), bucket_seconds=None))
    plain = replace(without_layout(order), bucket_seconds=None)
    table = write_scratch(bucket_table(placed, plain), "layout")
    longest, series = table.agg(F.max("_total"), F.count(F.when(F.col("_start") == 0, 1))).first()
    return placed, replace(plain, layout=table, layout_keys=order.keys, longest=longest or 0, series=series)


def filtered(order: Order) -> Order:
    """The order for some of the rows of an index: their buckets hold, their counts don't."""
    return without_layout(order)


def table_of(placed: DataFrame, order: Order) -> DataFrame:
    """The bucket table, kept or counted."""
    return bucket_table(placed, order) if order.layout is None else order.layout


def bucket_table(df: DataFrame, order: Order) -> DataFrame:
    """One row per series and ``_bucket``: rows in it, first position, position after the last, series total, and
    the first time and the length of the series in days.
    """
    days = epoch_days(order.time)
    counted = (df.groupBy(*order.key_columns(), "_bucket")
               .agg(F.count(F.lit(1)).alias("_n"), F.min(days).alias("_low"), F.max(days).alias("_high")))
    series = Window.partitionBy(*order.keys)
    running = series.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    return counted.select(
        *order.keys, "_bucket", "_n", F.sum("_n").over(running).alias("_end"), F.sum("_n").over(series).alias("_total"),
        F.max("_n").over(series).alias("_fullest"), F.min("_low").over(series).alias("_t0"),
        (F.max("_high").over(series) - F.min("_low").over(series)).alias("_span")
    ).withColumn("_start", F.col("_end") - F.col("_n"))


def with_layout(df: DataFrame, order: Order) -> Order:
    """Count clock buckets once and keep the table, for operators that pass over the same rows repeatedly.

    The rows of an order index are counted already.  Unless the order says how wide they are, buckets are narrowed until ``BLOCK_ROWS`` rows fill none, or one second.
    ``longest`` is then the number of rows of the longest series and ``series`` the number of series.
    """
    if order.layout is not None and "_bucket" in df.columns:
        return order
    for seconds in WIDTHS if order.bucket_seconds is None else (order.bucket_seconds,):
        clock = replace(without_layout(order), bucket_seconds=seconds)
        table = write_scratch(bucket_table(bucketed(df, clock), clock), "layout")
        longest, series, fullest = table.agg(F.max("_total"), F.count(F.when(F.col("_start") == 0, 1)), F.max("_n")).first()
        if (fullest or 0) <= BLOCK_ROWS:
            break
    return replace(clock, layout=table, layout_keys=order.keys, longest=longest or 0, series=series)


def without_layout(order: Order) -> Order:
    return replace(order, layout=None, layout_keys=(), longest=None, series=None)


def with_position(df: DataFrame, order: Order, name: str = "pos", total: str | None = None) -> DataFrame:
    """Add the 0-based position of every row in its series, and optionally the number of rows."""
    placed = bucketed(df, order)
    starts = table_of(placed, order).select(*order.keys, "_bucket", "_start", "_total")
    inside = Window.partitionBy(*order.keys, "_bucket").orderBy(*order.columns())
    out = (join_on(placed, starts, [*order.keys, "_bucket"])
           .withColumn(name, F.col("_start") + F.row_number().over(inside) - 1))
    if total:
        out = out.withColumn(total, F.col("_total"))
    kept = [*df.columns, name] + ([total] if total else [])
    return out.select(*[F.col(f"`{c}`") for c in kept])


def with_segment(df: DataFrame, order: Order, cuts: Callable[[Column], Sequence[Column]],
                 name: str = "segment") -> DataFrame:
    """Number each row by how many of the cut positions lie at or before it.

    ``cuts`` maps the length of a series to increasing positions.  Buckets without a cut inside get
    their number from the small table; only rows of the other buckets are ranked.
    """
    placed = bucketed(df, order)
    table = table_of(placed, order)
    marks = F.array(*[c.cast("long") for c in cuts(F.col("_total"))])
    table = table.withColumn("_cuts", marks).select(
        *order.keys, "_bucket", "_start", "_cuts",
        F.size(F.filter("_cuts", lambda c: c <= F.col("_start"))).alias("_low"),
        F.size(F.filter("_cuts", lambda c: c < F.col("_end"))).alias("_high"))
    tagged = join_on(placed, table, [*order.keys, "_bucket"])
    whole = tagged.filter(F.col("_low") == F.col("_high")).withColumn(name, F.col("_low"))
    inside = Window.partitionBy(*order.keys, "_bucket").orderBy(*order.columns())
    split = (tagged.filter(F.col("_low") < F.col("_high"))
             .withColumn("_pos", F.col("_start") + F.row_number().over(inside) - 1)
             .withColumn(name, F.size(F.filter("_cuts", lambda c: c <= F.col("_pos")))))
    kept = [F.col(f"`{c}`") for c in (*df.columns, name)]
    return whole.select(*kept).unionByName(split.select(*kept))


def halo_blocks(df: DataFrame, order: Order, before: int, after: int, block_rows: int | None = None,
                ends: bool = False) -> tuple[DataFrame, list[str]]:
    """Copy rows into blocks so that a frame of ``before``/``after`` rows never leaves its block.

    Returns the table with ``_block`` and ``_home`` (true in the one block that owns the row) and the
    columns to partition by.  The copies only concern buckets near the edge of a block.  With ``ends`` rows
    also get the first time ``_t0`` and the length ``_span`` of their series in days.
    """
    size = block_rows or max(BLOCK_ROWS, 4 * (before + after))
    placed = bucketed(df, order)
    table, keys = (bucket_table(placed, order), order.keys) if order.layout is None else (order.layout, order.layout_keys)
    own = F.floor(F.col("_start") / size).cast("long")
    low, high = own, own
    if after:
        low = F.greatest(F.lit(0).cast("long"), F.floor((F.col("_start") - F.col("_fullest") - after) / size).cast("long"))
    if before:
        last = F.max(own).over(Window.partitionBy(*keys))
        high = F.least(last, F.floor((F.col("_end") + before - 1) / size).cast("long"))
    extra = ["_t0", "_span"] if ends else []
    kept = [*[F.col(f"`{c}`") for c in df.columns], *extra]
    if not (before or after):
        table = table.select(*keys, "_bucket", own.alias("_block"), *extra)
        out = join_on(placed, table, [*keys, "_bucket"])
        return out.select(*kept, "_block", F.lit(True).alias("_home")), [*order.keys, "_block"]
    table = table.select(*keys, "_bucket", own.alias("_own"), low.alias("_from"), high.alias("_to"), *extra)
    out = (join_on(placed, table, [*keys, "_bucket"])
           .withColumn("_block", F.explode(F.sequence(F.least("_from", "_own"), F.greatest("_to", "_own"))))
           .withColumn("_home", F.col("_block") == F.col("_own")))
    return out.select(*kept, "_block", "_home"), [*order.keys, "_block"]


def framed(df: DataFrame, order: Order, before: int, after: int,
           build: Callable[[DataFrame, WindowSpec, WindowSpec], DataFrame],
           block_rows: int | None = None) -> DataFrame:
    """Run ``build(rows, ordered_window, whole_block)`` over halo blocks and keep each row once."""
    blocked, parts = halo_blocks(df, order, before, after, block_rows)
    block = Window.partitionBy(*parts)
    return build(blocked, block.orderBy(*order.columns()), block).filter("_home").drop("_block", "_home")


def running_counts(df: DataFrame, keys: Sequence[str], value: str, count: str) -> DataFrame:
    """Add ``before``: the sum of ``count`` over smaller ``value``s of the same key.

    ``df`` holds distinct values per key, null and NaN not among them.  They are ordered like the rows of a series, so a
    key with any number of values is cut into buckets of bounded size.
    """
    order = Order(value, tuple(keys))
    placed = bucketed(df, order)
    sums = placed.groupBy(*order.key_columns(), "_bucket").agg(F.sum(count).alias("_sum"))
    prior = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(prior), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(col_of(value)).rowsBetween(Window.unboundedPreceding, -1)
    return (join_on(placed, sums, [*keys, "_bucket"])
            .withColumn("before", (F.col("_base") + F.coalesce(F.sum(count).over(inside), F.lit(0))).cast("long"))
            .select(*df.columns, "before"))


#: Modulus of the bits that decide an exchange, and rounds of the keyed shuffle.
SHUFFLE_PRIME, SHUFFLE_ROUNDS = (1 << 31) - 1, 32


def shuffle_keys(seed: int, rounds: int = SHUFFLE_ROUNDS) -> list[tuple[int, int, int]]:
    """Three numbers below the modulus per round."""
    draw = random.Random(seed)
    return [(draw.randrange(SHUFFLE_PRIME), draw.randrange(1, SHUFFLE_PRIME), draw.randrange(SHUFFLE_PRIME)) for _ in range(rounds)]


def partner(position: Column, total: Column, seed: int) -> Column:
    """A keyed shuffle of 0 … total-1 whose every value is computed by itself: no hash ranks, no sort.

    In each round x and (key - x) mod total are exchanged or not, as a bit of the greater of the two says; both get the
    same bit, so every round, and the whole, is a bijection whatever the total.
    """
    keys = F.array(*[F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip("kms", key)]) for key in shuffle_keys(seed)])

    def turn(x: Column, key: Column) -> Column:
        other = F.pmod(key["k"] - x, total)
        top = F.greatest(x, other) % SHUFFLE_PRIME
        mixed = (top * key["m"] + key["s"]) % SHUFFLE_PRIME
        return F.when((mixed * mixed) % SHUFFLE_PRIME % 2 == 1, other).otherwise(x)

    return F.aggregate(keys, position.cast("long"), turn)
