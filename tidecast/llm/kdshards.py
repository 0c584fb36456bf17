"""Shards of near equal bytes: a k-d tree over metadata, cut at distributed weighted medians.  DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidecast.llm.common import with_running_sum
from tidecast.session import write_scratch

SHARDS = 24
#: Bytes that a row takes besides its text.
ROW_BYTES = 8
#: Cells a node's interval is cut into when its median is searched.
CELLS = 1 << 16
DIMENSIONS = ("source", "lang", "doc_id", "n_chars")
#: Keys behind the coordinate, so that a cut can pass between equal coordinates, texts and ids.
TIES = ("_text", "_doc", "_id")
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


@dataclass
class Cut:
    """A node of ``quota`` leaves from leaf ``node`` on, and where the first ``left`` of them end.

    Rows are ordered by coordinate ``axis``, then ``TIES``.  ``low`` and ``high`` bound the cell the cut is in, key by
    key; ``wanted`` is the weight still missing to its left, ``taken`` whether the cell itself goes left.
    """

    node: int
    quota: int
    axis: int
    wanted: int
    low: list[int]
    high: list[int]
    step: int = 0
    taken: bool = False
    done: bool = False
    left: int = field(init=False)

    def __post_init__(self):
        self.left = self.quota // 2


def coordinate(df: DataFrame, name: str) -> Column:
    """A long whose order is that of a number or time; other values lie in the order of their hash."""
    kind, value = dict(df.dtypes)[name], F.col(f"`{name}`")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return value.cast("long")
    if kind in ("float", "double") or kind.startswith("decimal"):
        bounded = F.greatest(F.least(value.cast("double") * 65536, F.lit(4e18)), F.lit(-4e18))
        return F.when(~F.isnan(bounded), bounded.cast("long"))
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(value.cast("timestamp"))
    return F.when(value.isNotNull(), F.shiftrightunsigned(F.xxhash64(value), 2))


def points(docs: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """One thin row per document: doc_id, size, text_crc32, the coordinates ``_x`` and the tie keys; written once.

    A missing column counts as null; nulls lie below every value.
    """
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long")
    axes = [coordinate(docs, d) if d in docs.columns else F.lit(None).cast("long") for d in dimensions]
    thin = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.coalesce(F.crc32("text"), F.lit(0).cast("long")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64("text"), 2).alias("_text"), F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long")), 2).alias("_doc"),
        F.monotonically_increasing_id().alias("_id"), F.array(*axes).alias("_x"))
    return write_scratch(thin, "points")


def _joined(rows: DataFrame, cuts: Sequence[Cut]) -> DataFrame:
    """Rows with the key bounds of the cut through their node, null where there is none.

    The cuts are a table of longs with at most one row per leaf, which is broadcast.
    """
    def cell(v: int) -> str:
        return "CAST('-9223372036854775808' AS BIGINT)" if v == LOWEST else f"{v}L"

    def line(c: Cut) -> str:
        width = max(1, -(-(c.high[c.step] - c.low[c.step] + 1) // CELLS))
        return "(" + ", ".join(map(cell, (c.node, c.axis, width, c.left, int(c.taken), c.step, c.wanted, *c.low, *c.high))) + ")"

    names = ["node", "_axis", "_cells", "_left", "_taken", "_step", "_wanted", *[f"_low{i}" for i in range(4)], *[f"_high{i}" for i in range(4)]]
    table = rows.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(map(line, cuts))} AS t({', '.join(names)})")
    joined = rows.join(F.broadcast(table), "node", "left")
    return joined.withColumn("_key0", F.coalesce(F.get("_x", F.col("_axis").cast("int")), F.lit(LOWEST)))


def _keys() -> list[Column]:
    return [F.col("_key0"), *[F.col(t) for t in TIES]]


def split(rows: DataFrame, cuts: Sequence[Cut]) -> DataFrame:
    """Send the rows right of their node's cut to the right child, whose number is that of its first leaf."""
    right = F.col("_taken") == 0
    for i, key in reversed(list(enumerate(_keys()))):
        right = (key > F.col(f"_high{i}")) | ((key >= F.col(f"_low{i}")) & right)
    moved = F.col("node") + F.when(F.coalesce(right, F.lit(False)), F.col("_left")).otherwise(F.lit(0).cast("long"))
    return _joined(rows, cuts).withColumn("node", moved).select(*rows.columns)


def _narrow(rows: DataFrame, cuts: list[Cut]) -> None:
    """One round of the search: weigh the cells of every open cut's interval and keep the one the cut is in."""
    keys = _keys()
    cell = rows_in = None
    for i, key in enumerate(keys):
        inside = key.between(F.col(f"_low{i}"), F.col(f"_high{i}"))
        rows_in = inside if rows_in is None else rows_in & inside
        # differences of wide coordinates pass 64 bits, so they are taken as doubles, which keeps their order
        at = F.floor((key.cast("double") - F.col(f"_low{i}").cast("double")) / F.col("_cells").cast("double")) if i == 0 else \
            F.floor((key - F.col(f"_low{i}")) / F.col("_cells"))
        cell = F.when(F.col("_step") == i, at) if cell is None else cell.when(F.col("_step") == i, at)
    found = _joined(rows, cuts).filter(rows_in).groupBy("node", "_wanted", cell.cast("long").alias("_cell")).agg(
        F.sum("size").alias("_sum"), F.count(F.lit(1)).alias("_n"),
        *[F.min(k).alias(f"_min{i}") for i, k in enumerate(keys)], *[F.max(k).alias(f"_max{i}") for i, k in enumerate(keys)])
    order = Window.partitionBy("node").orderBy("_cell")
    found = found.withColumn("_end", F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    hit = found.filter((F.col("_end") >= F.col("_wanted")) & (F.col("_end") - F.col("_sum") < F.col("_wanted")))
    by_node = {c.node: c for c in cuts}
    for r in hit.collect():  # one row per node
        c = by_node[r["node"]]
        c.wanted -= r["_end"] - r["_sum"]
        for i in range(c.step, 4):
            c.low[i], c.high[i] = (r[f"_min{i}"], r[f"_max{i}"]) if i == c.step or r["_n"] == 1 else (LOWEST, HIGHEST)
        if r["_n"] == 1:
            c.done, c.taken = True, 2 * c.wanted >= r["_sum"]
        elif float(c.high[c.step]) - float(c.low[c.step]) == 0 if c.step == 0 else c.high[c.step] == c.low[c.step]:
            c.step += 1
            c.low[c.step], c.high[c.step] = r[f"_min{c.step}"], r[f"_max{c.step}"]


def grow(rows: DataFrame, shards: int, axes: int) -> DataFrame:
    """Add ``node``, the leaf of every row, after splitting level by level until every node is one leaf.

    Per level: one aggregation finds the extent of every node in every dimension, and a few more narrow the cell
    of its weighted median.  Each returns one row per node.  The thin rows are written once per level and never shuffled.
    """
    rows, nodes, whole = rows.withColumn("node", F.lit(0).cast("long")), {0: shards}, None
    while max(nodes.values()) > 1:
        x = [F.col("_x")[i] for i in range(axes)]
        extent = rows.groupBy("node").agg(F.sum("size").alias("w"), *[F.min(c).alias(f"a{i}") for i, c in enumerate(x)],
                                          *[F.max(c).alias(f"b{i}") for i, c in enumerate(x)]).collect()
        spans = {r["node"]: [(r[f"b{i}"] or 0) - (r[f"a{i}"] or 0) for i in range(axes)] for r in extent}
        whole = whole or spans.get(0, [0] * axes)
        cuts = []
        for r in extent:
            if nodes[r["node"]] < 2:
                continue
            wide = [s / w if w else 0.0 for s, w in zip(spans[r["node"]], whole)]
            axis = wide.index(max(wide))
            low, high = r[f"a{axis}"], r[f"b{axis}"]
            cut = Cut(r["node"], nodes[r["node"]], axis, 0, [LOWEST] * 4, [HIGHEST] * 4)
            cut.wanted = r["w"] * cut.left // cut.quota
            cut.low[0], cut.high[0] = (LOWEST if low is None else low - 1 if low > LOWEST else low), (LOWEST if high is None else high)
            cuts.append(cut)
        rows = write_scratch(_settled(rows, cuts), "points") if cuts else rows
        nodes = {k: v for n, q in nodes.items() for k, v in (((n, q // 2), (n + q // 2, q - q // 2)) if q > 1 else ((n, q),))}
    return rows


def _settled(rows: DataFrame, cuts: list[Cut]) -> DataFrame:
    for c in cuts:  # nothing is to go left: the cut lies before every row
        if c.wanted <= 0:
            c.done, c.low, c.high = True, [LOWEST] * 4, [HIGHEST] * 4
    nulls = {c.node: c for c in cuts if not c.done}
    if nulls:  # rows without the coordinate lie below all others
        _narrow_nulls(rows, list(nulls.values()))
    while open_cuts := [c for c in cuts if not c.done]:
        _narrow(rows, open_cuts)
    return split(rows, cuts)


def _narrow_nulls(rows: DataFrame, cuts: list[Cut]) -> None:
    """Decide whether a cut lies among the rows without its coordinate, and leave out those rows if not."""
    missing = F.col("_key0") == LOWEST
    for r in _joined(rows, cuts).filter(F.col("_axis").isNotNull() & missing).groupBy("node").agg(F.sum("size").alias("w")).collect():
        c = next(c for c in cuts if c.node == r["node"])
        if r["w"] >= c.wanted:
            c.low[0] = c.high[0] = LOWEST
        else:
            c.wanted -= r["w"]


def kd_shards(docs: DataFrame, shards: int = SHARDS, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """doc_id, size, text_crc32, law (``bytes``), shard, slot (from 0 in every shard) and grown_shard (null), one row per row.

    A node is split across its widest dimension (extent relative to the whole table's; the first of equal ones) at the
    weighted median: at the row where half of its bytes, or the share of the leaves to its left, are reached.  Leaves thus
    have the table's bytes over ``shards``, up to one row per level.  Rows of equal coordinate follow each other by the hash
    of text and of doc_id, so equal texts stay together unless a cut has to pass between them; one group may so be
    spread over shards.  Slots follow doc_id; they are counted over ranges, so no task holds a whole shard.

    Null texts have size 8 and checksum 0; null metadata lies below every value, and missing columns count as null;
    empty and very long texts are rows like others (one longer than a shard makes its shard larger); ties are broken as
    said, and rows equal in all of it are interchangeable; an empty table gives an empty result; other columns are ignored.
    """
    leaves = grow(points(docs, dimensions), shards, len(dimensions)).withColumn("_one", F.lit(1).cast("long"))
    slots = with_running_sum(leaves.select("doc_id", "size", "text_crc32", "_text", "_id", F.col("node").alias("shard"), "_one"),
                             ["doc_id", "_text", "_id"], "_one", ["shard"], name="slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
