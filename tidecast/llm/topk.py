"""Exact top-k by inner product: term-at-a-time accumulation into dense score arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidecast.session import write_scratch

#: Rows and queries that one task holds.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 1024
FIELDS = "query_id long, vec_id long, score long"
#: Scores from here on, up or down, do not fit their column.
TOO_LARGE = 2**63 - 1


def usable(vector: str = "embedding") -> Column:
    """Whether a vector has no null and no component that is not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def quantised(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """_row, vec_id and ``_v``: floor(256 * x) of every component x as a double; whole doubles, since longs end at 2**63."""
    def whole(x: Column) -> Column:
        scaled = F.lit(256.0) * x.cast("double")
        return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled)  # larger doubles are whole

    kept = vectors.select(F.monotonically_increasing_id().alias("_row"), F.col("vec_id").cast("long"), vector).filter(usable(vector) & F.col("vec_id").isNotNull())
    return kept.select("_row", "vec_id", F.transform(vector, whole).alias("_v"))


def postings(vectors: pa.ChunkedArray) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """For every term (component) the rows that hold it and their weights, cut at 2**62; rows None when all rows do."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(flat.offsets.to_numpy())
    values, rows = flat.flatten().to_numpy().clip(-2.0**62, 2.0**62).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
    terms = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.argsort(terms, kind="stable")
    values, rows = values[order], rows[order]
    ends = np.cumsum(np.bincount(terms, minlength=int(sizes.max(initial=0))))
    out = []
    for a, b in zip([0, *ends[:-1]], ends):
        held = values[a:b] != 0
        if held.mean() > 0.5 and b - a == len(sizes):  # a term that most rows hold is kept as a whole column
            out.append((None, values[a:b]))
        else:
            out.append((rows[a:b][held], values[a:b][held]))
    return out


def largest(vectors: pa.ChunkedArray) -> np.ndarray:
    """The largest absolute component of every row, 0 of an empty one."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(flat.offsets.to_numpy())
    out = np.zeros(len(sizes))
    np.maximum.at(out, np.repeat(np.arange(len(sizes)), sizes), np.abs(flat.flatten().to_numpy()))
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    among = np.arange(len(scores))
    if len(scores) > k:
        among = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return among[np.lexsort((ids[among], -scores[among]))][:k]


def _search(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found, ids = [], rows["vec_id"].to_numpy() if rows.num_rows else np.zeros(0, np.int64)
        if rows.num_rows and queries.num_rows:
            lists, sizes = postings(rows["_v"]), largest(rows["_v"])
            place = {r: i for i, r in enumerate(rows["_row"].to_pylist())}
            for row, query, vector in zip(queries["_row"].to_pylist(), queries["vec_id"].to_pylist(), queries["_v"].to_pylist()):
                scores, weights = np.zeros(rows.num_rows, np.int64), [int(x) for x in vector]
                limit = 2**62 // max(1, len(lists) * max(map(abs, weights), default=0))
                if limit:  # else only rows without weight stay below it
                    for weight, (at, values) in zip(weights, lists):
                        if weight and at is None:
                            scores += weight * values
                        elif weight:
                            scores[at] += weight * values
                for i in np.flatnonzero(sizes > limit):  # sums that may pass 64 bits are done in whole numbers of any length
                    exact = sum(a * int(b) for a, b in zip(weights, rows["_v"][int(i)].as_py()))
                    scores[i] = min(max(exact, -TOO_LARGE), TOO_LARGE)
                own = place.get(row)
                others = np.arange(len(scores)) if own is None else np.delete(np.arange(len(scores)), own)
                for i in others[best(scores[others], ids[others], k)]:
                    found.append((query, row, int(ids[i]), int(scores[i])))
        columns = list(zip(*found)) or [[]] * 4
        return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(("query_id", "_row", "vec_id", "score"), columns)})
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding",
          block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows with the highest integer inner product of each query row.

    Rows and queries are hashed into blocks and each pair of blocks is one task: the terms of a query scatter their
    weighted postings into a dense score array, a partition selects the k highest, and these are merged over row
    blocks.  Every row but the query's own takes part, so a repeated row is found; ties go to the smaller vec_id.
    Rows without id or with a null, NaN or infinite component take no part; of vectors of different lengths
    the common components count; scores are exact whatever the components, and a result whose score does not fit a long is an
    error.  Fewer than k rows give fewer ranks.  A very long vector is a row like others, an empty one scores 0
    with every other; an empty table gives an empty result; other columns are ignored.
    """
    stored = write_scratch(quantised(vectors, vector), "vectors")
    queries = stored.filter(is_query)
    counts = stored.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    row_blocks, query_blocks = max(1, -(-counts[0] // block_rows)), max(1, -(-counts[1] // block_queries))

    def spread(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int").alias(own)  # an int and a long of one value hash apart
        return df.select("_row", "vec_id", "_v", block, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    left = spread(queries, "_q", query_blocks, "_r", row_blocks).groupBy("_q", "_r")
    right = spread(stored, "_r", row_blocks, "_q", query_blocks).groupBy("_q", "_r")
    found = left.cogroup(right).applyInArrow(_search(k), "query_id long, _row long, vec_id long, score long")
    ranked = Window.partitionBy("query_id", "_row").orderBy(F.desc("score"), "vec_id")
    error = F.raise_error(F.lit("a score of the result does not fit a long")).cast("long")
    return (found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.when(F.abs("score") < TOO_LARGE, F.col("score")).otherwise(error).alias("score")))
