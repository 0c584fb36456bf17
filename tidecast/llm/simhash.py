"""SimHash fingerprints of whole texts, linked within a Hamming distance by pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidecast.llm.common import components, stored, with_row
from tidecast.session import write_scratch

BITS, SEGMENTS, DISTANCE = 64, 4, 3
WIDTH = BITS // SEGMENTS
#: Fingerprints of a bucket that one task compares with as many others, and runs compared by shifting.
CHUNK, SHORT = 1024, 16
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Shingles whose bits are counted together.
COUNTED = 1 << 16


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """A bit is set if it is set in over half of the shingles' hashes; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) >= words_per_shingle:
        starts, ends = starts[:len(words) - words_per_shingle + 1], ends[words_per_shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    total, hashed = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(starts), COUNTED):
        cuts = zip(starts[i:i + COUNTED].tolist(), ends[i:i + COUNTED].tolist())
        hashes = np.array([hashed(joined[a:b], 42) for a, b in cuts], ">u8")
        total += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(starts)).view(">u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and ``fp``, the fingerprint's 64 bits as a signed long, and the row's ``_row``; written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t.as_py()) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.int64())], ["doc_id", "_row", "fp"])

    rows = with_row(docs, columns=["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "_row", "text")
    return write_scratch(rows.mapInArrow(run, "doc_id long, _row struct<file: long, row: long>, fp long"), "fingerprints")


def near(a: np.ndarray, b: np.ndarray, start) -> np.ndarray:
    """Whether fingerprints differ in at most ``DISTANCE`` bits, with the chains that begin at segment ``start``
    within budget.

    The first l segments of the ring from ``start`` may differ in at most l * DISTANCE / SEGMENTS bits; only
    pairs that pass go on to the next segment, and the chain of all segments is the full check.
    """
    difference = a ^ b
    alive = np.ones(difference.shape, bool)
    total = np.zeros(difference.shape, np.uint8)
    for length in range(1, SEGMENTS + 1):
        segment = (difference >> np.uint64(WIDTH) * ((np.uint64(start) + np.uint64(length - 1)) % np.uint64(SEGMENTS))) & np.uint64((1 << WIDTH) - 1)
        total += np.bitwise_count(segment)
        alive &= total <= length * DISTANCE // SEGMENTS
        if not alive.any():
            break
    return alive


def _forest(fps: np.ndarray, reps: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Links every row of a bucket to the smallest it is connected with, by comparing blocks of rows."""
    n = len(fps)
    links = np.concatenate([near(fps[i:i + 256, None], fps[None, :], start) for i in range(0, n, 256)])
    label = np.arange(n)
    while True:
        lower = np.array([label[row].min() for row in links])
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    tied = np.flatnonzero(label != np.arange(n))
    return reps[tied], reps[label[tied]]


def _link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the runs of rows of equal bucket, of a task's sorted rows."""
    names, held = ["u", "v"], None

    def links(rows: list[np.ndarray], last: bool):
        bucket, fps, reps, start = rows[0], rows[1].view(np.uint64), rows[2], rows[3]
        edges = np.flatnonzero(np.any([rows[0][1:] != rows[0][:-1], rows[4][1:] != rows[4][:-1]], axis=0)) + 1
        begins, stops = np.concatenate([[0], edges]), np.concatenate([edges, [len(bucket)]])
        if not last:
            begins, stops = begins[:-1], stops[:-1]
        keep = stops[-1] if len(stops) else 0
        us, vs = [], []
        short = (stops - begins > 1) & (stops - begins <= SHORT)
        at = np.concatenate([np.arange(a, b) for a, b in zip(begins[short], stops[short])] or [np.zeros(0, np.int64)])
        end = np.repeat(stops[short], (stops - begins)[short])
        for shift in range(1, SHORT):
            left, end = at[at + shift < end], end[at + shift < end]
            at = left
            if not len(left):
                break
            found = left[near(fps[left], fps[left + shift], start[left].astype(np.uint64))]
            us.append(reps[found])
            vs.append(reps[found + shift])
        for a, b in zip(begins[stops - begins > SHORT], stops[stops - begins > SHORT]):
            u, v = _forest(fps[a:b], reps[a:b], int(start[a]))
            us.append(u)
            vs.append(v)
        pairs = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in pairs], names), [r[keep:] for r in rows]

    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows)]
        if len(rows[0]):
            out, held = links(rows, last=False)
            yield out
    if held is not None and len(held[0]):
        yield links(held, last=True)[0]


def near_links(classes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links ``u``, ``v`` between distinct fingerprints ``fp``, enough to connect all that differ in at most ``DISTANCE`` bits.

    Two such fingerprints have a segment from which every chain on the ring is within its budget: it is equal
    and the next differs in one bit at most, so one half of that is equal too.  Segment and half make a bucket.
    A bucket with more than ``chunk`` members is cut into chunks, and every pair of chunks is a task's work.
    """
    keys = []
    for i in range(SEGMENTS):
        own = F.shiftrightunsigned("fp", i * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1))
        after = F.shiftrightunsigned("fp", (i + 1) % SEGMENTS * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1))
        for half, shift in enumerate((0, WIDTH // 2)):
            part = F.shiftrightunsigned(after, shift).bitwiseAND(F.lit((1 << WIDTH // 2) - 1))
            keys.append(F.shiftleft(own, 16) + F.shiftleft(part, 8) + F.lit(i * 2 + half))
    rows = classes.select("fp", F.explode(F.array(*keys)).alias("bucket"))
    sizes = rows.groupBy("bucket").count().filter("count > 1").select("bucket", F.ceil(F.col("count") / chunk).alias("_chunks"))
    rows = rows.join(sizes, "bucket").withColumn("_own", F.pmod(F.xxhash64("fp"), F.col("_chunks")))
    other = F.when(F.col("_chunks") == 1, F.array(F.lit(0).cast("long"))).when(
        F.col("_chunks") == 2, F.array(F.lit(1).cast("long"))).otherwise(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1), lambda c: c != F.col("_own")))
    # of two chunks all rows meet in one task; of more, each pair of chunks does
    paired = rows.withColumn("_other", F.explode(other)).withColumn("_pair", F.when(
        F.col("_chunks") <= 2, F.lit(0).cast("long")).otherwise(
        F.least("_own", "_other") * F.col("_chunks") + F.greatest("_own", "_other")))
    dealt = paired.select("bucket", "fp", F.col("fp").alias("rep"), F.pmod(F.col("bucket"), F.lit(256)).alias("_i"), "_pair")
    dealt = dealt.withColumn("_i", F.shiftright("_i", 1)).repartition("bucket", "_pair").sortWithinPartitions("bucket", "_pair", "rep")
    return dealt.mapInArrow(_link_rows, "u long, v long").distinct()


def linked(prints: DataFrame, first, chunk: int = CHUNK) -> DataFrame:
    """Per distinct fingerprint ``fp``: ``first``, the least value of that column over all rows its links reach.

    Equal fingerprints are one class before candidates are searched, so copies cost a partial aggregation.  Links run
    between fingerprints, so classes without a doc_id connect others like any.
    """
    classes = write_scratch(prints.groupBy("fp").agg(F.min(first).alias("first")), "classes")
    roots = components(near_links(classes, chunk))
    placed = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    placed = write_scratch(placed, "placed")
    least = placed.groupBy("root").agg(F.min("first").alias("first"))
    return placed.select("fp", "root").join(least, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable; one row per row.

    Null and empty texts have fingerprint zero and are linked like any other, and so are rows without doc_id; a component
    that has none at all is null.  Repeated rows and very long texts are rows like others; other columns are ignored.  An
    empty table gives an empty result.
    """
    prints = fingerprints(stored(docs))
    members = linked(prints, F.col("doc_id"), chunk).select(F.col("fp").alias("_fp"), F.col("first").alias("component_id"))
    return prints.join(members, prints["fp"] == members["_fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of every component: that with the smallest doc_id, of equal ids, or without any, the first row in file order.

    Null and empty texts are one fingerprint and so at most one row; rows without doc_id come after those with one; repeated
    rows are copies; very long texts are compared whole; an empty table stays empty and all columns pass through.
    """
    docs = stored(docs)
    first = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "_row")
    kept = linked(fingerprints(docs), first).select(F.col("first._row").alias("__kept")).distinct()
    numbered = with_row(docs, "__dedup_row")
    return numbered.join(kept, numbered["__dedup_row"] == kept["__kept"], "left_semi").select(*docs.columns)
