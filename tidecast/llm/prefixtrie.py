"""The trie of conversation prefixes: balanced parentheses per shard, whose shared spines are merged."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidecast.session import write_scratch

#: Nodes after which a task begins another shard, and bytes of a turn's digest.
SHARD_NODES, DIGEST = 1 << 19, 16
#: Parentheses per block of the excess.
BLOCK = 64
#: Bytes of ids that are joined into one piece before they are hashed.
PIECE = 1 << 16
#: Conversations that share a base, and the number of base turns at most, plus one.
FAMILY, SHARED = 100, 6
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODE = ("shard long, kind string, id binary, parent_id binary, conv_id long, parent_conv_id long, depth long, n_convs long, n_children long, "
        "n_leaves long, weighted long, own long, ends_sha256 string, path binary, path_chars binary")


class Parentheses:
    """A tree as a string of parentheses (1 opens), with the minima of its excess per block and over blocks of blocks."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        padded = np.full(-(-max(1, len(bits)) // BLOCK) * BLOCK, np.iinfo(np.int64).max)
        padded[:len(bits)] = self.excess
        self.blocks = padded.reshape(-1, BLOCK)
        size = 1 << (len(self.blocks) - 1).bit_length()
        low = np.full(size, np.iinfo(np.int64).max)
        low[:len(self.blocks)] = self.blocks.min(1)
        self.levels = [low]
        while len(self.levels[-1]) > 1:
            self.levels.append(self.levels[-1].reshape(-1, 2).min(1))
        self.opened = np.cumsum(bits, dtype=np.int64)
        leaf = np.zeros(len(bits), np.int64)
        leaf[:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
        self.leaves = np.cumsum(leaf)

    def findclose(self, opens: np.ndarray, at_once: int = 1 << 15) -> np.ndarray:
        """The parenthesis that closes each one of ``opens``: the first behind it whose excess is lower by one."""
        parts = [self._findclose(opens[i:i + at_once]) for i in range(0, len(opens), at_once)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _findclose(self, opens: np.ndarray) -> np.ndarray:
        wanted, block = self.excess[opens] - 1, opens // BLOCK
        inside = (self.blocks[block] <= wanted[:, None]) & (np.arange(BLOCK) > (opens % BLOCK)[:, None])
        found, at = inside.any(1), block * BLOCK + inside.argmax(1)
        left = np.flatnonzero(~found)
        place, level, low = block[left], np.zeros(len(left), np.int64), wanted[left]
        for up in range(len(self.levels)):  # climb until the right sibling holds the answer, then descend to its first block
            here = level == up
            if not here.any():
                break
            p = place[here]
            sibling = (p % 2 == 0) & (self.levels[up][np.minimum(p + 1, len(self.levels[up]) - 1)] <= low[here]) if up < len(self.levels) - 1 else np.zeros(len(p), bool)
            place[here] = np.where(sibling, p + 1, p // 2)
            level[here] = np.where(sibling, -up - 1, up + 1)
        for down in range(len(self.levels) - 1, 0, -1):
            here = level == -down - 1
            child = place[here] * 2
            place[here] = np.where(self.levels[down - 1][child] <= low[here], child, child + 1)
            level[here] = -down
        at[left] = place * BLOCK + (self.blocks[place] <= low[:, None]).argmax(1)
        return at

    def subtrees(self) -> tuple[np.ndarray, np.ndarray]:
        """Of every node in preorder: how many nodes its subtree has, and how many leaves."""
        opens = np.flatnonzero(self.bits)
        close = self.findclose(opens)
        return (close - opens + 1) // 2, self.leaves[close] - self.leaves[opens] + (self.leaves[opens] - np.concatenate([[0], self.leaves])[opens])


def _prefix_ids(path: bytes, depth: int) -> list[bytes]:
    """Digests of the path's prefixes of 0 to ``depth`` turns."""
    state, out = hashlib.md5(), [hashlib.md5(b"").digest()]
    for d in range(depth):
        state.update(path[d * DIGEST:(d + 1) * DIGEST])
        out.append(state.copy().digest())
    return out


def _shared(a: bytes, b: bytes) -> int:
    """How many turns two paths share at their beginning."""
    n, d = min(len(a), len(b)), 0
    if a[:n] == b[:n]:
        return n // DIGEST
    while a[d:d + DIGEST] == b[d:d + DIGEST]:
        d += DIGEST
    return d // DIGEST


def _encode(shard: int, rows: list[tuple[bytes, bytes, int, int, str]]) -> pa.RecordBatch:
    """The nodes of one shard: its sorted, distinct paths are written as parentheses and read off their ranks."""
    bits: list[int] = [1]
    depth, chars, top_path, node_of_end = [0], [0], [0], []  # top_path: the path that opened the node
    stack, last = [0], b""
    parent = [-1]
    for i, (path, lengths, *_) in enumerate(rows):
        shared, n = _shared(last, path), len(path) // DIGEST
        bits.extend([0] * (len(stack) - 1 - shared))
        del stack[shared + 1:]
        sizes = np.frombuffer(lengths, ">i8")
        for d in range(shared, n):
            bits.append(1)
            parent.append(stack[-1])
            stack.append(len(depth))
            depth.append(d + 1)
            chars.append(int(sizes[d]))
            top_path.append(i)
        node_of_end.append(stack[-1])
        last = path
    bits.extend([0] * len(stack))
    tree = Parentheses(np.array(bits, np.int8))
    size, leaves = tree.subtrees()
    nodes, ends = len(depth), np.array(node_of_end)
    first = np.arange(nodes)
    weight = np.zeros(nodes + 1, np.int64)
    weight[ends + 1] = [r[2] for r in rows]
    weight = np.cumsum(weight)
    convs = weight[first + size] - weight[first]
    chars_of = np.array(chars, np.int64)
    own = np.concatenate([[0], np.cumsum(chars_of)])
    heavy = np.concatenate([[0], np.cumsum(chars_of * convs)])
    children = np.bincount(np.array(parent[1:], np.int64), minlength=nodes) if nodes > 1 else np.zeros(1, np.int64)
    lowest = np.array([r[3] for r in rows])
    begin, end = np.searchsorted(ends, first), np.searchsorted(ends, first + size)
    pairs = np.stack([begin, np.minimum(end, len(lowest))], 1).ravel()
    conv = np.minimum.reduceat(np.concatenate([lowest, [np.iinfo(np.int64).max]]), pairs)[::2]
    sha: list[str | None] = [None] * nodes
    for i, node in enumerate(node_of_end):
        sha[node] = rows[i][4]
    spine, ids = np.zeros(nodes, bool), [None] * nodes
    for i in (0, len(rows) - 1):
        node, names = node_of_end[i], _prefix_ids(rows[i][0], len(rows[i][0]) // DIGEST)
        while node >= 0:
            spine[node], ids[node] = True, names[depth[node]]
            node = parent[node]
    above = np.array(parent)
    hangs = np.array([p >= 0 and bool(spine[p]) for p in parent])
    edge = [rows[0][0], rows[-1][0]], [rows[0][1], rows[-1][1]]
    columns = {
        "shard": [shard] * (nodes + 2), "kind": ["spine" if s else "node" for s in spine] + ["first", "last"], "id": ids + [None] * 2,
        "parent_id": [ids[p] if h else None for p, h in zip(parent, hangs)] + [None] * 2, "conv_id": conv.tolist() + [None] * 2,
        "parent_conv_id": [None if h or p < 0 else int(conv[p]) for p, h in zip(above, hangs)] + [None] * 2, "depth": depth + [None] * 2,
        "n_convs": convs.tolist() + [None] * 2, "n_children": children.tolist() + [None] * 2, "n_leaves": leaves.tolist() + [None] * 2,
        "weighted": (heavy[first + size] - heavy[first]).tolist() + [None] * 2, "own": (own[first + size] - own[first]).tolist() + [None] * 2,
        "ends_sha256": sha + [None] * 2, "path": [None] * nodes + edge[0], "path_chars": [None] * nodes + edge[1]}
    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
    return pa.RecordBatch.from_pydict({c: pa.array(columns[c], kinds[k]) for c, k in (f.split() for f in NODE.split(", "))})


def _encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut a task's sorted paths into shards; a shard's number grows with its paths."""
    from pyspark import TaskContext

    shard, rows, held = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            rows.append(row)
            held += len(row[0]) // DIGEST + 1
            if held >= SHARD_NODES:
                yield _encode(shard, rows)
                shard, rows, held = shard + 1, [], 0
    if rows:
        yield _encode(shard, rows)


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What two neighbouring shards count twice, per prefix that the last path of one and the first of the next share."""
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("id", "n_children", "n_leaves", "own")}
        for last, first, lengths in zip(*(c.to_pylist() for c in batch.columns)):
            shared = _shared(last, first)
            sizes = np.concatenate([[0], np.frombuffer(lengths, ">i8")[:shared]])
            out["id"] += _prefix_ids(first, shared)
            out["n_children"] += [-1] * shared + [0]
            out["n_leaves"] += [-int(len(last) == shared * DIGEST)] * (shared + 1)
            out["own"] += (-np.cumsum(sizes[::-1])[::-1]).tolist()
        yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.binary() if c == "id" else pa.int64()) for c, v in out.items()})


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, ``path`` (the digests of its turns, joined) and ``path_chars`` (their code points, 8 bytes each).

    A conversation's first turns, as many as the checksum of its id says, are those of its family's first one.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn").alias("turn"), F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
                    F.length(text).cast("long").alias("chars"))
    own = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    own = own.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(
        t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))
    own = write_scratch(own, "turns")
    base = own.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, SHARED - 1).alias("_first"))
    joined = own.join(base, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("_base"), "left")
    h = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")
    empty = F.slice("turns", 1, 0)
    all_turns = F.concat(F.slice(F.coalesce("_first", empty), F.lit(1), h), F.slice("turns", h + 1, F.size("turns")))
    joined = joined.withColumn("_turns", all_turns)
    return joined.select("conv_id", _joined_bytes(F.transform("_turns", lambda t: t["digest"])).alias("path"),
                         _joined_bytes(F.transform("_turns", lambda t: F.unhex(F.lpad(F.hex(t["chars"]), 16, "0")))).alias("path_chars"))


def _joined_bytes(parts: Column) -> Column:
    return F.unhex(F.array_join(F.transform(parts, lambda b: F.hex(b)), ""))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the ids of each path, in the sorted rows of a task, into strings of bounded length."""
    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[2] for r in rows], pa.string())], ["path", "first", "ids"])

    key, first, ids, size, done = None, None, [], 0, []
    for batch in batches:
        for path, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (path != key or size >= PIECE):
                done.append((key, first, ",".join(ids)))
                ids, size = [], 0
                if len(done) >= 1024:
                    yield batch_of(done)
                    done = []
            if not ids:
                key, first = path, conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        done.append((key, first, ",".join(ids)))
    if done:
        yield batch_of(done)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each path's pieces, fed in order; rows are sorted by path."""
    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["path", "sha"])

    key, state, done = None, None, []
    for batch in batches:
        for path, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if state is not None and path == key:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                done.append((key, state.hexdigest()))
            key, state = path, hashlib.sha256(ids.encode())
        if done:
            yield batch_of(done)
            done = []
    if state is not None:
        yield batch_of([(key, state.hexdigest())])


def ended_paths(paths: DataFrame) -> DataFrame:
    """The distinct paths with their ``ends`` (how many conversations are just that), the smallest of them and the hash of all.

    Ids are sorted over all tasks and joined into pieces first, so a path that many conversations share is a
    few long rows for the task that hashes it in one stream.
    """
    known = paths.groupBy("path").agg(F.count(F.lit(1)).alias("ends"), F.min("conv_id").alias("conv_id"), F.first("path_chars").alias("path_chars"))
    pieces = paths.select("path", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    pieces = pieces.mapInArrow(_pieces, "path binary, first long, ids string")
    hashed = pieces.repartition("path").sortWithinPartitions("path", "first").select("path", "ids").mapInArrow(_digests, "path binary, sha string")
    return known.join(hashed, "path").select("path", "path_chars", "ends", "conv_id", "sha")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.

    Distinct paths are sorted over all tasks and cut into shards.  A shard's trie is a string of parentheses: findclose, by
    blocks of the excess, delimits every subtree, ranks count its nodes and leaf pairs, and running sums over the
    preorder give its conversations and characters.  Nodes on a shard's first and last path may go on next door:
    their sums are added up, and what two neighbours both counted, a row per shared prefix, is taken off again.

    Turns are ordered by turn (null first), then by the MD5 of role and text; repeated rows are turns of their own; null role
    and text are empty, null and empty alike; rows without conv_id belong to no conversation; an empty table has
    no nodes; other columns are ignored.  Texts leave the scan as digests, so very long ones cost nothing later; the digests
    of one conversation (24 bytes a turn) have to fit a task.
    """
    paths = write_scratch(ended_paths(rebuilt(conversations)), "paths")
    sorted_paths = paths.repartitionByRange("path").sortWithinPartitions("path").select("path", "path_chars", "ends", "conv_id", "sha")
    nodes = write_scratch(sorted_paths.mapInArrow(_encode_rows, NODE), "trie")
    edges = nodes.filter("kind IN ('first', 'last')").select("shard", "kind", "path", "path_chars")
    by_shard = Window.orderBy("shard")  # one row per shard
    edges = edges.groupBy("shard").agg(F.max(F.when(F.col("kind") == "first", F.struct("path", "path_chars"))).alias("a"),
                                       F.max(F.when(F.col("kind") == "last", F.col("path"))).alias("last"))
    edges = edges.select("last", F.lead("a").over(by_shard).alias("next")).filter("next IS NOT NULL")
    twice = edges.select("last", F.col("next.path").alias("first"), F.col("next.path_chars").alias("chars")).mapInArrow(
        _overlaps, "id binary, n_children long, n_leaves long, own long")
    spine = nodes.filter("kind = 'spine'")
    sums = ("n_convs", "n_children", "n_leaves", "weighted", "own")
    both = spine.select("id", "parent_id", "conv_id", "depth", "ends_sha256", *sums).unionByName(twice, allowMissingColumns=True)
    merged = both.groupBy("id").agg(F.max("parent_id").alias("parent_id"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
                                    F.max("ends_sha256").alias("ends_sha256"), *[F.sum(c).alias(c) for c in sums])
    merged = write_scratch(merged, "spines")
    above = merged.select(F.col("id").alias("_above"), F.col("conv_id").alias("_above_conv"))
    inner = nodes.filter("kind = 'node'").select(*merged.columns, "parent_conv_id")
    every = inner.unionByName(merged.withColumn("parent_conv_id", F.lit(None).cast("long")))
    out = every.join(above, F.col("parent_id") == F.col("_above"), "left")
    return out.select("conv_id", "depth", F.coalesce("parent_conv_id", "_above_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      (F.col("weighted") - F.col("own")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
