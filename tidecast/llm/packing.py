"""Hierarchical packing of token sequences into windows of several lengths."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidecast.llm.common import worker_store
from tidecast.session import write_scratch

TIERS = (256, 512, 1024, 2048)
END = 1
#: Tokens that are packed together in a task, and tokens of a step of training.
BLOCK_TOKENS = 1 << 20
STEP_TOKENS = 1 << 16
#: Tasks whose rests are packed together.
MEET = 64
#: Characters that are encoded together, and words whose ids a worker remembers; others are encoded again.
CHARS = 1 << 21
REMEMBERED = 1 << 20
#: Parts that are encoded as the lines of one text.
LINES = 256

FIELDS = [("row_id", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
          ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
          ("tier", pa.int64()), ("step_group", pa.int64()), ("meet", pa.int64()), ("ids", pa.binary())]
ARROW = pa.schema(FIELDS)
SCHEMA = ", ".join(f"{n} {'binary' if t == pa.binary() else 'long'}" for n, t in FIELDS)


#: Places where the vocabulary's pattern always begins a new piece: between a letter or digit and one of these marks, and
#: between a single line feed and a letter or digit.  NUL marks them.
_MARK, _AFTER_FEED = r"([\pL\pN])([,.;:!?\n])", r"([\pL\pN\pP\x00])\n([\pL\pN])"


def encoder(path: str):
    """Texts to their ids, each as a numpy array of the ids of the whole text.

    The vocabulary's pattern always starts a new piece at a blank that precedes a non-blank, and where words meet common
    punctuation, so the parts between such places can be encoded apart: the distinct ones of some texts are looked up
    among those seen before.  A text with a blank before white space, or with NUL, is cut at its other blanks only.
    """
    from tokenizers import Tokenizer

    store = worker_store(f"tokenizer {path}")
    if "model" not in store:
        store["model"] = Tokenizer.from_file(path)
        store["model"].encode_special_tokens = True
        store["known"], store["before"] = {}, {}
    model = store["model"]
    odd, cut = re.compile(r" \s|\0| $").search, re.compile(r"(?= (?=\S))").split

    feed = model.encode("\n", add_special_tokens=False).ids
    one_piece = re.compile(r" ?\S+").fullmatch

    def coded(texts: list[str]) -> list[bytes]:
        """Ids of each text; those without white space but a first blank are encoded in lines, which costs less per text."""
        out: list[bytes] = [b""] * len(texts)
        lined = [i for i, t in enumerate(texts) if len(feed) == 1 and one_piece(t)]
        lines = [lined[i:i + LINES] for i in range(0, len(lined), LINES)]
        pages = model.encode_batch_fast(["".join(texts[i] + "\n" for i in page) for page in lines], add_special_tokens=False)
        for page, found in zip(lines, pages):
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(ids == feed[0]).tolist()
            for i, a, b in zip(page, [0, *[e + 1 for e in ends]], ends, strict=False):
                out[i] = ids[a:b].tobytes()
        rest = [i for i, t in enumerate(texts) if len(feed) != 1 or not one_piece(t)]
        for i, found in zip(rest, model.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(found.ids, "<u4").tobytes()
        return out

    def looked_up(distinct: list[str]) -> list[bytes]:
        """Ids by part, from two generations of what the worker has seen: when one is full the other goes."""
        known, before = store["known"], store["before"]
        values = list(map(known.get, distinct))
        for i, v in enumerate(values):
            if v is None and (old := before.get(distinct[i])) is not None:
                values[i] = known[distinct[i]] = old
        new = [w for w, v in zip(distinct, values) if v is None]
        if new:
            ids = dict(zip(new, coded(new)))
            known.update(ids)
            values = [ids[w] if v is None else v for w, v in zip(distinct, values)]
        if len(known) > REMEMBERED // 2:
            store["before"], store["known"] = known, {}
        return values

    def encode(texts: list[str]) -> list[np.ndarray]:
        plain = [i for i, t in enumerate(texts) if not odd(t)]
        marked = pc.replace_substring(pa.array([texts[i] for i in plain], pa.string()), " ", "\0 ")
        marked = pc.replace_substring_regex(marked, _MARK, "\\1\0\\2")
        parts = pc.split_pattern(pc.replace_substring_regex(marked, _AFTER_FEED, "\\1\n\0\\2"), "\0")
        if len(plain) < len(texts):
            rest = [i for i, t in enumerate(texts) if odd(t)]
            parts = pa.concat_arrays([parts, pa.array([cut(texts[i]) for i in rest], pa.list_(pa.string()))])
            plain += rest
        ends = parts.offsets.to_numpy()
        words = parts.flatten().dictionary_encode()
        index, distinct = words.indices.to_numpy(), words.dictionary.to_pylist()
        values = looked_up(distinct)
        flat = np.frombuffer(b"".join(values), "<u4")
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        size = sizes[index]
        starts, stops = (np.cumsum(sizes) - sizes)[index], np.cumsum(size)
        ids = flat[np.repeat(starts - stops + size, size) + np.arange(stops[-1] if len(stops) else 0)]
        bounds = np.concatenate([[0], stops])[ends]
        out: list[np.ndarray] = [ids[:0]] * len(texts)
        for place, a, b in zip(plain, bounds[:-1], bounds[1:]):
            out[place] = ids[a:b]
        return out

    return encode


def pack(pieces: list[tuple], tiers=TIERS) -> tuple[list[tuple[int, list[tuple]]], list[tuple]]:
    """Fill windows exactly; returns them as (tier, pieces) and the pieces of the one window that stays open.

    A piece is (row, doc_id, start, ids, tokens of its document).  Longer pieces than the top tier give whole
    windows first.  Then the longest piece opens a window of the shortest tier that holds it, and its gap, which
    is less than half the window above the lowest tier, takes the longest shorter pieces that fit.  When none
    fits, the shortest piece is cut to close the gap, and its rest goes back to the tier of its new length.
    """
    top, windows, pool, stock = tiers[-1], [], [], []

    def cut(piece: tuple, n: int) -> tuple[tuple, tuple]:
        row, doc, start, ids, tokens = piece
        return (row, doc, start, ids[:n], tokens), (row, doc, start + n, ids[n:], tokens)

    def add(piece: tuple) -> None:
        stock.append(piece)
        insort(pool, (len(piece[3]), len(stock) - 1))

    for piece in pieces:
        while len(piece[3]) >= top:
            whole, piece = cut(piece, top)
            windows.append((top, [whole]))
        if len(piece[3]):
            stock.append(piece)
            pool.append((len(piece[3]), len(stock) - 1))
    pool.sort()
    while pool:
        length, k = pool.pop()
        tier = tiers[bisect_left(tiers, length)]
        window, gap = [stock[k]], tier - length
        while gap and pool:
            fits = bisect_right(pool, (gap, len(stock))) - 1
            if fits >= 0:
                length, k = pool.pop(fits)
                window.append(stock[k])
                gap -= length
            else:
                _, k = pool.pop(0)
                head, rest = cut(stock[k], gap)
                window.append(head)
                add(rest)
                gap = 0
        if gap:
            return windows, window
        windows.append((tier, window))
    return windows, []


class Sequences:
    """Numbers windows, deals them into step groups and turns them into rows.

    A group holds windows of one tier with ``step_tokens`` tokens in all.  Windows are dealt in order of the
    cost of attention (the sum of squared piece lengths), back and forth over the groups, which balances it.
    """

    def __init__(self, first: int, tiers=TIERS, step_tokens: int = STEP_TOKENS):
        self.sequence = self.group = first
        self.tiers, self.step_tokens = tiers, step_tokens
        self.waiting: dict[int, list] = defaultdict(list)

    def add(self, windows) -> list[tuple]:
        for tier, window in windows:
            rows, offset = [], 0
            for row, doc, start, ids, tokens in window:
                rows.append((row, doc, start, len(ids), zlib.crc32(ids.tobytes()), tokens, self.sequence, offset))
                offset += len(ids)
            self.waiting[tier].append((-sum(r[3] ** 2 for r in rows), self.sequence, rows))
            self.sequence += 1
        return [r for t in self.tiers if len(self.waiting[t]) >= 8 * self.step_tokens // t for r in self.deal(t)]

    def deal(self, tier: int, last: bool = False) -> list[tuple]:
        waiting, per = self.waiting[tier], max(1, self.step_tokens // tier)
        count = -(-len(waiting) // per) if last else len(waiting) // per
        now, self.waiting[tier] = (waiting, []) if last else (waiting[:count * per], waiting[count * per:])
        out = []
        for i, (_, _, rows) in enumerate(sorted(now, key=lambda w: w[:2])):
            turn, place = divmod(i, count)
            group = self.group + (place if turn % 2 == 0 else count - 1 - place)
            out += [(*r, tier, group, None, None) for r in rows]
        self.group += count
        return out

    def end(self) -> list[tuple]:
        return [r for t in self.tiers if self.waiting[t] for r in self.deal(t, last=True)]


def _table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(FIELDS)
    return pa.Table.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, FIELDS)], schema=ARROW)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[str]]]:
    """Row numbers, ids and texts of as many rows as hold ``CHARS`` characters; a null text is empty."""
    rows, docs, texts, held = [], [], [], 0
    for batch in batches:
        for row, doc, text in zip(*batch.columns):
            rows.append(row.as_py())
            docs.append(doc.as_py())
            texts.append(text.as_py() or "")
            held += len(texts[-1])
            if held >= CHARS:
                yield rows, docs, texts
                rows, docs, texts, held = [], [], [], 0
    if texts:
        yield rows, docs, texts


def _pack_task(path: str, tiers, block_tokens: int, step_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        encode, end = encoder(path), np.array([END], "<u4")
        out, block, held = Sequences(task << 32, tiers, step_tokens), [], 0
        for rows, docs, texts in chunks(batches):
            for row, doc, ids in zip(rows, docs, encode(texts)):
                ids = np.append(ids, end)
                block.append((row, doc, 0, ids, len(ids)))
                held += len(ids)
            if held >= block_tokens:
                windows, block = pack(block, tiers)
                held = sum(len(p[3]) for p in block)
                yield from _table(out.add(windows)).to_batches()
        windows, rest = pack(block, tiers)
        rows = out.add(windows) + out.end()
        rows += [(row, doc, start, len(ids), zlib.crc32(ids.tobytes()), tokens, None, None, None, None, task // MEET,
                  ids.tobytes()) for row, doc, start, ids, tokens in rest]
        yield from _table(rows).to_batches()
    return run


def _pack_rests(tiers, step_tokens: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["row_id"], r["start"]))
        pieces = [(r["row_id"], r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]) for r in rows]
        out = Sequences((1 << 60) + (rows[0]["meet"] << 32), tiers, step_tokens)
        windows, rest = pack(pieces, tiers)
        return _table(out.add(windows + ([(tiers[-1], rest)] if rest else [])) + out.end())
    return run


def pack_documents(docs: DataFrame, vocabulary: str, tiers=TIERS, block_tokens: int = BLOCK_TOKENS,
                   step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pack the tokens of all documents into windows of the tiers; one row per piece.

    Every task packs the documents it reads, so no text and no ids are shuffled.  All windows are full except
    the last of each group of ``MEET`` tasks, whose rests are packed together: only that one is padded.  A null
    or empty text is the end token alone; repeated rows are packed each for itself and told apart by ``row_id``;
    other columns are not read.  An empty table gives an empty result.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group, row_id.
    """
    rows = docs.select(F.monotonically_increasing_id(), F.col("doc_id").cast("long"), "text")  # one pass, so its numbers hold
    pieces = write_scratch(rows.mapInArrow(_pack_task(vocabulary, tiers, block_tokens, step_tokens), SCHEMA), "pieces")
    rests = pieces.filter("ids IS NOT NULL").groupBy("meet").applyInArrow(_pack_rests(tiers, step_tokens), SCHEMA)
    done = pieces.filter("ids IS NULL").unionByName(rests)
    return done.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier",
                       "step_group", "row_id")
