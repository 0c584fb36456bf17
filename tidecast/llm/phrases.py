"""Phrases whose words occur together: an FM-index of word ids per shard, counts summed over shards."""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tidecast.session import write_scratch

LONGEST, LEAST, BEST = 4, 30, 2000
SCALE, COVERED = 2_000_000, 80
#: Words after which a task begins another shard, and hashes of words and pairs that one task adds up.
SHARD_WORDS, SLICE_HASHES = 1 << 21, 1 << 20
#: Rows of a batch that a task hands out.
BATCH = 1 << 16
#: Capitals become small, tabs blanks, and what ends a piece becomes a line feed.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
_TIMES = np.uint64(0x9E3779B97F4A7C15)
INDEX = "shard long, langs array<string>, lang_words array<long>, lang_of binary, words binary, word_ends binary, bwt binary, hashes long"


def _pack(values: np.ndarray) -> bytes:
    """Compressed integers, byte planes apart, as most numbers are small."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _ranks(keys: np.ndarray) -> np.ndarray:
    """The place of each key among the different keys."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    rank = np.empty(len(keys), np.int32)
    rank[order] = np.cumsum(np.append(False, keys[1:] != keys[:-1]), dtype=np.int32)
    return rank


def bwt_of(ids: np.ndarray) -> np.ndarray:
    """The symbol before each suffix, suffixes in the order of their first four symbols; ``ids`` is a ring.

    Pairs are ranked first, then pairs of ranks; deeper order isn't needed to extend intervals to four words.
    """
    if not len(ids):
        return ids

    def paired(numbers: np.ndarray, step: int) -> np.ndarray:
        keys = numbers.astype(np.int64)
        keys *= int(numbers.max()) + 1
        keys += np.roll(numbers, -step)
        return keys

    order = np.argsort(paired(_ranks(paired(ids, 1)), 2), kind="stable")
    return np.roll(ids, 1)[order]


class Intervals:
    """The phrases of one length in an FM-index: where their suffixes begin, how many there are, and how they grow.

    ``first`` is the word that extends phrase ``rest`` (of the length before) to the left; ``start`` is the first place of the
    interval, so the phrase without its last word is the one whose interval holds that place.
    """

    def __init__(self, first: np.ndarray, rest: np.ndarray, start: np.ndarray, count: np.ndarray, begun: np.ndarray):
        self.first, self.rest, self.start, self.count, self.begun = first, rest, start, count, begun


def intervals(bwt: np.ndarray, longest: int, wanted=lambda length, levels: None) -> list[Intervals]:
    """Phrases of 1 to ``longest`` words by extending every interval to the left by every word before it.

    The stable order of the BWT maps places to the places one word further left; runs of equal word and equal interval
    there are the extended intervals.  ``wanted(length, levels)`` may return which phrases of the last level to keep;
    only those are extended, to either side.
    """
    # places fit 32 bits, as a text has less than 2^31 bytes; a shard's arrays are most of a task's memory
    source = np.argsort(bwt, kind="stable").astype(np.int32)
    symbols = bwt[source]
    skip = int(np.searchsorted(symbols, 1))      # separators come first and are in no phrase
    source, symbols = source[skip:], symbols[skip:]
    inside = np.zeros(len(bwt), np.int32)        # the interval of the level before, per place; -1 outside
    levels: list[Intervals] = []
    for length in range(1, longest + 1):
        rest = inside[source]
        ok = rest >= 0
        if length > 1:                           # the phrase without its last word must be wanted as well
            ok &= inside[skip:] >= 0
        at = np.flatnonzero(ok).astype(np.int32)
        symbol, rest = symbols[at], rest[at]
        edge = np.ones(len(at), bool)
        edge[1:] = (symbol[1:] != symbol[:-1]) | (rest[1:] != rest[:-1])
        begin = np.flatnonzero(edge).astype(np.int32)
        start = at[begin] + np.int32(skip)
        level = Intervals(symbol[begin], rest[begin], start, np.diff(begin, append=np.int32(len(at))), inside[start])
        levels.append(level)
        del symbol, rest
        keep = wanted(length, levels)
        if length == longest:
            break
        number = np.cumsum(edge, dtype=np.int32) - np.int32(1)
        if keep is not None:
            number = np.where(keep, np.arange(len(begin), dtype=np.int32), np.int32(-1))[number]
        inside = np.full(len(bwt), -1, np.int32)
        inside[skip:][at] = number
    return levels


def _shard_rows(docs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shard: its words, their languages and the BWT of their ids."""
    from pyspark import TaskContext

    def started():
        # 0 ends a piece, 1 stands for the gaps between blanks; a word's id belongs to its language
        count = itertools.count(2).__next__
        return defaultdict(lambda: defaultdict(count, {b"\n": 0, b"": 1})), [], 0

    def finished(ids_of, parts):
        ids = np.concatenate([np.zeros(1, np.int32), *parts])
        parts.clear()
        # ids by frequency, so that most are small
        seen = np.bincount(ids)
        seen[0] = 0
        rank = np.argsort(-seen, kind="stable")
        number = np.zeros(len(seen), np.int32)
        number[rank[rank > 1]] = np.arange(1, (rank > 1).sum() + 1)
        words, lang_of = [b""] * ((rank > 1).sum() + 1), np.zeros((rank > 1).sum() + 1, np.int64)
        langs = sorted(ids_of)
        for k, lang in enumerate(langs):
            for word, i in ids_of.pop(lang).items():
                if i > 1:
                    words[number[i]], lang_of[number[i]] = word, k
        ends, words = np.cumsum([len(w) for w in words]), b"".join(words)
        ids = number[ids]
        bwt = bwt_of(ids)
        total = np.bincount(lang_of[ids[ids > 0]], minlength=len(langs))
        del ids
        pairs = sum(len(level.count) for level in intervals(bwt, 2))
        row = {"shard": [shard], "langs": [langs], "lang_words": [total.tolist()], "lang_of": [_pack(lang_of)],
               "words": [zstandard.ZstdCompressor(level=1).compress(words)], "word_ends": [_pack(ends)],
               "bwt": [_pack(bwt)], "hashes": [pairs]}
        return pa.RecordBatch.from_pydict(row, pa.schema([("shard", pa.int64()), ("langs", pa.list_(pa.string())), ("lang_words", pa.list_(pa.int64())),
                                                          *[(c, pa.binary()) for c in ("lang_of", "words", "word_ends", "bwt")], ("hashes", pa.int64())]))

    shard = TaskContext.get().partitionId() << 32
    ids_of, parts, held = started()
    for batch in docs:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            tokens = text.as_py().translate(_FOLD).replace(b"\n", b" \n ").split(b" ")
            found = np.fromiter(map(ids_of[lang].__getitem__, tokens), np.int32, len(tokens))
            parts += [found[found != 1], np.zeros(1, np.int32)]
            held += len(parts[-2])
            if held >= SHARD_WORDS:
                yield finished(ids_of, parts)
                shard += 1
                ids_of, parts, held = started()
    if parts:
        yield finished(ids_of, parts)


def fm_index(docs: DataFrame) -> DataFrame:
    """The shards of the index, one row each: word ids are per shard and language; written once."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return write_scratch(rows.mapInArrow(_shard_rows, INDEX), "index")


def _opened(row: dict) -> tuple[pa.Array, np.ndarray, np.ndarray, list[str]]:
    joined = zstandard.ZstdDecompressor().decompress(row["words"]) if row["words"] else b""
    ends = _unpack(row["word_ends"]).view(np.uint32)
    words = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(joined)])
    return words, _unpack(row["lang_of"]), _unpack(row["bwt"]), row["langs"]


def _hashes(words: pa.Array, lang_of: np.ndarray, langs: list[str], levels: list[Intervals]) -> np.ndarray:
    """64-bit hashes of the words of a shard, then of its pairs; the same in every shard."""
    seeds = [xxhash.xxh64_intdigest(g.encode("utf-8", "surrogatepass")) & 0xFFFFFFFF for g in langs]
    of_word = np.empty(len(words), np.uint64)
    for i in range(0, len(words), BATCH):
        of_word[i:i + BATCH] = [xxhash.xxh64_intdigest(w, seeds[g]) for w, g in zip(words[i:i + BATCH].to_pylist(), lang_of[i:i + BATCH].tolist())]
    singles = len(levels[0].first)
    hashes = np.empty(singles + len(levels[1].first), np.uint64)
    hashes[:singles] = of_word[levels[0].first]
    pair = hashes[singles:]
    pair[:] = of_word[levels[1].first]
    pair *= _TIMES
    pair += hashes[levels[1].rest]
    pair ^= pair >> np.uint64(29)
    pair *= _TIMES
    return hashes


def _sliced(hashes: np.ndarray, slices: int) -> tuple[np.ndarray, list[int]]:
    """The order of the hashes, and where in it each slice begins and the last ends; a slice is a range of hashes."""
    order = np.argsort(hashes).astype(np.int32)
    bounds = np.array([(p << 64) // slices for p in range(1, slices)], np.uint64)
    return order, [0, *np.searchsorted(hashes, bounds, sorter=order).tolist(), len(hashes)]


def _hash_slices(slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from sliced(row)

    def sliced(row: dict) -> Iterator[pa.RecordBatch]:
        words, lang_of, bwt, langs = _opened(row)
        levels = intervals(bwt, 2)
        del bwt
        hashes = _hashes(words, lang_of, langs, levels)
        counts = np.minimum(np.concatenate([levels[0].count, levels[1].count]), LEAST).astype(np.uint8)
        del words, lang_of, levels
        order, ends = _sliced(hashes, slices)
        first = 0
        for p in range(1, slices + 1):
            if p == slices or ends[p + 1] - ends[first] > BATCH:
                some = [q for q in range(first, p) if ends[q] < ends[q + 1]]
                at = [order[ends[q]:ends[q + 1]] for q in some]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([row["shard"]] * len(some), pa.int64()), "slice": pa.array(some, pa.int64()),
                    "hashes": pa.array([hashes[a].tobytes() for a in at], pa.binary()), "counts": pa.array([counts[a].tobytes() for a in at], pa.binary())})
                first = p
    return run


def _frequent_bits(group: pa.Table) -> pa.Table:
    """Add up one slice of the hashes over all shards; a bit per hash and shard says whether it may be frequent."""
    hashes, counts = (np.frombuffer(b"".join(group[c].to_pylist()), kind) for c, kind in (("hashes", np.uint64), ("counts", np.uint8)))
    order = np.argsort(hashes)
    ordered = hashes[order]
    begin = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    del ordered
    sums = np.add.reduceat(counts[order], begin, dtype=np.int64)
    often = np.zeros(len(hashes), bool)
    often[order] = np.repeat(sums >= LEAST, np.diff(begin, append=len(hashes)))
    ends = np.cumsum([0, *pc.binary_length(group["counts"]).to_pylist()])
    bits = [np.packbits(often[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
    return pa.table({"shard": group["shard"], "slice": group["slice"], "bits": pa.array(bits, pa.binary())})


def _phrase_counts(slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from counted(row)

    def counted(row: dict) -> Iterator[pa.RecordBatch]:
        words, lang_of, bwt, langs = _opened(row)
        levels = intervals(bwt, 2)
        singles, pairs_start = len(levels[0].first), levels[1].start
        hashes = _hashes(words, lang_of, langs, levels)
        del levels
        order, ends = _sliced(hashes, slices)
        often = np.zeros(len(hashes), bool)
        del hashes
        for b in row["bits"]:
            at = order[ends[b["slice"]]:ends[b["slice"] + 1]]
            often[at] = np.unpackbits(np.frombuffer(b["bits"], np.uint8), count=len(at))
        del order
        single, pair = often[:singles], often[singles:]

        def wanted(length: int, grown: list[Intervals]):
            if length == 1:
                return single
            if length == 2:  # pairs of frequent words are fewer than all pairs: found by their place in the index
                return pair[np.searchsorted(pairs_start, grown[1].start)]
            return None

        grown = intervals(bwt, LONGEST, wanted)
        del bwt
        of_lang = pa.array(langs, pa.string())
        for length, level in enumerate(grown, 1):
            keep = wanted(length, grown)
            at = np.arange(len(level.count)) if keep is None else np.flatnonzero(keep)
            for i in range(0, len(at), BATCH):
                some = rest = at[i:i + BATCH]
                parts = []
                for shorter in grown[length - 1::-1]:  # the word in front, then those of the rest
                    parts.append(words.take(pa.array(shorter.first[rest])).cast(pa.binary()))
                    rest = shorter.rest[rest]
                phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
                yield pa.RecordBatch.from_pydict({
                    "lang": of_lang.take(pa.array(lang_of[level.first[some]])), "phrase": phrase,
                    "a": pa.array(level.count[some], pa.int64())})
    return run


def frequent_phrases(index: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, phrase, words (how many) and a, of all phrases of up to four words that occur ``least`` times or more.

    A phrase can only be that frequent if all its words and pairs are.  Shards first exchange hashes of theirs with counts up
    to ``least``, cut into slices of bounded size, and get back a bit for each; equal hashes of different pairs only
    let more through.  Then they enumerate what is left, and exact counts are added up.
    """
    total = index.agg(F.sum("hashes")).first()[0] or 0
    slices = max(1, -(-total // SLICE_HASHES))
    sliced = index.mapInArrow(_hash_slices(slices), "shard long, slice long, hashes binary, counts binary")
    bits = sliced.groupBy("slice").applyInArrow(_frequent_bits, "shard long, slice long, bits binary")
    bits = bits.groupBy("shard").agg(F.collect_list(F.struct("slice", "bits")).alias("bits"))
    bits = write_scratch(bits, "bits")
    found = index.join(bits, "shard").mapInArrow(_phrase_counts(slices), "lang string, phrase binary, a long")
    found = found.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).filter(F.col("a") >= least)
    return found.select("lang", "phrase", F.size(F.split(F.col("phrase").cast("string"), " ", -1)).alias("words"), "a")


def collocations(docs: DataFrame, best: int = BEST, least: int = LEAST) -> DataFrame:
    """The first ``best`` phrases of every language by score: lang, rank, phrase, a, l, r, n and score.

    A phrase of two to four words that occurs ``least`` times or more scores 2,000,000 a / (l + r) at its lowest cut into two
    parts that occur l and r times.  One whose words lie inside a longer such phrase with at least 80 % of its
    occurrences is dropped.  Everything is counted over all texts, within the pieces between punctuation.

    Null texts are empty; a null language is ``und``; texts without words count nothing; a very long text makes its shard
    longer, as shards are cut between texts; ties go by score, a and phrase, and in a score to the first cut; repeated rows count each;
    an empty table gives an empty result; other columns are ignored.
    """
    index = fm_index(docs)
    sizes = index.select(F.explode(F.arrays_zip("langs", "lang_words")).alias("z")).groupBy(F.col("z.langs").alias("lang")).agg(F.sum("z.lang_words").alias("n"))
    table = write_scratch(frequent_phrases(index, least).withColumn("phrase", F.col("phrase").cast("string")), "phrases")
    longer = table.filter("words > 1").withColumn("_words", F.split("phrase", " ", -1))
    # parts of every cut, looked up together
    cuts = longer.select("lang", "phrase", "words", "a", "_words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "words", "a", "k", F.array_join(F.slice("_words", F.lit(1), F.col("k")), " ").alias("_left"),
                       F.array_join(F.slice("_words", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("_right"))
    part = table.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("a").alias("_f"))
    cuts = cuts.join(part.withColumnRenamed("_f", "l"), (F.col("lang") == F.col("_lang")) & (F.col("_left") == F.col("_phrase"))).drop("_lang", "_phrase")
    cuts = cuts.join(part.withColumnRenamed("_f", "r"), (F.col("lang") == F.col("_lang")) & (F.col("_right") == F.col("_phrase"))).drop("_lang", "_phrase")
    score = F.expr(f"CAST(({SCALE}BD * a) DIV (l + r) AS BIGINT)")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))
    # the most frequent longer phrase around every phrase
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: F.array_join(F.slice("_words", i, m), " "))))
    around = longer.filter("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("_longer"))
    around = around.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter(F.coalesce(F.lit(100) * F.col("_longer") < F.lit(COVERED) * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.col("s.score").desc(), F.col("a").desc(), F.col("phrase"))
    top = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= best)
    return top.join(sizes, "lang").select("lang", "rank", "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), "n", F.col("s.score").alias("score"))
