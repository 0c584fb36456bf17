"""Language by prediction by partial matching: exact code lengths of a text's bytes under each language's contexts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

UNKNOWN = "und"
#: Bytes of context, documents learned from for each language, rows and bytes scored together.
ORDER, PER_LANGUAGE, ROWS, BYTES = 3, 500, 256, 1 << 19
#: The score is the posterior of a passage of so many bytes, coded at the text's mean rate.
PASSAGE = 64


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning, by the CRC-32 of its id as text; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def grams(data: bytes) -> np.ndarray:
    """Every byte with the ORDER bytes before it as one number; ``data`` begins with the first one's context."""
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    return a[:-3] << 24 | a[1:-2] << 16 | a[2:-1] << 8 | a[3:]


def encoded(text: str) -> bytes:
    return b"\0" * ORDER + text.encode("utf-8", "surrogatepass")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(*batch.columns):
            keys, counts = np.unique(grams(encoded(text.as_py())), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(keys), pa.string()),
                                              pa.array(keys.astype(np.int64)), pa.array(counts)], ["lang", "gram", "n"])


@dataclass
class Model:
    """Frozen statistics as code lengths in bits, a column per language.

    ``cost[k]`` is for a byte after k bytes, whole tables for k < 2; ``keys[k]`` are the sorted numbers some language
    has seen and ``escapes`` what leaving a context costs.
    """

    languages: list[str]
    keys: dict[int, np.ndarray]
    cost: dict[int, np.ndarray]
    contexts: np.ndarray
    escapes: dict[int, np.ndarray]

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """Code length of every byte: from the longest context a language knows, with its escapes on the way."""
        out = np.empty((len(keys), len(self.languages)), np.float32)
        at, found = _find(self.keys[3], keys)
        out[found] = self.cost[3][at[found]]
        rest = keys[~found]
        if len(rest):
            at, known = _find(self.contexts, rest >> 8)
            escape = np.where(known[:, None], self.escapes[3][at], 0)
            at, seen = _find(self.keys[2], rest & 0xFFFFFF)
            shorter = self.escapes[2][rest >> 8 & 0xFFFF] + self.cost[1][rest & 0xFFFF]
            out[~found] = escape + np.where(seen[:, None], self.cost[2][at], shorter)
        return out


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def build_model(counts: list[tuple[str, int, int]] | pa.Table) -> Model | None:
    """The code lengths from how often each language has each number of ``grams``; None without any."""
    table = counts if isinstance(counts, pa.Table) else pa.table(
        {n: [c[i] for c in counts] for i, n in enumerate(("lang", "gram", "n"))})
    if not table.num_rows:
        return None
    names = table["lang"].to_pylist()
    languages = sorted(set(names))
    column = np.array([{n: i for i, n in enumerate(languages)}[x] for x in names])
    gram, n = table["gram"].to_numpy().astype(np.uint32), table["n"].to_numpy().astype(np.float64)

    def totals(number: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(number, return_inverse=True)
        sums = np.zeros((len(keys), len(languages)))
        np.add.at(sums, (place, column), weight)
        return keys, sums

    def of_contexts(keys: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Contexts, how often each was met, and how many bytes were met after it."""
        contexts, place = np.unique(keys >> 8, return_inverse=True)
        met, kinds = np.zeros((2, len(contexts), len(languages)))
        np.add.at(met, place, sums)
        np.add.at(kinds, place, sums > 0)
        return contexts, met, kinds

    def code(c, met, kinds, shorter) -> tuple[np.ndarray, np.ndarray]:
        """Bits of a byte met c times after a context, and of the escape from it: the escape counts the kinds."""
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(met > 0, -np.log2(kinds / (met + kinds)), 0)
            direct = -np.log2(c / (met + kinds))
        return np.where(c > 0, direct, escape + shorter), escape

    cost, keys_of, escapes = {}, {}, {}
    everything = np.full((256, len(languages)), 8.0)
    keys, sums = totals(gram & 0xFF, n)
    dense = np.zeros((256, len(languages)))
    dense[keys] = sums
    cost[0], _ = code(dense, dense.sum(0), (dense > 0).sum(0).astype(float), everything)
    keys, sums = totals(gram & 0xFFFF, n)
    dense = np.zeros((1 << 16, len(languages)))
    dense[keys] = sums
    pairs = dense.reshape(256, 256, -1)
    cost[1] = code(pairs, pairs.sum(1)[:, None], (pairs > 0).sum(1).astype(float)[:, None], cost[0][None])[0].reshape(1 << 16, -1)
    for k, mask in ((2, 0xFFFFFF), (3, 0xFFFFFFFF)):
        keys, sums = totals(gram & np.uint32(mask), n)
        contexts, met, kinds = of_contexts(keys, sums)
        at = np.searchsorted(contexts, keys >> 8)
        if k == 2:
            shorter = cost[1][keys & 0xFFFF]
        else:
            shorter = cost[2][np.searchsorted(keys_of[2], keys & 0xFFFFFF)]
        cost[k], _ = code(sums, met[at], kinds[at], shorter)
        _, escape = code(met, met, kinds, 0)
        keys_of[k] = keys
        if k == 2:
            escapes[2] = np.zeros((1 << 16, len(languages)))
            escapes[2][contexts] = escape
        else:
            escapes[3] = escape
    return Model(languages, keys_of, {k: v.astype(np.float32) for k, v in cost.items()}, contexts,
                 {k: v.astype(np.float32) for k, v in escapes.items()})


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Learn from about ``per_language`` documents of each language, chosen by a hash of the id among all that have
    text and language and aren't held out.  What goes to the driver is bounded by this sample.
    """
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out() & F.col("doc_id").isNotNull())
    shares = known.groupBy("lang").count().select(F.col("lang").alias("_lang"), (F.lit(float(per_language)) / F.col("count")).alias("_share"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = known.join(F.broadcast(shares), known["lang"] == shares["_lang"]).filter(place < F.col("_share"))
    counts = chosen.select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
    return build_model(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())


def code_lengths(texts: list[str], model: Model) -> np.ndarray:
    """Bits of each text (rows) under each language (columns); long texts go through in slices."""
    out = np.zeros((len(texts), len(model.languages)))
    parts, owners, held = [], [], 0

    def flush() -> None:
        nonlocal parts, owners, held
        if parts:
            keys = np.concatenate([grams(p) for p in parts])
            sizes = np.array([len(p) - ORDER for p in parts])
            bits = np.add.reduceat(model.bits(keys), np.cumsum(sizes) - sizes, axis=0, dtype=np.float64)
            np.add.at(out, owners, bits)
        parts, owners, held = [], [], 0

    for i, text in enumerate(texts):
        data = encoded(text)
        for a in range(0, len(data) - ORDER, BYTES):
            parts.append(data[a:a + BYTES + ORDER])
            owners.append(i)
            held += len(parts[-1])
            if held >= BYTES:
                flush()
    flush()
    return out


def _scored(rows: DataFrame, model: Model | None, text: int, passed: int) -> DataFrame:
    """The first ``passed`` columns of ``rows`` and lang_pred and score; ``text`` is the text's place, and the last
    column tells whether it has a letter.
    """
    handle = rows.sparkSession.sparkContext.broadcast(model) if model else None  # bounded by the sample learned from

    def judge(texts: list[str], names: np.ndarray, scores: np.ndarray, at: np.ndarray) -> None:
        bits = code_lengths(texts, handle.value)
        sizes = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts])
        rate = bits * (np.minimum(sizes, PASSAGE) / sizes)[:, None]
        weight, best = np.exp2(rate.min(1)[:, None] - rate), bits.argmin(1)
        names[at] = [handle.value.languages[i] for i in best]
        scores[at] = weight[np.arange(len(texts)), best] / weight.sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                batch = whole.slice(a, ROWS)
                at = np.flatnonzero(np.array(batch.columns[-1].to_pylist(), bool))
                names, scores = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
                if handle and len(at):
                    judge(batch.column(text).take(pa.array(at)).to_pylist(), names, scores, at)
                yield pa.RecordBatch.from_arrays([*batch.columns[:passed], pa.array(names.tolist(), pa.string()), pa.array(scores)],
                                                 [*batch.schema.names[:passed], "__lang_pred", "__score"])

    schema = T.StructType([*rows.schema.fields[:passed], T.StructField("__lang_pred", T.StringType()), T.StructField("__score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def _letters() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letters")


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) for every row of ``docs``.

    The language with the shortest code for the whole text wins, ties by name.  A null text or one without a
    letter is ``und`` with score 0, and so is every text when nothing was learned.  Only the text is looked at.  A very
    long text is coded whole, in slices; repeated rows get equal results; a null doc_id is not held out; an empty table
    gives an empty result, and other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text", _letters())
    return _scored(rows, model, 2, 2).withColumnsRenamed({"__lang_pred": "lang_pred", "__score": "score"})


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that have a language; those that are ``und`` (null texts and texts without a letter) go.

    Repeated rows stay each; very long texts are read whole; an empty table stays empty; all columns pass through,
    whatever their names.
    """
    rows = docs.select(*docs.columns, _letters())
    return _scored(rows, model, docs.columns.index("text"), len(docs.columns)).filter(F.col("__lang_pred") != UNKNOWN).select(*docs.columns)
