"""Order MinHash fingerprints of whole texts, and their likeness, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Letters of a token, tokens of a k-mer, bins of the hash, and k-mers that a bin keeps.
TOKEN, KMER, BIN_BITS, KEPT = 8, 3, 6, 2
#: A packed number holds a hash above and a position in the text below.
PLACE_BITS = 24
PLACES = (1 << PLACE_BITS) - 1
#: 2 ** NEAR neighbouring doc_ids share a part, 2 ** COARSE parts a coarser one.
NEAR, COARSE = 7, 12
TOKENS = rf"[^\x20\x09-\x0D]{{1,{TOKEN}}}"


def _pack(hashed: Column, place: Column) -> Column:
    return hashed.bitwiseAND(F.lit(~PLACES)).bitwiseOR(F.least(place.cast("long"), F.lit(PLACES)))


def _starts(numbers: str, shift: int) -> Column:
    """Where runs of equal leading bits begin in a sorted array."""
    def first(x: Column, i: Column) -> Column:
        same = F.shiftright(x, shift) == F.shiftright(F.get(F.col(numbers), i - 1), shift)
        return F.when((i > 0) & same, F.lit(-1)).otherwise(i)
    return F.filter(F.transform(numbers, first), lambda i: i >= 0)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``, an array with one long per bin that has k-mers: the bin above, 32 bits of the tuple's hash below.

    Tokens are runs of up to 8 characters without ASCII white space, a k-mer is three in a row (all, if fewer), and
    the n-th occurrence of a k-mer in a text is hashed together with n.  Bins cut the range of these hashes; each
    keeps its ``KEPT`` smallest, puts them in the order of the text, and hashes that tuple.  The columns in between
    are each used more than once, so Spark keeps them apart and computes them once per row.
    """
    t, p, s, g, m, b = (f"__{name}_{x}" for x in "tpsgmb")
    i = F.sequence(F.lit(0), F.size(t) - KMER)
    grams = F.transform(i, lambda i: _pack(F.xxhash64(*[F.get(F.col(t), i + j) for j in range(KMER)]), i))
    one = F.array(_pack(F.xxhash64(F.concat_ws(" ", t)), F.lit(0)))
    none = F.filter(one, lambda x: F.lit(False))
    df = df.withColumn(t, F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKENS), F.lit(0)))
    df = df.withColumn(p, F.sort_array(F.when(F.size(t) >= KMER, grams).when(F.size(t) > 0, one).otherwise(none)))
    df = df.withColumn(s, _starts(p, PLACE_BITS))

    def numbered(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(F.col(s), k + 1), F.size(p))
        kmer = F.shiftright(F.get(F.col(p), start), PLACE_BITS)
        return F.transform(F.sequence(start, stop - 1), lambda q: _pack(
            F.xxhash64(kmer, q - start), F.get(F.col(p), q).bitwiseAND(F.lit(PLACES))))

    df = df.withColumn(g, F.sort_array(F.flatten(F.transform(s, numbered))))
    bits = 64 - BIN_BITS
    df = df.withColumn(m, F.filter(g, lambda x, i: (i < KEPT) | (
        F.shiftright(x, bits) != F.shiftright(F.get(F.col(g), i - KEPT), bits))))
    df = df.withColumn(b, _starts(m, bits))

    def of_bin(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(F.col(b), k + 1), F.size(m))
        turned = F.transform(F.slice(m, start + 1, stop - start), lambda x: F.shiftleft(
            x.bitwiseAND(F.lit(PLACES >> 1)), 64 - PLACE_BITS).bitwiseOR(F.shiftrightunsigned(x, PLACE_BITS)))
        tuple_hash = F.xxhash64(F.transform(F.sort_array(turned), lambda x: x.bitwiseAND(F.lit((1 << 64 - PLACE_BITS) - 1))))
        number = F.shiftright(F.get(F.col(m), start), bits) + (1 << BIN_BITS - 1)
        return F.shiftleft(number, 32).bitwiseOR(tuple_hash.bitwiseAND(F.lit((1 << 32) - 1)))

    return df.withColumn(name, F.transform(b, of_bin)).drop(t, p, s, g, m, b)


def as_text(fingerprint: str) -> Column:
    """Ten hex digits for each bin that has k-mers: its number and its hash."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 10, "0"))), "")


def likeness(a: str, b: str) -> Column:
    """The share of bins with equal tuples, of those that either text has; 1 for two texts without words."""
    def bins(c: str) -> Column:
        return F.transform(c, lambda x: F.shiftright(x, 32))
    held = F.size(F.array_union(bins(a), bins(b)))
    return F.when(held == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / held)


def neighbourhoods(ids: DataFrame) -> DataFrame:
    """_part, _first (its smallest doc_id) and _previous (the part before it; the last one's for the first).

    A part holds the ids that are equal but for the last ``NEAR`` bits.  Parts are put in order within coarser parts, and only
    the ends of those meet in one task.
    """
    parts = ids.groupBy("_part").agg(F.min("doc_id").alias("_first"))
    parts = parts.withColumn("_coarse", F.shiftright("_part", COARSE))
    inside = Window.partitionBy("_coarse").orderBy("_part")
    ends = parts.groupBy("_coarse").agg(F.max("_part").alias("_end"))
    before = F.lag("_end").over(Window.orderBy("_coarse"))
    ends = ends.select(F.col("_coarse").alias("_c"), F.coalesce(before, F.max("_end").over(Window.partitionBy())).alias("_end_before"))
    parts = parts.withColumn("_lag", F.lag("_part").over(inside))
    return parts.join(ends, parts["_coarse"] == ends["_c"]).select("_part", "_first", F.coalesce("_lag", "_end_before").alias("_previous"))


def order_minhash(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; one row per row.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next document
    (by doc_id, then text; the first after the last).  Texts are dealt once, by neighbouring doc_ids; the first text
    of each neighbourhood is also sent to the one before it.  Null is an empty text; rows without doc_id come
    first and rows with equal ids follow each other by text.  A sole document is followed by itself.
    """
    whole = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    least = F.lit(-(1 << 62))
    rows = whole.withColumn("_part", F.shiftright(F.coalesce("doc_id", least), NEAR))
    parts = neighbourhoods(rows.select("_part", F.coalesce("doc_id", least).alias("doc_id")).repartition("_part"))
    rows = with_fingerprint(rows, "text", "_fp")
    in_order = Window.partitionBy("_part").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    # both uses of the rows of a part share one exchange, so texts move once
    heads = rows.withColumn("_lag", F.lag(F.lit(1)).over(in_order)).filter("_lag IS NULL")
    heads = heads.join(parts.withColumnRenamed("_part", "_own"), F.col("_part") == F.col("_own"))
    heads = heads.select(F.col("_previous").alias("_before"), F.struct("text", "_fp").alias("_head"))
    local = rows.select("*", F.lead("text").over(in_order).alias("_next"), F.lead("_fp").over(in_order).alias("_next_fp"))
    joined = local.join(heads, local["_part"] == heads["_before"], "left")
    joined = joined.select("doc_id", "text", "_fp", F.coalesce("_next", "_head.text").alias("_next"), F.coalesce("_next_fp", "_head._fp").alias("_next_fp"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("_next", F.lit(1), half))
    joined = joined.select("doc_id", F.length("text").cast("long").alias("n_chars"), "_fp", "_next_fp", edited.alias("_edited"))
    joined = with_fingerprint(joined.withColumn("edited_sha256", F.sha2("_edited", 256)), "_edited", "_edited_fp")
    return joined.select("doc_id", "n_chars", "edited_sha256", as_text("_fp").alias("fingerprint"), as_text("_edited_fp").alias("edited_fingerprint"),
                         likeness("_fp", "_edited_fp").alias("near_edited"), likeness("_fp", "_next_fp").alias("near_next"))
