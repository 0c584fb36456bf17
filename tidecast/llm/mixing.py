"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidecast.llm.common import WORD, same_keys, stored, with_row, with_running_sum
from tidecast.session import write_scratch

#: Weights of the sources in code point order, repeating; how often a source may be read at most.
WEIGHTS, PASSES = (1, 2, 3), 3


def sized(docs: DataFrame) -> DataFrame:
    """_row, doc_id, source, size in words (a null text has none) and ``_text``, which orders rows of equal id."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return with_row(docs, columns=["doc_id", "source", "text"]).select("_row", "doc_id", "source", words.alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("_text"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """source, source_size and target: shares of the total by weight, none above ``passes`` times its source's size.

    The excess of a source that is full goes to the others by weight.  Sources fill up in the order of size over
    weight, so one pass over them in this order finds which are full.  The table has one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")).cast("long")
    totals = totals.select("source", "source_size", weight.alias("_w"), (F.col("source_size") * passes).alias("_cap"))
    rising = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(0, Window.unboundedFollowing)
    totals = totals.select("*", F.sum("source_size").over(everything).alias("_all"),
                           F.coalesce(F.sum("_cap").over(before), F.lit(0)).alias("_full"),
                           F.sum("_w").over(after).alias("_rest"))
    totals = totals.withColumn("_capped", F.col("_cap") * F.col("_rest") <= F.col("_w") * (F.col("_all") - F.col("_full")))
    open_words = F.col("_all") - F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(~F.col("_capped"), F.col("_w")).otherwise(0)).over(everything)
    share = (F.col("_w") * open_words).cast("double") / F.when(open_weight > 0, open_weight).cast("double")
    return totals.select("source", "source_size", F.when(F.col("_capped"), F.col("_cap").cast("double"))
                         .otherwise(share).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """The mix: one row per copy taken of a document, in the order of its virtual finish time.

    Columns: _row (number of the row in ``docs``), doc_id, source, size, source_size, target, copy (from 0),
    finish, words (taken of this copy) and position (words of the mix before it).

    Documents are shuffled by the MD5 of their id.  The finish time of a copy is the words its source has
    served with it, over the source's target; time 1 is when the total budget is reached.  Copies are sorted
    by it over all tasks.  A copy that is still being served at time 1 gives only its first words, at most one per
    source; later ones are cut off, so every source gives its target to the word.  A source is summed up over
    ranges of the shuffle, so one that holds most rows is spread over tasks.

    A null source is a source, the last; null and empty texts have no words and are not taken; rows with equal
    id are each a document, in the order of their texts' MD5; very long texts count whole; other columns are ignored; an
    empty table gives an empty mix.  ``docs`` comes from ``stored``.
    """
    sizes = write_scratch(sized(docs), "sizes")
    return _served(sizes, source_targets(sizes, weights, passes), passes)


def _served(sizes: DataFrame, targets: DataFrame, passes: int) -> DataFrame:
    shuffled = sizes.withColumn("_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    served = with_running_sum(shuffled, ["_key", "doc_id", "_text", "_row"], "size", ["source"])
    joined = served.join(targets, same_keys(served, targets, ["source"])).drop(targets["source"])
    copies = joined.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(passes - 1).cast("long"))))
    start = F.col("copy") * F.col("source_size") + F.col("_before")
    words = F.greatest(F.lit(0).cast("long"), F.least("size", F.floor("target") - start))
    copies = copies.withColumns({"words": words, "finish": (start + F.col("size")) / F.col("target")}).filter("words > 0")
    copies = copies.select("_row", "doc_id", "source", "size", "source_size", "target", "copy", "finish", "words", "_key", "_text")
    placed = with_running_sum(copies, ["finish", "source", "_key", "doc_id", "_text", "_row", "copy"], "words", name="position")
    return placed.drop("_key", "_text")


def taken_words(docs: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, ``taken``, the words the mix takes of it, and
    first_position, the words of the mix before its first copy (-1 if it is not taken).
    """
    sizes = write_scratch(sized(stored(docs)), "sizes")
    targets = source_targets(sizes, weights, passes)
    given = _served(sizes, targets, passes).groupBy("_row").agg(F.sum("words").alias("taken"), F.min("position").alias("first_position"))
    rows = sizes.join(targets, same_keys(sizes, targets, ["source"])).drop(targets["source"]).join(given, "_row", "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
                       F.coalesce("first_position", F.lit(-1).cast("long")).alias("first_position"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """The rows of ``docs`` as the mix holds them: repeated by copies or left out, always with their whole texts.

    The document in service when its source's budget ends is taken if at least half of it was to be served, which
    leaves the source nearer to its target.  Null and empty texts are left out, a null source is the last one, rows of
    equal id are documents each; all columns pass through, whatever their names; an empty table stays empty.
    """
    docs = stored(docs)
    taken = mix(docs, weights, passes).filter("2 * words >= size").select(F.col("_row").alias("__mix_of"))
    return with_row(docs, "__mix_row").join(taken, F.col("__mix_row") == F.col("__mix_of")).select(*docs.columns)
