"""Conversations in reply order: quoted passages are linked to the messages they come from and taken out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidecast.llm.common import with_running_sum
from tidecast.session import write_scratch

QUOTED = r"(?m)^[ \t]*>"
MARKS = r"^[ \t]*(?:>[ \t]?)*"
#: A line that announces a quotation, right above one.
ANNOUNCES = r"(?i)^\s*(?:on|am|le|el)\b.{1,200}\b(?:wrote|schrieb.{0,80}|a écrit|escribió)\s*:\s*$"
WHOLE, PARAGRAPH, LINE = 3, 2, 1


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def passages(text: Column) -> Column:
    """What of a text can be recognised: itself, its paragraphs and its lines, as (weight, hash) of the normalised."""
    def part(weight: int, pieces: Column) -> Column:
        return F.transform(pieces, lambda x: F.struct(F.lit(weight).alias("weight"), normalised(x).alias("passage")))
    every = F.concat(part(WHOLE, F.array(text)), part(PARAGRAPH, F.split(text, r"\n[ \t]*\n")), part(LINE, F.split(text, "\n")))
    return F.transform(F.filter(every, lambda x: x["passage"] != ""), lambda x: F.struct(x["weight"].alias("weight"), F.md5(x["passage"]).alias("hash")))


def with_levels(messages: DataFrame) -> DataFrame:
    """Add ``_lines`` (level of quotation and content), ``_own`` (the text without quotes) and ``_blocks``: runs of
    quoted lines of one level, with level and text.
    """
    lines = F.split(F.coalesce("text", F.lit("")), r"\r?\n", -1)
    level = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", ""))
    parsed = F.transform(lines, lambda x: F.struct(level(x).alias("level"), F.when(level(x) > 0, F.regexp_replace(x, MARKS, "")).otherwise(x).alias("line")))
    out = messages.withColumn("_lines", parsed)

    def announces(x: Column, i: Column) -> Column:
        return (x["level"] == 0) & x["line"].rlike(ANNOUNCES) & F.coalesce(F.get("_lines", i + 1)["level"] > 0, F.lit(False))
    quoted = F.col("text").rlike(QUOTED)
    own = F.transform(F.filter("_lines", lambda x, i: (x["level"] == 0) & ~announces(x, i)), lambda x: x["line"])
    stripped = F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")
    begins = F.filter(F.transform("_lines", lambda x, i: F.when((i > 0) & (x["level"] == F.get("_lines", i - 1)["level"]), F.lit(-1)).otherwise(i)), lambda i: i >= 0)
    out = out.withColumns({"_own": F.when(quoted, stripped).otherwise(F.coalesce("text", F.lit(""))), "_begins": begins})
    blocks = F.transform("_begins", lambda a, k: F.struct(F.get("_lines", a)["level"].alias("level"), F.array_join(F.transform(
        F.slice("_lines", a + 1, F.coalesce(F.get("_begins", k + 1), F.size("_lines")) - a), lambda x: x["line"]), "\n").alias("text")))
    return out.withColumn("_blocks", F.when(quoted, F.filter(blocks, lambda b: b["level"] > 0)).otherwise(F.filter(blocks, lambda b: F.lit(False)))).drop("_begins")


def quotation_links(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, source, weight: the messages that the quotes of a message come from, at each level.

    A passage comes from the first message of the conversation that holds it as its own text.  A block, a run of quoted
    lines of one level, takes the heaviest of its passages that have one in an earlier turn (a whole before a paragraph
    before a line), of equal ones the latest message; blocks of one level may come from different messages.  Of blocks
    from the same message the heaviest weight is kept.  Only conversations that quote are looked at.
    """
    parsed = with_levels(messages)
    quotes = parsed.select("conv_id", "turn", F.posexplode("_blocks").alias("_place", "_b"))
    # rows that share conv_id and turn have blocks of their own: equal places are told apart by their text
    quotes = quotes.select("conv_id", "turn", "_b.level", F.struct("_place", F.md5("_b.text").alias("hash")).alias("_block"),
                           F.explode(passages(F.col("_b.text"))).alias("_p"))
    quotes = quotes.select("conv_id", "turn", "level", "_block", "_p.weight", "_p.hash")
    quoting = messages.filter(F.col("text").rlike(QUOTED)).select("conv_id").distinct()
    own = parsed.join(quoting, "conv_id", "left_semi").select("conv_id", "turn", F.explode(passages(F.col("_own"))).alias("_p"))
    sources = own.groupBy("conv_id", F.col("_p.hash").alias("hash")).agg(F.min("turn").alias("source"))
    found = quotes.distinct().join(sources, ["conv_id", "hash"]).filter("source < turn")
    best = found.groupBy("conv_id", "turn", "level", "_block").agg(F.max(F.struct("weight", "source")).alias("_best"))
    return best.groupBy("conv_id", "turn", "level", F.col("_best.source").alias("source")).agg(F.max("_best.weight").alias("weight"))


def threads(replies: DataFrame) -> DataFrame:
    """conv_id, turn, thread (the first message of the chain of replies) and depth, by doubling the known step.

    ``replies`` has conv_id, turn and reply_to, unique; a reply always has a later turn than what it answers.
    """
    steps = write_scratch(replies.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        onward = steps.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("thread").alias("_to"), F.col("depth").alias("_d"))
        joined = steps.join(onward, (F.col("conv_id") == F.col("_c")) & (F.col("thread") == F.col("_t")), "left")
        if joined.filter("_to IS NOT NULL").limit(1).count() == 0:
            return steps
        steps = write_scratch(joined.select("conv_id", "turn", F.coalesce("_to", "thread").alias("thread"),
                                            (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth")), "threads")


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """One row per message: conv_id, position, turn, role, text without quotes, reply_to, thread, depth, quoted.

    ``reply_to`` is the message that the first level of quotes comes from (of several the one quoted by the heaviest
    passage, then the latest), ``quoted`` all levels with all their messages.  Messages of a conversation are ordered by thread (the message its replies go back to) and turn, so a
    reply follows what it answers; ``position`` counts from 0.  A conversation may hold any share of the rows.

    A message whose quotes come from nowhere, or without any, begins a thread.  A null text is empty; repeated rows
    are messages each, and rows that share conv_id and turn share their links; without conv_id or turn there are no
    links; an empty table gives an empty result; a very long message is parsed whole, in one row; other columns are ignored.
    """
    messages = conversations.select("conv_id", "turn", "role", "text")
    links = write_scratch(quotation_links(messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL")), "links")
    quoted = links.groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(F.struct("level", "source"))).alias("quoted"),
                                                  F.max(F.when(F.col("level") == 1, F.struct("weight", "source")))["source"].alias("reply_to"))
    quoted = write_scratch(quoted, "quoted")
    replies = quoted.filter("reply_to IS NOT NULL").select("conv_id", "turn", "reply_to")
    placed = quoted.join(threads(replies), ["conv_id", "turn"], "left")
    placed = placed.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), "quoted", "reply_to", "thread", "depth")
    clean = with_levels(messages.withColumn("_row", F.monotonically_increasing_id())).select("_row", "conv_id", "turn", "role", F.col("_own").alias("text"))
    joined = clean.join(placed, (F.col("conv_id") == F.col("_c")) & (F.col("turn") == F.col("_t")), "left")
    out = joined.select("_row", "conv_id", "turn", "role", "text", "reply_to", F.coalesce("thread", "turn").alias("thread"),
                        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "quoted", F.lit(1).alias("_one"))
    placed = with_running_sum(out, ["thread", "turn", "_row"], "_one", ["conv_id"], "position")
    return placed.select("conv_id", "position", "turn", "role", "text", "reply_to", "thread", "depth", "quoted")
