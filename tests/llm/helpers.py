"""Small stored tables with awkward rows."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, fp long, _row long, bucket string, kind string"


def stored(spark, tmp_path, rows, schema, name="t", partitions=2):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, schema).repartition(partitions).write.parquet(path)
    return spark.read.parquet(path)


def documents(spark, tmp_path, rows, name="docs"):
    """Rows of (doc_id, text, lang, source) with further columns whose names operators might use themselves."""
    full = [(d, t, g, s, None if t is None else len(t), -1, -2, -3, "b", "k") for d, t, g, s in rows]
    return stored(spark, tmp_path, full, DOCS, name)


def words(seed, n, vocabulary=4000, letters="abcdefghij"):
    import random

    r = random.Random(seed)
    make = lambda i: "".join(letters[int(c)] for c in str(i + 1000))
    return " ".join(make(r.randrange(vocabulary)) for _ in range(n))


AWKWARD = [None, "", "   \n\t ", "!!! 123 ###", "one", "Two words", "x" * 5000, "Same text here again", "Same text here again"]


def awkward_documents(spark, tmp_path, name="docs"):
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else f"s{i % 4}") for i, t in enumerate(AWKWARD)]
    rows += [(100 + i, words(i, 60 + 40 * i), "en", "s1") for i in range(8)]
    rows += [(200, words(50, 30_000), "en", "s2"), (8, AWKWARD[8], None, "s0"), (None, "no id at all", "en", "s1")]
    return documents(spark, tmp_path, rows, name), rows
