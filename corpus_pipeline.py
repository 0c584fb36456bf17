"""The corpus pipeline: language, near duplicates, personal data, source mix, packing.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written and read again as the next one's docs.
All but the last return the columns of ``documents``.  Null and empty texts have no language and go in the first stage; very
long texts are handled whole in all; rows that repeat go in the second; an empty table stays empty through all stages, and
further columns, whatever their names, pass through to the last.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidecast.llm import langid, mixing, packing, simhash, surrogates  # noqa: E402
from tidecast.llm.queries import KEY, read, vocabulary  # noqa: E402
from tidecast.session import configure, write_scratch  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go; the models learn from the stage's own input."""
    configure(spark)
    return langid.identified(docs, langid.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near duplicates one row stays: that with the smallest doc_id, see ``simhash``.

    Fingerprints of three-word shingles link at three or fewer differing bits.  Rows without a doc_id are grouped like
    others and come after those with one; of rows that repeat it the first stays.
    """
    configure(spark)
    return simhash.without_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every entity is replaced by its surrogate; n_chars is that of the new text."""
    configure(spark)
    replaced = surrogates.replace_entities(docs, KEY)
    return with_length(replaced)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, kept or left out, always whole, so that sources come near their shares of the words."""
    configure(spark)
    return with_length(mixing.mixed_documents(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    configure(spark)
    return packing.pack_documents(docs, vocabulary())


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars``, if there, counted again from the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language), ("simhash_near_dedup", near_dedup), ("pii_surrogates", personal_data),
    ("source_mix", source_mix), ("packing", packed),
]

#: SQL has no learned language model, hash links or tokenizer, so the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
