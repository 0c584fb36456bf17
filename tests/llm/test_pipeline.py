"""The pipeline's stages on their own input, against plain versions."""

from __future__ import annotations

from collections import Counter

from helpers import DOCS, awkward_documents, stored
from test_operators import check_packing, kept_ids, plain_classes

import corpus_pipeline


def test_stages(spark, tmp_path):
    docs, rows = awkward_documents(spark, tmp_path)
    kept = dict((name, None) for name, _ in corpus_pipeline.STAGES)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / name)
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns and dict(docs.dtypes) == dict(before.dtypes)
        kept[name] = docs.collect()
    languages, dedup, private, mixed, pieces = kept.values()
    assert Counter(r.doc_id for r in languages) == Counter(d for d, t, *_ in rows if t and any(c.isalpha() for c in t))
    assert Counter(r.doc_id for r in dedup) == kept_ids(plain_classes([(r.doc_id, r.text) for r in languages]))
    assert Counter(private) == Counter(dedup)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in private} and all(r.n_chars == len(r.text) for r in mixed)
    check_packing([(r.doc_id, r.text) for r in mixed], pieces)


def test_empty_table(spark, tmp_path):
    docs = stored(spark, tmp_path, [], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 100
