"""The pipeline against brute force, stage by stage."""

from __future__ import annotations

import corpus_pipeline
from limpid.llm import quality
from tests.llm import brute
from tests.llm.conftest import SF


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_each_stage_on_its_predecessor(spark, documents):
    names, stages = zip(*corpus_pipeline.STAGES, strict=True)
    assert len(names) == 4
    good = stages[0](spark, documents, SF)
    assert good.columns == documents.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = quality.quality_scores(documents, labels).collect()
    assert sorted(i for i, _ in rows_of(good)) == sorted(r["doc_id"] for r in scores if r["predicted"])

    single = stages[1](spark, good, SF)
    assert single.columns == documents.columns
    kept = [i for i, _, _, k in brute.near_groups(rows_of(good)) if k]
    assert sorted(i for i, _ in rows_of(single)) == sorted(kept)

    cleaned = stages[2](spark, single, SF)
    assert cleaned.columns == documents.columns
    texts = dict(rows_of(cleaned))
    single_rows = rows_of(single)
    for i, data, gone in brute.repeated(single_rows, lambda t: t.encode(), 50):
        mask = list(gone)
        starts = [p for p, b in enumerate(data) if b & 0xC0 != 0x80] + [len(data)]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            mask[a:b] = [any(gone[a:b])] * (b - a)
        assert texts[i] == bytes(b for b, m in zip(data, mask, strict=True) if not m).decode()
    assert {r["n_chars"] - len(r["text"]) for r in cleaned.collect()} == {0}

    packed = stages[3](spark, cleaned, SF)
    assert {r["doc_id"] for r in packed.collect()} == set(texts)
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_pipeline_of_no_documents(spark, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == documents.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0
