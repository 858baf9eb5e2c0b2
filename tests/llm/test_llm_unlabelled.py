"""The language stage where there is little or nothing to learn from."""

from __future__ import annotations

import corpus_pipeline
from llm_samples import prose
from pyspark.sql import functions as F

from veritill.llm import language_crf


def test_unlabelled_documents_stay(spark, frame):
    rows = [(1, prose(1, 40), None), (2, "12 --", None), (3, None, None), (4, "ab", None)]
    kept = corpus_pipeline.language(spark, frame(rows, clashing=False), "").collect()
    assert {r["doc_id"]: (r["text"], r["lang"]) for r in kept} == {1: (rows[0][1], None), 4: ("ab", None)}


def test_short_texts_are_learned(frame):
    rows = [(i, "guten tag" if i % 2 else "good day", "de" if i % 2 else "en") for i in range(20)]
    model = language_crf.learn(frame(rows), F.col("doc_id").isNotNull())
    assert model is not None and model.labels == ["de", "en"]
