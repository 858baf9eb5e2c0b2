"""Long repeats of short words."""

from __future__ import annotations

import hashlib
import random

import corpus_pipeline
from llm_samples import prose

import __spark_entry__ as entry


def test_passage_of_short_words(spark, frame):
    """51 words recur however short they are; 50 such words do not count."""
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.choice((2, 3)))) for _ in range(51)]
    passage, less = " ".join(words), " ".join(w[::-1] for w in words[:50])
    assert len(passage) < corpus_pipeline.REPEAT_BYTES
    texts = [f"{prose(i, 30)} q{i} {passage} z{i} {prose(50 + i, 30)} é{i}  {less} y{i}" for i in range(3)]
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.suffixes(spark, frame(list(enumerate(texts)), clashing=False), "").collect()}
    assert kept == {i: text.replace(passage, "") for i, text in enumerate(texts)}


def test_query_shows_what_is_left(spark, frame, tmp_path):
    """Repeated passages of over 50 words are gone from the text of the query, all else stands; the digests are of the same bytes."""
    passage, clean, shared = prose(70, 80), prose(71, 200), "é" * 250
    assert len(passage.split()) > 50 and len(passage) >= 400
    texts = [*(f"{prose(72 + i, 30)} q{i} {passage} {i}z {prose(82 + i, 30)}" for i in range(3)), clean, None, "", f"ê{shared}è", f"ë{shared}ê"]
    frame(list(enumerate(texts)), clashing=False).write.parquet(f"{tmp_path}/documents.parquet")
    found = entry.queries()["op1_suffixes"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts[:6]):
        # the blanks around the passage recur with it
        left = (text or "").replace(f" {passage} ", "")
        assert rows[i]["text"] == left
        assert rows[i]["n_bytes"] == len((text or "").encode()) == rows[i]["n_removed"] + len(left.encode())
        assert rows[i]["kept_sha256"] == hashlib.sha256(left.encode()).hexdigest()
    assert [rows[i]["n_spans"] for i in range(6)] == [1, 1, 1, 0, 0, 0]
    # the first byte of all these letters is the same, so the run takes half of the letter behind it
    assert [rows[i]["text"] for i in (6, 7)] == ["ê", "ë"]
    assert rows[6]["kept_sha256"] == hashlib.sha256("êè".encode()[:2] + "è".encode()[1:]).hexdigest()
