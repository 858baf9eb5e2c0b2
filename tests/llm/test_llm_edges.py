"""Every operator over awkward rows, repeated with clashing columns, and over an empty table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from veritill.llm import (
    ball_tree, language_crf, license_scan, line_templates, minhash, packing, piece_codec, spot_signatures, suffix_dedup, warc,
)
from veritill.llm.queries import byte_model, piece_model


def _language(df):
    return language_crf.predict(df, language_crf.learn(df, F.col("doc_id").isNotNull()))


OPERATORS = {
    "suffixes": suffix_dedup.removed_digests,
    "pieces": lambda df: piece_codec.encode_digests(df, piece_model()),
    "licenses": license_scan.license_summary,
    "spots": spot_signatures.edited_and_next,
    "near_duplicates": minhash.near_duplicates,
    "language": _language,
    "lines": line_templates.without_templates,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(frame, awkward, name):
    found = OPERATORS[name](frame(awkward)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in awkward)


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(frame, name):
    assert OPERATORS[name](frame([])).collect() == []


def test_packing_awkward_rows(frame, awkward):
    found = packing.pack_documents(frame(awkward), *byte_model()).collect()
    assert {r["doc_id"] for r in found} == {r[0] for r in awkward}
    places = {}
    for r in found:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    assert packing.pack_documents(frame([]), *byte_model()).collect() == []


def test_archive_awkward_rows(spark):
    rows = [(1, "http://a\r\nX: y", "one"), (2, None, "one"), (3, "http://c", None), (4, "http://d", ""), (5, "e", "\r\n\r\nWARC/1.1\r\n\r\n"),
            (6, "f", "é" * 100_000), (7, "g", "same"), (7, "g", "same"), (None, "h", "same"), (None, "i", "alone")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as bytes", "'x' as sha256", "'y' as holder")
    found = warc.resolve(warc.read(spark, warc.export(*warc.store(df)))).collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r["page_id"], []).append((r["record_type"], r["refers_to"], r["payload_bytes"]))
    assert by[1] == [("revisit", 2, 3)] and by[2] == [("response", None, 3)]
    assert by[3] == [("revisit", 4, 0)] and by[6] == [("response", None, 200_000)]
    assert by[7] == [("response", None, 4)] * 2
    assert sorted(by[None], key=str) == [("response", None, 5), ("revisit", 7, 4)]
    empty = spark.createDataFrame([], df.schema)
    assert warc.resolve(warc.read(spark, warc.export(*warc.store(empty)))).collect() == []


def test_one_page_with_two_payloads(spark):
    rows = [(1, "u", "a"), (1, "u", "b"), (0, "u", "b"), (-1, "u", "a")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = warc.resolve(warc.read(spark, warc.export(*warc.store(df)))).collect()
    digests = {text: warc.base64.b32encode(warc.hashlib.sha1(text.encode()).digest()).decode() for text in "ab"}
    assert sorted((r["page_id"], r["payload_digest"], r["record_type"], r["refers_to"] or 9) for r in found) == sorted(
        [(1, digests["a"], "response", 9), (1, digests["b"], "response", 9), (0, digests["b"], "revisit", 1), (-1, digests["a"], "revisit", 1)]
    )


def test_small_payloads_are_no_revisits(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id bigint, url string, html string")
    found = warc.resolve(warc.read(spark, warc.export(*warc.store(df, min_bytes=5)))).collect()
    assert {r["page_id"]: r["refers_to"] for r in found} == {1: None, 2: None, 3: 4, 4: None}


def test_vectors_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, []), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [0.5, 0.5]),
            (7, [0.5, 0.5]), (None, [9.0, 9.0]), (8, [1.0]), (20, [-1.0, 0.015]), (40, [2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as v", "2 as dim", "3 as shard", "4 as block")
    found = ball_tree.top_k(df, F.col("vec_id") % 20 == 0, k=3).collect()
    of = {q: [(r["rank"], r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 20, 40)}
    assert of[0] == [(1, 1, 64 * 64 + 32 * 32), (2, 7, 64 * 32 + 32 * 32), (3, 20, -64 * 64)]
    assert of[20] == [(1, 7, -64 * 32), (2, 0, -64 * 64), (3, 1, -64 * 64)]
    assert of[40] == [(1, 8, 128 * 64)]
    assert ball_tree.top_k(spark.createDataFrame([], df.schema), F.col("vec_id") % 20 == 0).collect() == []
