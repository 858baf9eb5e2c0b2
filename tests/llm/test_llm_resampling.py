"""Importance resampling against plain counting."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from llm_samples import prose

import __spark_entry__ as entry
from veritill.llm import resampling

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text):
    words = WORD.findall((text or "").encode().lower())
    return len(words), [zlib.crc32(b" ".join(words[i:i + k])) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def _plain(rows, target):
    source = [(doc, *_features(text)) for doc, text in rows]
    s = Counter(b for *_, found in source for b in found)
    t = Counter(b for text in target for b in _features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)
    }
    out = []
    for doc, words, found in source:
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    enough = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(enough[: 5 * len(enough) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def _rows(found):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in found.collect()), key=str)


def _samples():
    return [(1000 + i, prose(i, 15 + i % 60)) for i in range(300)]


@pytest.mark.parametrize("words", [7, 1 << 19])
def test_resampling(spark, frame, awkward, monkeypatch, words):
    """Also where a block of words ends inside of the texts."""
    monkeypatch.setattr(resampling, "STEP_WORDS", words)
    rows = [r[:2] for r in awkward if not r[1] or len(r[1]) < 20_000 or words > 7] + _samples()
    target = [None, "", prose(4, 80), prose(5, 80).upper(), "Ünïcode ÀB 12-34 and the"]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    found = resampling.resample(frame(rows), benchmark)
    assert _rows(found) == _plain(rows, target)


def test_ties_and_one_hot_row(spark, frame):
    """A third of all rows are one document; equal scores are ranked by id, repeated rows each for itself."""
    rows = [(7, prose(1, 40))] * 200 + _samples()
    benchmark = spark.createDataFrame([(0, prose(1, 40))], "item_id bigint, text string")
    found = resampling.resample(frame(rows, clashing=False), benchmark, percent=80)
    drawn = sorted(r["rank"] for r in found.collect() if r["rank"])
    eligible = sum(len(t.split()) >= 20 for _, t in rows)
    assert drawn == list(range(1, 80 * eligible // 100 + 1))


def test_no_rows(spark, frame):
    empty = frame([])
    assert resampling.resample(empty, empty).collect() == []
    rows = [(1, prose(1, 30))]
    assert _rows(resampling.resample(frame(rows), empty)) == _plain(rows, [])


def test_kept_columns(spark, frame):
    rows = [(i, prose(i, 30), "en") for i in range(50)]
    found = resampling.resample(frame(rows), frame(rows[:1]), percent=10, keep=("text", "lang", "rank"))
    assert "text" in found.columns and found.where("text is null").count() == 0


def test_query_over_its_whole_table(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert _rows(entry.queries()["op12_resampling"](spark, sf)) == _plain(rows, target)
