"""Recurrent language model: counts against plain counting, scores against a plain network, gradients against differences."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_samples import prose
from pyspark.sql import functions as F

import __spark_entry__ as entry
from veritill.llm import recurrent_lm

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _words(text):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return WORD.findall(lower) + ["end"]


def _held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1


def _base(rows):
    train = Counter(w for doc, text in rows if doc is not None and not _held(doc) for w in _words(text))
    n, v = sum(train.values()), len(train)
    out = []
    for doc, text in rows:
        words = _words(text)
        score = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out.append((doc, _held(doc), len(words), sum(train[w] > 0 for w in words), n, round(score, 6)))
    return sorted(out, key=str)


def _rows(found):
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    rows = found.collect()
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    return sorted((tuple(round(r[c], 6) if c == "base_score" else r[c] for c in columns) for r in rows), key=str)


def _scored(df):
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1, F.lit(False))
    return recurrent_lm.score_documents(df, held, ~held & F.col("doc_id").isNotNull())


@pytest.mark.parametrize("shares", [100_000, 60])
def test_base_columns(frame, awkward, monkeypatch, shares):
    """With few words in the tasks' table, most counts come through the join."""
    monkeypatch.setattr(recurrent_lm, "SHARES", shares)
    monkeypatch.setattr(recurrent_lm, "COUNTED", 50)
    rows = [r[:2] for r in awkward] + [(100 + i, prose(i, 50)) for i in range(30)] + [(300, "ÀB \x0b c\x85d e A.\tA.")]
    assert _rows(_scored(frame(rows))) == _base(rows)


def test_no_rows_and_nothing_to_learn(frame):
    assert _scored(frame([])).collect() == []
    held = [doc for doc in range(100) if _held(doc)]
    rows = [(doc, "a b") for doc in held] + [(None, "c"), (None, None)]
    assert _rows(_scored(frame(rows))) == _base(rows)


def _network(seed=3, words=40):
    counts = np.array([50, *range(words, 0, -1)])
    net = recurrent_lm.Network.started(counts, np.array([5.0, 0.0, 9.0, 30.0]))
    draw = np.random.default_rng(seed)
    for part in net.parts.values():
        part += draw.normal(0, 0.3, part.shape).astype(np.float32)
    return net


def _plain(net, tokens):
    """Log10 of one document, token by token, with the formulas written out."""
    p, h, state, last, total = net.parts, recurrent_lm.HIDDEN, np.zeros(recurrent_lm.HIDDEN), 0, 0.0
    for token in tokens:
        given, mixed = p["inner"] @ p["embedding"][last] + p["gate_bias"], p["recurrent"] @ state
        reset, update = (1 / (1 + np.exp(-(given + mixed)[k * h:(k + 1) * h])) for k in (0, 1))
        new = np.tanh(given[2 * h:] + reset * mixed[2 * h:])
        state = (1 - update) * new + update * state
        logits = p["class_weights"] @ state + p["class_bias"]
        k = net.class_of[token]
        total += logits[k] - np.log(np.exp(logits).sum())
        if k < len(net.bounds) - 1:
            low, high = net.bounds[k], net.bounds[k + 1]
            inside = p["word_weights"][low:high] @ state + p["word_bias"][low:high]
            total += inside[token - low] - np.log(np.exp(inside).sum())
        last = token
    return total / math.log(10)


def test_scores_do_not_depend_on_lanes_or_windows(monkeypatch):
    net, draw = _network(), np.random.default_rng(5)
    documents = [draw.integers(0, 45, size).astype(np.uint16) for size in (1, 1, 2, 3, 7, 30, 31, 200, 90, 5)]
    expected = [_plain(net, d.tolist()) for d in documents]
    for lanes, window in ((1, 1), (3, 4), (192, 24), (2, 1000)):
        monkeypatch.setattr(recurrent_lm, "LANES", lanes)
        monkeypatch.setattr(recurrent_lm, "WINDOW", window)
        assert np.allclose(net.score(documents), expected, rtol=1e-4)


def test_probabilities_add_up_to_one():
    net = _network()
    for start in ([], [3, 44, 0, 7]):
        before = _plain(net, start) if start else 0.0
        assert abs(sum(10 ** (_plain(net, [*start, token]) - before) for token in range(45)) - 1) < 1e-5


def test_gradients_against_differences():
    net, draw = _network(), np.random.default_rng(7)
    for array in net.parts:
        net.parts[array] = net.parts[array].astype(np.float64)
    inputs, targets = draw.integers(0, 45, (6, 5)), draw.integers(0, 45, (6, 5))
    fresh, real = draw.random((6, 5)) < 0.2, np.ones((6, 5), bool)
    real[4:, 3] = False
    state = np.zeros((recurrent_lm.HIDDEN, 5))
    grads, _, _ = net.gradients(inputs, targets, fresh, real, state)
    dense = {name: np.zeros_like(part) for name, part in net.parts.items()}
    for name, rows, grad in grads:
        dense[name][rows] += grad
    for name, part in net.parts.items():
        flat, step = part.reshape(-1), 1e-2
        for at in draw.choice(flat.size, min(12, flat.size), replace=False):
            kept, found = flat[at], []
            for to in (kept + step, kept - step):
                flat[at] = to
                found.append(net.gradients(inputs, targets, fresh, real, state)[1])
            flat[at] = kept
            assert abs((found[0] - found[1]) / (2 * step) - dense[name].reshape(-1)[at]) < 2e-2, name


def test_held_out_documents_are_better_explained_than_by_the_base(spark, sf):
    found = entry.queries()["op13_recurrent"](spark, sf)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert _rows(found) == _base(rows)
    held = [(r["score"], r["base_score"], r["n_tokens"]) for r in found.collect() if r["held_out"]]
    assert sum(h[0] for h in held) / sum(h[2] for h in held) > sum(h[1] for h in held) / sum(h[2] for h in held) + 0.08
