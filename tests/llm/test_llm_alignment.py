"""Token alignment against plain search over byte ranges."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from llm_samples import prose
from pyspark.sql import functions as F

import __spark_entry__ as entry
from veritill.llm import token_alignment
from veritill.llm.queries import byte_model, piece_model


def _plain(rows):
    """Expected rows of the query, from the two libraries and all pairs of tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(byte_model()[0])
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    visible = {}  # byte-level entries show bytes as characters
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    for at, byte in enumerate(shown + [b for b in range(256) if b not in shown]):
        visible[chr(byte) if at < len(shown) else chr(256 + at - len(shown))] = byte
    found, documents = [], Counter()
    for doc, text in rows:
        whole = (" " + (text or "")).encode()
        a = a_side.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes = [bytes(visible[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole or not text:
            found.append((doc, [], [], Counter(), ""))
            continue
        spans = []
        for side in (a_bytes, b_bytes):
            at, own = 0, []
            for token in side:
                own.append((at, at + len(token)))
                at += len(token)
            spans.append(own)
        links = Counter(
            (a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e
        )
        groups, at = [], [0, 0]
        for end in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
            parts = []
            for side, ids in ((0, a), (1, b)):
                to = next(k for k, (_, e) in enumerate(spans[side]) if e == end) + 1
                parts.append(",".join(map(str, ids[at[side]:to])))
                at[side] = to
            groups.append("|".join(parts))
        found.append((doc, a, b, links, ";".join(groups)))
        documents.update(links.keys())
    best = {}
    for (x, _), n in documents.items():
        best[x] = max(best.get(x, 0), n)
    return sorted(
        (
            (doc, len(a), len(b), groups.count(";") + 1 if groups else 0, sum(links.values()),
             sum(n for pair, n in links.items() if documents[pair] == best[pair[0]]),
             sum(n * documents[pair] for pair, n in links.items()),
             hashlib.sha256(groups.encode()).hexdigest() if groups else "")
            for doc, a, b, links, groups in found
        ),
        key=str,
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _rows(found):
    return sorted((tuple(r[c] for c in COLUMNS) for r in found.collect()), key=str)


@pytest.mark.parametrize("shares", [100_000, 200])
def test_alignment(frame, awkward, monkeypatch, shares):
    """With few pairs in the tasks' table, most counts come through the join."""
    monkeypatch.setattr(token_alignment, "SHARES", shares)
    rows = [r[:2] for r in awkward if r[1] is None or len(r[1]) < 20_000]
    rows += [(100 + i, prose(i, 60)) for i in range(20)]
    rows += [(200, "a▁b"), (201, " lead"), (202, "trail "), (203, "two  spaces\n\n\nlines"), (204, "<|endoftext|>"), (205, "▁")]
    rows += [(206, "\x00\x01\x7f"), (207, "नमस्ते दुनिया"), (208, "<0x41> <s></s>"), (209, " 　 x")]
    assert _rows(token_alignment.alignment(frame(rows), byte_model(), piece_model())) == _plain(rows)


def test_no_rows(frame):
    assert token_alignment.alignment(frame([]), byte_model(), piece_model()).collect() == []


def test_long_texts(frame, awkward):
    rows = [r for r in awkward if r[1] and len(r[1]) >= 20_000]
    found = token_alignment.alignment(frame(rows), byte_model(), piece_model()).collect()
    for r in found:
        assert r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] > 0
        # of one document every pair is in one document, so every link is a best one
        assert r["count_sum"] == r["n_best"] == r["n_links"]


def test_groups_can_be_shown(frame):
    one = token_alignment.aligned(frame([(1, "hello world")]), byte_model(), piece_model(), with_groups=True).first()
    assert hashlib.sha256(one["groups"].encode()).hexdigest() == one["groups_sha256"]
    assert one["groups"].count("|") == one["n_groups"]


@pytest.mark.parametrize("seed", range(60))
def test_diagonal_runs(seed):
    draw = random.Random(seed)
    n = draw.choice([1, 2, 5, 40, 300])
    density = draw.choice([0.2, 0.9, 0.99])
    a, b = ([e for e in range(1, n) if draw.random() < density] + [n] for _ in range(2))
    irregular, left, right = token_alignment.align(a, b)
    common = set(a) & set(b)
    links, at_a, at_b = list(zip(left, right)), 0, 0
    for from_a, to_a, from_b, to_b in [*irregular, (len(a), len(a), len(b), len(b))]:
        assert a[at_a:from_a] == b[at_b:from_b]
        links += zip(range(at_a, from_a), range(at_b, from_b))
        if to_a > from_a:
            assert a[to_a - 1] == b[to_b - 1] and not common & set(a[from_a:to_a - 1])
        at_a, at_b = to_a, to_b
    starts = [[0, *side] for side in (a, b)]
    assert sorted(links) == [
        (i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < b[j] and starts[1][j] < a[i]
    ]


def test_query_over_its_whole_table(spark, sf):
    found = entry.queries()["op11_alignment"](spark, sf)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").where(F.length("text") < 4000).collect()]
    # counts need all documents; everything else is a matter of one
    own = {r[0]: (*r[:5], r[7]) for r in _plain(rows)}
    got = {r["doc_id"]: (r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) for r in found.collect()}
    assert len(got) == 200 and all(got[doc] == own[doc] for doc in own)
