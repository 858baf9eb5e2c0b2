"""Operators that SQL cannot express, against plain brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_samples import edited, prose
from pyspark.sql import functions as F

from veritill.llm import language_crf, license_scan, minhash, packing, piece_codec, spot_signatures, suffix_dedup
from veritill.llm.components import components
from veritill.llm.queries import byte_model, op6_language, piece_model


# -- long repeats ---------------------------------------------------------------------------------
def removed(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for raw in raws:
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(raw, dtype=np.uint8)[~gone])
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts():
    passage, base = prose(3, 90), prose(4, 200)
    return [
        base, base, edited(base, 1, 2), edited(base, 2, 3), edited(base, 3, 1), prose(5, 120) + passage + prose(6, 50), passage,
        "é" + passage, prose(7, 40) + " " + passage[:399], prose(8, 300), "abc" * 300, "z" * 1000, prose(9, 60) * 2, None, "",
        *(prose(20 + i, 30) + passage[i : i + 420] + prose(40 + i, 30) for i in range(12)),
    ]


@pytest.mark.parametrize("hot", [50_000, 1])
def test_suffixes(frame, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", hot)
    texts = repeat_texts()
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.removed_digests(frame(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == removed(texts, 400)


# -- subword pieces -------------------------------------------------------------------------------
def test_pieces(spark, sf, frame, awkward):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + [r[1] for r in awkward]
    got = {r["doc_id"]: tuple(r)[1:] for r in piece_codec.encode_digests(frame(list(enumerate(texts))), piece_model()).collect()}
    for i, text in enumerate(texts):
        ids = model.encode(text or "")
        hashed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i] == (len(ids), hashed, hashlib.sha256(model.decode(ids).encode()).hexdigest())


# -- licences -------------------------------------------------------------------------------------
def best_edits(line, notice):
    """Fewest edits between the notice and any part of the line."""
    row = [0] * (len(line) + 1)
    for i, a in enumerate(notice, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(line, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def test_licenses(frame):
    draw, texts = random.Random(3), [None, "", "CC BY-NC, cc-by  gnu GENERAL\npublic license apache license apache", "mit licensed MIT License."]
    for notice in license_scan.NOTICES:
        for edits in range(6):
            chars = list(notice)
            for _ in range(edits):
                at, kind = draw.randrange(len(chars)), draw.randrange(3)
                chars[at : at + (kind != 0)] = [] if kind == 1 else [draw.choice("abcxyz")]
            texts.append(f"{prose(draw.random(), 8)} {''.join(chars)} {prose(draw.random(), 8)}")
    got = {r["doc_id"]: r for r in license_scan.license_summary(frame(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        line, n_words = license_scan.normal(text)
        words = line.split()
        base = [(j, label) for phrase, label in license_scan.BASE.items() for j in range(len(words))
                if words[j : j + len(phrase.split())] == phrase.split()]
        near = {label for notice, label in license_scan.NOTICES.items() if line and best_edits(line, notice) <= len(notice) // license_scan.CHARS_PER_EDIT}
        assert got[i]["n_words"] == n_words and got[i]["n_base"] == len(base)
        assert got[i]["first_word"] == min((j for j, _ in base), default=None)
        assert got[i]["last_word"] == max((j for j, _ in base), default=None)
        assert got[i]["base_labels"] == ",".join(sorted({label for _, label in base}))
        assert got[i]["labels"] == ",".join(sorted({label for _, label in base} | near))
        assert 0 <= got[i]["score"] <= 1
    spans = license_scan.license_spans(frame([(1, "one two Releasd under the MIT License now")])).where("label = 'mit'").collect()
    assert [(r["first_word"], r["last_word"], r["edits"]) for r in spans] == [(2, 6, 1)]


# -- spot signatures ------------------------------------------------------------------------------
def spots(text):
    words = text.lower().translate(str.maketrans(spot_signatures._MARKS, " " * len(spot_signatures._MARKS))).split(" ")
    words = [w for w in words if w]
    found = set()
    for i, word in enumerate(words):
        chain = [w for w in words[i + 1 : i + 60] if w not in spot_signatures.ANCHORS][:2]
        if word in spot_signatures.ANCHORS and len(chain) == 2:
            found.add((word, *chain))
    return found or {tuple(words)}


def alike(a, b):
    return len(a & b) / len(a | b)


def test_spots(frame):
    base = prose(1, 80)
    texts = [base, edited(base, 1, 3), edited(base, 2, 8), prose(2, 50), None, "", "the", "of the end", base, "é🙂 the x y", prose(3, 7)]
    rows = [(3 * i - 5, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in spot_signatures.edited_and_next(frame(rows)).collect()}
    whole = [t or "" for t in texts]
    for i, (doc, _) in enumerate(rows):
        following, half = whole[(i + 1) % len(whole)], len(whole[i]) // 2
        changed = whole[i][: len(whole[i]) - half] + following[:half]
        assert got[doc]["n_chars"] == len(whole[i])
        assert got[doc]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert math.isclose(got[doc]["near_edited"], alike(spots(whole[i]), spots(changed)))
        assert math.isclose(got[doc]["near_next"], alike(spots(whole[i]), spots(following)))
    assert got[rows[0][0]]["fingerprint"] == got[rows[8][0]]["fingerprint"] != got[rows[1][0]]["fingerprint"]


def test_similar_spots(frame):
    base = prose(1, 80)
    texts = [base, base, *(edited(base, i, i) for i in range(1, 8)), *(prose(50 + i, 60) for i in range(5))]
    members, pairs = spot_signatures.similar_sets(spot_signatures.fingerprints(frame(list(enumerate(texts)))), 0.6)
    classes = {}
    for i, text in enumerate(texts):
        classes.setdefault(frozenset(spots(text)), i)
    wanted = {(a, b) for (x, a), (y, b) in itertools.combinations(classes.items(), 2) if alike(x, y) >= 0.6}
    assert {(r["a"], r["b"]) for r in pairs.collect()} == wanted and wanted
    assert {r["doc_id"]: r["class_id"] for r in members.collect()} == {i: classes[frozenset(spots(t))] for i, t in enumerate(texts)}


# -- near-duplicates ------------------------------------------------------------------------------
def by_brute_force(rows, words_each, percent=80):
    sets, root = {}, {doc: doc for doc, _ in rows}
    for doc, text in rows:
        words = (text or "").lower().split()
        sets[doc] = {tuple(words[i : i + words_each]) for i in range(max(1, len(words) - words_each + 1))} if words else set()

    def top(x):
        return x if root[x] == x else top(root[x])

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return {doc: (len(sets[doc]), top(doc)) for doc in sets}


def families():
    rows = [(0, None), (1, ""), (2, "one two"), (3, "ONE  two"), (4, "one")]
    for family in range(6):
        base = prose(100 + family, 140)
        # chains: each a few edits away from the one before, so that ends are linked through the middle only
        text = base
        for step in range(10):
            rows.append((len(rows) * 3, text))
            text = edited(text, family * 50 + step, 2 if family % 2 else 4)
    return rows


def test_near_duplicates(frame, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = families()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(frame(rows), words_each=4).collect()}
    assert got == by_brute_force(rows, 4)
    assert any(component != doc for doc, (_, component) in got.items())


def test_bayesian_bounds_keep_what_they_promise():
    for n, least in minhash.least_matches(0.8, 1e-6):
        below = sum(math.comb(n + 1, m) * 0.8**m * 0.2 ** (n + 1 - m) for m in range(least))
        assert below < 1e-6 <= below + math.comb(n + 1, least) * 0.8**least * 0.2 ** (n + 1 - least)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 30)] + [(100, 90), (90, 95), (95, 100), (7, 7), (200, 201)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 90: 90, 95: 90, 100: 90, 200: 200, 201: 200}


# -- language -------------------------------------------------------------------------------------
def test_marginals_are_those_of_all_paths():
    draw = np.random.default_rng(1)
    lengths, labels = np.array([5, 1, 3]), 3
    emission, moves = draw.normal(size=(9, labels)), draw.normal(size=(labels, labels))
    for run in (language_crf.RUN, 2):
        language_crf.RUN, before = run, language_crf.RUN
        got = language_crf.marginals(emission, moves, lengths)
        language_crf.RUN = before
        start = 0
        for n in lengths:
            wanted = np.zeros((n, labels))
            for path in itertools.product(range(labels), repeat=int(n)):
                weight = np.exp(moves[:, path[0]]).sum()
                weight *= math.exp(sum(emission[start + i, p] for i, p in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
                for i, p in enumerate(path):
                    wanted[i, p] += weight
            assert np.allclose(got[start : start + n], wanted / wanted.sum(axis=1, keepdims=True))
            start += n


def test_transition_gradient_against_differences():
    """The likelihood by enumerating all paths, with a uniform label before the first word."""
    import itertools

    draw = np.random.default_rng(4)
    lengths, labels = np.array([6, 1, 3]), 3
    emission, moves = draw.normal(0, 1, (10, labels)), draw.normal(0, 1, (labels, labels))
    gold = draw.integers(0, labels, 10)

    def likelihood(t):
        total, at = 0.0, 0
        for n in lengths:
            own = emission[at:at + n]
            weights = {
                path: np.exp(sum(own[i, y] for i, y in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))
                * np.exp(t[:, path[0]]).sum()
                for path in itertools.product(range(labels), repeat=int(n))
            }
            total += np.log(weights[tuple(gold[at:at + n])] / sum(weights.values()))
            at += n
        return total

    for run in (language_crf.RUN, 2):
        language_crf.RUN, before = run, language_crf.RUN
        expected = np.zeros((labels, labels))
        language_crf.marginals(emission, moves, lengths, expected)
        language_crf.RUN = before
        slope = language_crf.transition_slope(moves, gold, lengths, expected)
        for a in range(labels):
            for b in range(labels):
                step = np.zeros_like(moves)
                step[a, b] = 1e-5
                assert abs((likelihood(moves + step) - likelihood(moves - step)) / 2e-5 - slope[a, b]) < 1e-6


def test_language_on_held_out_rows(spark, sf):
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = op6_language(spark, sf).where("held_out").join(truth, "doc_id")
    right, all_ = held.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.97 * all_


def test_code_switched_words_and_unknown(frame):
    rows = [(i, f"the cat and the dog {i} of this house", "en") for i in range(20)] + [(50 + i, f"le chat et le chien {i} de cette maison", "fr") for i in range(20)]
    model = language_crf.fit([(lang, " ".join([text] * 5)) for _, text, lang in rows])
    probe = frame([(1, "the cat and the dog of this house le chat et le chien de cette maison"), (2, None), (3, "123 ..."), (4, "")])
    words = {r["doc_id"]: r["labels"] for r in language_crf.label_words(probe, model).collect()}
    assert words[1] == ["en"] * 8 + ["fr"] * 8 and words[2] == words[3] == words[4] == []
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_crf.predict(probe, model).collect()}
    assert got[2] == got[3] == got[4] == ("und", 0.0) and 0.4 < got[1][1] < 0.7


# -- packing --------------------------------------------------------------------------------------
def fewest(sizes, capacity):
    """Exact bin packing by search."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for j in {room: j for j, room in enumerate(bins) if room >= sizes[i]}.values():
            place(i + 1, [*bins[:j], bins[j] - sizes[i], *bins[j + 1 :]])
        place(i + 1, [*bins, capacity - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(150))
def test_reduction_loses_nothing(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 20, 50])
    sizes = [draw.randint(1, capacity) for _ in range(draw.randint(1, 11))]
    found = packing.plan(Counter(sizes), capacity)
    used = Counter()
    for pattern, times, _ in found:
        assert sum(pattern) <= capacity
        used.update({size: n * times for size, n in Counter(pattern).items()})
    assert used == Counter(sizes)
    best, fixed = fewest(sizes, capacity), [p for p, times, sure in found if sure for _ in range(times)]
    rest = list((Counter(sizes) - Counter(s for p in fixed for s in p)).elements())
    assert len(fixed) + fewest(rest, capacity) == best  # what is fixed belongs to an optimal packing
    assert packing.lower_bound(Counter(sizes), capacity) <= best


def test_pieces_of_documents(spark, sf, frame, awkward):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(byte_model()[0])
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + [r[1] for r in awkward]
    got = {}
    for r in packing.pieces(frame(list(enumerate(texts))), *byte_model()).collect():
        got.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for i, text in enumerate(texts):
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        ends = list(range(len(ids), 0, -packing.CAPACITY))[::-1]
        wanted = [(n, start, end - start, zlib.crc32(ids[start:end].tobytes())) for n, (start, end) in enumerate(zip([0, *ends], ends))]
        assert sorted(got[i]) == wanted
