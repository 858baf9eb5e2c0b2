"""Each stage of the pipeline against plain Python over what the stage before has kept."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_samples import edited, prose
from tokenizers import Tokenizer

import corpus_pipeline
from veritill.llm import line_templates
from veritill.llm.queries import byte_model


def documents():
    notice = "This work is licensed under version {} of the open notice for everybody"
    rows = [(0, None, None), (1, "", "en"), (2, "12 34 --", "en")]
    for i in range(3, 40):
        body = prose(i, 60) + "\n" + prose(1000 + i, 50)
        if i % 4 == 0:
            body += "\n" + notice.format(i)
        rows.append((i, body, "en" if i % 2 else None))
    base, passage = prose(77, 150), prose(78, 55)
    rows += [(40, base, "en"), (41, base, "en"), (42, edited(base, 1, 2), "en"), (43, edited(base, 2, 40), "en")]
    rows += [(44 + i, prose(300 + i, 40) + " " + passage + " " + prose(400 + i, 40), "en") for i in range(3)]
    return rows


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory, frame):
    """(input rows, output rows) of every stage."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    frame(documents(), clashing=False).write.parquet(f"{folder}/documents.parquet")
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.dtypes
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == columns
        out.write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        found[name] = (docs.collect(), out.collect())
        docs = out
    found["run"] = ([], corpus_pipeline.run(spark, folder).collect())
    return found


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_language(stages):
    given, kept = map(texts, stages["language"])
    assert kept == {doc: text for doc, text in given.items() if text and re.search("[^\\W\\d_]", text)}
    assert {r["lang"] for r in stages["language"][1]} == {"en"}


def test_lines(stages):
    given, kept = map(texts, stages["lines"])
    seen = defaultdict(set)

    def masked(line):
        return re.sub("[^ ]*[0-9][^ ]*", "<*>", line)

    for doc, text in given.items():
        for line in text.split("\n"):
            if len([t for t in masked(line).split(" ") if t]) >= line_templates.MIN_TOKENS:
                seen[masked(line)].add(doc)
    gone = {line: min(docs) for line, docs in seen.items() if len(docs) >= line_templates.MIN_DOCS}
    assert gone
    wanted = {doc: "\n".join(x for x in text.split("\n") if gone.get(masked(x), doc) == doc) for doc, text in given.items()}
    assert kept == wanted


def test_near_duplicates(stages):
    given, kept = map(texts, stages["near_duplicates"])
    sets = {}
    for doc, text in given.items():
        words = text.lower().split()
        sets[doc] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    root = {doc: doc for doc in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {doc: new if r == old else r for doc, r in root.items()}
    assert kept == {doc: text for doc, text in given.items() if root[doc] == doc}
    assert 41 not in kept and 42 not in kept and {40, 43} <= set(kept)


def test_suffixes(stages):
    given, kept = map(texts, stages["suffixes"])
    raws = {doc: text.encode() for doc, text in given.items()}
    size = corpus_pipeline.REPEAT_BYTES
    seen = Counter(raw[i : i + size] for raw in raws.values() for i in range(len(raw) - size + 1))
    wanted = {}
    for doc, raw in raws.items():
        keep = np.ones(len(raw), dtype=bool)
        for i in range(len(raw) - size + 1):
            if seen[raw[i : i + size]] > 1:
                keep[i : i + size] = False
        wanted[doc] = bytes(np.frombuffer(raw, dtype=np.uint8)[keep]).decode()
    assert kept == wanted and kept != given


def test_packing_and_run(stages):
    given = texts(stages["packing"][0])
    model = Tokenizer.from_file(byte_model()[0])
    lengths = {doc: len(model.encode(text, add_special_tokens=False).ids) + 1 for doc, text in given.items()}
    for rows in (stages["packing"][1], stages["run"][1]):
        assert Counter({doc: n for doc, n in lengths.items()}) == sum((Counter({r["doc_id"]: r["length"]}) for r in rows), Counter())
        places = defaultdict(list)
        for r in rows:
            places[r["sequence_id"]].append((r["offset"], r["length"]))
        for own in places.values():
            end = 0
            for offset, length in sorted(own):
                assert offset == end
                end += length
            assert end <= 2048
        assert len(places) == -(-sum(lengths.values()) // 2048)
