"""Recurring lines: what is dropped, and what is not."""

from __future__ import annotations

import random

from veritill.llm import line_templates


def left(frame, texts):
    rows = line_templates.without_templates(frame(list(enumerate(texts)))).collect()
    return {r["doc_id"]: r["kept"] for r in rows}


def word(draw):
    return "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=9))


def test_many_templates_and_a_hot_line_in_one_leaf(frame):
    """Each template alone is found; so it is beside five others and a line with a third of all rows."""
    draw = random.Random(1)
    own = [[word(draw) for _ in range(8)] for _ in range(6)]
    texts = [" ".join(["all", "start", "alike", *own[i % 6][:4], word(draw), *own[i % 6][4:]]) for i in range(72)]
    texts += ["all start alike but this hot line is the same every time"] * 36
    noise = [" ".join(["all", "start", "alike", *(word(draw) for _ in range(9))]) for _ in range(30)]
    kept = left(frame, texts + noise)
    assert [i for i in range(len(texts)) if kept[i]] == [0, 1, 2, 3, 4, 5, 72]
    assert [kept[len(texts) + i] for i in range(30)] == noise


def test_tables_of_numbers_stay(frame):
    """Rows of other numbers are no repeats; the same row again is one."""
    rows = [f"{i} {i * 7 % 13} {i * i}" for i in range(6)]
    sums = [f"{i} + {i + 1} = {2 * i + 1}" for i in range(6)]
    kept = left(frame, [f"{a}\n{b}\n12 30 45\n{word(random.Random(a))}" for a, b in zip(rows, sums)])
    for i, (a, b) in enumerate(zip(rows, sums)):
        assert kept[i].split("\n")[:-1] == [a, b, *(["12 30 45"] if i == 0 else [])]


def test_short_lines_and_lines_without_blanks(frame):
    """Tabs part tokens; a long line without blanks recurs; a short one goes only where a share of all documents has it."""
    draw = random.Random(3)
    unspaced, tabs, menu, chance = "版权所有未经许可不得转载本站内容", "Home\tNews\tContact", "Read more", "Les."
    texts = [f"{word(draw)} {word(draw)} {i}\n{word(draw)}" for i in range(110)]
    common = [unspaced, tabs, menu]
    texts = [f"{t}\n" + "\n".join(common[: 3 if i < 10 else 0] + [chance] * (10 <= i < 15)) for i, t in enumerate(texts)]
    kept = left(frame, texts)
    assert kept[0] == texts[0]
    for i in range(1, 10):
        assert not {unspaced, tabs, menu} & set(kept[i].split("\n"))
    assert all(chance in kept[i].split("\n") for i in range(10, 15))


def test_texts_are_masked_once(frame):
    """The scan of all texts works each pattern out once a line; the filter on blank lines does not repeat them."""
    docs = frame([(0, "a 1\n\nb")]).selectExpr("doc_id as doc", "doc_id as tag", "text as body")
    plan = line_templates._lines(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(line") == 1
    assert "lambdafunction" not in plan


def test_white_space_of_any_kind_parts_tokens(frame):
    """All of the listed characters, and no other one, are white space within a line."""
    spaces = {9, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
    codes = [c for c in range(1, 0x11000) if c not in (10, 32) and not 0xD800 <= c < 0xE000]
    docs = frame([(c, f"{chr(c)}  {chr(c)}a{chr(c)}b ") for c in codes]).selectExpr("doc_id as doc", "doc_id as tag", "text as body")
    found = {r["doc"]: (r["n"], r["spaced"]) for r in line_templates._lines(docs).collect()}
    for c in codes:
        token = "<*>" if chr(c) in "0123456789" else None
        whole = token or f"{chr(c)}a{chr(c)}b"
        assert found[c] == ((2, "a b") if c in spaces else (2, f"{token or chr(c)} {whole}")), hex(c)
