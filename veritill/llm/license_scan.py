"""Licence scan: exact base phrases, and short notices found in spite of edits.

A text is lower-cased (A-Z) and reduced to its words, joined by single spaces.  Base phrases are
places where their words stand one after the other.  For the notices, each with its number of
allowed edits k, the notice is cut into k + 1 seeds: by the pigeonhole principle a copy with at
most k edits holds one of them unchanged.  One Aho-Corasick pass finds all seeds; around each, the
regex library's bounded-error matching decides and gives the span and the number of edits.

Cases: null and empty text have no words and score 0; very long texts are scanned whole; overlapping
windows of a notice are joined before they are verified; repeated rows each give a row; a null id
stays null; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from veritill.llm.common import per_row

# Base phrases and their labels
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices looked for with edits, and their labels
NOTICES = {
    "licensed under the apache license version 2 0": "apache",
    "apache license": "apache",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def normal(text: str | None) -> tuple[str, int]:
    """Words with one space before and after each, one character per UTF-8 byte, and their number."""
    words = (text or "").encode().translate(_WORD_BYTES).split()
    return (b" " + b" ".join(words) + b" ").decode("latin-1") if words else "", len(words)


class Scanner:
    def __init__(self, notices: dict[str, str] | None = None, chars_per_edit: int = CHARS_PER_EDIT) -> None:
        import ahocorasick
        import regex

        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (notice, label) in enumerate((NOTICES if notices is None else notices).items()):
            edits = len(notice) // chars_per_edit
            pattern = regex.compile(f"(?e)(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}")
            self.notices.append((notice, label, edits, pattern))
            cuts = [i * len(notice) // (edits + 1) for i in range(edits + 2)]
            for start, end in zip(cuts, cuts[1:]):
                seeds.setdefault(notice[start:end], []).append((number, start))
        self.seeds = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.seeds.add_word(seed, (len(seed), places))
        self.seeds.make_automaton()

    def base(self, line: str) -> list[tuple[int, str]]:
        """(word, label) of every base place."""
        found = []
        for phrase, label in BASE.items():
            phrase = f" {phrase} "
            at = line.find(phrase)
            while at >= 0:
                found.append((line.count(" ", 0, at), label))
                at = line.find(phrase, at + 1)
        return found

    def fuzzy(self, line: str) -> list[tuple[str, str, int, int, int]]:
        """(label, notice, first character, end, edits) of every verified notice."""
        windows: dict[int, list[list[int]]] = {}
        for end, (size, places) in self.seeds.iter(line):
            for number, offset in places:
                notice, _, edits, _ = self.notices[number]
                start = end + 1 - size - offset
                span = [max(0, start - edits), start + len(notice) + edits]
                own = windows.setdefault(number, [])
                if own and span[0] <= own[-1][1]:
                    own[-1][0], own[-1][1] = min(own[-1][0], span[0]), max(own[-1][1], span[1])
                else:
                    own.append(span)
        found = []
        for number, spans in sorted(windows.items()):
            notice, label, _, pattern = self.notices[number]
            for start, end in spans:
                for match in pattern.finditer(line, start, min(end, len(line))):
                    found.append((label, notice, match.start(), match.end(), sum(match.fuzzy_counts)))
        return found


def license_spans(df: DataFrame, notices: dict[str, str] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per notice found with edits: label, notice, words it spans (from 0), edits, matched words."""

    def work(scanner, ids, texts):
        out: list[list] = [[] for _ in range(7)]
        for doc, text in zip(ids, texts):
            line, _ = normal(text)
            for label, notice, start, end, edits in scanner.fuzzy(line):
                first = max(0, line.count(" ", 0, start + 1) - 1)
                last = max(first, line.count(" ", 0, end) - (2 if line[end - 1] == " " else 1))
                matched = line[start:end].encode("latin-1").decode(errors="replace")
                for column, value in zip(out, (doc, label, notice, first, last, edits, matched)):
                    column.append(value)
        return out

    schema = f"{id_column} bigint, label string, notice string, first_word bigint, last_word bigint, edits int, matched string"
    return per_row(df, [id_column, text_column], schema, work, lambda: Scanner(notices))


def license_summary(df: DataFrame, notices: dict[str, str] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: words, base places, labels, and the likeness of its best notice (1: exact)."""

    def work(scanner, ids, texts):
        out: list[list] = [[] for _ in range(9)]
        for doc, text in zip(ids, texts):
            line, n_words = normal(text)
            base = scanner.base(line)
            fuzzy = scanner.fuzzy(line)
            places = [word for word, _ in base]
            own = {label for _, label in base}
            score = max([1.0 if base else 0.0, *(1 - edits / len(notice) for _, notice, _, _, edits in fuzzy)])
            row = (
                doc, n_words, len(base), min(places, default=None), max(places, default=None), ",".join(sorted(own)),
                ",".join(sorted(own | {f[0] for f in fuzzy})), score, len(fuzzy),
            )
            for column, value in zip(out, row):
                column.append(value)
        return out

    schema = (
        f"{id_column} bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, n_notices bigint"
    )
    return per_row(df, [id_column, text_column], schema, work, lambda: Scanner(notices))
