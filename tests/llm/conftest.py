from __future__ import annotations

from pathlib import Path

import pytest
from llm_samples import edited, prose

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"

#: Names the operators use inside; here they are further columns of the input.
CLASHING = "doc body tag key data spots words content bucket n rank label line tokens masked own kept gone start".split()


def pytest_collection_modifyitems(items):
    for item in items:
        if "llm" in str(item.fspath) and not Path(SF).exists():
            item.add_marker(pytest.mark.skip(reason="test tables not present"))


@pytest.fixture(scope="session", autouse=True)
def _workers(spark):
    entry._reachable(spark)


@pytest.fixture(scope="session")
def sf():
    return SF


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (doc_id, text[, lang]) as documents, with further columns of clashing names."""

    def make(rows, clashing=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(3)
        for name in CLASHING if clashing else []:
            df = df.selectExpr("*", f"'other' as `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty, blank and very long texts, repeated rows, ids and texts, odd characters."""
    base = prose(1, 300)
    return [
        (1, None, None), (2, "", "en"), (3, "   ", "en"), (None, base, "en"), (4, base, "en"), (4, base, "en"), (5, base, None),
        (6, prose(2, 30_000), "en"), (7, "a", "en"), (7, "b c", "en"), (8, "x" * 5000, None), (9, "日本語 ﬁ ▁ é\x00\n\r\n\t  end ", "fr"),
        (10, edited(base, 5, 2), "en"), (11, "1 2 3\n\n\n", None), (None, None, None), (12, ("ab " * 700).strip(), "de"),
        (13, "<|endoftext|> <s> it's  the   MIT License!", "en"), (-14, "🙂" * 450, None),
    ]
