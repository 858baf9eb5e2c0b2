from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from veritill.session import SETTINGS  # noqa: E402

AS_OF = "2024-06-30 00:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def as_of():
    return AS_OF


@pytest.fixture()
def rows():
    """Rows of a frame as dicts, optionally sorted by columns."""

    def collect(df, *by):
        found = [r.asDict() for r in df.collect()]
        return sorted(found, key=lambda r: tuple(str(r[c]) for c in by)) if by else found

    return collect
