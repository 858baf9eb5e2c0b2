"""What lies on the executors' disks at a time: no shuffle of an ended step, no stored table that nothing reads any more."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from veritill import session
from veritill.catalogue import adapters, frames, layers, reports, upkeep
from veritill.operators import enrich
from veritill.plans import fact_upkeep, run
from veritill.sources import sinks, snapshots

DAY = dt.datetime(1997, 3, 1)


@pytest.fixture()
def tables(spark, tmp_path):
    lines = [
        (o, p, 1, n, 2.0, 10.0, 0.0, 0.0, "N", "O", dt.datetime(1997 + o % 3, 1 + o % 12, 5)) for o in range(1, 30) for p, n in ((1, 1), (1, 2), (2, 3))
    ]
    found = {
        "nation": [(0, "ALGERIA", 0)],
        "customer": [(c, "a", 0, 1.0, "AUTO") for c in range(1, 8)],
        "part": [(1, "red pin", "b", "t", 1, 1.0)],
        "orders": [(o, 1 + o % 8, "O", 1.0, dt.datetime(1997, 1 + o % 12, 15), "1-URGENT") for o in range(1, 28)],
        "lineitem": [*lines, (None, 1, 1, 1, 2.0, 10.0, 0.0, 0.0, "N", "O", DAY), (None, 1, 1, 2, 2.0, 10.0, 0.0, 0.0, "N", "O", DAY)],
    }
    for name, rows in found.items():
        spark.createDataFrame(rows, adapters.TABLES[name]).write.parquet(f"{tmp_path}/tables/{name}.parquet")
    return f"{tmp_path}/tables"


@pytest.fixture()
def scratch(spark):
    """The scratch folders that a test has left."""
    root = Path(session.scratch_dir(spark, "any")).parent
    before = set(root.iterdir()) if root.exists() else set()
    return lambda: set(root.iterdir()) - before


def _sorted(df):
    return sorted(map(str, df.collect()))


def test_shuffle_files_are_freed_within_a_query_and_a_run(spark, monkeypatch, tmp_path):
    from veritill.catalogue import registry

    seen = []
    note = lambda *_: seen.append(spark.conf.get(session.SHUFFLE_CLEANUP))
    registry._compiled_small(note)(spark, "")
    monkeypatch.setattr(run, "_run", note)
    run.run_pipeline(spark, "", str(tmp_path))
    assert seen == ["true", "true"] and spark.conf.get(session.SHUFFLE_CLEANUP) == "false"


def test_slices_of_the_lines_are_all_lines(spark, tables):
    raw, clean = frames.raw_slices(spark, tables), frames.clean_slices(spark, tables)
    stored = frames.clean_parts(adapters.raw_transactions(spark, tables))
    assert len(raw) == len(clean) == len(stored) > 1 and all(part.count() for part in (*raw, *clean, *stored))
    assert _sorted(stored[0].unionByName(stored[1])) == _sorted(frames.clean_tx(spark, tables))
    assert _sorted(raw[0].unionByName(raw[1])) == _sorted(adapters.raw_transactions(spark, tables))
    assert _sorted(clean[0].unionByName(clean[1])) == _sorted(frames.clean_tx(spark, tables))


def test_a_fact_in_slices_is_the_whole_fact(spark, tables, scratch, tmp_path, monkeypatch):
    """joined and gathered in slices; the clean rows go with the last of them."""
    slices, write = [], sinks.month_slice
    monkeypatch.setattr(sinks, "month_slice", lambda n: slices.append(n) or write(n))
    whole = frames.fact(spark, tables)
    assert frames.saved_fact(spark, tables, f"{tmp_path}/fact") == whole.count()
    found = spark.read.parquet(f"{tmp_path}/fact").select(whole.columns)
    assert _sorted(found) == _sorted(whole) and slices == [sinks.FACT_SLICES] * sinks.FACT_SLICES
    assert not any(p.name.startswith("transactions-") for p in scratch())


def test_months_that_are_null_are_in_a_slice(spark, tmp_path):
    tx = spark.createDataFrame([("a", None, None), ("b", 1997, 3), ("c", 1997, None)], "k string, TxYear int, TxMonth int")
    assert sinks.save_fact(tx, f"{tmp_path}/fact", None, 4) == 3
    assert sinks.save_fact(tx.where("false"), f"{tmp_path}/fact", None, 4) == 0
    assert not list(Path(tmp_path, "fact").rglob("part-*"))


def test_upkeep_keeps_one_version_and_no_clean_rows(spark, tables, scratch):
    """months are built in slices; parts that only earlier versions have are gone."""
    found = upkeep.j12_late(spark, tables)
    whole = frames.fact(spark, tables)
    assert _sorted(found) == _sorted(adapters.plain(whole).select(found.columns))
    assert "transactions" not in [p.name.split("-")[0] for p in scratch()]
    path = str(next(p for p in scratch() if p.name.startswith("upkeep-")))
    kept = {Path(part.path).parts[0] for part in snapshots.current(spark, path).tables[fact_upkeep.FACT]}
    held = {p.parent.parent.name for p in Path(path, fact_upkeep.FACT).rglob("*.parquet")}
    assert held == kept and len(snapshots._numbers(spark, path)) == 1


def test_refresh_in_slices_is_the_fact_built_anew(spark, tables, tmp_path):
    tx, cu, days = frames.clean_tx(spark, tables), frames.clean_cu(spark, tables), adapters.holidays(spark, tables)
    path = f"{tmp_path}/upkeep"
    made = fact_upkeep.create(tx, cu.limit(0), days, path, "2002-01-01", slices=3)
    assert made.months == sorted(made.months) and len(made.months) > 3 and made.rows == tx.count()
    done = fact_upkeep.refresh(spark, path, "2002-01-02", customers=cu)
    assert done.months == sorted(done.months) and len(done.months) > sinks.FACT_SLICES
    whole = enrich.build_fact(tx, cu, days)
    assert _sorted(fact_upkeep.read_fact(spark, path).select(whole.columns)) == _sorted(whole)


def test_deliveries_of_a_run_are_packed(spark, tables):
    """the export takes a fraction of the room as text, and reads back whole."""
    folder = layers._delivery(spark, tables, "run")
    parts = [p.name for p in Path(folder, "transactions.csv").glob("part-*")]
    assert parts and all(name.endswith(".csv.gz") for name in parts)
    read = layers.files.read_transactions(spark, folder, as_delivered=False).drop("_row_id")
    assert read.count() == 89 and read.where(F.col("InvoiceNo").isNull()).count() == 2


def test_reports_store_the_columns_that_their_checks_read(spark, tables, monkeypatch):
    """all rows, no column that no check reads, and the same results."""
    seen, checks = {}, reports.run_anomaly_detection
    monkeypatch.setattr(reports, "run_anomaly_detection", lambda fact, *given: seen.update(fact=fact) or checks(fact, *given))
    found = reports._results(spark, tables)
    raw = frames.stored_raw(spark, tables)
    tx, cu, fact = frames.stored_layers(spark, tables)
    args = (adapters.AS_OF, adapters.RUN_DATE)
    whole = reports.validation.validate_raw(*raw, *args).unionByName(reports.quality.run_quality_checks(tx, cu, fact, *args)).unionByName(checks(fact, *args))
    assert _sorted(found) == _sorted(whole) and found.count() > 25
    assert set(seen["fact"].columns) == {"CustomerID", "Quantity", "LineTotal", "InvoiceDate", "UnitPrice", "Status"}


def test_only_scratch_folders_are_dropped(spark):
    kept = session.scratch_dir(spark, "kept")
    spark.range(1).write.parquet(kept)
    root = kept.rsplit("/", 1)[0]
    for wrong in (root, f"{root}/", f"{kept}/part", "/tmp/elsewhere"):
        with pytest.raises(ValueError):
            session.drop_scratch(spark, wrong)
    session.drop_scratch(spark, kept)
    assert not Path(kept).exists()
