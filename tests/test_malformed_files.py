"""The malformed export is written in parallel."""

from __future__ import annotations

from veritill.catalogue import adapters, layers


def test_rows_do_not_pass_through_one_file(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(str(i), "a b") for i in range(70)], "InvoiceNo string, StockCode string").repartition(4)
    folder = tmp_path / "malformed"
    monkeypatch.setattr(adapters, "raw_transactions", lambda *_: rows)
    monkeypatch.setattr(layers, "scratch_dir", lambda *_: str(folder))
    found = {(r["record"], r["fields"]) for r in layers.s01_malformed(spark, "").collect()}
    assert found == {(f"{i},a b,surplus", f"{i},a b") for i in range(0, 70, 7)} | {(str(i), str(i)) for i in range(1, 70, 7)}
    assert len(list(folder.glob("part-*"))) == 4
