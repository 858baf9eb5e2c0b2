from __future__ import annotations

import json

import pytest
from fixtures import dirty_customers, dirty_transactions, holidays
from pyspark.errors import AnalysisException

from veritill import run_pipeline
from veritill.model import LOADED_AT
from veritill.operators import cleaning
from veritill.session import scratch_dir
from veritill.sources import files, sinks, snapshots


@pytest.fixture()
def delivery(spark, tmp_path):
    """A delivery folder as plain files, the way an export job leaves them."""
    dirty_transactions(spark).drop("_row_id").toPandas().to_csv(tmp_path / "transactions.csv", index=False)
    dirty_customers(spark).drop("_row_id").toPandas().to_csv(tmp_path / "customers.csv", index=False)
    (tmp_path / "holidays").mkdir()
    documents = [
        {"date": "2023-01-15", "localName": "Tag", "name": "A Day", "countryCode": "GB"},
        {"date": "2022-01-15", "localName": "Tag", "name": "Old Day", "countryCode": "GB", "global": False},
        {"date": "2023-02-20", "localName": "Jour", "name": "B Day", "countryCode": "CH", "global": True},
    ]
    (tmp_path / "holidays" / "days.json").write_text("\n".join(map(json.dumps, documents)))
    return tmp_path


def test_csv_keeps_text_and_order(spark, delivery, rows):
    raw = files.read_transactions(spark, str(delivery))
    assert raw.count() == 9
    by_order = raw.orderBy("_row_id").collect()
    assert [r["InvoiceNo"] for r in by_order] == ["I1", "I2", "I3", "I4", "I1", "I5", "I6", None, None]
    assert by_order[1]["Status"] == " VOID " and by_order[5]["UnitPrice"] is None
    assert raw.schema["Quantity"].dataType.simpleString() == "string"


def test_csv_reads_missing_marks_and_quotes(spark, tmp_path, rows):
    (tmp_path / "x.csv").write_text('a,b\nNA,"say ""hi"", ok"\nnull,x\n')
    assert [(r["a"], r["b"]) for r in files.read_csv(spark, str(tmp_path / "x.csv")).collect()] == [
        (None, 'say "hi", ok'), (None, "x"),
    ]


def test_missing_export_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_csv(spark, str(tmp_path / "nothing.csv"))


def test_holidays(spark, delivery, rows):
    path = str(delivery / "holidays")
    days = rows(files.read_holidays(spark, path, year=2023))
    assert [(r["country_code"], str(r["date"]), r["is_global"]) for r in days] == [("GB", "2023-01-15", True)]
    assert files.read_holidays(spark, path, countries=None).count() == 3
    assert files.read_holidays(spark, path + "-absent").count() == 0


def test_missing_layer_is_none(spark, tmp_path):
    assert files.read_layer(spark, str(tmp_path / "none")) is None


def test_landing_replaces_its_own_day_only(spark, tmp_path, rows):
    path, df = str(tmp_path / "raw"), spark.range(5)
    assert sinks.land_raw(df, path, "2024-01-01") == 5
    assert sinks.land_raw(df.limit(2), path, "2024-01-02") == 2
    assert sinks.land_raw(df.limit(3), path, "2024-01-01") == 3
    assert spark.read.parquet(path).count() == 5
    assert files.latest_run(files.read_layer(spark, path)).count() == 2
    assert files.read_layer(spark, path, "2024-01-01").count() == 3
    with pytest.raises(AnalysisException):
        sinks.land_raw(df, path, "2024-01-02", overwrite=False)
    assert sinks.land_raw(df, path, "2024-01-03", overwrite=False) == 5


def test_loads(spark, tmp_path, rows):
    path = str(tmp_path / "wh")
    cu = cleaning.clean_customers(dirty_customers(spark)).clean
    assert sinks.replace_table(cu, path, "stg_customers", "2024-01-01 00:00:00") == (4, 0)
    assert sinks.replace_table(cu, path, "stg_customers", "2024-01-02 00:00:00") == (4, 0)
    assert sinks.replace_table(cu.where("false"), path, "stg_customers", "2024-01-03 00:00:00") == (0, 0)
    loaded = files.read_table(spark, path, "stg_customers")
    assert loaded.count() == 4 and {str(r[LOADED_AT]) for r in loaded.collect()} == {"2024-01-02 00:00:00"}


def test_values_that_do_not_fit_are_reported(spark, tmp_path, as_of):
    tx = cleaning.clean_transactions(dirty_transactions(spark), as_of).clean
    odd = tx.selectExpr("* except (UnitPrice)", "if(InvoiceNo = 'I1', double('inf'), UnitPrice) as UnitPrice")
    load = sinks.replace_table(odd, str(tmp_path), "stg_transactions", as_of)
    assert (load.rows, load.unfit) == (3, 1)
    aside = snapshots.read(spark, str(tmp_path), "rejected_stg_transactions").first()
    assert aside["InvoiceNo"] == "I1" and aside["unfit_columns"] == ["UnitPrice"] and aside["UnitPrice"] == float("inf")


def test_quantities_are_not_rounded(spark, tmp_path, as_of):
    tx = cleaning.clean_transactions(dirty_transactions(spark), as_of).clean
    odd = tx.selectExpr("* except (Quantity)", "if(InvoiceNo = 'I1', 2.5D, double(Quantity)) as Quantity")
    assert sinks.replace_table(odd, str(tmp_path), "stg_transactions", as_of) == (3, 1)


def test_load_all_counts(spark, tmp_path, as_of):
    from veritill.operators.enrich import build_fact

    tx = cleaning.clean_transactions(dirty_transactions(spark), as_of).clean
    cu = cleaning.clean_customers(dirty_customers(spark)).clean
    counts = sinks.load_all(cu, tx, build_fact(tx, cu), str(tmp_path), as_of, holidays(spark).where("false"))
    assert counts == {"stg_customers": 4, "stg_transactions": 4, "fct_transactions": 4}


def test_run(spark, delivery, as_of, rows):
    out = str(delivery / "out")
    run = lambda: run_pipeline(spark, str(delivery), out, "2024-06-30", as_of, str(delivery / "holidays"), holiday_year=2023)
    result = run()
    assert result.code == 1
    assert result.counts["transactions"] == 9 and result.counts["holidays"] == 1
    parts = [result.counts[f"transactions_{p}"] for p in ("clean", "rejected", "duplicate")]
    assert parts == [4, 3, 2] and result.counts["fact"] == 4 == result.counts["loaded_fct_transactions"]
    fact = spark.read.parquet(f"{out}/processed/fct_transactions")
    assert len(fact.columns) == 25 and fact.where("is_holiday").count() == 1
    manifest = spark.read.json(f"{out}/manifest").first()
    assert (manifest["transactions"], manifest["customers"], manifest["holidays"]) == (9, 6, 1)
    results = spark.read.parquet(f"{out}/results/run_date=2024-06-30")
    assert results.groupBy("stage").count().count() == 3
    verdict = spark.read.parquet(f"{out}/report/verdict").first()
    assert verdict["verdict"] == "NEEDS ATTENTION" and verdict["status_code"] == 1
    history = lambda: snapshots.read(spark, f"{out}/warehouse", "dq_results")
    assert history().count() == 13

    again = run()
    assert again.counts == result.counts
    assert spark.read.parquet(f"{out}/raw/transactions").count() == 9
    assert history().count() == 13  # the day's results are replaced


def test_empty_delivery(spark, delivery, as_of):
    """A header without rows is a finding; nothing of an earlier run of the day is reported again."""
    out = str(delivery / "out")
    run = lambda: run_pipeline(spark, str(delivery), out, "2024-06-30", as_of)
    assert run().counts["transactions"] == 9
    header = (delivery / "transactions.csv").read_text().split("\n")[0]
    (delivery / "transactions.csv").write_text(header + "\n")
    result = run()
    assert result.code == 1 and result.counts["transactions"] == 0 == result.counts["fact"]
    assert result.counts["transactions_duplicate"] == 0
    assert run_pipeline(spark, str(delivery), str(delivery / "fresh"), "2024-06-30", as_of).code == 1


def test_malformed_rows(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b,c\n1,2,3\n1,2,3,4\n1,2\n"x,y",2,3\n')
    assert sorted(r["record"] for r in files.malformed_rows(spark, str(path)).collect()) == ["1,2", "1,2,3,4"]


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "transactions.csv").write_text('InvoiceNo,Description\nI1,"two\nlines"\nI2,one\n')
    found = files.read_transactions(spark, str(tmp_path), multiline=True).collect()
    assert [(r["InvoiceNo"], r["Description"]) for r in found] == [("I1", "two\nlines"), ("I2", "one")]


def test_latest_manifest_defaults(spark, tmp_path):
    row = files.latest_manifest(spark, str(tmp_path / "none")).first()
    assert (row["run_date"], row["transactions"], row["holidays"]) == (None, 0, 0)


def test_run_without_exports_gives_two(spark, tmp_path):
    assert run_pipeline(spark, str(tmp_path / "nowhere"), str(tmp_path / "out"), "2024-06-30").code == 2


def test_scratch_folders_are_new_and_shared(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_run_with_a_customer_table_beyond_broadcast(spark, delivery, as_of):
    """No table is broadcast and hot keys are salted: the run builds the same fact."""
    out = {n: str(delivery / n) for n in ("plain", "salted")}
    run = lambda path, **kw: run_pipeline(spark, str(delivery), path, "2024-06-30", as_of, warehouse=False, **kw)
    plain = run(out["plain"])
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        salted = run(out["salted"], salted=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert salted.code == plain.code == 1 and salted.counts == plain.counts
    facts = [spark.read.parquet(f"{path}/processed/fct_transactions") for path in out.values()]
    assert facts[0].exceptAll(facts[1]).count() == 0 and facts[1].exceptAll(facts[0]).count() == 0
