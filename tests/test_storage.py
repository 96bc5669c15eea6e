"""Reports over co-partitioned relations equal those over plain ones, and their invoice joins need no exchange."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cuadre.catalog.mapping import relations
from cuadre.plans import reports
from cuadre.sources import storage
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"


def master(invoices, tax_lines, payments, requisitions, **options):
    return reports.report_master("code", invoices, tax_lines, payments, requisitions, **options)


MASTER = {"invoices": "invoices_v1", "tax_lines": "tax_lines_v1", "payments": "payments_v1", "requisitions": "requisitions"}
NET = {"invoices": "invoices_net", "tax_lines": "tax_lines_v1", "requisitions": "requisitions"}
FLOW = {"invoices": "flow_invoices", "payments": "flow_payments", "rates": "daily_rates"}
SCHEDULE = {
    "invoices": "invoices_v2", "schedules": "schedules", "payments": "payments_v4", "distributions": "distributions",
    "taxes": "taxes_v2", "prepay_ers": "prepay_ers",
}
CASES = [
    (master, MASTER, ()), (reports.report_net_payable, NET, ()), (reports.report_historical_fx, FLOW, ()),
    (reports.report_schedule_payment, SCHEDULE, ("prepay_ers",)),
]


def given(spark, names):
    r = relations(spark, SF_DIR)
    found = {argument: r[name] for argument, name in names.items()}
    if "schedules" in found:
        found["payments"] = found["payments"].drop("DESCRIPTION", "FECHA_PAGO")
    return found


@pytest.mark.parametrize("build,names,whole", CASES, ids=["master", "net", "flow", "schedule"])
@pytest.mark.parametrize("hot_work", [4, 10**6])
def test_reports_over_parts(spark, tmp_path, build, names, whole, hot_work):
    inputs = given(spark, names)
    storage.store(inputs, str(tmp_path), 3, hot_work=hot_work)
    parts = storage.stored(spark, str(tmp_path))
    hot = spark.read.parquet(f"{tmp_path}/_hot").count()
    assert hot > 0 if hot_work == 4 else hot == 0
    for name in parts.bucketed:
        assert parts.whole(name).count() == inputs[name].count()
        assert not parts.bucketed[name].where("INVOICE_ID IS NULL").count()
    found = storage.over_parts(build, parts, whole)
    assert rows(found, *sorted(found.columns)) == rows(build(**inputs), *sorted(found.columns))


def test_joins_of_stored_relations_need_no_exchange(spark, tmp_path):
    storage.store(given(spark, MASTER), str(tmp_path), 3)
    parts = storage.stored(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = master(**parts.bucketed, salted=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3


def test_one_file_a_bucket_and_no_half_store(spark, tmp_path):
    storage.store({"a": spark.range(1000).withColumnRenamed("id", "INVOICE_ID")}, f"{tmp_path}/s", 4)
    assert len([f for f in os.listdir(f"{tmp_path}/s/a/bucketed") if f.endswith(".parquet")]) == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        storage.stored(spark, f"{tmp_path}/none")


def test_hot_and_missing_keys_are_not_bucketed(spark, tmp_path):
    many = spark.range(500).select(F.when(F.col("id") < 300, 7).when(F.col("id") < 400, None).otherwise(F.col("id")).alias("INVOICE_ID"))
    storage.store({"many": many, "rates": spark.range(3)}, str(tmp_path), 2, hot_work=100)
    parts = storage.stored(spark, str(tmp_path))
    assert parts.bucketed["many"].count() == 100 and parts.rest["many"].count() == 400
    assert parts.plain["rates"].count() == 3 and parts.whole("rates").count() == 3


def test_buckets_grow_with_the_input(spark, tmp_path, monkeypatch):
    """A bucket is one task: twice the files, twice the buckets; the rows stay the same."""
    rows = spark.range(4_000).selectExpr("id % 500 as INVOICE_ID", "cast(id as string) as NUM_PAGO")
    rows.repartition(4).write.parquet(str(tmp_path / "rows"))
    relations = {"payments": spark.read.parquet(str(tmp_path / "rows"))}
    size = sum(p.stat().st_size for p in (tmp_path / "rows").glob("*.parquet"))
    monkeypatch.setattr(storage, "BUCKET_BYTES", -(-size // 6))
    storage.store(relations, f"file://{tmp_path}/store", 2)
    files = [p.name for p in (tmp_path / "store" / "payments" / "bucketed").glob("part-*")]
    assert len(files) == 6
    found = storage.stored(spark, f"file://{tmp_path}/store").whole("payments")
    assert found.exceptAll(relations["payments"]).isEmpty() and found.count() == 4_000
    assert storage.buckets_for(spark, {"one": spark.range(9)}, 3) == 3
