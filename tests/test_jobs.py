"""Jobs from CSV extracts give the report of the relations they were written from."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cuadre.catalog.mapping import BASE_SQL, base_tables, relations
from cuadre.plans import extracts
from cuadre.plans.jobs import JOBS, load_inputs, run_extracts, run_job
from cuadre.session import input_bytes
from cuadre.plans import jobs
from cuadre.sources import versions
from cuadre.sources.files import conform
from tests.compare import cell

SF_DIR = "/root/testdata/sf0.001"
# job argument -> mapped relation
RELATIONS = {
    "master_code": dict(invoices="invoices_v1", tax_lines="tax_lines_v1", payments="payments_v1", requisitions="requisitions"),
    "master_account": dict(invoices="invoices_v1", tax_lines="tax_lines_v1", payments="payments_v1",
                           requisitions="requisitions", chart="chart_of_accounts"),
    "net_payable": dict(invoices="invoices_net", tax_lines="tax_lines_v1", requisitions="requisitions"),
    "historical_fx": dict(invoices="flow_invoices", payments="flow_payments", rates="daily_rates"),
    "schedule_payment": dict(invoices="invoices_v2", schedules="schedules", payments="payments_v4",
                             distributions="distributions", taxes="taxes_v2", prepay_ers="prepay_ers"),
    "invoice_v4": dict(invoices="invoices_v2", taxes="taxes_v4", withholding="withholding",
                       distributions="distributions", payments="payments_v4", prepay_ers="prepay_ers"),
}


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Jobs size the partitions of their session; the tests' own sizes come back afterwards."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = {name: spark.conf.get(name) for name in names}
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def land(df, path: str) -> None:
    """An extract with a dirty header, as a folder of CSV files."""
    dirty = df.toDF(*[f" {c.lower()} " if i % 2 else c for i, c in enumerate(df.columns)])
    options = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    dirty.coalesce(2).write.options(**options).csv(path)


def text_rows(df):
    return sorted(tuple(cell(v) for v in row) for row in df.collect())


@pytest.mark.parametrize("name", sorted(RELATIONS))
def test_job(spark, tmp_path, name):
    job = JOBS[name]
    mapped = relations(spark, SF_DIR)
    expected = {}
    for argument, relation in RELATIONS[name].items():
        land(mapped[relation], f"{tmp_path}/in/{job.inputs[argument].file}")
        expected[argument] = conform(mapped[relation], job.inputs[argument].relation)
    run_job(spark, name, f"{tmp_path}/in", f"{tmp_path}/out")
    report = versions.read(spark, f"{tmp_path}/out", "report")
    assert text_rows(report) == text_rows(job.build(**expected))
    assert versions.read(spark, f"{tmp_path}/out", "profile").count() == len(report.columns)
    if job.summary:
        summary = versions.read(spark, f"{tmp_path}/out", "summary").first()
        assert summary["row_count"] == report.count()
        assert summary["invoice_count"] == mapped["invoices_v2"].count()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_texts_with_line_breaks(spark, tmp_path, fmt):
    """Descriptions with line breaks, quotes and commas, in and out."""
    text = ' two\nlines, "quoted" '
    invoices = relations(spark, SF_DIR)["invoices_v1"].limit(20).withColumn("DESCRIPTION", F.lit(text))
    land(invoices, f"{tmp_path}/in/XX_RO_FACTURAS_REP.csv")
    run_job(spark, "master_rate", f"{tmp_path}/in", f"{tmp_path}/out", fmt=fmt)
    report = versions.read(spark, f"{tmp_path}/out", "report")
    assert report.count() == 20 and [r[0] for r in report.select("DESCRIPTION").distinct().collect()] == [text]
    profile = {r["column_name"]: r for r in versions.read(spark, f"{tmp_path}/out", "profile").collect()}
    assert int(profile["DESCRIPTION"]["distinct_count"]) == 1 and int(profile["IMPORTE"]["null_count"]) == 0


def test_no_profile(spark, tmp_path):
    land(relations(spark, SF_DIR)["invoices_v1"], f"{tmp_path}/in/XX_RO_FACTURAS_REP.csv")
    run_job(spark, "master_code", f"{tmp_path}/in", f"{tmp_path}/out", profiled=False)
    assert list(versions.current(spark, f"{tmp_path}/out").schemas) == ["report"]


def test_base_tables_to_relations_and_report(spark, tmp_path):
    base = base_tables(spark, SF_DIR)
    for name in BASE_SQL:
        base[name].write.parquet(f"{tmp_path}/base/{name}")
    since = dt.date(1996, 6, 1)
    run_extracts(spark, f"{tmp_path}/base", f"{tmp_path}/out", since=since, ordered=True)
    for relation in ("invoices_v1", "schedules", "daily_rates", "requisitions"):
        written = spark.read.parquet(f"{tmp_path}/out/{relation}")
        assert text_rows(written) == text_rows(extracts.extract(base, relation, since))
    dates = [r[0] for r in spark.read.parquet(f"{tmp_path}/out/daily_rates").select("FECHA_TASA").collect()]
    assert dates == sorted(dates, reverse=True)
    # base tables to report: the same as through the relations
    run_job(spark, "master_code", f"{tmp_path}/base", f"{tmp_path}/one", input_fmt="base", since=since)
    job = JOBS["master_code"]
    read = {a: conform(spark.read.parquet(f"{tmp_path}/out/{i.relation.name}"), i.relation) for a, i in job.inputs.items()}
    report = versions.read(spark, f"{tmp_path}/one", "report")
    assert text_rows(report) == text_rows(job.build(**read)) and report.count() > 0


def test_partitions_follow_the_input(spark, tmp_path):
    base_tables(spark, SF_DIR)["AP_CHECKS_ALL"].write.parquet(f"{tmp_path}/t")
    size = input_bytes(spark, [f"{tmp_path}/t", f"{tmp_path}/none"])
    assert size >= sum(p.stat().st_size for p in (tmp_path / "t").glob("*.parquet")) > 0


def test_only_invoices_landed(spark, tmp_path):
    invoices = relations(spark, SF_DIR)["invoices_v2"]
    land(invoices, f"{tmp_path}/in/other.csv")
    run_job(spark, "schedule_payment", f"{tmp_path}/in", f"{tmp_path}/out", fmt="csv", files={"invoices": "other.csv"})
    report = versions.read(spark, f"{tmp_path}/out", "report")
    assert report.count() == invoices.count()
    assert report.where(F.col("NUM_PAGO").isNotNull()).count() == 0


def test_invoices_are_required(spark, tmp_path):
    with pytest.raises(AnalysisException):
        load_inputs(spark, JOBS["master_code"], str(tmp_path))


def test_a_job_that_ends_early_leaves_the_former_version(spark, tmp_path, monkeypatch):
    invoices = relations(spark, SF_DIR)["invoices_v1"]
    land(invoices.where("INVOICE_ID % 3 = 0"), f"{tmp_path}/in/XX_RO_FACTURAS_REP.csv")
    land(invoices, f"{tmp_path}/in/more.csv")
    out = f"{tmp_path}/out"
    run_job(spark, "master_code", f"{tmp_path}/in", out)
    rows = versions.read(spark, out, "report").count()
    with pytest.raises(ValueError, match="has a version"):
        run_job(spark, "master_code", f"{tmp_path}/in", out)

    def fails(df):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError, match="killed"):
        patched.setattr(jobs, "profile", fails)
        run_job(spark, "master_code", f"{tmp_path}/in", out, mode="overwrite", files={"invoices": "more.csv"})
    assert versions.current(spark, out).number == 1
    assert versions.read(spark, out, "report").count() == rows
    # a retry needs nothing cleared away
    run_job(spark, "master_code", f"{tmp_path}/in", out, mode="overwrite", files={"invoices": "more.csv"})
    assert versions.read(spark, out, "report").count() == invoices.count() > rows
    run_job(spark, "master_code", f"{tmp_path}/in", out, mode="append")
    assert versions.read(spark, out, "report").count() == invoices.count() + rows
    assert [v.number for v in versions.history(spark, out)] == [1, 2, 3]
    assert versions.read(spark, out, "report", versions.history(spark, out)[0]).count() == rows
    assert len(versions.remove_old(spark, out)) == 2  # the first version's part and what the failed run left
    assert versions.read(spark, out, "report").count() == invoices.count() + rows


def test_two_runs_from_one_version(spark, tmp_path):
    out, schema = str(tmp_path), spark.range(1).schema
    before = versions.current(spark, out)
    for expected in (1, None):
        part = versions.new_part(out)
        spark.range(1).write.parquet(f"{part}/t")
        if expected:
            versions.commit(spark, out, before, part, "parquet", {"t": schema})
        else:
            with pytest.raises(RuntimeError, match="another run"):
                versions.commit(spark, out, before, part, "parquet", {"t": schema})
    assert versions.read(spark, out, "t").count() == 1
    with pytest.raises(ValueError, match="no committed table"):
        versions.read(spark, out, "u")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_profile_while_writing(spark, tmp_path, fmt):
    land(relations(spark, SF_DIR)["invoices_v1"], f"{tmp_path}/in/XX_RO_FACTURAS_REP.csv")
    for profiled in (True, "while_writing"):
        run_job(spark, "master_code", f"{tmp_path}/in", f"{tmp_path}/{profiled}", fmt=fmt, profiled=profiled)
    exact, along = (versions.read(spark, f"{tmp_path}/{p}", "profile") for p in (True, "while_writing"))
    assert text_rows(along.drop("distinct_count")) == text_rows(exact.drop("distinct_count"))
    with pytest.raises(ValueError, match="profiled"):
        run_job(spark, "master_code", f"{tmp_path}/in", f"{tmp_path}/no", profiled="maybe")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_summaries_of_runs_are_merged(spark, tmp_path, fmt):
    invoices, out = relations(spark, SF_DIR)["invoices_v2"], f"{tmp_path}/out"
    land(invoices.where("INVOICE_ID % 3 = 0"), f"{tmp_path}/in/first.csv")
    land(invoices.where("INVOICE_ID % 3 > 0"), f"{tmp_path}/in/second.csv")
    land(invoices, f"{tmp_path}/in/core_invoices.csv")
    for name in ("first.csv", "second.csv", "first.csv"):
        run_job(
            spark, "schedule_payment", f"{tmp_path}/in", out, fmt=fmt, mode="append", files={"invoices": name}, profiled=False
        )
    run_job(spark, "schedule_payment", f"{tmp_path}/in", f"{tmp_path}/once", fmt=fmt, profiled=False)
    once = versions.read(spark, f"{tmp_path}/once", "summary")
    # the third run repeats the first one: a correction takes its place, otherwise its rows count again
    assert text_rows(jobs.merged_summary(spark, out, corrections=True)) == text_rows(once)
    repeated = jobs.merged_summary(spark, out).first()
    assert repeated["invoice_count"] == once.first()["invoice_count"] == invoices.count()
    assert repeated["row_count"] == versions.read(spark, out, "report").count() > once.first()["row_count"]
