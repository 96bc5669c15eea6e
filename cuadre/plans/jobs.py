"""Reports and extracts as jobs.

A report job reads landed extracts, or base tables in one plan with the extract queries, and writes the report with
its profile and summary. An extract job reads base tables and writes relations.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from cuadre.operators import summaries
from cuadre.operators.profile import WhileWriting, profile
from cuadre.plans import extracts, reports
from cuadre.session import size_session
from cuadre.sources import spec, versions
from cuadre.sources.files import conform, read_csv, read_extract, require
from cuadre.sources.sinks import replace_nan, write_report
from cuadre.sources.spec import RelationSpec


@dataclass(frozen=True)
class Input:
    relation: RelationSpec
    file: str
    required: bool = False


@dataclass(frozen=True)
class Job:
    """`inputs` maps an argument of `build` to its extract."""

    build: Callable[..., DataFrame]
    inputs: dict[str, Input]
    offsets: str = "wall"
    summary: bool = False


# ---- fixed values: names under which the extracts land ------------------------
_MASTER = {
    "invoices": Input(spec.INVOICES_V1, "XX_RO_FACTURAS_REP.csv", required=True),
    "tax_lines": Input(spec.TAX_LINES_V1, "XX_RO_IMPUESTOS_REP.csv"),
    "payments": Input(spec.PAYMENTS_V1, "XX_RO_PAGOS_REP.csv"),
    "requisitions": Input(spec.REQUISITIONS, "XX_RO_FACTURA_REQUI_REP.csv"),
}
_NET_PAYABLE = {
    "invoices": Input(spec.INVOICES_NET, "XX_RO_FACTURAS_REP.csv", required=True),
    "tax_lines": Input(spec.TAX_LINES_V1, "XX_RO_IMPUESTOS_REP.csv", required=True),
    "requisitions": Input(spec.REQUISITIONS, "XX_RO_FACTURA_REQUI_REP.csv", required=True),
}
_HISTORICAL = {
    "invoices": Input(spec.FLOW_INVOICES, "XX_RO_CXP_MODEL_REP.csv", required=True),
    "payments": Input(spec.FLOW_PAYMENTS, "XX_RO_PAGOS_MODEL_REP.csv", required=True),
    "rates": Input(spec.DAILY_RATES, "XX_RO_RATES_MODEL_REP.csv", required=True),
}
_SCHEDULE_PAYMENT = {
    "invoices": Input(spec.INVOICES_V2, "core_invoices.csv", required=True),
    "schedules": Input(spec.SCHEDULES, "payment_schedules.csv"),
    "payments": Input(spec.PAYMENTS_V2, "payments_applied.csv"),
    "distributions": Input(spec.DISTRIBUTIONS, "distributions.csv"),
    "taxes": Input(spec.TAXES_V2, "taxes.csv"),
    "prepay_ers": Input(spec.PREPAY_ERS, "prepayments_ers.csv"),
}
_INVOICE_V4 = {
    "invoices": Input(spec.INVOICES_V4, "core_invoices_rep.csv", required=True),
    "taxes": Input(spec.TAXES_V4, "taxes_rep.csv"),
    "withholding": Input(spec.WITHHOLDING, "withholding_rep.csv"),
    "distributions": Input(spec.DISTRIBUTIONS, "distributions_rep.csv"),
    "payments": Input(spec.PAYMENTS_V4, "payments_applied_rep.csv"),
    "prepay_ers": Input(spec.PREPAY_ERS_V4, "payments_ers_rep.csv"),
}
# -------------------------------------------------------------------------------


def _master(variant: str) -> Callable[..., DataFrame]:
    return lambda **inputs: reports.report_master(variant, **inputs)


JOBS = {
    "master_rate": Job(_master("rate"), _MASTER),
    "master_code": Job(_master("code"), _MASTER),
    "master_account": Job(
        _master("account"), {**_MASTER, "chart": Input(spec.CHART_OF_ACCOUNTS, "XX_RO_PLAN_CUENTAS_REP.csv")}
    ),
    "net_payable": Job(reports.report_net_payable, _NET_PAYABLE),
    "historical_fx": Job(reports.report_historical_fx, _HISTORICAL),
    # the keys stay in front: the summary tells invoices and schedules apart by them
    "schedule_payment": Job(
        partial(reports.report_schedule_payment, keep_key=True), _SCHEDULE_PAYMENT, offsets="utc", summary=True
    ),
    "invoice_v4": Job(reports.report_invoice_v4, _INVOICE_V4),
}


class BaseTables(dict):
    """Base tables of one folder, a Parquet table under each name, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self._spark, self._folder = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._spark.read.parquet(f"{self._folder}/{name}")
        return self[name]


def load_inputs(
    spark: SparkSession,
    job: Job,
    folder: str,
    fmt: str = "csv",
    files: dict[str, str] | None = None,
    cells: str = "quoted",
) -> dict[str, DataFrame]:
    """The relations a job reads from `folder`; `files` renames single inputs, `cells` as in read_csv."""
    names = {argument: source.file for argument, source in job.inputs.items()} | (files or {})
    return {
        argument: read_extract(
            spark, source.relation, f"{folder}/{names[argument]}", required=source.required, fmt=fmt,
            offsets=job.offsets, cells=cells,
        )
        for argument, source in job.inputs.items()
    }


def from_base(t: extracts.Tables, job: Job, since: dt.date | None = None) -> dict[str, DataFrame]:
    """The relations a job reads, as extract queries over base tables: with the report they are one plan.

    A relation that has no extract query cannot be made this way.
    """
    return {
        argument: conform(extracts.extract(t, source.relation.name, since), source.relation, job.offsets)
        for argument, source in job.inputs.items()
    }


def run_job(
    spark: SparkSession,
    name: str,
    source: str,
    target: str,
    input_fmt: str = "csv",
    fmt: str = "parquet",
    mode: str = "errorifexists",
    files: dict[str, str] | None = None,
    cells: str = "quoted",
    profiled: bool | str = True,
    since: dt.date | None = None,
    non_empty: bool = False,
) -> None:
    """Write the tables report, profile unless it is not wanted and, where there is one, summary, and commit them together
    as a version of `target`, which `versions.read` reads. `profiled` "while_writing" takes the profile along with the write,
    its distinct counts estimated, where True reads the report again and counts. With a summary go the states that it is made of
    (`merged_summary`).

    `input_fmt` "base" reads base tables from `source` instead of extracts. Partitions are sized
    by the bytes of the inputs. `non_empty` stops a job without invoices. Profile and summary read the written report, so it
    is computed once. `mode` says what happens where the target has a version: an error, a new version instead of it
    (overwrite), or one that has its rows as well (append). A job that ends early leaves the version that was there.
    """
    job = JOBS[name]
    if profiled not in (True, False, "while_writing"):
        raise ValueError(f"profiled must be True, False or 'while_writing', not {profiled!r}")
    if mode not in ("errorifexists", "overwrite", "append"):
        raise ValueError(f"mode must be 'errorifexists', 'overwrite' or 'append', not {mode!r}")
    before = versions.current(spark, target)
    if before.number and mode == "errorifexists":
        raise ValueError(f"{target} has a version already")
    size_session(spark, [source])
    if input_fmt == "base":
        inputs = from_base(BaseTables(spark, source), job, since)
    else:
        inputs = load_inputs(spark, job, source, input_fmt, files, cells)
    if non_empty:
        require(inputs["invoices"], "invoices")
    report = job.build(**inputs)
    part = versions.new_part(target)
    schemas = {}

    def put(table: str, df: DataFrame) -> None:
        write_report(df, f"{part}/{table}", fmt)
        schemas[table] = df.schema

    along = WhileWriting(replace_nan(report)) if profiled == "while_writing" else None
    put("report", along.rows if along else report)

    def written(table: str) -> DataFrame:
        if fmt == "csv":
            return read_csv(spark, f"{part}/{table}", "free", schemas[table])
        return spark.read.schema(schemas[table]).format(fmt).load(f"{part}/{table}")

    if profiled:
        put("profile", along.profile() if along else profile(written("report")))
    if job.summary:
        # in order of days, so that a span of days reads a part of the files
        put("states", summaries.states(written("report")).repartitionByRange(summaries.DAY, *summaries.INVOICE))
        put("summary", summaries.summary(written("states")))
    versions.commit(spark, target, before, part, fmt, schemas, append=mode == "append")


def merged_summary(spark: SparkSession, target: str, corrections: bool = False) -> DataFrame:
    """One summary of all that the current version of `target` holds, from the stored states: no report is read.

    After `mode="append"` the table summary has a row for each run; this is the one of their union. With `corrections` each run
    tells the whole of its invoices, and takes the place of what earlier runs say of them.
    """
    version = versions.current(spark, target)
    parts = [versions.read(spark, target, "states", replace(version, parts=[part])) for part in version.parts]
    return summaries.summary(summaries.corrected(*parts) if corrections else summaries.merged(*parts))


def run_extracts(
    spark: SparkSession,
    source: str,
    target: str,
    relations: list[str] | None = None,
    since: dt.date | None = None,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    ordered: bool = False,
) -> None:
    """Write relations extracted from the base tables in `source`, a folder for each under `target`.

    `ordered` sorts those that have an extract order as their files are sorted.
    """
    size_session(spark, [source])
    tables = BaseTables(spark, source)
    for relation in relations or extracts.EXTRACTS:
        df = extracts.extract(tables, relation, since)
        if ordered and relation in extracts.EXTRACT_ORDER:
            df = extracts.in_extract_order(df, relation)
        write_report(df, f"{target}/{relation}", fmt, mode)
