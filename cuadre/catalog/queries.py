"""Registered queries: every operator over the whole mapped test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadre.catalog.mapping import base_tables, relations
from cuadre.functions import classify, dates, measures, text
from cuadre.functions.numbers import money, or_zero, percentage, rate_or_one, row_sum, to_number
from cuadre.operators import aggregates as agg
from cuadre.operators import joins, profile, summaries
from cuadre.operators.columns import ensure_money, reindex
from cuadre.plans import extracts, reports
from cuadre.session import scratch_folder, shuffles_end_with_the_write
from cuadre.sources import changes, files, sinks, spec, storage, versions

# The test tables run from 1995 to 2001; the extracts' own bound lies after them.
SINCE = dt.date(1996, 6, 1)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _on(source, name: str):
    def register(build: Callable[[dict], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: build(source(spark, sf_dir))
        return build

    return register


def _relation(name: str):
    return _on(relations, name)


def _base(name: str):
    return _on(base_tables, name)


# ---- extracts ----------------------------------------------------------------

_base("e1_invoices_v1")(lambda t: extracts.invoices_v1(t, SINCE))
_base("e1a_first_receipt")(extracts.first_receipt)
_base("e1c_expense_account")(extracts.expense_account)
_base("e2_invoices_v2")(lambda t: extracts.invoices_v2(t, SINCE))
_base("e2a_max_po")(extracts.max_purchase_order)
_base("e3_tax_lines")(lambda t: extracts.tax_lines_v1(t, SINCE))
_base("e4_taxes_nonzero")(lambda t: extracts.taxes_v2(t, SINCE))
_base("e5_payments_cleared")(lambda t: extracts.payments_v1(t, True, SINCE))
_base("e6_payments_all")(lambda t: extracts.payments_v1(t, False))
_base("e7_payments_v2")(lambda t: extracts.payments_v2(t, SINCE))
_base("e8_distributions")(lambda t: extracts.distributions(t, SINCE))
_base("e9_schedules")(lambda t: extracts.schedules(t, SINCE))
_base("e10_requisition_bridge")(extracts.requisition_bridge)
_base("e11_account_bridge")(lambda t: extracts.account_bridge(t, SINCE))
_base("e12_chart")(extracts.chart_of_accounts)
_base("e13_rates")(lambda t: extracts.daily_rates(t, since=SINCE))
_base("e14_prepay_ers")(lambda t: extracts.prepay_ers(t, SINCE))
_base("e15_withholding")(lambda t: extracts.withholding(t, SINCE))

# ---- sources -----------------------------------------------------------------

_relation("s4_conform")(lambda r: files.conform(r["invoices_v1"], spec.INVOICES_V1))
_relation("s5_peek")(lambda r: files.peek(r["invoices_v1"].orderBy("INVOICE_ID")))
_relation("k2_no_nan")(lambda r: sinks.replace_nan(r["amounts_double"]))
_base("o1_extract_order")(lambda t: extracts.in_extract_order(extracts.schedules(t, SINCE), "schedules"))
_base("o1_positions")(
    lambda t: extracts.with_positions(
        extracts.schedules(t, SINCE), "schedules", scratch_folder(t["AP_PAYMENT_SCHEDULES_ALL"].sparkSession, "placed")
    )
)
_relation("s3_nullify")(lambda r: files.nullify_tokens(r["flow_payments"]))
_relation("p2_reindex")(
    lambda r: reindex(r["invoices_v1"], ["FACTURA", "TC_FACTURA", "INVOICE_ID"], {"TC_FACTURA": spec.RATE})
)
_relation("p9_ensure_money")(
    lambda r: ensure_money(
        r["payments_v1"].select("INVOICE_ID", "NUM_PAGO", "ADELANTO_APLICADO", "TC_PAGO"),
        ["ADELANTO_APLICADO", "RET_IVA"],
        ["TC_PAGO"],
    )
)


def _landed(df: DataFrame, headers: list[str], relation: spec.RelationSpec) -> DataFrame:
    """`df` written as a report in CSV, under other headers, and read back as an extract."""
    folder = scratch_folder(df.sparkSession, "landed")
    sinks.write_report(df.toDF(*headers), folder, fmt="csv")
    return files.read_extract(df.sparkSession, relation, folder)


_HEADERS = [" invoice_id", "Factura ", "PROVEEDOR", "description", "moneda", "Importe", " FECHA ", "estatus"]
_relation("s1_csv_extract")(lambda r: _landed(r["invoices_landed"], _HEADERS, spec.INVOICES_V1))
_relation("x16_header_tokens")(
    lambda r: _landed(r["daily_rates"], ["conversion date of day", "from_currency", "to_currency", "official rate"], spec.DAILY_RATES)
)


@_relation("k1_report_sink")
def _k1(r) -> DataFrame:
    amounts = r["amounts_double"]
    folder = scratch_folder(amounts.sparkSession, "report")
    sinks.write_report(amounts, folder, partition_by=["LINE"])
    return amounts.sparkSession.read.parquet(folder).select(*amounts.columns)


@_relation("s2_optional")
def _s2(r) -> DataFrame:
    bridge = files.conform(r["requisitions"], spec.REQUISITIONS)
    absent = scratch_folder(bridge.sparkSession, "absent")
    return bridge.unionByName(files.read_extract(bridge.sparkSession, spec.REQUISITIONS, absent, required=False))


_relation("s6_changes")(lambda r: changes.changes(r["schedules"], r["schedules_next"], ["INVOICE_ID"]))


@_relation("s6_applied")
def _s6_applied(r) -> DataFrame:
    """The earlier schedules brought up to date by a change set that was landed."""
    spark = r["schedules"].sparkSession
    folder = scratch_folder(spark, "changes")
    change_set = changes.changes(r["schedules"], r["schedules_next"], ["INVOICE_ID"])
    sinks.write_report(change_set, folder)
    return changes.applied(r["schedules"], spark.read.parquet(folder))


@_relation("k1_versions")
def _k1_versions(r) -> DataFrame:
    """A table that is committed, and another one that is added to it."""
    spark = r["schedules"].sparkSession
    target = scratch_folder(spark, "versions")
    for year in (True, False):
        some = r["schedules"].where((F.year("FECHA_VENCIMIENTO") < 1997) == year)
        before, part = versions.current(spark, target), versions.new_part(target)
        sinks.write_report(some, f"{part}/schedules", fmt="csv")
        versions.commit(spark, target, before, part, "csv", {"schedules": some.schema}, append=True)
    return versions.read(spark, target, "schedules")


_relation("f7_non_empty")(lambda r: files.require(r["schedules"], "schedules"))
_base("s6_scan_since")(
    lambda t: files.scan_since(t["AP_INVOICES_ALL"], "CREATION_DATE", SINCE).select("INVOICE_ID", "CREATION_DATE")
)

# ---- classification ----------------------------------------------------------


def _classed(relation: str, columns: list[str], category) -> Callable:
    return lambda r: r[relation].select(*columns, category().alias("category"))


_TAX = ["INVOICE_ID", "TAX_RATE", "TAX_AMT", "TIPO_LINEA", "CODIGO_IMPUESTO"]
_relation("c1_rate")(_classed("tax_lines_v1", _TAX, classify.classify_by_rate))
_relation("c2_rate_detail")(_classed("tax_lines_v1", _TAX, classify.classify_by_rate_detail))
_relation("c3_code")(_classed("tax_lines_v1", _TAX, classify.classify_by_code))
_relation("c4_type")(
    _classed("taxes_v2", ["INVOICE_ID", "TRX_LINE_NUMBER", "TAX_TYPE_CODE"], classify.classify_by_type)
)


@_relation("c5_percentage")
def _c5(r) -> DataFrame:
    held = r["withholding"].withColumn("PORCENTAJE_RETENCION", percentage("RETENCION_USD", "MONTO_BASE"))
    return held.select(
        "INVOICE_ID", "DISTRIBUTION_LINE_NUMBER", "PORCENTAJE_RETENCION",
        classify.classify_by_percentage().alias("category"),
    )


# ---- aggregates --------------------------------------------------------------

_LINE = "DISTRIBUTION_LINE_NUMBER"

_relation("a1_tax_pivot")(
    lambda r: agg.tax_pivot(r["tax_lines_v1"], classify.classify_by_code(), spec.CLASSES_BY_CODE)
)
_relation("a2_pivot_two")(
    lambda r: agg.pivot_two(
        r["withholding"], "CLASIFICACION_RETENCION", spec.CLASSES_BY_PERCENTAGE, "RETENCION_USD", "RETENCION_MXN",
        "RET_OTRO",
    )
)
_relation("a2_pivot_taxes")(
    lambda r: agg.pivot_two(
        r["taxes_v4"], "CLASIFICACION_IMPUESTO", spec.CLASSES_V4_TAX, "IMPUESTO_USD", "IMPUESTO_MXN", "OTROS_TAX"
    )
)
_relation("a3_group_sum")(
    lambda r: r["payments_v4"].groupBy("INVOICE_ID").agg(agg.sum_or_zero("IMPORTE_PAGO_MXN").alias("paid_mxn"))
)
_relation("a4_mean_max")(
    lambda r: r["payments_v4"].groupBy("INVOICE_ID").agg(
        agg.mean_rate("TIPO_CAMBIO_PAGO").alias("mean_rate"), F.max("FECHA_APLICACION").alias("last_applied")
    )
)
_relation("a5_distinct_list")(
    lambda r: agg.distinct_lists(
        r["distributions"], "INVOICE_ID", [agg.ListOf("departments", "CC_DEPARTAMENTO", " | ")], F.col(_LINE), 3
    )
)
_relation("a5_distinct_list_all")(
    lambda r: agg.distinct_lists(
        r["distributions"], "INVOICE_ID", [agg.ListOf("accounts", "CC_CUENTA", ", ")], F.col(_LINE)
    )
)
_relation("a5_distinct_values")(
    lambda r: agg.distinct_values(
        r["distributions"],
        "INVOICE_ID",
        [agg.ListOf("account", "CC_CUENTA"), agg.ListOf("department", "CC_DEPARTAMENTO")],
        F.col(_LINE),
    )
)
_relation("a6_first_non_null")(
    lambda r: r["distributions"].groupBy("INVOICE_ID").agg(
        agg.first_non_null("DESCRIPTION", F.col(_LINE)).alias("description")
    )
)
_relation("a7_distinct")(lambda r: r["distributions"].select("INVOICE_ID", "CC_CUENTA").distinct())
_relation("a9_value_counts")(lambda r: agg.value_counts(r["prepay_ers"], "TIPO_ORIGEN"))
_relation("a10_row_sum")(
    lambda r: r["payments_v1"].select(
        "INVOICE_ID", "NUM_PAGO", "IMPORTE_PAGO", row_sum("IMPORTE_PAGO", "ADELANTO_APLICADO").alias("total")
    )
)
_relation("a11_distributions")(lambda r: agg.agg_distributions(r["distributions"]))
_relation("a12_principal")(lambda r: agg.principal_distribution(r["distributions"]))
_relation("a13_payments")(lambda r: agg.agg_payments(r["payments_v4"]))
_relation("a14_prepayments")(lambda r: agg.agg_prepayments(r["prepay_ers"]))
_relation("a15_prepaid")(lambda r: agg.split_prepay_ers(r["prepay_ers"])[0])
_relation("a15_receipts")(lambda r: agg.split_prepay_ers(r["prepay_ers"])[1])

# ---- joins and ordering ------------------------------------------------------

_relation("j3_fanout")(
    lambda r: joins.report_lines(
        r["invoices_v1"].select("INVOICE_ID", "FACTURA", "IMPORTE"),
        [r["payments_v1"].select("INVOICE_ID", "NUM_PAGO", "IMPORTE_PAGO"), r["requisitions"]],
    )
)
_relation("j4_schedule_payment")(
    lambda r: joins.merge_schedule_payment(
        r["invoices_v2"].select("INVOICE_ID", "FACTURA", "INVOICE_AMOUNT"),
        r["schedules"].select("INVOICE_ID", "PAYMENT_NUM", "SALDO_USD"),
        r["payments_v4"].select("INVOICE_ID", "NUM_PAGO", "IMPORTE_PAGO_USD"),
    )
)
_relation("j5_first")(
    lambda r: joins.left_join_first(
        r["invoices_v1"].select("INVOICE_ID", "FACTURA"), r["payments_v1"], "INVOICE_ID", joins.first_payment_order()
    )
)
_relation("j6_master")(
    lambda r: joins.merge_master(
        r["invoices_v2"].select("INVOICE_ID", "FACTURA"),
        agg.principal_distribution(r["distributions"]),
        agg.split_prepay_ers(r["prepay_ers"])[0],
    )
)
_relation("j7_account_text")(
    lambda r: joins.with_account_description(
        r["invoices_v1"].select("INVOICE_ID", "CUENTA_GASTO"), r["chart_of_accounts"]
    ).select("INVOICE_ID", "CTA_NUM", "CUENTA_GASTO_FULL")
)
_relation("j8_receipts")(
    lambda r: joins.with_receipts(
        r["invoices_v2"].select("INVOICE_ID", "ORDEN_COMPRA"), agg.split_prepay_ers(r["prepay_ers"])[1]
    )
)
# orders whose receipts grow with the data
_relation("a15_few")(lambda r: agg.receipt_lists(r["prepay_ers_few"]))
_relation("j8_few")(
    lambda r: joins.with_receipts(
        r["invoices_v2_few"].select("INVOICE_ID", "ORDEN_COMPRA"), agg.receipt_lists(r["prepay_ers_few"])
    )
)
_relation("j9_rate_lookup")(
    lambda r: joins.with_daily_rate(
        r["invoices_v1"].select("INVOICE_ID", "FECHA"), joins.one_rate_per_date(r["daily_rates"]), "FECHA", "rate"
    )
)
_relation("o2_first_row")(
    lambda r: agg.first_row(r["payments_v1"], "INVOICE_ID", joins.first_payment_order()).select(
        "INVOICE_ID", "FECHA_PAGO", "NUM_PAGO", "IMPORTE_PAGO"
    )
)
_relation("o4_top_rows")(
    lambda r: r["payments_v1"]
    .select("INVOICE_ID", "NUM_PAGO", "FECHA_PAGO", "IMPORTE_PAGO")
    .orderBy(F.desc("IMPORTE_PAGO"), "INVOICE_ID", "NUM_PAGO", "FECHA_PAGO")
    .limit(10)
)

# ---- scalar functions --------------------------------------------------------

_base("x1_account_string")(
    lambda t: t["GL_CODE_COMBINATIONS"].select(
        "CODE_COMBINATION_ID",
        text.account_string(extracts.SEGMENTS, "-").alias("account9"),
        text.account_string(extracts.SEGMENTS[:5], ".").alias("account5"),
    )
)
_relation("x3_to_number")(lambda r: r["flow_invoices"].select("INVOICE_ID", to_number("INVOICE_AMOUNT").alias("amount")))
_relation("x4_rate_or_one")(
    lambda r: r["payments_v1"].select(
        "INVOICE_ID", "NUM_PAGO", "TC_PAGO", rate_or_one("TC_PAGO").alias("rate"),
        rate_or_one("TC_PAGO", zero_is_one=False).alias("rate_null_only"),
    )
)
_relation("x6_offsets")(
    lambda r: r["flow_invoices"].select(
        "INVOICE_ID",
        dates.to_stamp("INVOICE_DATE", "wall").alias("wall"),
        dates.to_stamp("INVOICE_DATE", "utc").alias("utc"),
        dates.to_date("INVOICE_DATE").alias("day"),
    )
)
_relation("x7_periods")(
    lambda r: r["invoices_v2"].select(
        "INVOICE_ID",
        dates.iso_week("FECHA").alias("week"),
        *[dates.month("FECHA", s).alias(s) for s in ("english", "spanish", "year_month", "number")],
    )
)
_relation("x8_segment")(
    lambda r: r["invoices_v1"].select("INVOICE_ID", text.segment("CUENTA_GASTO", 5).alias("account"))
)
_relation("x12_payment_status")(
    lambda r: r["invoices_net"].select(
        "INVOICE_ID",
        text.payment_status("ESTATUS_PAGO").alias("status"),
        text.payment_status("ESTATUS_PAGO", "DESCONOCIDO").alias("status_or_unknown"),
    )
)
_relation("x13_approval2")(
    lambda r: r["invoices_v1"].select("INVOICE_ID", text.approval_2way("ESTATUS_APROBACION").alias("approval"))
)
_relation("x13_approval3")(lambda r: r["invoices_v2"].select("INVOICE_ID", text.approval_3way("ESTATUS").alias("approval")))
_relation("x14_uuid")(lambda r: r["invoices_net"].select("INVOICE_ID", text.uuid_check("UUID").alias("uuid_check")))
_relation("x15_display")(
    lambda r: text.presentation(r["payments_v1"].select("INVOICE_ID", "FECHA_PAGO", "IMPORTE_PAGO", "TC_PAGO"), "$")
)

# ---- measures ----------------------------------------------------------------


def _taxed(r, category, classes) -> DataFrame:
    invoices = r["invoices_v1"].select("INVOICE_ID", "IMPORTE")
    return joins.merge_master(invoices, agg.tax_pivot(r["tax_lines_v1"], category, classes))


def _v4(r) -> DataFrame:
    invoices = r["invoices_v2"].select("INVOICE_ID", F.col("INVOICE_AMOUNT").alias("IMPORTE"))
    taxes = agg.pivot_two(
        r["taxes_v4"], "CLASIFICACION_IMPUESTO", spec.CLASSES_V4_TAX, "IMPUESTO_USD", "IMPUESTO_MXN", "OTROS_TAX"
    )
    held = agg.pivot_two(
        r["withholding"], "CLASIFICACION_RETENCION", spec.CLASSES_BY_PERCENTAGE, "RETENCION_USD", "RETENCION_MXN",
        "RET_OTRO",
    )
    return joins.merge_master(invoices, taxes, held)


def _fx(r, *columns: str) -> DataFrame:
    return measures.with_currency_fx(r["invoices_v2"]).select("INVOICE_ID", "CURRENCY", "FX_RATE", *columns)


_relation("m1_subtotal_vat")(
    lambda r: _taxed(r, classify.classify_by_rate(), spec.CLASSES_BY_RATE).select(
        "INVOICE_ID", measures.subtotal("vat").alias("subtotal")
    )
)
_relation("m2_subtotal")(
    lambda r: _taxed(r, classify.classify_by_code(), spec.CLASSES_BY_CODE).select(
        "INVOICE_ID", measures.subtotal("vat_ret").alias("subtotal")
    )
)
_relation("m3_subtotal_v4")(
    lambda r: _v4(r).select(
        "INVOICE_ID",
        measures.subtotal("v4").alias("subtotal"),
        measures.subtotal("v4", include_iva_6=True).alias("subtotal_with_6"),
    )
)
_relation("m4_subtotal_header")(
    lambda r: r["invoices_v2"].select("INVOICE_ID", measures.subtotal("header").alias("subtotal"))
)
_relation("m5_balance")(
    lambda r: joins.report_lines(
        r["invoices_v1"].select("INVOICE_ID", "IMPORTE"), [r["payments_v1"].select("INVOICE_ID", "IMPORTE_PAGO")]
    ).select("INVOICE_ID", measures.balance("paid").alias("balance"))
)
_relation("m6_balance_prepaid")(
    lambda r: joins.merge_master(
        r["invoices_v2"].select("INVOICE_ID", F.col("INVOICE_AMOUNT").alias("IMPORTE")),
        r["payments_v4"].groupBy("INVOICE_ID").agg(agg.sum_or_zero("IMPORTE_PAGO_USD").alias("IMPORTE_PAGO_USD")),
        agg.split_prepay_ers(r["prepay_ers"])[0],
    ).select("INVOICE_ID", measures.balance("paid_prepaid").alias("balance"))
)
_relation("m7_to_mxn")(
    lambda r: measures.to_mxn(
        r["payments_v1"].select("INVOICE_ID", "NUM_PAGO", "IMPORTE_PAGO", "ADELANTO_APLICADO", "TC_PAGO"),
        ["IMPORTE_PAGO", "ADELANTO_APLICADO"],
        rate_or_one("TC_PAGO"),
    )
)
_relation("m8_split_as_usd")(
    lambda r: measures.split_currency(
        _fx(r, "INVOICE_AMOUNT"), F.col("INVOICE_AMOUNT"), "amount_usd", "amount_mxn", other="as_usd"
    )
)
_relation("m9_split_zero")(
    lambda r: measures.split_currency(
        _fx(r, "INVOICE_AMOUNT"), F.col("INVOICE_AMOUNT"), "amount_usd", "amount_mxn", other="zero"
    )
)
_relation("m10_payment_split")(
    lambda r: measures.split_payment_currency(
        joins.report_lines(
            _fx(r),
            [r["payments_v4"].select("INVOICE_ID", "NUM_PAGO", "IMPORTE_PAGO_USD", "TIPO_CAMBIO_PAGO", "MONEDA_PAGO")],
        )
    )
)
_relation("m11_currency_fx")(lambda r: _fx(r, "MONEDA", "TIPO_CAMBIO_FACTURA"))


@_relation("m12_net")
def _m12(r) -> DataFrame:
    classes = spec.CLASSES_BY_RATE_DETAIL
    taxes = agg.tax_pivot(r["tax_lines_v1"], classify.classify_by_rate_detail(), classes)
    rows = joins.merge_master(r["invoices_net"].select("INVOICE_ID", "TOTAL_FACTURA"), taxes)
    rows = ensure_money(rows, ["TOTAL_FACTURA", *classes])
    return rows.select("INVOICE_ID", "TOTAL_FACTURA", measures.net_payable().alias("net"))


@_relation("m13_historical")
def _m13(r) -> DataFrame:
    invoices = r["flow_invoices"].withColumns(
        {"day": dates.to_date("INVOICE_DATE"), "amount": or_zero(to_number("INVOICE_AMOUNT"))}
    )
    rated = joins.with_daily_rate(invoices, joins.one_rate_per_date(r["daily_rates"]), "day", "rate")
    return rated.select(
        "INVOICE_ID", "day", "rate", "amount",
        measures.historical_mxn("amount", "INVOICE_CURRENCY_CODE", "rate").alias("amount_mxn"),
        measures.rate_missing("INVOICE_CURRENCY_CODE", ("day", "rate")).alias("rate_missing"),
    )


_relation("m14_gross_retentions")(
    lambda r: _v4(r).select(
        "INVOICE_ID", money("IMPORTE").alias("gross"), row_sum(*measures.V4_RETENTIONS).alias("retentions")
    )
)

# ---- reports -----------------------------------------------------------------


def _master(r, variant: str, **options) -> DataFrame:
    return reports.report_master(
        variant, r["invoices_v1"], r["tax_lines_v1"], r["payments_v1"], r["requisitions"], **options
    )


def _schedule_payment(r, **options) -> DataFrame:
    return reports.report_schedule_payment(
        r["invoices_v2"], r["schedules"], r["payments_v4"].drop("DESCRIPTION", "FECHA_PAGO"), r["distributions"],
        r["taxes_v2"], r["prepay_ers"], **options,
    )


def _invoices_v4(r) -> DataFrame:
    return r["invoices_v2"].withColumnsRenamed({"INVOICE_AMOUNT": "IMPORTE", "ESTATUS": "ESTATUS_APROBACION"})


_relation("r1")(lambda r: _master(r, "rate"))
_relation("r2")(lambda r: _master(r, "code"))
_relation("r2_filled_rate")(lambda r: _master(r, "code", fill_rate=True))
_relation("r3")(lambda r: _master(r, "account", chart=r["chart_of_accounts"]))
_relation("r4")(lambda r: reports.report_net_payable(r["invoices_net"], r["tax_lines_v1"], r["requisitions"]))
_relation("r5")(lambda r: reports.report_historical_fx(r["flow_invoices"], r["flow_payments"], r["daily_rates"]))
_relation("r6")(_schedule_payment)
_relation("r7")(
    lambda r: reports.report_invoice_v4(
        _invoices_v4(r), r["taxes_v4"], r["withholding"], r["distributions"], r["payments_v4"], r["prepay_ers"]
    )
)


@_relation("r2_stored")
def _r2_stored(r) -> DataFrame:
    """r2 over relations stored co-partitioned by invoice; invoices with more than 40 rows in it count as hot."""
    names = {"invoices": "invoices_v1", "tax_lines": "tax_lines_v1", "payments": "payments_v1", "requisitions": "requisitions"}
    spark = r["invoices_v1"].sparkSession
    folder = scratch_folder(spark, "stored")
    storage.store({argument: r[name] for argument, name in names.items()}, folder, 8, hot_work=40)
    return storage.over_parts(partial(reports.report_master, "code"), storage.stored(spark, folder))


_relation("r6_rows")(
    lambda r: reports.report_schedule_payment(
        r["invoices_v2_few"], r["schedules"], r["payments_v4"].drop("DESCRIPTION", "FECHA_PAGO"), r["distributions"],
        r["taxes_v2"], r["prepay_ers_few"], lists="rows",
    )
)
_relation("r6_receipts")(lambda r: agg.receipt_values(r["prepay_ers_few"]))
_relation("r7_rows")(
    lambda r: reports.report_invoice_v4(
        _invoices_v4(r), r["taxes_v4"], r["withholding"], r["distributions"], r["payments_v4"], r["prepay_ers"],
        lists="rows",
    )
)
_relation("r7_lists")(lambda r: reports.invoice_lists(r["payments_v4"], r["prepay_ers"]))

# ---- profiles ----------------------------------------------------------------

_relation("q1_profile")(lambda r: profile.profile(r["invoices_v1"]))
_relation("q2_summary")(lambda r: profile.report_summary(_schedule_payment(r, keep_key=True, few_columns=True)))


def _landed_states(report: DataFrame, *wanted: Column) -> list[DataFrame]:
    """The states of parts of a report, each stored and read back. All rows of the report are stored for them, in the columns that
    they read."""
    spark, parts = report.sparkSession, []
    folder = scratch_folder(spark, "states")
    with shuffles_end_with_the_write(spark):
        sinks.write_report(report.select("INVOICE_ID", "PAYMENT_NUM", *summaries.READ), f"{folder}/report")
        for i, rows in enumerate(wanted):
            sinks.write_report(summaries.states(spark.read.parquet(f"{folder}/report").where(rows)), f"{folder}/{i}")
            parts.append(spark.read.parquet(f"{folder}/{i}"))
    return parts


@_relation("a8_merged")
def _a8_merged(r) -> DataFrame:
    """q2_summary from the states of two extracts, among which the payments of a schedule are dealt."""
    dealt = F.crc32(F.coalesce("NUM_PAGO", F.lit(""))) % 2
    return summaries.summary(summaries.merged(*_landed_states(_schedule_payment(r, keep_key=True, few_columns=True), dealt == 0, dealt == 1)))


@_relation("a8_corrected")
def _a8_corrected(r) -> DataFrame:
    """The summary after the schedules of some invoices have changed: only those invoices are reported again."""
    (before,) = _landed_states(_schedule_payment(r, keep_key=True, few_columns=True), F.lit(True))
    touched = changes.changes(r["schedules"], r["schedules_next"], ["INVOICE_ID"]).select("INVOICE_ID").distinct()
    again = {**r, "schedules": r["schedules_next"], "invoices_v2": r["invoices_v2"].join(touched, "INVOICE_ID", "left_semi")}
    (after,) = _landed_states(_schedule_payment(again, keep_key=True, few_columns=True), F.lit(True))
    return summaries.summary(summaries.corrected(before, after))


_relation("a8_days")(
    lambda r: summaries.by_day(summaries.states(_schedule_payment(r, keep_key=True, few_columns=True))).select(
        summaries.DAY, *summaries.MERGED_BY
    )
)


@_relation("q1_while_writing")
def _q1_while_writing(r) -> DataFrame:
    """The profile that a write takes along; its distinct counts are estimates, so they are not compared."""
    along = profile.WhileWriting(r["invoices_v1"])
    sinks.write_report(along.rows, scratch_folder(r["invoices_v1"].sparkSession, "profiled"))
    return along.profile().drop("distinct_count")


_relation("q3_prepayment")(lambda r: profile.prepayment_profile(r["prepay_ers"]))
_relation("q4_codes")(lambda r: profile.withholding_code_profile(r["taxes_v2"]))
_relation("q4_containing")(
    lambda r: profile.codes_containing(r["taxes_v2"]).select("INVOICE_ID", "TAX_TYPE_CODE", "IMPUESTO_MXN")
)
_relation("q7_unexpected")(lambda r: profile.unexpected_columns(r["invoices_v1"], list(spec.INVOICES_NET.columns)))
_relation("q5_width")(lambda r: profile.width_profile(r["invoices_v1"]))
