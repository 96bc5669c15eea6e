"""The audit reports, end to end, from relations to their final layout.

Each is one lazy plan. Sides with one row per invoice are joined first, while
there is one row per invoice; the sides that multiply rows come last and are
shuffled together once. All joins on INVOICE_ID then share a partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadre.functions import classify, dates, measures, text
from cuadre.functions.numbers import MONEY, money, or_zero, rate_or_one, row_sum, to_number
from cuadre.operators import aggregates as agg
from cuadre.operators import joins
from cuadre.operators.columns import (
    ensure_money,
    left_join,
    reindex,
    select_ordered,
    select_present,
)
from cuadre.sources import spec
from cuadre.sources.spec import INT

HEADER_AMOUNTS = ["IMPORTE", "IVA", "RET_IVA", "RET_ISR", "RET_ISR_4"]
PAYMENT_AMOUNTS = ["IMPORTE_PAGO", "ADELANTO_APLICADO"]
MXN_AMOUNTS = ["SUBTOTAL", "IVA", "IMPORTE", "SALDO", "IMPORTE_PAGO", "ADELANTO_APLICADO"]


def report_master(
    variant: str,
    invoices: DataFrame,
    tax_lines: DataFrame,
    payments: DataFrame,
    requisitions: DataFrame,
    chart: DataFrame | None = None,
    fill_rate: bool = False,
    **skew,
) -> DataFrame:
    """Master audit report.

    "rate": taxes classed by rate and sign, invoice × payment × requisition.
    "code": taxes classed by code, retentions in the subtotal, same rows.
    "account": as "code" with the account text, one payment and one requisition
    per invoice, and Spanish month names. `chart` belongs to this one; without it
    the account is shown as it is.
    `fill_rate` reports a missing payment rate as 1.
    """
    invoices = _payment_flag(invoices)
    if variant == "rate":
        return _master_by_rate(invoices, tax_lines, payments, requisitions, **skew)
    if variant == "code":
        return _master_by_code(invoices, tax_lines, payments, requisitions, fill_rate, **skew)
    if variant == "account":
        return _master_by_account(invoices, tax_lines, payments, requisitions, chart)
    raise ValueError(f"unknown variant {variant!r}")


def _tax_id(invoices: DataFrame) -> DataFrame:
    """RFC, from INCOME_TAX_ID where it is missing."""
    if "INCOME_TAX_ID" not in invoices.columns:
        return invoices
    rfc = F.col("RFC") if "RFC" in invoices.columns else F.lit(None)
    return invoices.withColumn("RFC", F.coalesce(rfc, "INCOME_TAX_ID")).drop("INCOME_TAX_ID")


def _payment_flag(invoices: DataFrame) -> DataFrame:
    """The payment flag under one name, NULL when the extract has none."""
    if "ESTATUS_PAGO" in invoices.columns:
        return invoices
    if "ESTATUS" in invoices.columns:
        return invoices.withColumnRenamed("ESTATUS", "ESTATUS_PAGO")
    return invoices.withColumn("ESTATUS_PAGO", F.lit(None).cast("string"))


def _master_by_rate(invoices, tax_lines, payments, requisitions, **skew) -> DataFrame:
    taxes = agg.tax_pivot(tax_lines, classify.classify_by_rate(), spec.CLASSES_BY_RATE)
    headers = joins.merge_master(invoices, taxes)

    def header(rows: DataFrame) -> DataFrame:
        return rows.withColumn("IVA", or_zero("IVA")).withColumn("SUBTOTAL", measures.subtotal("vat"))

    def amounts(paid: DataFrame) -> DataFrame:
        paid = paid.withColumn("SALDO", measures.balance("paid"))
        return measures.to_mxn(paid, MXN_AMOUNTS, rate_or_one("TC_PAGO", zero_is_one=False))

    return _master_rows(headers, payments, requisitions, header, amounts, **skew)


def _master_rows(headers, payments, requisitions, header, amounts, **skew) -> DataFrame:
    """The invoice × payment × requisition rows of the master report.

    Every expression is evaluated at its own grain and behind the shuffle: header columns per invoice,
    payment periods per payment, amounts per invoice and payment.
    """

    def with_header(rows: DataFrame) -> DataFrame:
        rows = measures.with_periods(header(rows), "english", {"FECHA": ""})
        return rows.withColumn("ESTATUS", text.payment_status("ESTATUS_PAGO"))

    def with_payment_periods(paid: DataFrame) -> DataFrame:
        return measures.with_periods(paid, "english", {"FECHA_PAGO": "_PAGO"})

    sides, derived = [payments, requisitions], [with_header, with_payment_periods]
    rows = joins.report_lines(headers, sides, after=[amounts], derived=derived, **skew)
    return reindex(rows, spec.MASTER_COLUMNS)


def _master_by_code(invoices, tax_lines, payments, requisitions, fill_rate, **skew) -> DataFrame:
    taxes = agg.tax_pivot(tax_lines, classify.classify_by_code(), spec.CLASSES_BY_CODE)
    headers = joins.merge_master(invoices, taxes)

    def header(rows: DataFrame) -> DataFrame:
        return ensure_money(rows, HEADER_AMOUNTS).withColumn("SUBTOTAL", measures.subtotal("vat_ret"))

    def amounts(paid: DataFrame) -> DataFrame:
        paid = ensure_money(paid, PAYMENT_AMOUNTS, ["TC_PAGO"] if fill_rate else [])
        paid = paid.withColumn("SALDO", measures.balance("paid"))
        return measures.to_mxn(paid, MXN_AMOUNTS, rate_or_one("TC_PAGO"))

    return _master_rows(headers, payments, requisitions, header, amounts, **skew)


def _master_by_account(invoices, tax_lines, payments, requisitions, chart) -> DataFrame:
    if chart is not None:
        invoices = joins.with_account_description(invoices, chart)
    else:
        invoices = invoices.withColumn("CUENTA_GASTO_FULL", F.col("CUENTA_GASTO"))
    category = classify.classify_by_code(default="OTROS")
    taxes = agg.tax_pivot(tax_lines, category, spec.CLASSES_BY_CODE[:-1])
    rows = joins.merge_master(invoices, taxes)
    rows = joins.left_join_first(rows, payments, "INVOICE_ID", joins.first_payment_order())
    # the least requisition number is the first row of a two-column bridge
    first_requisition = requisitions.groupBy("INVOICE_ID").agg(
        F.min("REQUISITION_NUMBER").alias("REQUISITION_NUMBER")
    )
    rows = left_join(rows, first_requisition, "INVOICE_ID")
    rows = ensure_money(rows, HEADER_AMOUNTS + PAYMENT_AMOUNTS)
    rows = rows.withColumns({"SUBTOTAL": measures.subtotal("vat_ret"), "SALDO": measures.balance("paid")})
    rows = measures.to_mxn(rows, MXN_AMOUNTS, rate_or_one("TC_PAGO"), suffix="_MXN")
    rows = measures.with_periods(rows, "spanish")
    if "ESTATUS_APROBACION" in rows.columns:
        rows = rows.withColumn("ESTATUS_APROBACION", text.approval_2way("ESTATUS_APROBACION"))
    rows = rows.withColumn("ESTATUS", text.payment_status("ESTATUS_PAGO"))
    rows = rows.drop("CUENTA_GASTO").withColumnRenamed("CUENTA_GASTO_FULL", "CUENTA_GASTO")
    return reindex(rows, spec.ACCOUNT_MASTER_COLUMNS)


def report_net_payable(invoices: DataFrame, tax_lines: DataFrame, requisitions: DataFrame, **skew) -> DataFrame:
    """Net amount to pay after retentions, with the UUID check."""
    classes = spec.CLASSES_BY_RATE_DETAIL
    taxes = agg.tax_pivot(tax_lines, classify.classify_by_rate_detail(), classes)
    one_per_invoice = ensure_money(joins.merge_master(invoices, taxes), ["TOTAL_FACTURA", *classes])
    one_per_invoice = one_per_invoice.withColumn("NETO_A_PAGAR", measures.net_payable())
    if "ESTATUS_PAGO" in invoices.columns:
        status = text.payment_status("ESTATUS_PAGO", default="DESCONOCIDO")
        one_per_invoice = one_per_invoice.withColumn("ESTATUS_PAGO", status)
    if "UUID" in invoices.columns:
        one_per_invoice = one_per_invoice.withColumn("VALIDACION_UUID", text.uuid_check("UUID"))
    rows = joins.report_lines(one_per_invoice, [requisitions], **skew)
    return select_present(rows, spec.NET_PAYABLE_COLUMNS)


def report_historical_fx(invoices: DataFrame, payments: DataFrame, rates: DataFrame, **skew) -> DataFrame:
    """Invoices with payments, both in MXN at the rate of their own day."""
    daily = joins.one_rate_per_date(rates)
    invoices = invoices.withColumns(
        {
            "_invoice_day": dates.to_date("INVOICE_DATE"),
            "INVOICE_AMOUNT": F.coalesce(to_number("INVOICE_AMOUNT"), F.lit(0).cast(MONEY)),
        }
    )
    invoices = joins.with_daily_rate(invoices, daily, "_invoice_day", "TASA_FECHA_FACTURA")
    invoices = invoices.withColumn(
        "IMPORTE_FACTURA_MXN",
        measures.historical_mxn("INVOICE_AMOUNT", "INVOICE_CURRENCY_CODE", "TASA_FECHA_FACTURA"),
    )
    payments = payments.withColumns(
        {"_payment_day": dates.to_date("ACCOUNTING_DATE"), "AMOUNT": to_number("AMOUNT")}
    )
    payments = joins.with_daily_rate(payments, daily, "_payment_day", "TASA_FECHA_PAGO")
    rows = joins.report_lines(invoices, [payments], clash="_PAGO", **skew)
    rows = rows.withColumn("AMOUNT", or_zero("AMOUNT"))
    rows = rows.withColumns(
        {
            "IMPORTE_PAGO_MXN": measures.historical_mxn("AMOUNT", "INVOICE_CURRENCY_CODE", "TASA_FECHA_PAGO"),
            "RATE_MISSING": measures.rate_missing(
                "INVOICE_CURRENCY_CODE",
                ("_invoice_day", "TASA_FECHA_FACTURA"),
                ("_payment_day", "TASA_FECHA_PAGO"),
            ),
        }
    ).drop("_invoice_day", "_payment_day")
    added = ["TASA_FECHA_FACTURA", "TASA_FECHA_PAGO", "IMPORTE_FACTURA_MXN", "IMPORTE_PAGO_MXN", "RATE_MISSING"]
    return select_ordered(rows, [c for c in rows.columns if c not in added] + added)


def report_schedule_payment(
    invoices: DataFrame,
    schedules: DataFrame,
    payments: DataFrame,
    distributions: DataFrame,
    taxes: DataFrame,
    prepay_ers: DataFrame,
    keep_key: bool = False,
    lists: str = "cell",
    few_columns: bool = False,
    **skew,
) -> DataFrame:
    """Invoice × schedule × payment report with amounts split into USD and MXN.

    `lists` "cell" puts the receipts of the invoice's order into one text cell of
    each row. With "rows" the report has ORDEN_COMPRA in that place, and
    `aggregates.receipt_values` gives the receipts of each order as rows: for
    orders with many receipts, whose cell would be copied to many rows.
    `keep_key` leaves INVOICE_ID and PAYMENT_NUM in front, as the summary needs them.
    Sums and accounts of an invoice ride with its schedules through their shuffle, so that headers are shuffled once. For a
    reader of `few_columns` they join the headers beforehand: the optimizer leaves out such a join when nobody asks for it.
    """
    _known_lists(lists)
    type_code = "_type"
    if "TIPO_IMPUESTO" in taxes.columns:
        taxes = taxes.withColumn(type_code, F.coalesce("TIPO_IMPUESTO", "TAX_TYPE_CODE"))
    else:
        taxes = taxes.withColumn(type_code, F.col("TAX_TYPE_CODE"))
    tax_columns = agg.tax_pivot(
        taxes, classify.classify_by_type(type_code), spec.CLASSES_BY_TYPE, "IMPUESTO_MXN", "_MXN", narrow=True
    )
    core = _tax_id(invoices.drop("ERS"))
    accounts = agg.agg_distributions(distributions, amount="IMPORTE_DISTRIBUCION_USD" in spec.SCHEDULE_PAYMENT_COLUMNS)
    one_row = [accounts, tax_columns, agg.prepaid_amounts(prepay_ers)]
    if few_columns:
        core, one_row = joins.merge_master(core, *one_row), []
    if lists == "cell":
        # receipt lists can be long, so they join as late as there is one row per invoice
        core = joins.with_receipts(core, agg.receipt_lists(prepay_ers), counted=invoices, **skew)
    layout = spec.SCHEDULE_PAYMENT_COLUMNS
    if lists == "rows":
        layout = ["ORDEN_COMPRA" if c == "ERS" else c for c in layout]
    wanted = {*layout, "INVOICE_ID", "CURRENCY", "FX_RATE", "ADELANTO_USD"}
    # a narrow core is what gets shuffled
    inputs = {*measures.CURRENCIES, *measures.RATES, "INVOICE_AMOUNT", "TOTAL_TAX_AMOUNT", "FECHA", "ESTATUS"}
    core = core.select(*[c for c in core.columns if c in wanted | inputs])
    one_row = [part.select(*[c for c in part.columns if c in wanted]) for part in one_row]

    def header(rows: DataFrame) -> DataFrame:
        given = [c for c in rows.columns if c not in core.columns]
        rows = measures.with_currency_fx(rows)
        rows = rows.withColumns(
            {"SUBTOTAL_ORIGINAL": measures.subtotal("header"), "ESTATUS": text.approval_3way("ESTATUS")}
        )
        rows = measures.split_currency(
            rows, F.col("SUBTOTAL_ORIGINAL"), "SUBTOTAL_USD", "SUBTOTAL_MXN", other="as_usd"
        )
        rows = measures.with_periods(rows, "year_month", {"FECHA": ""})
        # amounts of the sides come from the sides
        return rows.select(*[c for c in rows.columns if c in wanted or c in given])

    schedules = select_present(schedules, ["INVOICE_ID", "PAYMENT_NUM", "IMPORTE_BRUTO_USD", "SALDO_USD"])
    payments = select_present(
        payments,
        ["INVOICE_ID", "NUM_PAGO", "BANCO_CUENTA", "FECHA_APLICACION", "IMPORTE_PAGO_USD", "TIPO_CAMBIO_PAGO",
         "MONEDA_PAGO"],
    )

    def with_payment_periods(paid: DataFrame) -> DataFrame:
        return measures.with_periods(
            paid.withColumn("FECHA_PAGO", F.col("FECHA_APLICACION")), "year_month", {"FECHA_PAGO": "_PAGO"}
        )

    def due(scheduled: DataFrame) -> DataFrame:
        for original, in_mxn in (
            ("ADELANTO_USD", "ADELANTO_MXN"), ("IMPORTE_BRUTO_USD", "IMPORTE_MXN"), ("SALDO_USD", "SALDO_MXN_CALC")
        ):
            scheduled = measures.split_currency(scheduled, F.col(original), original, in_mxn, other="zero")
        return scheduled

    rows = joins.merge_schedule_payment(
        core, schedules, payments, after=[due, measures.split_payment_currency],
        derived=[header, None, with_payment_periods], flat=one_row, **skew,
    )
    key = {"INVOICE_ID": INT, "PAYMENT_NUM": INT} if keep_key else {}
    return reindex(rows, [*key, *layout], key)


def report_invoice_v4(
    invoices: DataFrame,
    taxes: DataFrame,
    withholding: DataFrame,
    distributions: DataFrame,
    payments: DataFrame,
    prepay_ers: DataFrame,
    include_iva_6: bool = False,
    lists: str = "cell",
    salted: bool = True,
) -> DataFrame:
    """One row per invoice with withholdings by percentage class.

    `lists` "cell" puts payments, banks, receipts and advances of an invoice into text cells. With "rows"
    the report has INVOICE_ID in front instead, and `invoice_lists` gives their values as rows. No join of
    it multiplies rows, so `salted` changes nothing; all reports take it.
    """
    _known_lists(lists)
    in_cells = lists == "cell"
    core = _tax_id(invoices)
    principal = agg.principal_distribution(distributions)
    if in_cells:
        known = [*core.columns, *principal.columns]
        amounts, *texts = agg.invoice_amounts_and_lists(taxes, withholding, payments, prepay_ers, known)
    else:
        amounts, texts = agg.invoice_amounts(taxes, withholding, payments, prepay_ers), []
    rows = joins.merge_master(core, amounts, principal, *texts)
    rows = rows.withColumns(
        {
            "SUBTOTAL": measures.subtotal("v4", include_iva_6),
            "SALDO": measures.balance("paid_prepaid"),
            "IMPORTE_BRUTO": money("IMPORTE"),
            "TOTAL_RETENCIONES": row_sum(*measures.v4_retentions(include_iva_6)),
        }
    )
    rows = measures.with_periods(rows, "number")
    key = [] if in_cells else ["INVOICE_ID"]
    rows = rows.drop(*[c for c in spec.INVOICE_V4_DROPPED if c not in key])
    return select_ordered(rows, [*key, *spec.INVOICE_V4_COLUMNS]).withColumnsRenamed(spec.INVOICE_V4_RENAMES)


def invoice_lists(payments: DataFrame, prepay_ers: DataFrame) -> DataFrame:
    """The lists of report_invoice_v4 as rows: INVOICE_ID, list, value and its first place."""
    return agg.payment_values(payments).unionByName(agg.prepayment_values(prepay_ers))


def _known_lists(lists: str) -> None:
    if lists not in ("cell", "rows"):
        raise ValueError(f"lists must be 'cell' or 'rows', not {lists!r}")
