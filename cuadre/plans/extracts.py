"""Extract queries: relations of the report domain from ERP base tables.

Each function takes `t`, a mapping of base table name to DataFrame, and returns
one relation. Lookups that yield one value per invoice are an aggregate joined
back, never a correlated subquery. Bridges, where both sides repeat a key, are
reduced to distinct pairs before they join. Dimension sides carry no
broadcast hint: the optimizer broadcasts them when their size allows it and
otherwise shuffles, where AQE splits a hot key on the large side, or
join_lookup salts it where AQE cannot.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadre.functions.classify import classify_by_percentage
from cuadre.functions.numbers import MONEY, RATE, money, percentage
from cuadre.functions.text import account_string
from cuadre.operators.numbering import numbered
from cuadre.operators.skew import join_lookup
from cuadre.sources.files import scan_since

Tables = Mapping[str, DataFrame]

SINCE = dt.date(2025, 1, 1)
RATES_SINCE = dt.date(2024, 1, 1)
SEGMENTS = [f"SEGMENT{i}" for i in range(1, 10)]
EXPENSE = "5"


def null_text(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


# ---- invoice headers ---------------------------------------------------------


def invoices_v1(t: Tables, since: dt.date = SINCE, **skew) -> DataFrame:
    """Invoice with supplier, operating unit, receipt and two account strings."""
    tax_ids = t["POZ_SUPPLIERS_PII"].select("VENDOR_ID", F.col("INCOME_TAX_ID").alias("RFC"))
    parties = t["HZ_PARTIES"].select("PARTY_ID", F.col("PARTY_NAME").alias("PROVEEDOR"))
    suppliers = (
        t["POZ_SUPPLIERS"]
        .select("VENDOR_ID", "PARTY_ID", F.col("SEGMENT1").alias("NUM_PROV"))
        .join(parties, "PARTY_ID")
        .join(tax_ids, "VENDOR_ID", "left")
        .drop("PARTY_ID")
    )
    units = t["HR_OPERATING_UNITS"].select(
        F.col("ORGANIZATION_ID").alias("ORG_ID"), F.col("NAME").alias("EMPRESA")
    )
    liability = t["GL_CODE_COMBINATIONS"].select(
        F.col("CODE_COMBINATION_ID").alias("ACCTS_PAY_CODE_COMBINATION_ID"),
        account_string(SEGMENTS, "-").alias("CUENTA_BALANCE"),
    )
    invoices = scan_since(t["AP_INVOICES_ALL"], "CREATION_DATE", since).select(
        "INVOICE_ID", "VENDOR_ID", "ORG_ID", "ACCTS_PAY_CODE_COMBINATION_ID",
        F.col("INVOICE_NUM").alias("FACTURA"),
        F.col("SOURCE").alias("ORIGEN"),
        F.col("PAYMENT_STATUS_FLAG").alias("ESTATUS"),
        F.col("GLOBAL_ATTRIBUTE1").alias("UUID"),
        F.col("INVOICE_DATE").cast("date").alias("FECHA"),
        F.col("INVOICE_CURRENCY_CODE").alias("MONEDA"),
        "DESCRIPTION",
        F.col("INVOICE_AMOUNT").cast(MONEY).alias("IMPORTE"),
    )
    in_units = invoices.join(units, "ORG_ID")
    return (
        join_lookup(in_units, suppliers, "VENDOR_ID", ["INVOICE_ID"], "inner", counted=invoices, **skew)
        .join(liability, "ACCTS_PAY_CODE_COMBINATION_ID", "left")
        .join(first_receipt(t), "INVOICE_ID", "left")
        .join(expense_account(t, **skew), "INVOICE_ID", "left")
        .select(
            "INVOICE_ID", "EMPRESA", "NUM_PROV", "PROVEEDOR", "RFC", "FACTURA", "ERS", "ORIGEN", "ESTATUS",
            "UUID", "FECHA", "MONEDA", "DESCRIPTION", "IMPORTE", "CUENTA_BALANCE", "CUENTA_GASTO",
        )
    )


def first_receipt(t: Tables) -> DataFrame:
    """One receipt number per invoice, the least of its receipts."""
    received = (
        t["AP_INVOICE_DISTRIBUTIONS_ALL"]
        .where(F.col("RCV_TRANSACTION_ID").isNotNull())
        .select("INVOICE_ID", F.col("RCV_TRANSACTION_ID").alias("TRANSACTION_ID"))
    )
    receipts = (
        t["RCV_TRANSACTIONS"]
        .select("TRANSACTION_ID", "SHIPMENT_HEADER_ID")
        .join(t["RCV_SHIPMENT_HEADERS"].select("SHIPMENT_HEADER_ID", "RECEIPT_NUM"), "SHIPMENT_HEADER_ID")
    )
    return received.join(receipts, "TRANSACTION_ID").groupBy("INVOICE_ID").agg(F.min("RECEIPT_NUM").alias("ERS"))


def _located_accounts(t: Tables) -> DataFrame:
    """Distinct (PO line location, account, natural account) of the order side."""
    accounts = t["GL_CODE_COMBINATIONS"].select(
        "CODE_COMBINATION_ID", account_string(SEGMENTS, "-").alias("ACCOUNT"), "SEGMENT5"
    )
    return (
        t["PO_DISTRIBUTIONS_ALL"]
        .select(F.col("LINE_LOCATION_ID").alias("PO_LINE_LOCATION_ID"), "CODE_COMBINATION_ID")
        .distinct()
        .join(accounts, "CODE_COMBINATION_ID")
        .drop("CODE_COMBINATION_ID")
    )


def _located_lines(lines: DataFrame) -> DataFrame:
    """(invoice, PO line location) of the invoice lines that have an order."""
    return lines.where(F.col("PO_LINE_LOCATION_ID").isNotNull()).select("INVOICE_ID", "PO_LINE_LOCATION_ID")


def expense_account(t: Tables, **skew) -> DataFrame:
    """One account per invoice through its order lines; expense accounts first."""
    # one best account per location before the join: the least of the least is the least
    not_expense = ~F.coalesce(F.col("SEGMENT5").startswith(EXPENSE), F.lit(False))
    rank = F.struct(not_expense.alias("not_expense"), F.col("ACCOUNT").alias("account"))
    by_location = _located_accounts(t).groupBy("PO_LINE_LOCATION_ID").agg(F.min(rank).alias("_best"))
    lines = _located_lines(t["AP_INVOICE_LINES_ALL"])
    return (
        join_lookup(lines, by_location, "PO_LINE_LOCATION_ID", ["INVOICE_ID"], "inner", **skew)
        .groupBy("INVOICE_ID")
        .agg(F.min("_best")["account"].alias("CUENTA_GASTO"))
    )


def invoices_v2(t: Tables, since: dt.date = SINCE, **skew) -> DataFrame:
    """Invoice header per terms line, with supplier, unit and purchase order."""
    tax_ids = t["POZ_SUPPLIERS_PII"].select("VENDOR_ID", "INCOME_TAX_ID")
    suppliers = (
        t["POZ_SUPPLIERS_V"]
        .select(
            "VENDOR_ID",
            F.col("SEGMENT1").alias("NUM_PROV"),
            F.col("VENDOR_NAME").alias("PROVEEDOR"),
            "ORGANIZATION_TYPE_LOOKUP_CODE",
        )
        .join(tax_ids, "VENDOR_ID")
    )
    units = t["HR_ALL_ORGANIZATION_UNITS_F_VL"].select(
        F.col("ORGANIZATION_ID").alias("ORG_ID"), F.col("NAME").alias("EMPRESA")
    )
    terms = t["AP_TERMS_LINES"].select(F.col("TERM_ID").alias("TERMS_ID"), "DUE_DAYS")
    invoices = scan_since(t["AP_INVOICES_ALL"], "INVOICE_DATE", since).select(
        "INVOICE_ID",
        F.col("INVOICE_NUM").alias("FACTURA"),
        "VOUCHER_NUM",
        F.col("INVOICE_AMOUNT").cast(MONEY).alias("INVOICE_AMOUNT"),
        F.col("TOTAL_TAX_AMOUNT").cast(MONEY).alias("TOTAL_TAX_AMOUNT"),
        F.col("INVOICE_DATE").alias("FECHA"),
        "TERMS_DATE",
        F.col("INVOICE_CURRENCY_CODE").alias("MONEDA"),
        F.col("EXCHANGE_RATE").cast(RATE).alias("TIPO_CAMBIO_FACTURA"),
        "GLOBAL_ATTRIBUTE1",
        F.col("GLOBAL_ATTRIBUTE2").alias("UUID"),
        F.col("SOURCE").alias("ORIGEN"),
        F.col("APPROVAL_STATUS").alias("ESTATUS"),
        F.col("INVOICE_TYPE_LOOKUP_CODE").alias("TIPO"),
        "VENDOR_ID", "ORG_ID", "TERMS_ID",
    )
    in_units = invoices.join(units, "ORG_ID")
    return (
        join_lookup(in_units, suppliers, "VENDOR_ID", ["INVOICE_ID"], "inner", counted=invoices, **skew)
        # the order goes in before the terms lines multiply the rows
        .join(max_purchase_order(t), "INVOICE_ID", "left")
        .join(terms, "TERMS_ID")
        .select(
            *invoices.columns,
            "NUM_PROV", "PROVEEDOR", "ORGANIZATION_TYPE_LOOKUP_CODE", "EMPRESA", "INCOME_TAX_ID", "DUE_DAYS",
            "ORDEN_COMPRA", null_text("RFC"),
        )
    )


def max_purchase_order(t: Tables) -> DataFrame:
    """The greatest purchase order number behind each invoice's distributions."""
    ordered = (
        t["AP_INVOICE_DISTRIBUTIONS_ALL"]
        .where(F.col("PO_DISTRIBUTION_ID").isNotNull())
        .select("INVOICE_ID", "PO_DISTRIBUTION_ID")
    )
    numbers = (
        t["PO_DISTRIBUTIONS_ALL"]
        .select("PO_DISTRIBUTION_ID", "PO_HEADER_ID")
        .join(t["PO_HEADERS_ALL"].select("PO_HEADER_ID", "SEGMENT1"), "PO_HEADER_ID")
    )
    return (
        ordered.join(numbers, "PO_DISTRIBUTION_ID")
        .groupBy("INVOICE_ID")
        .agg(F.max("SEGMENT1").alias("ORDEN_COMPRA"))
    )


# ---- taxes and withholdings --------------------------------------------------


def tax_lines_v1(t: Tables, since: dt.date = SINCE) -> DataFrame:
    """Tax and withholding lines, a missing rate as 0."""
    lines = t["AP_INVOICE_LINES_ALL"]
    return (
        scan_since(lines, "CREATION_DATE", since)
        .where(F.col("LINE_TYPE_LOOKUP_CODE").isin("TAX", "AWT"))
        .select(
            "INVOICE_ID",
            F.coalesce(F.col("TAX_RATE"), F.lit(0)).cast(RATE).alias("TAX_RATE"),
            F.col("AMOUNT").cast(MONEY).alias("TAX_AMT"),
            F.col("LINE_TYPE_LOOKUP_CODE").alias("TIPO_LINEA"),
            F.col("TAX_RATE_CODE").alias("CODIGO_IMPUESTO"),
        )
    )


def taxes_v2(t: Tables, since: dt.date = SINCE) -> DataFrame:
    """Tax lines with an amount."""
    return (
        scan_since(t["ZX_LINES"], "CREATION_DATE", since)
        .where(F.col("TAX_AMT") != 0)
        .select(
            F.col("TRX_ID").alias("INVOICE_ID"),
            "TRX_LINE_NUMBER",
            "TAX_TYPE_CODE",
            F.col("TAX_AMT").cast(MONEY).alias("IMPUESTO_USD"),
            F.col("TAX_AMT_FUNCL_CURR").cast(MONEY).alias("IMPUESTO_MXN"),
            "TAX_CURRENCY_CODE",
            F.col("CURRENCY_CONVERSION_RATE").cast(RATE).alias("CURRENCY_CONVERSION_RATE"),
        )
    )


def withholding(t: Tables, since: dt.date = SINCE, **skew) -> DataFrame:
    """Withholding lines with the percentage of the invoice's item total and its class.

    Withholdings of invoices without item lines are left out.
    """
    lines = t["AP_INVOICE_DISTRIBUTIONS_ALL"]
    item_total = (
        lines.where(F.col("LINE_TYPE_LOOKUP_CODE") == "ITEM")
        .groupBy("INVOICE_ID")
        .agg(money(F.sum(F.col("AMOUNT").cast(MONEY))).alias("MONTO_BASE"))
    )
    invoices = t["AP_INVOICES_ALL"].select("INVOICE_ID", F.col("INVOICE_NUM").alias("FACTURA"))
    taxes = t["ZX_TAXES_B"].select(
        F.col("TAX_ID").alias("WITHHOLDING_TAX_CODE_ID"), F.col("TAX").alias("NOMBRE_IMPUESTO"), "TAX_REGIME_CODE"
    )
    held = (
        scan_since(lines, "CREATION_DATE", since)
        .where(F.col("LINE_TYPE_LOOKUP_CODE") == "AWT")
        .select(
            "INVOICE_ID",
            "DISTRIBUTION_LINE_NUMBER",
            F.col("AMOUNT").cast(MONEY).alias("RETENCION_USD"),
            F.col("BASE_AMOUNT").cast(MONEY).alias("RETENCION_MXN"),
            "WITHHOLDING_TAX_CODE_ID",
            F.col("ACCOUNTING_DATE").alias("FECHA_APLICACION"),
        )
    )
    return (
        join_lookup(
            held.join(taxes, "WITHHOLDING_TAX_CODE_ID", "left"),
            invoices.join(item_total, "INVOICE_ID"),
            "INVOICE_ID",
            spread=["DISTRIBUTION_LINE_NUMBER", "RETENCION_USD"],
            how="inner",
            counted=held,
            **skew,
        )
        .withColumn("PORCENTAJE_RETENCION", percentage("RETENCION_USD", "MONTO_BASE"))
        .withColumn("CLASIFICACION_RETENCION", classify_by_percentage())
        .select(
            "INVOICE_ID", "FACTURA", "DISTRIBUTION_LINE_NUMBER", "RETENCION_USD", "RETENCION_MXN",
            "WITHHOLDING_TAX_CODE_ID", "NOMBRE_IMPUESTO", "TAX_REGIME_CODE", "MONTO_BASE",
            "PORCENTAJE_RETENCION", "CLASIFICACION_RETENCION", "FECHA_APLICACION",
        )
    )


# ---- payments, schedules, prepayments ----------------------------------------


def payments_v1(t: Tables, cleared_only: bool = True, since: dt.date = SINCE) -> DataFrame:
    """Payments with their check.

    With `cleared_only` only cleared checks since a date and with currency and
    rate; without, every payment with the shorter column list.
    """
    checks = t["AP_CHECKS_ALL"]
    payments = t["AP_INVOICE_PAYMENTS_ALL"]
    if cleared_only:
        checks = checks.where(F.col("STATUS_LOOKUP_CODE") == "CLEARED")
        payments = scan_since(payments, "CREATION_DATE", since)
    joined = payments.select("INVOICE_ID", "CHECK_ID", "ACCOUNTING_DATE", "AMOUNT", "DISCOUNT_TAKEN").join(
        checks.select("CHECK_ID", "CHECK_NUMBER", "CHECK_DATE", "BANK_ACCOUNT_NAME", "CURRENCY_CODE", "EXCHANGE_RATE"),
        "CHECK_ID",
    )
    columns = [
        F.col("INVOICE_ID"),
        F.col("CHECK_NUMBER").alias("NUM_PAGO"),
        F.col("CHECK_DATE").cast("date").alias("FECHA_PAGO"),
        F.col("ACCOUNTING_DATE").cast("date").alias("FECHA_APLICACION"),
        F.col("BANK_ACCOUNT_NAME").alias("BANCO_CUENTA"),
        F.col("AMOUNT").cast(MONEY).alias("IMPORTE_PAGO"),
        F.col("DISCOUNT_TAKEN").cast(MONEY).alias("ADELANTO_APLICADO"),
    ]
    if cleared_only:
        columns += [F.col("CURRENCY_CODE").alias("MONEDA_PAGO"), F.col("EXCHANGE_RATE").cast(RATE).alias("TC_PAGO")]
    return joined.select(*columns)


def payments_v2(t: Tables, since: dt.date = SINCE) -> DataFrame:
    """Payments with base amount and rate."""
    payments = scan_since(t["AP_INVOICE_PAYMENTS_ALL"], "CREATION_DATE", since).select(
        "INVOICE_ID", "CHECK_ID",
        F.col("ACCOUNTING_DATE").alias("FECHA_APLICACION"),
        F.col("AMOUNT").cast(MONEY).alias("IMPORTE_PAGO_USD"),
        F.col("INVOICE_BASE_AMOUNT").cast(MONEY).alias("IMPORTE_PAGO_MXN"),
        F.col("EXCHANGE_RATE").cast(RATE).alias("TIPO_CAMBIO_PAGO"),
    )
    checks = t["AP_CHECKS_ALL"].select(
        "CHECK_ID",
        F.col("CHECK_NUMBER").alias("NUM_PAGO"),
        F.col("BANK_ACCOUNT_NAME").alias("BANCO_CUENTA"),
        F.col("CURRENCY_CODE").alias("MONEDA_PAGO"),
    )
    return payments.join(checks, "CHECK_ID").select(
        "INVOICE_ID", "CHECK_ID", "NUM_PAGO", "BANCO_CUENTA", "FECHA_APLICACION", "IMPORTE_PAGO_USD",
        "IMPORTE_PAGO_MXN", "TIPO_CAMBIO_PAGO", "MONEDA_PAGO",
    )


def schedules(t: Tables, since: dt.date = SINCE) -> DataFrame:
    """Payment schedules."""
    return scan_since(t["AP_PAYMENT_SCHEDULES_ALL"], "CREATION_DATE", since).select(
        "INVOICE_ID", "PAYMENT_NUM",
        F.col("DUE_DATE").alias("FECHA_VENCIMIENTO"),
        F.col("GROSS_AMOUNT").cast(MONEY).alias("IMPORTE_BRUTO_USD"),
        F.col("AMOUNT_REMAINING").cast(MONEY).alias("SALDO_USD"),
        "PAYMENT_PRIORITY",
    )


def prepay_ers(t: Tables, since: dt.date = SINCE) -> DataFrame:
    """Prepayment applications and received transactions as one tagged relation."""
    prepaid = t["AP_INVOICES_ALL"].select(
        F.col("INVOICE_ID").alias("PREPAY_INVOICE_ID"),
        F.col("INVOICE_AMOUNT").cast(MONEY).alias("ADELANTO_USD"),
        F.col("INVOICE_CURRENCY_CODE").alias("MONEDA"),
        F.col("EXCHANGE_RATE").cast(RATE).alias("TIPO_CAMBIO"),
    )
    prepayments = (
        scan_since(t["AP_PREPAY_HISTORY_ALL"], "CREATION_DATE", since)
        .select("INVOICE_ID", "PREPAY_INVOICE_ID", F.col("ACCOUNTING_DATE").alias("FECHA_APLICACION"))
        .join(prepaid, "PREPAY_INVOICE_ID", "left")
        .withColumn("TIPO_ORIGEN", F.lit("PREPAYMENT"))
    )
    orders = t["PO_HEADERS_ALL"].select("PO_HEADER_ID", F.col("SEGMENT1").alias("ORDEN_COMPRA"))
    receipts = (
        scan_since(t["RCV_TRANSACTIONS"], "CREATION_DATE", since)
        .where(F.col("TRANSACTION_TYPE") == "RECEIVE")
        .select(
            "PO_HEADER_ID",
            F.col("TRANSACTION_DATE").alias("FECHA_APLICACION"),
            F.col("SOURCE_TRANSACTION_NUM").alias("ERS"),
        )
        .join(orders, "PO_HEADER_ID", "left")
        .drop("PO_HEADER_ID")
        .withColumn("TIPO_ORIGEN", F.lit("ERS"))
    )
    # missing columns of either branch become NULLs of the other branch's type
    return prepayments.unionByName(receipts, allowMissingColumns=True).select(
        "INVOICE_ID", "PREPAY_INVOICE_ID", "ADELANTO_USD", "FECHA_APLICACION", "MONEDA", "TIPO_CAMBIO",
        "TIPO_ORIGEN", "ERS", "ORDEN_COMPRA",
    )


# ---- accounts, requisitions, rates -------------------------------------------


def distributions(t: Tables, since: dt.date = SINCE) -> DataFrame:
    """Distributions with their expense account in 5 segments."""
    accounts = t["GL_CODE_COMBINATIONS"].select(
        F.col("CODE_COMBINATION_ID").alias("DIST_CODE_COMBINATION_ID"),
        account_string(SEGMENTS[:5], ".").alias("CUENTA_CONTABLE_GASTO"),
        F.col("SEGMENT1").alias("CC_EMPRESA"),
        F.col("SEGMENT2").alias("CC_DEPARTAMENTO"),
        F.col("SEGMENT3").alias("CC_CUENTA"),
    )
    return (
        scan_since(t["AP_INVOICE_DISTRIBUTIONS_ALL"], "CREATION_DATE", since)
        .select(
            "INVOICE_ID", "DISTRIBUTION_LINE_NUMBER", "DESCRIPTION",
            F.col("AMOUNT").cast(MONEY).alias("IMPORTE_DISTRIBUCION_USD"),
            "DIST_CODE_COMBINATION_ID",
        )
        .join(accounts, "DIST_CODE_COMBINATION_ID", "left")
        .select(
            "INVOICE_ID", "DISTRIBUTION_LINE_NUMBER", "DESCRIPTION", "IMPORTE_DISTRIBUCION_USD",
            "DIST_CODE_COMBINATION_ID",
            # an unmatched account joins as empty segments, not as NULL
            F.coalesce("CUENTA_CONTABLE_GASTO", F.lit("....")).alias("CUENTA_CONTABLE_GASTO"),
            "CC_EMPRESA", "CC_DEPARTAMENTO", "CC_CUENTA",
        )
    )


def requisition_bridge(t: Tables) -> DataFrame:
    """Distinct (invoice, requisition) through the ordered item lines."""
    requisitions = (
        t["PO_LINE_LOCATIONS_ALL"]
        .select(F.col("LINE_LOCATION_ID"))
        .join(t["PO_DISTRIBUTIONS_ALL"].select("LINE_LOCATION_ID", "REQ_DISTRIBUTION_ID"), "LINE_LOCATION_ID")
        .select(
            F.col("LINE_LOCATION_ID").alias("PO_LINE_LOCATION_ID"),
            F.col("REQ_DISTRIBUTION_ID").alias("DISTRIBUTION_ID"),
        )
        .distinct()
        .join(t["POR_REQ_DISTRIBUTIONS_ALL"].select("DISTRIBUTION_ID", "REQUISITION_LINE_ID"), "DISTRIBUTION_ID")
        .join(
            t["POR_REQUISITION_LINES_ALL"].select("REQUISITION_LINE_ID", "REQUISITION_HEADER_ID"),
            "REQUISITION_LINE_ID",
        )
        .join(
            t["POR_REQUISITION_HEADERS_ALL"].select("REQUISITION_HEADER_ID", "REQUISITION_NUMBER"),
            "REQUISITION_HEADER_ID",
        )
        .select("PO_LINE_LOCATION_ID", "REQUISITION_NUMBER")
        .distinct()
    )
    items = t["AP_INVOICE_LINES_ALL"].where(F.col("LINE_TYPE_LOOKUP_CODE") == "ITEM")
    return (
        _located_lines(items)
        .distinct()
        .join(requisitions, "PO_LINE_LOCATION_ID")
        .select("INVOICE_ID", "REQUISITION_NUMBER")
        .distinct()
    )


def account_bridge(t: Tables, since: dt.date = SINCE) -> DataFrame:
    """Distinct (invoice, natural expense account) through the order lines."""
    expense = (
        _located_accounts(t)
        .where(F.col("SEGMENT5").startswith(EXPENSE))
        .select("PO_LINE_LOCATION_ID", F.col("SEGMENT5").alias("CUENTA_NUM"))
        .distinct()
    )
    return (
        _located_lines(scan_since(t["AP_INVOICE_LINES_ALL"], "CREATION_DATE", since))
        .distinct()
        .join(expense, "PO_LINE_LOCATION_ID")
        .select("INVOICE_ID", "CUENTA_NUM")
        .distinct()
    )


#: Fixed value: the value set that holds the natural accounts.
ACCOUNT_VALUE_SET = "Cuenta CORPORATIVO"


def chart_of_accounts(t: Tables, value_set: str = ACCOUNT_VALUE_SET, language: str = "E") -> DataFrame:
    """Enabled accounts of one value set with their description in one language."""
    sets = t["FND_FLEX_VALUE_SETS"].where(F.col("FLEX_VALUE_SET_NAME") == value_set).select("FLEX_VALUE_SET_ID")
    values = t["FND_FLEX_VALUES"].where(F.col("ENABLED_FLAG") == "Y")
    texts = t["FND_FLEX_VALUES_TL"].where(F.col("LANGUAGE") == language).select("FLEX_VALUE_ID", "DESCRIPTION")
    return (
        values.join(sets, "FLEX_VALUE_SET_ID")
        .join(texts, "FLEX_VALUE_ID")
        .select(F.col("FLEX_VALUE").alias("CUENTA_NUM"), F.col("DESCRIPTION").alias("CUENTA_DESCRIPCION"))
    )


def daily_rates(
    t: Tables,
    from_: str = "USD",
    to: str = "MXN",
    type_: str = "Corporate",
    since: dt.date = RATES_SINCE,
) -> DataFrame:
    """Daily rates of one currency pair and type."""
    return (
        scan_since(t["GL_DAILY_RATES"], "CONVERSION_DATE", since)
        .where(
            (F.col("FROM_CURRENCY") == from_) & (F.col("TO_CURRENCY") == to) & (F.col("CONVERSION_TYPE") == type_)
        )
        .select(
            F.col("CONVERSION_DATE").cast("date").alias("FECHA_TASA"),
            "FROM_CURRENCY", "TO_CURRENCY",
            F.col("CONVERSION_RATE").cast(RATE).alias("CONVERSION_RATE"),
        )
    )


# Order of each extract when it leaves as a file: column, descending. The
# source database puts NULL last ascending and first descending.
EXTRACT_ORDER = {
    "invoices_v2": [("FECHA", True)],
    "taxes_v2": [("INVOICE_ID", False), ("TRX_LINE_NUMBER", False)],
    "payments_v2": [("INVOICE_ID", False), ("FECHA_APLICACION", True)],
    "schedules": [("INVOICE_ID", False), ("PAYMENT_NUM", False)],
    "distributions": [("INVOICE_ID", False), ("DISTRIBUTION_LINE_NUMBER", False)],
    "prepay_ers": [("TIPO_ORIGEN", False), ("FECHA_APLICACION", True)],
    "withholding": [("INVOICE_ID", False), ("DISTRIBUTION_LINE_NUMBER", False)],
    "daily_rates": [("FECHA_TASA", True)],
    "chart_of_accounts": [("CUENTA_NUM", False)],
}


def _order(relation: str) -> list[Column]:
    return [
        F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_last()
        for c, descending in EXTRACT_ORDER[relation]
    ]


def in_extract_order(df: DataFrame, relation: str) -> DataFrame:
    """Sort a relation as its extract is written; only worth it at a sink."""
    return df.orderBy(*_order(relation))


def with_positions(df: DataFrame, relation: str, folder: str) -> DataFrame:
    """A relation with POSITION, its row's place in the extract from 1 on; ties stand by all their columns.

    Rows are numbered over range partitions (`numbering`), which are written to `folder`, a new one that executors share.
    """
    ties = [F.col(c).asc_nulls_first() for c in df.columns if c not in dict(EXTRACT_ORDER[relation])]
    placed = numbered(df, [*_order(relation), *ties], folder, position="POSITION")
    return placed.withColumn("POSITION", F.col("POSITION") + 1)


# Relation -> the query that extracts it from base tables, with the earliest date it takes where it is bounded.
EXTRACTS = {
    "invoices_v1": invoices_v1,
    "invoices_v2": invoices_v2,
    "tax_lines_v1": tax_lines_v1,
    "taxes_v2": taxes_v2,
    "withholding": withholding,
    "payments_v1": payments_v1,
    "payments_v2": payments_v2,
    "schedules": schedules,
    "prepay_ers": prepay_ers,
    "distributions": distributions,
    "requisitions": requisition_bridge,
    "invoice_accounts": account_bridge,
    "chart_of_accounts": chart_of_accounts,
    "daily_rates": daily_rates,
}
UNBOUNDED = {"requisitions", "chart_of_accounts"}


def extract(t: Tables, relation: str, since: dt.date | None = None) -> DataFrame:
    """One relation from base tables; `since` replaces the extract's own earliest date."""
    if since is None or relation in UNBOUNDED:
        return EXTRACTS[relation](t)
    return EXTRACTS[relation](t, since=since)
