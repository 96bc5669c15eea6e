"""Joins of the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadre.functions.text import segment
from cuadre.operators.aggregates import first_row
from cuadre.operators.columns import left_join
from cuadre.operators.skew import fan_out, join_lookup
from cuadre.session import expect_long_cells

NO_DESCRIPTION = "DESC NO ENCONTRADA"


#: Columns that tell the rows of an invoice in a side apart; those present spread a hot invoice.
IDENTITY = ("NUM_PAGO", "FECHA_APLICACION", "REQUISITION_NUMBER", "PAYMENT_NUM", "ACCOUNTING_DATE", "AMOUNT")


def identity(side: DataFrame) -> list[str]:
    """The columns of IDENTITY that `side` has, else all: a narrow hash, so that the others can be pruned."""
    return [c for c in IDENTITY if c in side.columns] or side.columns


def report_lines(invoices: DataFrame, sides: list[DataFrame], **skew) -> DataFrame:
    """invoice × side × side rows; invoices without side rows stay."""
    return fan_out(invoices, sides, "INVOICE_ID", spread=[identity(s) for s in sides], **skew)


def merge_schedule_payment(
    invoices: DataFrame, schedules: DataFrame, payments: DataFrame, flat: list[DataFrame] = (), **skew
) -> DataFrame:
    """invoice × schedule × payment rows; clashing payment columns get _PAY. `flat` is that of fan_out."""
    of_invoice = {c for part in (invoices, *flat) for c in part.columns}
    payments = payments.withColumnsRenamed(
        {c: f"{c}_PAY" for c in payments.columns if c in schedules.columns and c != "INVOICE_ID"}
    )
    schedules = schedules.withColumnsRenamed(
        {c: f"{c}_SCHED" for c in schedules.columns if c in of_invoice and c != "INVOICE_ID"}
    )
    sides = [schedules, payments]
    return fan_out(invoices, sides, "INVOICE_ID", clash="_PAY", spread=[identity(s) for s in sides], flat=flat, **skew)


def left_join_first(left: DataFrame, right: DataFrame, on: str, order: list[Column]) -> DataFrame:
    """Left join to the first right row of each key by a total order."""
    return left_join(left, first_row(right, on, order), on)


def first_payment_order() -> list[Column]:
    """By payment date, number and amount, then what is left, missing last."""
    columns = ("FECHA_PAGO", "NUM_PAGO", "IMPORTE_PAGO", "FECHA_APLICACION", "BANCO_CUENTA", "MONEDA_PAGO",
               "TC_PAGO", "ADELANTO_APLICADO")
    return [F.col(c).asc_nulls_last() for c in columns]


def merge_master(
    invoices: DataFrame, *sides: DataFrame, on: str = "INVOICE_ID", clash: str = "left"
) -> DataFrame:
    """Left joins to sides with one row per key; the row count stays."""
    for side in sides:
        invoices = left_join(invoices, side, on, clash)
    return invoices


def with_account_description(invoices: DataFrame, chart: DataFrame, account: str = "CUENTA_GASTO") -> DataFrame:
    """CUENTA_GASTO_FULL: natural account and its description.

    Value sets may repeat an account; it counts with its least description, so
    an invoice stays one row. The chart is left to the optimizer: broadcast when
    its size allows, else a shuffle join.
    """
    keyed = invoices.withColumn("CTA_NUM", segment(account, 5))
    names = chart.groupBy(F.col("CUENTA_NUM").alias("CTA_NUM")).agg(
        F.min("CUENTA_DESCRIPCION").alias("CUENTA_DESCRIPCION")
    )
    text = F.coalesce(F.col("CUENTA_DESCRIPCION"), F.lit(NO_DESCRIPTION))
    return keyed.join(names, "CTA_NUM", "left").withColumn(
        "CUENTA_GASTO_FULL", F.concat("CTA_NUM", F.lit(" - "), text)
    )


def with_receipts(invoices: DataFrame, receipts: DataFrame, **skew) -> DataFrame:
    """Receipt list of the invoice's purchase order; orders may be hot or NULL.

    A hot order's list grows with its receipts and is copied to each of its invoices, so the session is told to expect long cells.
    """
    expect_long_cells(invoices.sparkSession)
    return join_lookup(invoices, receipts, "ORDEN_COMPRA", spread=["INVOICE_ID"], **skew)


def one_rate_per_date(rates: DataFrame, from_: str = "USD", to: str = "MXN") -> DataFrame:
    """(FECHA_TASA, CONVERSION_RATE) of one currency pair, the highest of a day."""
    return (
        rates.where((F.col("FROM_CURRENCY") == from_) & (F.col("TO_CURRENCY") == to))
        .groupBy("FECHA_TASA")
        .agg(F.max("CONVERSION_RATE").alias("CONVERSION_RATE"))
    )


def with_daily_rate(df: DataFrame, rates: DataFrame, date_col: str, out: str) -> DataFrame:
    """The rate of the very day in `date_col` as `out`, NULL when there is none.

    `rates` has one row per calendar day, so its size is bounded by the calendar
    and it is broadcast.
    """
    by_day = rates.select(F.col("FECHA_TASA").alias(date_col), F.col("CONVERSION_RATE").alias(out))
    return df.join(F.broadcast(by_day), date_col, "left")
