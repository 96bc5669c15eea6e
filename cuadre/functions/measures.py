"""Derived amounts and periods. Each function adds columns to a DataFrame.

Retentions arrive as negative amounts, so subtracting them from a total adds
them back to the subtotal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadre.functions import dates
from cuadre.functions.numbers import RATE, money, or_zero, rate_or_one, row_sum, to_number

#: Columns that may hold an invoice's currency and its rate, the first ones first.
CURRENCIES = ("MONEDA", "INVOICE_CURRENCY_CODE", "CURRENCY_CODE")
RATES = ("EXCHANGE_RATE", "TIPO_CAMBIO_FACTURA", "TIPO_CAMBIO", "CURRENCY_CONVERSION_RATE")
V4_RETENTIONS = ("RET_ISR_4_USD", "RET_ISR_125_USD", "RET_ISR_10_USD", "RET_IVA_USD", "RET_OTRO_USD")


def subtotal(mode: str, include_iva_6: bool = False) -> Column:
    """SUBTOTAL of an invoice row.

    "vat": total less VAT; "vat_ret": less VAT and the retentions;
    "v4": the same over the *_USD columns, the 6% retention only on request;
    "header": invoice amount less the header's tax total.
    """
    if mode == "vat":
        return money(F.col("IMPORTE") - or_zero("IVA"))
    if mode == "vat_ret":
        return money(or_zero("IMPORTE") - row_sum("IVA", "RET_IVA", "RET_ISR", "RET_ISR_4"))
    if mode == "v4":
        return money(or_zero("IMPORTE") - or_zero("IVA_USD") - row_sum(*v4_retentions(include_iva_6)))
    if mode == "header":
        return money(or_zero("INVOICE_AMOUNT") - or_zero("TOTAL_TAX_AMOUNT"))
    raise ValueError(f"unknown subtotal mode {mode!r}")


def v4_retentions(include_iva_6: bool = False) -> list[str]:
    return [*V4_RETENTIONS, *(["RET_IVA_6_USD"] if include_iva_6 else [])]


def balance(mode: str) -> Column:
    """SALDO: total less payments ("paid"), and less prepayments ("paid_prepaid")."""
    if mode == "paid":
        return money(F.col("IMPORTE") - or_zero("IMPORTE_PAGO"))
    if mode == "paid_prepaid":
        return money(or_zero("IMPORTE") - row_sum("IMPORTE_PAGO_USD", "ADELANTO_USD"))
    raise ValueError(f"unknown balance mode {mode!r}")


def to_mxn(df: DataFrame, columns: list[str], rate: Column, suffix: str = " MXN") -> DataFrame:
    """`<column><suffix>` = column times the rate."""
    return df.withColumns({f"{c}{suffix}": money(F.col(c) * rate) for c in columns})


def with_currency_fx(
    df: DataFrame,
    currencies: tuple[str, ...] = CURRENCIES,
    rates: tuple[str, ...] = RATES,
) -> DataFrame:
    """CURRENCY (upper case, MXN when missing) and FX_RATE (1 when missing).

    The currency is the first candidate column that exists; the rate is the
    first candidate that has a value in the row.
    """
    currency = next((F.col(c) for c in currencies if c in df.columns), F.lit(None).cast("string"))
    found = [to_number(c, RATE) for c in rates if c in df.columns]
    return df.withColumns(
        {
            "CURRENCY": F.upper(F.coalesce(currency, F.lit("MXN"))),
            "FX_RATE": F.coalesce(*found, F.lit(1).cast(RATE)),
        }
    )


def split_currency(
    df: DataFrame,
    original: Column,
    usd: str,
    mxn: str,
    other: str,
    currency: str = "CURRENCY",
    fx: str = "FX_RATE",
) -> DataFrame:
    """An amount in its own currency as a USD and an MXN column.

    MXN amounts leave USD at 0. Currencies beside USD and MXN count as USD with
    other="as_usd" and as nothing with other="zero".
    """
    if other not in ("as_usd", "zero"):
        raise ValueError(f"other must be 'as_usd' or 'zero', not {other!r}")
    code = F.upper(F.col(currency))
    amount = or_zero(original)
    foreign = (code != "MXN") if other == "as_usd" else (code == "USD")
    return df.withColumns(
        {
            usd: money(F.when(foreign, amount).otherwise(0)),
            mxn: money(
                F.when(code == "MXN", amount)
                .when(foreign, amount * F.coalesce(F.col(fx), F.lit(1).cast(RATE)))
                .otherwise(0)
            ),
        }
    )


def split_payment_currency(df: DataFrame) -> DataFrame:
    """Payment amount by the payment's own currency and rate.

    A missing payment currency is MXN and a missing payment rate the invoice's;
    without a payment currency column the invoice currency holds.
    """
    if "MONEDA_PAGO" in df.columns:
        currency = F.upper(F.coalesce(F.col("MONEDA_PAGO"), F.lit("MXN")))
    else:
        currency = F.col("CURRENCY")
    if "TIPO_CAMBIO_PAGO" in df.columns:
        fx = F.coalesce(F.col("TIPO_CAMBIO_PAGO"), F.col("FX_RATE"))
    else:
        fx = F.col("FX_RATE")
    marked = df.withColumns({"_pay_currency": currency, "_pay_fx": fx})
    return split_currency(
        marked, F.col("IMPORTE_PAGO_USD"), "IMPORTE_PAGO_USD", "IMPORTE_PAGO_MXN",
        other="zero", currency="_pay_currency", fx="_pay_fx",
    ).drop("_pay_currency", "_pay_fx")


def net_payable(total: str = "TOTAL_FACTURA") -> Column:
    """Invoice total plus its (negative) retentions."""
    return row_sum(total, "RET_IVA", "RET_ISR_4", "RET_ISR_10")


def historical_mxn(amount: str, currency: str, rate: str) -> Column:
    """USD amounts at the day's rate; any other amount, or no rate, unchanged."""
    applies = (F.upper(F.col(currency)) == "USD") & F.col(rate).isNotNull()
    return money(F.when(applies, F.col(amount) * F.col(rate)).otherwise(F.col(amount)))


def rate_missing(currency: str, *date_and_rate: tuple[str, str]) -> Column:
    """True where a USD amount has a date but no rate for it."""
    gap = F.lit(False)
    for date, rate in date_and_rate:
        gap = gap | (F.col(date).isNotNull() & F.col(rate).isNull())
    return F.coalesce((F.upper(F.col(currency)) == "USD") & gap, F.lit(False))


def with_periods(df: DataFrame, style: str, columns: dict[str, str] | None = None) -> DataFrame:
    """SEMANA/MES of each date column; `columns` maps date column to suffix."""
    added = {}
    for column, suffix in (columns or {"FECHA": "", "FECHA_PAGO": "_PAGO"}).items():
        added[f"SEMANA{suffix}"] = dates.iso_week(column)
        added[f"MES{suffix}"] = dates.month(column, style)
    return df.withColumns(added)

