"""Text expressions: account strings, status labels, display formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuadre.sources.spec import PAYMENT_STATUS


def account_string(segments: list[str], sep: str) -> Column:
    """Segments joined by `sep`; a missing segment leaves its place empty."""
    parts: list[Column] = []
    for segment in segments:
        parts += [F.lit(sep), F.coalesce(_col(segment), F.lit(""))]
    return F.concat(*parts[1:])


def segment(c: Column | str, position: int, sep: str = "-") -> Column:
    """The 1-based `position`-th part of a joined account, '' if there is none."""
    return F.coalesce(F.get(F.split(_col(c), sep, -1), F.lit(position - 1)), F.lit(""))


def upper_or_empty(c: Column | str) -> Column:
    return F.coalesce(F.upper(_col(c)), F.lit(""))


def payment_status(c: Column | str, default: str = "PENDIENTE") -> Column:
    flag = _col(c)
    label = F.lit(None).cast("string")
    for code, text in PAYMENT_STATUS.items():
        label = F.when(flag == code, text).otherwise(label)
    return F.coalesce(label, F.lit(default))


def approval_2way(c: Column | str, trim: bool = True) -> Column:
    """NO VALIDADO when never approved; anything else, also NULL, is VALIDADO."""
    status = F.upper(F.trim(_col(c)) if trim else _col(c))
    return F.when(status == "NEVER APPROVED", "NO VALIDADO").otherwise("VALIDADO")


def approval_3way(c: Column | str) -> Column:
    """As approval_2way, with CANCELADO told apart and NULL taken as NO VALIDADO."""
    status = F.trim(F.upper(_col(c)))
    return (
        F.when(status.isNull() | (status == "NEVER APPROVED"), "NO VALIDADO")
        .when(status == "CANCELLED", "CANCELADO")
        .otherwise("VALIDADO")
    )


def uuid_check(c: Column | str) -> Column:
    return F.when(F.trim(_col(c)) != "", "OK").otherwise("⚠️ FALTA UUID")


def display_money(c: Column | str, symbol: str = "") -> Column:
    """#,##0.00 text, the sign before the currency symbol."""
    col = _col(c)
    digits = F.format_number(F.abs(col), 2)
    return F.when(col.isNotNull(), F.concat(F.when(col < 0, "-").otherwise(""), F.lit(symbol), digits))


def display_rate(c: Column | str) -> Column:
    return F.format_number(_col(c), 4)


def display_date(c: Column | str) -> Column:
    return F.date_format(_col(c), "dd/MM/yyyy")


def presentation(df: DataFrame, symbol: str = "") -> DataFrame:
    """A report with money, rates and dates as display text, by column type."""
    shown = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            col = display_money(col, symbol) if f.dataType.scale <= 2 else display_rate(col)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = display_date(col)
        shown.append(col.alias(f.name))
    return df.select(*shown)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
