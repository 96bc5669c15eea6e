"""Numeric expressions. Money is decimal(18,2), exchange rates decimal(18,6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 6)


def zero() -> Column:
    return F.lit(0).cast(MONEY)


def money(c: Column | str) -> Column:
    """Round half up to cents; an amount of more than 16 digits before the point is NULL."""
    return _col(c).try_cast(MONEY)


def to_number(c: Column | str, kind: T.DataType = MONEY) -> Column:
    """Text or number to a decimal; what does not parse is NULL."""
    return _col(c).try_cast(kind)


def or_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), zero())


def rate_or_one(c: Column | str, zero_is_one: bool = True) -> Column:
    """An exchange rate, 1 where missing and (by default) where zero."""
    rate = _col(c)
    if zero_is_one:
        rate = F.nullif(rate, F.lit(0).cast(RATE))
    return F.coalesce(rate, F.lit(1).cast(RATE))


def row_sum(*cols: Column | str) -> Column:
    """Sum across columns of one row, NULL counted as 0."""
    total = or_zero(cols[0])
    for c in cols[1:]:
        total = total + or_zero(c)
    return money(total)


def percentage(part: Column | str, base: Column | str) -> Column:
    """|part| / |base| * 100 rounded half up to 2 places; NULL on a zero base."""
    ratio = F.abs(_col(part)) * F.lit(100) / F.nullif(F.abs(_col(base)), zero())
    return F.round(ratio, 2).cast(MONEY)


def canonical_id(c: Column | str, source: T.DataType) -> Column:
    """Identifier text without a decimal tail, whatever type it was stored in; a number that is no
    whole number is no identifier and keeps its fraction, so that it meets no other."""
    col = _col(c)
    if isinstance(source, (T.FloatType, T.DoubleType, T.DecimalType)):
        whole = col.try_cast(T.DecimalType(38, 0))
        return F.when(whole == col, whole.cast("string")).otherwise(col.cast("string"))
    if isinstance(source, T.StringType):
        return F.regexp_replace(F.trim(col), r"^(-?\d+)\.0+$", "$1")
    return col.cast("string")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
