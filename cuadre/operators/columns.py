"""Column-list operators: fixed layouts, present-only layouts, clashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuadre.functions.numbers import MONEY, RATE


def named(column: str) -> Column:
    """A column by its exact name, also one with blanks or dots."""
    return F.col(f"`{column}`")


def read_whole(df: DataFrame) -> DataFrame:
    """The rows of an exchange for several readers, who then read one and the same, where the optimizer would give each reader an
    exchange of its own columns.

    A condition that always holds names all columns. As it asks for the partition, it is not moved below the exchange, and its
    part that would cost time is never reached.
    """
    return df.where((F.spark_partition_id() >= 0) | (F.xxhash64(*[named(c) for c in df.columns]) == 0))


def reindex(df: DataFrame, columns: list[str], types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Exactly `columns`; a missing one is NULL (text unless typed)."""
    types = types or {}
    return df.select(
        *[
            named(c) if c in df.columns else F.lit(None).cast(types.get(c, T.StringType())).alias(c)
            for c in columns
        ]
    )


def select_present(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[named(c) for c in columns if c in df.columns])


def select_ordered(df: DataFrame, columns: list[str], keep_rest: bool = True) -> DataFrame:
    """Listed columns first, in list order, then the unlisted ones."""
    rest = [c for c in df.columns if c not in columns] if keep_rest else []
    return select_present(df, [*columns, *rest])


def ensure_money(df: DataFrame, amounts: list[str], rates: list[str] = ()) -> DataFrame:
    """Amount columns exist and default to 0, rate columns to 1."""
    filled = {}
    for c in amounts:
        value = F.col(c).try_cast(MONEY) if c in df.columns else F.lit(None).cast(MONEY)
        filled[c] = F.coalesce(value, F.lit(0).cast(MONEY))
    for c in rates:
        value = F.col(c).try_cast(RATE) if c in df.columns else F.lit(None).cast(RATE)
        filled[c] = F.coalesce(value, F.lit(1).cast(RATE))
    return df.withColumns(filled)


def settle_clash(left: DataFrame, right: DataFrame, on: list[str], clash: str = "left") -> DataFrame:
    """`right` ready to join: columns also in `left` dropped, or given a suffix."""
    repeated = [c for c in right.columns if c in left.columns and c not in on]
    if clash == "left":
        return right.drop(*repeated)
    return right.withColumnsRenamed({c: c + clash for c in repeated})


def left_join(left: DataFrame, right: DataFrame, on: str | list[str], clash: str = "left") -> DataFrame:
    """Left join by column name with clashes settled before the join."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(settle_clash(left, right, keys, clash), keys, "left")
