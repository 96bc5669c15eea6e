"""Profiles and summaries of relations and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cuadre.operators.aggregates import value_counts
from cuadre.operators.columns import named

#: Columns that tell invoices apart, and schedules of one.
INVOICE, SCHEDULE = ("INVOICE_ID",), ("PAYMENT_NUM",)


def profile(df: DataFrame) -> DataFrame:
    """Column, type, NULL count and distinct count (NULL counts as a value).

    Cells are unpivoted to (column, text) and counted by value, with partial
    aggregation on both levels: one narrow shuffle for all columns, where one
    count(DISTINCT) per column would widen every row by all of them.
    """
    cells = F.array(
        *[F.struct(F.lit(i).alias("i"), named(c).cast("string").alias("v")) for i, c in enumerate(df.columns)]
    )
    by_value = (
        df.select(F.explode(cells).alias("_c"))
        .groupBy(F.col("_c.i").alias("_i"), F.col("_c.v").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    by_column = by_value.groupBy("_i").agg(
        F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_rows"))), F.lit(0)).alias("null_count"),
        F.sum(F.when(F.col("_v").isNotNull(), F.col("_rows")).otherwise(0)).alias("value_count"),
        F.count(F.lit(1)).alias("distinct_count"),
    )
    names = F.array(*[F.lit(c) for c in df.columns])
    kinds = F.array(*[F.lit(f.dataType.simpleString()) for f in df.schema.fields])
    return by_column.select(
        F.get(names, F.col("_i")).alias("column_name"),
        F.get(kinds, F.col("_i")).alias("data_type"),
        "null_count",
        "value_count",
        "distinct_count",
    )


class WhileWriting:
    """A profile that a write takes along: `rows` are to be written, `profile` gives the table when they are.

    Nothing is read a second time. NULLs and values are counted; distinct values are estimated by sketches of fixed size, with
    the relative standard deviation `error`. The counts are taken by the tasks that write, each of which counts once
    however often it is tried; rows that a shuffle follows would not be counted so, hence `rows` go to the writer as they are.
    """

    def __init__(self, df: DataFrame, error: float = 0.01):
        self._observed, self._fields = Observation(), df.schema.fields
        self._spark = df.sparkSession
        counts = [F.count(named(f.name)).alias(f"values{i}") for i, f in enumerate(self._fields)]
        # as text, as `profile` tells values apart
        kinds = [
            F.approx_count_distinct(named(f.name).cast("string"), error).alias(f"distinct{i}") for i, f in enumerate(self._fields)
        ]
        self.rows = df.observe(self._observed, F.count(F.lit(1)).alias("rows"), *counts, *kinds)

    def profile(self) -> DataFrame:
        """The columns of `profile`, one row per column of the report. Waits for the write."""
        found = self._observed.get
        cells = []
        for i, f in enumerate(self._fields):
            values = found[f"values{i}"]
            nulls = found["rows"] - values
            counts = {"null_count": nulls, "value_count": values, "distinct_count": found[f"distinct{i}"] + (nulls > 0)}
            texts = {"column_name": f.name, "data_type": f.dataType.simpleString()}
            cells.append(F.struct(*[F.lit(v).alias(n) for n, v in texts.items()],
                                  *[F.lit(v).cast("long").alias(n) for n, v in counts.items()]))
        return self._spark.range(1 if found["rows"] else 0).select(F.inline(F.array(*cells)))


def unexpected_columns(df: DataFrame, expected: list[str]) -> DataFrame:
    """Profile of the columns of a relation that are not `expected`."""
    return profile(df.select(*[named(c) for c in df.columns if c not in expected]))


def report_summary(df: DataFrame, key: list[str] = INVOICE, schedule: list[str] = SCHEDULE) -> DataFrame:
    """One row of totals over a schedule-payment report.

    `key` tells invoices apart and `schedule` the schedules of one. `total_*` count each schedule once, however
    many payments repeat it; `row_total_*` add up all rows. The rows shrink in steps (schedules, suppliers,
    one row), each combined before its shuffle, so no row is copied for a distinct count.
    """
    due = {"usd": "IMPORTE_BRUTO_USD", "mxn": "IMPORTE_MXN"}
    by_schedule = df.groupBy(*[named(c) for c in (*key, *schedule)], named("PROVEEDOR").alias("_supplier")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.max(named(c)).alias(f"_due_{k}") for k, c in due.items()],
        *[F.sum(named(c)).alias(f"_sum_{k}") for k, c in due.items()],
        F.count("NUM_PAGO").alias("_paid"),
        F.count_if(F.col("SALDO_USD") > 0).alias("_pending_usd"),
        F.count_if((F.col("SALDO_USD") > 0) | (F.col("SALDO_MXN_CALC") > 0)).alias("_pending_any"),
        F.min("FECHA").alias("_first"),
        F.max("FECHA").alias("_last"),
    )
    return totals(by_schedule, key)


def totals(by_schedule: DataFrame, key: list[str] = INVOICE) -> DataFrame:
    """The row of totals from one row of counts and sums per schedule and supplier."""
    added = ["_rows", "_due_usd", "_due_mxn", "_sum_usd", "_sum_mxn", "_paid", "_pending_usd", "_pending_any"]
    shrunk = by_schedule
    for keys, counts in (([*key, "_supplier"], []), (["_supplier"], ["_invoices"]), ([], ["_invoices", "_suppliers"])):
        if counts == ["_invoices"]:
            shrunk = shrunk.withColumn("_invoices", F.lit(1))
        if counts == ["_invoices", "_suppliers"]:
            shrunk = shrunk.withColumn("_suppliers", F.col("_supplier").isNotNull().cast("int"))
        sums = [F.sum(c).alias(c) for c in [*added, *counts]]
        shrunk = shrunk.groupBy(*[named(c) for c in keys]).agg(
            *sums, F.min("_first").alias("_first"), F.max("_last").alias("_last")
        )
    return shrunk.select(*summary_columns())


def summary_columns() -> list[Column]:
    """The summary's columns from those of the whole."""
    money38 = "decimal(38,2)"
    none = F.lit(0).cast("long")
    return [
        F.coalesce("_rows", none).alias("row_count"),
        F.coalesce(F.col("_invoices").cast("long"), none).alias("invoice_count"),
        F.coalesce(F.col("_suppliers").cast("long"), none).alias("supplier_count"),
        F.col("_due_usd").cast(money38).alias("total_usd"),
        F.col("_due_mxn").cast(money38).alias("total_mxn"),
        F.col("_sum_usd").cast(money38).alias("row_total_usd"),
        F.col("_sum_mxn").cast(money38).alias("row_total_mxn"),
        F.coalesce("_paid", none).alias("paid_rows"),
        F.coalesce("_pending_usd", none).alias("pending_usd"),
        F.coalesce("_pending_any", none).alias("pending_any"),
        F.col("_first").alias("first_date"),
        F.col("_last").alias("last_date"),
    ]


def prepayment_profile(df: DataFrame) -> DataFrame:
    """Rows by origin, with and without an MXN amount."""
    return (
        df.where(F.col("TIPO_ORIGEN").isNotNull())
        .groupBy("TIPO_ORIGEN")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count("ADELANTO_MXN").alias("with_mxn"),
            F.count_if(F.col("ADELANTO_MXN").isNull()).alias("without_mxn"),
        )
    )


def withholding_code_profile(
    df: DataFrame, class_column: str = "TIPO_IMPUESTO", wanted: str = "RETENCION_ISR", limit: int = 20
) -> DataFrame:
    """The most frequent rate codes of one withholding class."""
    return value_counts(df.where(named(class_column) == wanted), "TAX_RATE_CODE", limit)


def codes_containing(df: DataFrame, token: str = "4", column: str = "TAX_TYPE_CODE") -> DataFrame:
    """Tax lines whose type code contains `token`."""
    return df.where(named(column).contains(token))


def width_profile(df: DataFrame, widest: int = 50, margin: int = 2) -> DataFrame:
    """Display width of each column: longest text (header included) + margin, at most `widest`."""
    lengths = df.agg(
        *[F.max(F.length(named(c).cast("string"))).alias(str(i)) for i, c in enumerate(df.columns)]
    )
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.least(
                    F.greatest(F.lit(len(c)), F.coalesce(named(str(i)), F.lit(0))) + margin, F.lit(widest)
                ).alias("width"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return lengths.select(F.inline(pairs))
