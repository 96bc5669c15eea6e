"""Summaries that add up: partial states of a schedule-payment report, stored and merged over extracts.

A state has one row per schedule, supplier and day: counts, sums and the amounts due, in a fraction of the report's columns and
rows. States of parts of a report add up to the state of the whole, however its rows are dealt to the parts; `summary` of them is
`report_summary` of those rows. A late correction is a state of the invoices that it touches: `corrected` takes it in
place of what earlier states say of them.

`by_day` goes on to one row per day, whose invoices and suppliers are sketches of fixed size: a year of days is a few
hundred rows, and any span of days has its totals from them. Sums are exact there, the two distinct counts are not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadre.operators.columns import named
from cuadre.operators.profile import INVOICE, SCHEDULE, summary_columns, totals

DAY, SUPPLIER = "DAY", "SUPPLIER"
MONEY38 = "decimal(38,2)"

#: Columns of a state with the function that merges them.
MERGED_BY = {
    "ROWS": F.sum, "DUE_USD": F.max, "DUE_MXN": F.max, "SUM_USD": F.sum, "SUM_MXN": F.sum, "PAID": F.sum,
    "PENDING_USD": F.sum, "PENDING_ANY": F.sum, "FIRST": F.min, "LAST": F.max,
}
#: Columns of a report that its state reads, beside the keys and the day.
READ = ["PROVEEDOR", "FECHA", "IMPORTE_BRUTO_USD", "IMPORTE_MXN", "NUM_PAGO", "SALDO_USD", "SALDO_MXN_CALC"]
#: Registers of a sketch are 2 to this power: a relative error of 1.6 %.
SKETCH_SIZE = 12


def states(report: DataFrame, key: list[str] = INVOICE, schedule: list[str] = SCHEDULE, day: str = "FECHA") -> DataFrame:
    """The state of a report's rows. `day` is a date or timestamp column of it; NULL is a day like any other."""
    keys = [named(c) for c in (*key, *schedule)]
    grouped = report.groupBy(*keys, named("PROVEEDOR").alias(SUPPLIER), named(day).cast("date").alias(DAY))
    return _typed(
        grouped.agg(
            F.count(F.lit(1)).alias("ROWS"),
            F.max("IMPORTE_BRUTO_USD").alias("DUE_USD"),
            F.max("IMPORTE_MXN").alias("DUE_MXN"),
            F.sum("IMPORTE_BRUTO_USD").alias("SUM_USD"),
            F.sum("IMPORTE_MXN").alias("SUM_MXN"),
            F.count("NUM_PAGO").alias("PAID"),
            F.count_if(F.col("SALDO_USD") > 0).alias("PENDING_USD"),
            F.count_if((F.col("SALDO_USD") > 0) | (F.col("SALDO_MXN_CALC") > 0)).alias("PENDING_ANY"),
            F.min("FECHA").alias("FIRST"),
            F.max("FECHA").alias("LAST"),
        )
    )


def _typed(state: DataFrame) -> DataFrame:
    # merging leaves the types as they are, so that a merged state may be stored beside others
    return state.withColumns({c: F.col(c).cast(MONEY38) for c in ("DUE_USD", "DUE_MXN", "SUM_USD", "SUM_MXN")})


def _grouped(state: DataFrame, keys: list[str]) -> DataFrame:
    merges = [merge(c).alias(c) for c, merge in MERGED_BY.items()]
    return _typed(state.groupBy(*[named(c) for c in keys]).agg(*merges))


def _keys(state: DataFrame) -> list[str]:
    return [c for c in state.columns if c not in MERGED_BY]


def _united(parts: tuple[DataFrame, ...]) -> DataFrame:
    if not parts:
        raise ValueError("there is no state to merge")
    return reduce(DataFrame.unionByName, parts)


def merged(*parts: DataFrame) -> DataFrame:
    """The state of all rows that the parts are states of; a row counts in each part that has it."""
    return _grouped(_united(parts), _keys(parts[0]))


def corrected(*parts: DataFrame, key: list[str] = INVOICE, gone: DataFrame | None = None) -> DataFrame:
    """The parts, oldest first, each with the whole state of the invoices that it knows: the last part that has an invoice tells of
    it alone. `gone` holds keys of invoices without any row now; a NULL key is a key."""
    tagged = _united(tuple(p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)))
    last = tagged.groupBy(*[named(c).alias(f"_{c}") for c in key]).agg(F.max("_part").alias("_last"))
    if gone is not None:
        left_out = gone.select(*[named(c).alias(f"_gone_{c}") for c in key])
        last = last.join(left_out, [named(f"_{c}").eqNullSafe(named(f"_gone_{c}")) for c in key], "left_anti")
    same = [named(c).eqNullSafe(named(f"_{c}")) for c in key]
    return tagged.join(last, [*same, F.col("_part") == F.col("_last")], "left_semi").drop("_part")


def by_schedule(state: DataFrame) -> DataFrame:
    """One row per schedule and supplier, whatever its days."""
    return _grouped(state, [c for c in _keys(state) if c != DAY])


def summary(state: DataFrame, key: list[str] = INVOICE) -> DataFrame:
    """The row of `report_summary` over the rows of a state. All counts are exact."""
    return totals(by_schedule(state).withColumnsRenamed({c: f"_{c.lower()}" for c in [*MERGED_BY, SUPPLIER]}), key)


def _sketch(values: list[Column], any_null: bool) -> Column:
    told = F.xxhash64(*[x for v in values for x in (v, v.isNull())])
    return F.hll_sketch_agg(told if any_null else F.when(values[0].isNotNull(), told), F.lit(SKETCH_SIZE))


def by_day(state: DataFrame, key: list[str] = INVOICE) -> DataFrame:
    """One row per day: sums, and sketches of the day's invoices and suppliers.

    A schedule counts in `DUE_*` on each day that its rows have, which is one where `day` belongs to the invoice.
    """
    return state.groupBy(DAY).agg(
        *[(F.sum if merge is F.max and c != "LAST" else merge)(c).alias(c) for c, merge in MERGED_BY.items()],
        _sketch([named(c) for c in key], True).alias("INVOICES"),
        _sketch([F.col(SUPPLIER)], False).alias("SUPPLIERS"),
    )


def summary_of_days(*days: DataFrame) -> DataFrame:
    """The row of `report_summary` over rows of `by_day`, each day in one of the parts; invoices and suppliers are estimates."""
    sums = [c for c in MERGED_BY if c not in ("FIRST", "LAST")]
    whole = _united(days).agg(
        *[F.sum(c).alias(f"_{c.lower()}") for c in sums],
        F.min("FIRST").alias("_first"),
        F.max("LAST").alias("_last"),
        *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"_{c.lower()}") for c in ("INVOICES", "SUPPLIERS")],
    )
    return whole.select(*summary_columns())
