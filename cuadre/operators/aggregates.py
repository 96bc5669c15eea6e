"""Aggregates with one row per key.

Sums of few columns combine on the map side first, so a key holding much of a
relation reaches its task as one partial row per map task. Aggregates with wide
states deal the rows themselves out by key (`dealt`): where a relation is not in
the order of its keys, as extracts are not, a map task meets most keys once, and
a state of a kilobyte for each is what fills its memory and the shuffle. A key
then reaches its task as its narrow rows, which are streamed through one state.
Ordered distinct lists aggregate by (key, value) before anything is collected.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuadre.functions.classify import known_class
from cuadre.functions.numbers import MONEY, RATE, money
from cuadre.operators.columns import named, read_whole
from cuadre.operators.one_row import Side, Tagged
from cuadre.sources.spec import CLASSES_BY_PERCENTAGE, CLASSES_V4_TAX


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows that have a key, all of one key in one task: groupings by it, also by it and more columns, and joins on it follow
    without another exchange."""
    return df.where(named(key).isNotNull()).repartition(named(key))


def class_sums(
    df: DataFrame,
    key: str,
    category: Column,
    classes: tuple[str, ...],
    measures: dict[str, str],
    narrow: bool = False,
) -> DataFrame:
    """Sums by key and class, one column per class and measure, 0 where none.

    `measures` maps a column suffix to the summed column. The class list is
    fixed, so the pivot is a set of conditional sums in one aggregation. Rows
    without a key are left out and a NULL class counts nowhere. With `narrow` the
    rows themselves are dealt out by key, cut down to a class number and the
    measures: a state has a sum for each class, most of them empty.
    """
    rows = df.where(named(key).isNotNull()).withColumn("_class", category)
    names = {c: F.lit(c) for c in classes}
    if narrow:
        names = {c: F.lit(i).cast("tinyint") for i, c in enumerate(classes)}
        number = F.coalesce(*[F.when(F.col("_class") == c, i) for c, i in names.items()])
        rows = dealt(rows.select(named(key), number.alias("_class"), *[named(c) for c in dict.fromkeys(measures.values())]), key)
    sums = [
        money(F.coalesce(F.sum(F.when(F.col("_class") == names[c], F.col(column))), F.lit(0))).alias(c + suffix)
        for suffix, column in measures.items()
        for c in classes
    ]
    return rows.groupBy(key).agg(*sums)


def tax_pivot(
    df: DataFrame, category: Column, classes: tuple[str, ...], value: str = "TAX_AMT", suffix: str = "", narrow: bool = False
) -> DataFrame:
    """Tax amount by invoice and class."""
    return class_sums(df, "INVOICE_ID", category, classes, {suffix: value}, narrow)


def pivot_two(
    df: DataFrame, category: str, classes: tuple[str, ...], usd: str, mxn: str, other: str
) -> DataFrame:
    """USD and MXN amounts by invoice and class; unlisted classes fold into `other`."""
    folded = known_class(category, classes, other)
    return class_sums(df, "INVOICE_ID", folded, classes, {"_USD": usd, "_MXN": mxn})


@dataclass(frozen=True)
class ListOf:
    """An output column: distinct values of `column`, joined by `sep`."""

    name: str
    column: str
    sep: str = ", "


def _entries(df: DataFrame, key: str, lists: list[ListOf], order: Column, first_slot: int = 0) -> DataFrame:
    """One row per row of `df` and list: key, _order, _slot (the list's number) and _value."""
    slots = [
        F.struct(F.lit(i).alias("slot"), named(spec.column).cast("string").alias("value"))
        for i, spec in enumerate(lists, first_slot)
    ]
    return df.where(named(key).isNotNull()).select(key, order.alias("_order"), F.inline(F.array(*slots)).alias("_slot", "_value"))


def _first_appearances(rows: DataFrame, key: str) -> DataFrame:
    """One row per key, list and distinct value (NULL too) with its first place: a narrow aggregation, combined by map tasks."""
    return (
        rows.groupBy(key, "_slot", "_value")
        # min skips NULL, so NULL-first is kept by a flag of its own
        .agg(
            F.min(F.when(F.col("_order").isNull(), 0).otherwise(1)).alias("_known"),
            F.min("_order").alias("_first"),
        )
        .withColumn("_first", F.when(F.col("_known") == 1, F.col("_first")))
    )


def distinct_values(df: DataFrame, key: str, lists: list[ListOf], order: Column) -> DataFrame:
    """The content of distinct_lists as rows: key, list, value, first place.

    For keys with more values than one text cell can hold; nothing is collected.
    """
    first = _first_appearances(_entries(df, key, lists, order), key).where(F.col("_value").isNotNull())
    names = F.array(*[F.lit(spec.name) for spec in lists])
    return first.select(
        key,
        F.get(names, F.col("_slot")).alias("list"),
        F.col("_value").alias("value"),
        F.col("_first").alias("first"),
    )


def distinct_lists(df: DataFrame, key: str, lists: list[ListOf], order: Column, limit: int | None = None) -> DataFrame:
    """Ordered distinct text lists by key; '' where a key has no value.

    Values stand in order of their first appearance by `order` (a number or a
    date; NULL first), ties by value. Of rows that are not `dealt` by the key only the first values are
    ever shuffled to it with a `limit`, otherwise the distinct ones.
    """
    return _lists(_first_appearances(_entries(df, key, lists, order), key), key, lists, limit)


def lists_of_sides(key: str, sides: list[tuple[DataFrame, list[ListOf], Column]]) -> DataFrame:
    """The lists of several relations, as distinct_lists gives them of one, by one aggregation over their union; NULL where a
    relation does not have the key. All orders are of one type. The rows are shuffled once, before they become entries."""
    width = max(len(own) for _, own, _ in sides)
    rows, lists = None, []
    for df, own, order in sides:
        values = [named(spec.column).cast("string") for spec in own] + [F.lit(None).cast("string")] * (width - len(own))
        some = df.select(named(key), order.alias("_order"), F.lit(len(lists)).alias("_first_slot"), F.lit(len(own)).alias("_own"),
                         *[v.alias(f"_value{i}") for i, v in enumerate(values)])
        rows, lists = some if rows is None else rows.unionByName(some), [*lists, *own]
    slots = [F.struct((F.col("_first_slot") + i).alias("slot"), F.col(f"_value{i}").alias("value")) for i in range(width)]
    slots = F.slice(F.array(*slots), F.lit(1), F.col("_own"))
    entries = dealt(rows, key).select(key, "_order", F.inline(slots).alias("_slot", "_value"))
    return _lists(_first_appearances(entries, key), key, lists, None, of_sides=True)


def _lists(first: DataFrame, key: str, lists: list[ListOf], limit: int | None, of_sides: bool = False) -> DataFrame:
    if limit is not None:
        by_first = Window.partitionBy(key, "_slot").orderBy(
            F.col("_value").isNull(), "_known", F.col("_first").asc_nulls_first(), "_value"
        )
        first = first.withColumn("_n", F.row_number().over(by_first)).where(F.col("_n") <= limit)
        return _texts_by_place(first, key, lists, limit)
    entry = F.struct("_known", "_first", "_value")
    collected = first.groupBy(key).agg(
        *[
            F.array_sort(
                F.collect_list(F.when((F.col("_slot") == i) & F.col("_value").isNotNull(), entry))
            ).alias(spec.name)
            for i, spec in enumerate(lists)
        ],
        # a relation that has the key has an entry in each of its lists, a missing value at least
        *[F.max(F.col("_slot") == i).alias(f"_has_{i}") for i in range(len(lists) if of_sides else 0)],
    )
    texts = [F.array_join(named(spec.name)["_value"], spec.sep) for spec in lists]
    if of_sides:
        texts = [F.when(F.col(f"_has_{i}"), text) for i, text in enumerate(texts)]
    return collected.select(key, *[text.alias(spec.name) for spec, text in zip(lists, texts)])


def _texts_by_place(first: DataFrame, key: str, lists: list[ListOf], limit: int) -> DataFrame:
    """Lists of the values whose place `_n` is known: each is picked by its place, in the order that the window left, where
    collected values would be hashed, sorted by the key once more and sorted again within it."""
    here = [(F.col("_slot") == i) & (F.col("_n") == n) for i in range(len(lists)) for n in range(1, limit + 1)]
    picked = first.groupBy(key).agg(*[F.max(F.when(at, F.col("_value"))).alias(f"_at{i}") for i, at in enumerate(here)])
    places = [[f"_at{i * limit + n}" for n in range(limit)] for i in range(len(lists))]
    return picked.select(key, *[F.concat_ws(spec.sep, *own).alias(spec.name) for spec, own in zip(lists, places)])


def first_non_null(column: str, order: Column) -> Column:
    """The first value of `column` by `order` that is not NULL; ties by value. The state holds the value once."""
    value = named(column)
    return F.min(F.when(value.isNotNull(), F.struct(order.alias("_order"), value.alias("_value"))))["_value"]


def first_row(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key, the first by a total order."""
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_n") == 1).drop("_n")


def value_counts(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Rows by value, most frequent first, ties by value; NULL left out."""
    counts = (
        df.where(named(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )
    return counts if limit is None else counts.limit(limit)


def sum_or_zero(column: str) -> Column:
    """Sum where all-NULL gives 0."""
    return money(F.coalesce(F.sum(named(column)), F.lit(0)))


def mean_rate(column: str) -> Column:
    return F.avg(named(column).cast(RATE)).cast(RATE)


# ---- composite aggregates, one row per invoice or order ----------------------


def agg_distributions(df: DataFrame, amount: bool = True) -> DataFrame:
    """First 3 accounts and departments, amount if wanted, first description by invoice."""
    line = F.col("DISTRIBUTION_LINE_NUMBER")
    lists = [ListOf("CUENTA_CONTABLE_GASTO", "CUENTA_CONTABLE_GASTO", " | "),
             ListOf("CC_DEPARTAMENTO", "CC_DEPARTAMENTO", " | ")]
    sums = {
        **({"IMPORTE_DISTRIBUCION_USD": sum_or_zero("IMPORTE_DISTRIBUCION_USD")} if amount else {}),
        "DESCRIPTION": first_non_null("DESCRIPTION", line),
    }
    read = ["INVOICE_ID", "DISTRIBUTION_LINE_NUMBER", *[spec.column for spec in lists], *sums]
    df = read_whole(dealt(df.select(*[named(c) for c in read]), "INVOICE_ID"))
    return _with_lists(df, sums, distinct_lists(df, "INVOICE_ID", lists, order=line, limit=3))


def principal_distribution(df: DataFrame) -> DataFrame:
    """By invoice the first non-NULL value of each account column, in line order."""
    line = F.col("DISTRIBUTION_LINE_NUMBER")
    wanted = ("CUENTA_CONTABLE_GASTO", "CC_EMPRESA", "CC_DEPARTAMENTO", "CC_CUENTA", "DESCRIPTION")
    wanted = [c for c in wanted if c in df.columns]
    return dealt(df, "INVOICE_ID").groupBy("INVOICE_ID").agg(*[first_non_null(c, line).alias(c) for c in wanted])


def _latest_first(column: str) -> Column:
    """Order of an extract sorted by a date descending, missing dates first."""
    return -F.unix_micros(F.col(column).cast("timestamp"))


#: An order before that of any date; divisible by 4.
_BEFORE_ALL = -(2**63)
PAYMENT_LISTS = [ListOf(c, c) for c in ("NUM_PAGO", "BANCO_CUENTA", "DESCRIPTION")]
PREPAYMENT_LISTS = [ListOf(c, c) for c in ("TIPO_ORIGEN", "ERS", "ORDEN_COMPRA", "FACTURA_ADELANTO")]
RECEIPT_LIST = ListOf("ERS", "ERS", " | ")


def agg_payments(df: DataFrame, lists: bool = True) -> DataFrame:
    """Payments by invoice: lists if wanted, sums, mean rate, latest dates."""
    sums = {
        "IMPORTE_PAGO_USD": sum_or_zero("IMPORTE_PAGO_USD"),
        "IMPORTE_PAGO_MXN": sum_or_zero("IMPORTE_PAGO_MXN"),
        "TIPO_CAMBIO_PAGO": mean_rate("TIPO_CAMBIO_PAGO"),
        "FECHA_APLICACION": F.max("FECHA_APLICACION"),
        "FECHA_PAGO": F.max("FECHA_PAGO"),
    }
    if not lists:
        return _by_key(df, "INVOICE_ID", sums)
    return _with_lists(df, sums, distinct_lists(df, "INVOICE_ID", PAYMENT_LISTS, _latest_first("FECHA_APLICACION")))


def payment_values(df: DataFrame) -> DataFrame:
    """The lists of agg_payments as rows."""
    return distinct_values(df, "INVOICE_ID", PAYMENT_LISTS, _latest_first("FECHA_APLICACION"))


def agg_prepayments(df: DataFrame, lists: bool = True) -> DataFrame:
    """Prepayments and receipts by invoice.

    The MXN amount falls back to the USD column where the currency is MXN and
    no MXN amount is given at all.
    """
    latest = _latest_first("FECHA_APLICACION")
    no_mxn = F.count("ADELANTO_MXN") == 0
    currency = first_non_null("MONEDA", latest)
    sums = {
        "ADELANTO_USD": sum_or_zero("ADELANTO_USD"),
        "ADELANTO_MXN": F.when(no_mxn & (currency == "MXN"), sum_or_zero("ADELANTO_USD")).otherwise(
            sum_or_zero("ADELANTO_MXN")
        ),
        "TIPO_CAMBIO": mean_rate("TIPO_CAMBIO"),
        "FECHA_APLICACION": F.max("FECHA_APLICACION"),
        "MONEDA": currency,
    }
    if not lists:
        return _by_key(df, "INVOICE_ID", sums)
    return _with_lists(df, sums, distinct_lists(df, "INVOICE_ID", PREPAYMENT_LISTS, order=latest))


def prepayment_values(df: DataFrame) -> DataFrame:
    """The lists of agg_prepayments as rows."""
    return distinct_values(df, "INVOICE_ID", PREPAYMENT_LISTS, _latest_first("FECHA_APLICACION"))


def _by_key(df: DataFrame, key: str, sums: dict[str, Column]) -> DataFrame:
    return df.where(named(key).isNotNull()).groupBy(key).agg(*[c.alias(n) for n, c in sums.items()])


def _with_lists(df: DataFrame, sums: dict[str, Column], lists: DataFrame) -> DataFrame:
    """Sums by invoice beside its lists: two narrow aggregations over pruned columns. In one, every row of the sums would
    go through the grouping of the lists, once for each list."""
    return lists.join(_by_key(df, "INVOICE_ID", sums), "INVOICE_ID")


def invoice_amounts(taxes: DataFrame, withholding: DataFrame, payments: DataFrame, prepayments: DataFrame) -> DataFrame:
    """The sums of pivot_two (taxes and withholdings), agg_payments and agg_prepayments by invoice, by one aggregation."""
    return _amounts(_invoice_rows(taxes, withholding, payments, prepayments))


def invoice_amounts_and_lists(
    taxes: DataFrame, withholding: DataFrame, payments: DataFrame, prepayments: DataFrame, known: list[str]
) -> list[DataFrame]:
    """invoice_amounts and invoice_text_lists out of one exchange: payments and prepayments are shuffled once for both."""
    own = {"paid": _unknown(PAYMENT_LISTS, known), "prepaid": _unknown(PREPAYMENT_LISTS, known)}
    union = _invoice_rows(taxes, withholding, payments, prepayments, own)
    slots, lists = [], []
    for side, wanted in own.items():
        some = [F.struct(F.lit(len(lists) + i).alias("slot"), F.col(f"_text{i}").alias("value")) for i in range(len(wanted))]
        slots += [F.when(union.is_of(side), F.array(*some))] if some else []
        lists += wanted
    if not lists:
        return [_amounts(union)]
    # rows of the other relations have no values, nor entries
    entries = union.rows.select(
        "INVOICE_ID", _latest_first("_applied").alias("_order"), F.inline(F.coalesce(*slots)).alias("_slot", "_value")
    )
    found = _lists(_first_appearances(entries, "INVOICE_ID"), "INVOICE_ID", lists, None, of_sides=True)
    return [_amounts(union), found]


def _invoice_rows(
    taxes: DataFrame,
    withholding: DataFrame,
    payments: DataFrame,
    prepayments: DataFrame,
    lists: dict[str, list[ListOf]] | None = None,
) -> Tagged:
    """The rows of four relations by invoice, with the values of `lists` by relation if wanted."""
    texts = {side: {f"_text{i}": named(spec.column) for i, spec in enumerate(own)} for side, own in (lists or {}).items()}
    text_slots = sorted({slot for own in texts.values() for slot in own})

    def amounts(name: str, **more: Column) -> dict[str, Column]:
        return {"_usd": F.col(f"{name}_USD"), "_mxn": F.col(f"{name}_MXN"), **more}

    # how the currency compares with MXN; 3 where there is none
    rank = F.when(F.col("MONEDA") < "MXN", 0).when(F.col("MONEDA") == "MXN", 1).when(F.col("MONEDA") > "MXN", 2).otherwise(3)
    return Tagged(
        "INVOICE_ID",
        {
            "_usd": MONEY, "_mxn": MONEY, "_rate": RATE, "_applied": T.TimestampNTZType(), "_paid": T.TimestampNTZType(),
            "_currency": T.ShortType(), **{slot: T.StringType() for slot in text_slots},
        },
        {
            "tax": Side(taxes, amounts("IMPUESTO"), known_class("CLASIFICACION_IMPUESTO", CLASSES_V4_TAX, "OTROS_TAX"), CLASSES_V4_TAX),
            "held": Side(
                withholding, amounts("RETENCION"), known_class("CLASIFICACION_RETENCION", CLASSES_BY_PERCENTAGE, "RET_OTRO"),
                CLASSES_BY_PERCENTAGE,
            ),
            "paid": Side(
                payments,
                amounts(
                    "IMPORTE_PAGO", _rate=F.col("TIPO_CAMBIO_PAGO"), _applied=F.col("FECHA_APLICACION"), _paid=F.col("FECHA_PAGO"),
                    **texts.get("paid", {}),
                ),
            ),
            "prepaid": Side(
                prepayments,
                amounts("ADELANTO", _rate=F.col("TIPO_CAMBIO"), _applied=F.col("FECHA_APLICACION"), _currency=rank, **texts.get("prepaid", {})),
            ),
        },
        shared=lists is not None,
    )


def _amounts(union: Tagged) -> DataFrame:
    def pivoted(side: str, classes: tuple[str, ...]) -> dict[str, Column]:
        return {
            f"{c}_{money_}": sum_of(union.of(side, slot, c)) for slot, money_ in (("_usd", "USD"), ("_mxn", "MXN")) for c in classes
        }

    def sum_of(value: Column) -> Column:
        return money(F.coalesce(F.sum(value), F.lit(0)))

    of = union.of
    no_mxn = F.count(of("prepaid", "_mxn")) == 0
    # the first currency by date and text, as a number: dates in steps of 4, which leave room for how it compares with MXN
    place = F.coalesce(_latest_first("_applied") * 4, F.lit(_BEFORE_ALL)) + F.col("_currency")
    in_mxn = F.pmod(F.min(F.when(union.is_of("prepaid") & (F.col("_currency") < 3), place)), F.lit(4)) == 1
    return union.aggregated(
        {
            "tax": pivoted("tax", CLASSES_V4_TAX),
            "held": pivoted("held", CLASSES_BY_PERCENTAGE),
            "paid": {
                "IMPORTE_PAGO_USD": sum_of(of("paid", "_usd")), "IMPORTE_PAGO_MXN": sum_of(of("paid", "_mxn")),
                "TIPO_CAMBIO_PAGO": F.avg(of("paid", "_rate")).cast(RATE), "FECHA_APLICACION": F.max(of("paid", "_applied")),
                "FECHA_PAGO": F.max(of("paid", "_paid")),
            },
            "prepaid": {
                "ADELANTO_USD": sum_of(of("prepaid", "_usd")),
                "ADELANTO_MXN": F.when(no_mxn & in_mxn, sum_of(of("prepaid", "_usd"))).otherwise(sum_of(of("prepaid", "_mxn"))),
                "TIPO_CAMBIO": F.avg(of("prepaid", "_rate")).cast(RATE),
            },
        }
    )


def _unknown(lists: list[ListOf], known: list[str]) -> list[ListOf]:
    return [spec for spec in lists if spec.name not in known]


def invoice_text_lists(payments: DataFrame, prepayments: DataFrame, known: list[str]) -> DataFrame:
    """The lists of agg_payments and agg_prepayments by invoice, by one aggregation, but for those named in `known`."""
    latest = _latest_first("FECHA_APLICACION")
    paid, prepaid = _unknown(PAYMENT_LISTS, known), _unknown(PREPAYMENT_LISTS, known)
    return lists_of_sides("INVOICE_ID", [(payments, paid, latest), (prepayments, prepaid, latest)])


def prepaid_amounts(df: DataFrame) -> DataFrame:
    """Prepaid amount by invoice, from the tagged union."""
    return (
        df.where((F.col("TIPO_ORIGEN") == "PREPAYMENT") & F.col("INVOICE_ID").isNotNull())
        .groupBy("INVOICE_ID")
        .agg(sum_or_zero("ADELANTO_USD").alias("ADELANTO_USD"))
    )


def receipt_lists(df: DataFrame) -> DataFrame:
    """Receipt list by order, from the tagged union: one text cell for each order."""
    receipts = df.where(F.col("TIPO_ORIGEN") == "ERS")
    return distinct_lists(receipts, "ORDEN_COMPRA", [RECEIPT_LIST], order=_latest_first("FECHA_APLICACION"))


def receipt_values(df: DataFrame) -> DataFrame:
    """The receipts of each order as rows, for orders with more than a cell can hold."""
    receipts = df.where(F.col("TIPO_ORIGEN") == "ERS")
    return distinct_values(receipts, "ORDEN_COMPRA", [RECEIPT_LIST], order=_latest_first("FECHA_APLICACION"))


def split_prepay_ers(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tagged union as (prepaid amount by invoice, receipt list by order)."""
    return prepaid_amounts(df), receipt_lists(df)
