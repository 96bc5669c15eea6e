from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from cuadre.operators import aggregates as agg
from cuadre.operators import profile
from cuadre.operators.aggregates import ListOf
from tests.conftest import rows


def test_class_sums_keep_every_class(spark):
    df = spark.createDataFrame(
        [("1", "IVA", D(10)), ("1", "IVA", D(5)), ("1", None, D(3)), (None, "IVA", D(9)), ("2", "IEPS", None)],
        "INVOICE_ID string, c string, TAX_AMT decimal(18,2)",
    )
    got = agg.tax_pivot(df, F.col("c"), ("IVA", "RET", "IEPS"))
    assert got.columns == ["INVOICE_ID", "IVA", "RET", "IEPS"]
    assert rows(got) == [("1", D(15), D(0), D(0)), ("2", D(0), D(0), D(0))]


def test_pivot_two_folds_unlisted_classes(spark):
    df = spark.createDataFrame(
        [("1", "IVA", D(10), None), ("1", "IEPS", D(1), D(18)), ("1", "OTROS_TAX", D(2), D(36))],
        "INVOICE_ID string, c string, u decimal(18,2), m decimal(18,2)",
    )
    got = agg.pivot_two(df, "c", ("IVA", "OTROS_TAX"), "u", "m", "OTROS_TAX")
    assert got.columns == ["INVOICE_ID", "IVA_USD", "OTROS_TAX_USD", "IVA_MXN", "OTROS_TAX_MXN"]
    assert rows(got) == [("1", D(10), D(3), D(0), D(54))]


LIST_ROWS = [
    ("1", 3, "c", None), ("1", 1, "a", None), ("1", 2, "a", "y"), ("1", 4, "b", "x"), ("1", 5, "d", "x"),
    ("1", None, "z", None), ("2", 1, None, None), (None, 1, "q", "q"),
]


def test_distinct_lists(spark):
    df = spark.createDataFrame(LIST_ROWS, "k string, ord int, v string, w string")
    lists = [ListOf("v", "v", ","), ListOf("w", "w", " | ")]
    assert rows(agg.distinct_lists(df, "k", lists, F.col("ord"))) == [("1", "z,a,c,b,d", "y | x"), ("2", "", "")]
    limited = agg.distinct_lists(df, "k", lists, F.col("ord"), limit=3)
    assert rows(limited) == [("1", "z,a,c", "y | x"), ("2", "", "")]


def test_distinct_lists_against_plain_python(spark):
    import random

    random.seed(7)
    data = [(random.randint(0, 5), random.choice([None, *range(9)]), random.choice([None, *"abcdefg"])) for _ in range(400)]
    df = spark.createDataFrame(data, "k int, ord int, v string")
    got = dict(agg.distinct_lists(df, "k", [ListOf("v", "v", "-")], F.col("ord")).collect())
    for key in {k for k, _, _ in data}:
        first: dict[str, tuple] = {}
        for k, o, v in data:
            if k == key and v is not None:
                rank = (o is not None, -1 if o is None else o, v)
                first[v] = min(first.get(v, rank), rank)
        assert got[key] == "-".join(sorted(first, key=first.get))


def test_first_non_null_is_not_the_first_row(spark):
    df = spark.createDataFrame(
        [("1", 1, None, "x"), ("1", 2, "b", None), ("1", 2, "a", None), ("2", 1, None, None)],
        "INVOICE_ID string, DISTRIBUTION_LINE_NUMBER int, CUENTA_CONTABLE_GASTO string, DESCRIPTION string",
    )
    assert rows(agg.principal_distribution(df)) == [("1", "a", "x"), ("2", None, None)]


def test_prepayment_fallback(spark):
    stamp = dt.datetime(2025, 1, 1)
    schema = (
        "INVOICE_ID string, ADELANTO_USD decimal(18,2), ADELANTO_MXN decimal(18,2), MONEDA string, "
        "TIPO_CAMBIO decimal(18,6), FECHA_APLICACION timestamp_ntz, TIPO_ORIGEN string, ERS string, "
        "ORDEN_COMPRA string, FACTURA_ADELANTO string"
    )

    def line(invoice, usd, mxn, currency):
        return (invoice, D(usd), mxn and D(mxn), currency, D("18.5"), stamp, "PREPAYMENT", None, None, "F1")

    df = spark.createDataFrame(
        [
            line("1", 5, None, "MXN"), line("1", 6, None, None),  # no MXN amount at all
            line("2", 5, 90, "MXN"), line("2", 6, None, "MXN"),   # one given
            line("3", 5, None, "USD"), line(None, 5, 5, "USD"),
        ],
        schema,
    )
    got = agg.agg_prepayments(df)
    assert rows(got, "INVOICE_ID", "ADELANTO_USD", "ADELANTO_MXN", "MONEDA", "ERS", "TIPO_ORIGEN") == [
        ("1", D(11), D(11), "MXN", "", "PREPAYMENT"),
        ("2", D(11), D(90), "MXN", "", "PREPAYMENT"),
        ("3", D(5), D(0), "USD", "", "PREPAYMENT"),
    ]


def test_value_counts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "v string")
    assert [tuple(r) for r in agg.value_counts(df, "v").collect()] == [("b", 2), ("a", 1), ("c", 1)]
    assert [tuple(r) for r in agg.value_counts(df, "v", 2).collect()] == [("b", 2), ("a", 1)]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", None), (1, None, None), (2, "b", None)], "x int, `y z` string, w date")
    assert rows(profile.profile(df)) == [
        ("w", "date", 3, 0, 1), ("x", "int", 0, 3, 2), ("y z", "string", 1, 2, 3),
    ]
    assert rows(profile.width_profile(df)) == [("w", 3), ("x", 3), ("y z", 5)]
    long = spark.createDataFrame([("x" * 80,)], "c string")
    assert rows(profile.width_profile(long)) == [("c", 50)]


def test_prepayment_and_code_profiles(spark):
    df = spark.createDataFrame([("ERS", None), ("PREPAYMENT", 1), ("PREPAYMENT", None)], "TIPO_ORIGEN string, ADELANTO_MXN int")
    assert rows(profile.prepayment_profile(df)) == [("ERS", 1, 0, 1), ("PREPAYMENT", 2, 1, 1)]
    taxes = spark.createDataFrame(
        [("RETENCION_ISR", "R1", "ISR"), ("RETENCION_ISR", "R1", "ISR4"), ("IVA", "R2", "IVA")],
        "TIPO_IMPUESTO string, TAX_RATE_CODE string, TAX_TYPE_CODE string",
    )
    assert rows(profile.withholding_code_profile(taxes)) == [("R1", 2)]
    assert profile.codes_containing(taxes).count() == 1


def test_union_of_sides_equals_their_joins(spark):
    """One aggregation over taxes, withholdings, payments and prepayments against one for each."""
    import random

    draw = random.Random(5)
    some = lambda *values: draw.choice([None, *values])
    day = lambda: some(*[dt.datetime(2025, 1, d) for d in (1, 2, 3)])
    taxes = [(some(1, 2, 3, 4), some("IVA", "IEPS", "OTROS_TAX", "x"), some(D("1.5"), D(2)), some(D(3))) for _ in range(60)]
    held = [(some(3, 4, 5), some("RET_ISR_4", "RET_IVA", "x"), some(D(1), D(-2)), some(D(4))) for _ in range(60)]
    paid = [(some(2, 6), str(some("p", "q")), some("b"), some("d"), some(D(1)), some(D(9)), some(D("18.5"), D(19)), day(), day()) for _ in range(40)]
    prepaid = [
        (draw.choice([None, 1, 7, 8, 9, 10, 11]), "PREPAYMENT", some("e"), some("o"), some("f", "g"), some(D(1), D(7)),
         some(D(2)) if draw.random() < 0.3 else None, some(D(20)), day(), some("MXN", "USD", "EUR", "MXN"))
        for _ in range(40)
    ]
    money = "decimal(18,2)"
    t = spark.createDataFrame(taxes, f"INVOICE_ID int, CLASIFICACION_IMPUESTO string, IMPUESTO_USD {money}, IMPUESTO_MXN {money}")
    w = spark.createDataFrame(held, f"INVOICE_ID int, CLASIFICACION_RETENCION string, RETENCION_USD {money}, RETENCION_MXN {money}")
    p = spark.createDataFrame(
        paid, f"INVOICE_ID int, NUM_PAGO string, BANCO_CUENTA string, DESCRIPTION string, IMPORTE_PAGO_USD {money}, IMPORTE_PAGO_MXN"
        f" {money}, TIPO_CAMBIO_PAGO decimal(18,6), FECHA_APLICACION timestamp_ntz, FECHA_PAGO timestamp_ntz")  # fmt: skip
    a = spark.createDataFrame(
        prepaid, f"INVOICE_ID int, TIPO_ORIGEN string, ERS string, ORDEN_COMPRA string, FACTURA_ADELANTO string, ADELANTO_USD {money},"
        f" ADELANTO_MXN {money}, TIPO_CAMBIO decimal(18,6), FECHA_APLICACION timestamp_ntz, MONEDA string")  # fmt: skip
    invoices = spark.createDataFrame([(i,) for i in range(1, 13)], "INVOICE_ID int")
    classes_t, classes_w = agg.CLASSES_V4_TAX, agg.CLASSES_BY_PERCENTAGE
    joined = (
        invoices.join(agg.pivot_two(t, "CLASIFICACION_IMPUESTO", classes_t, "IMPUESTO_USD", "IMPUESTO_MXN", "OTROS_TAX"), "INVOICE_ID", "left")
        .join(agg.pivot_two(w, "CLASIFICACION_RETENCION", classes_w, "RETENCION_USD", "RETENCION_MXN", "RET_OTRO"), "INVOICE_ID", "left")
        .join(agg.agg_payments(p), "INVOICE_ID", "left")
        .join(agg.agg_prepayments(a).drop("FECHA_APLICACION", "MONEDA"), "INVOICE_ID", "left")
    )
    found = invoices.join(agg.invoice_amounts(t, w, p, a), "INVOICE_ID", "left").join(
        agg.invoice_text_lists(p, a, []), "INVOICE_ID", "left"
    )
    assert rows(found, *sorted(joined.columns)) == rows(joined, *sorted(joined.columns))
