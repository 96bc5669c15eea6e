from __future__ import annotations

from decimal import Decimal as D

import pytest

from cuadre.functions import classify
from cuadre.functions.numbers import percentage

RATE_ROWS = [
    # rate, amount, by rate, by rate in detail
    (16, 1, "IVA", "IVA_16"),
    (8, 1, "IVA", "IVA_8"),
    (16, -1, "RET_IVA", "RET_IVA"),
    (4, 1, "RET_ISR_4", "RET_ISR_4"),
    (4, -1, "RET_ISR_4", "RET_ISR_4"),
    (10, -1, "RET_ISR", "RET_ISR_10"),
    (10, 1, "OTROS_TAX", "OTROS_IMPUESTOS"),
    (0, 0, "OTROS_TAX", "OTROS_IMPUESTOS"),
    (16, None, "OTROS_TAX", "OTROS_IMPUESTOS"),
    (None, -1, "RET_IVA", "RET_IVA"),
]


def test_by_rate(spark):
    df = spark.createDataFrame(
        [(r, a, x, y) for r, a, x, y in RATE_ROWS], "TAX_RATE int, TAX_AMT int, x string, y string"
    )
    got = df.select("x", classify.classify_by_rate().alias("a"), "y", classify.classify_by_rate_detail().alias("b"))
    for x, a, y, b in got.collect():
        assert (a, b) == (x, y)


CODE_ROWS = [
    ("IVA16", "TAX", 16, "IVA"),
    ("iva8", "TAX", 8, "IVA"),
    ("RET_ISR_4", "AWT", 4, "RET_ISR_4"),
    ("RET_IVA_4", "AWT", 0, "RET_ISR_4"),
    ("RET_ISR_10", "AWT", 10, "RET_ISR"),
    ("RET_IVA", "AWT", 10, "RET_IVA"),
    (None, "AWT", 0, "RET_IVA"),
    (None, "awt", 4, "RET_ISR_4"),
    ("IVA", "AWT", 4, "IVA"),
    ("RET", "TAX", 4, "RET_ISR_4"),
    ("RET", None, None, "RET_IVA"),
    ("IEPS", "TAX", 4, "OTROS_TAX"),
    (None, None, None, "OTROS_TAX"),
]


def test_by_code(spark):
    df = spark.createDataFrame(
        CODE_ROWS, "CODIGO_IMPUESTO string, TIPO_LINEA string, TAX_RATE int, expected string"
    )
    for expected, got in df.select("expected", classify.classify_by_code()).collect():
        assert got == expected
    default = df.where("CODIGO_IMPUESTO = 'IEPS'").select(classify.classify_by_code(default="OTROS")).first()[0]
    assert default == "OTROS"


@pytest.mark.parametrize(
    "code,expected",
    [
        (None, "OTRO"), ("IVA", "IVA"), ("RET_IVA", "RETENCION_IVA"), ("iva_ret", "RETENCION_IVA"),
        ("RET_ISR", "RETENCION_ISR"), ("RET_ISR_4", "RETENCION_ISR_4"), ("ISR_4", "RETENCION_ISR_4"),
        ("4 isr", "RETENCION_ISR_4"), ("OTHER", "OTRO"), ("RETENCION_ISR", "RETENCION_ISR"), ("ISR", "OTRO"),
    ],
)
def test_by_type(spark, code, expected):
    df = spark.createDataFrame([(code,)], "TAX_TYPE_CODE string")
    assert df.select(classify.classify_by_type()).first()[0] == expected


@pytest.mark.parametrize(
    "amount,base,pct,expected",
    [
        ("-4", "100", "4.00", "RET_ISR_4"),
        ("-1.25", "100", "1.25", "RET_ISR_125"),
        ("10.66", "-100", "10.66", "RET_IVA"),
        ("-10", "100", "10.00", "RET_ISR_10"),
        ("-6", "100", "6.00", "RET_IVA_6"),
        ("-3", "100", "3.00", "RET_OTRO"),
        ("-12.45", "1000", "1.25", "RET_ISR_125"),  # 1.245 rounds half up
        ("-12.54", "1000", "1.25", "RET_ISR_125"),
        ("-12.55", "1000", "1.26", "RET_OTRO"),
        ("-5", "0", None, "RET_OTRO"),
        ("-5", None, None, "RET_OTRO"),
    ],
)
def test_by_percentage(spark, amount, base, pct, expected):
    row = (D(amount), None if base is None else D(base))
    df = spark.createDataFrame([row], "a decimal(18,2), b decimal(18,2)")
    df = df.withColumn("PORCENTAJE_RETENCION", percentage("a", "b"))
    got = df.select("PORCENTAJE_RETENCION", classify.classify_by_percentage()).first()
    assert got[0] == (None if pct is None else D(pct))
    assert got[1] == expected


def test_known_class(spark):
    df = spark.createDataFrame([("IVA",), ("IEPS",), (None,)], "c string")
    got = [r[0] for r in df.select(classify.known_class("c", ("IVA", "OTROS"), "OTROS")).collect()]
    assert got == ["IVA", "OTROS", None]
