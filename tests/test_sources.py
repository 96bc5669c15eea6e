from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cuadre.functions import dates, numbers, text
from cuadre.sources import csv_scan, files, sinks, spec
from tests.conftest import rows


def write(path, body: str) -> str:
    path.write_text(body, encoding="utf-8")
    return str(path)


def test_csv_with_dirty_header_and_tokens(spark, tmp_path):
    path = write(
        tmp_path / "pagos.csv",
        " invoice_id ,Check_Number,IMPORTE_PAGO_USD, extra\n"
        "100.0,0012,10.505,x\n"
        "101,NULL,abc,y\n"
        '102,None,"1,000.5",z\n'
        "103,N/A,,w\n",
    )
    df = files.read_extract(spark, spec.PAYMENTS_V2, path)
    assert df.columns == list(spec.PAYMENTS_V2.columns)
    assert rows(df, "INVOICE_ID", "NUM_PAGO", "IMPORTE_PAGO_USD") == [
        ("100", "0012", D("10.51")),
        ("101", None, None),
        ("102", None, None),
        ("103", None, None),
    ]
    # what the extract lacks is there, typed and NULL
    assert dict(df.dtypes)["FECHA_APLICACION"] == "timestamp_ntz"


def test_quotes_and_line_breaks(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'CUENTA_NUM,CUENTA_DESCRIPCION\n0501,"say ""hi"", and\nmore"\n')
    df = files.read_extract(spark, spec.CHART_OF_ACCOUNTS, path)
    assert rows(df) == [("0501", 'say "hi", and\nmore')]


def test_line_breaks_by_lines_fail(spark, tmp_path):
    """Files that are said to have no line breaks in cells are split; a broken record is an error, not a row."""
    fine = write(tmp_path / "f.csv", 'CUENTA_NUM,CUENTA_DESCRIPCION\n0501,"a, b"\n0502,c\n')
    assert files.read_extract(spark, spec.CHART_OF_ACCOUNTS, fine, cells="one_line").count() == 2
    broken = write(tmp_path / "b.csv", 'CUENTA_NUM,CUENTA_DESCRIPCION\n0501,"two\nlines"\n')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.read_extract(spark, spec.CHART_OF_ACCOUNTS, broken, cells="one_line").collect()


def test_identifiers_read_from_numbers(spark):
    df = spark.createDataFrame([(100.0, 50123.0, 7.5)], "ORDEN_COMPRA double, NUM_PROV double, VOUCHER_NUM double")
    got = files.conform(df, spec.INVOICES_V2).select("ORDEN_COMPRA", "NUM_PROV", "VOUCHER_NUM")
    # a fraction is not rounded to the number of another
    assert rows(got) == [("100", "50123", "7.5")]


def test_uuid_from_the_attribute(spark):
    df = spark.createDataFrame([("1", "abc")], "INVOICE_ID string, GLOBAL_ATTRIBUTE1 string")
    assert rows(files.conform(df, spec.INVOICES_V2), "UUID", "GLOBAL_ATTRIBUTE1") == [("abc", "abc")]
    both = df.selectExpr("*", "'own' AS UUID")
    assert rows(files.conform(both, spec.INVOICES_V2), "UUID") == [("own",)]


def test_rates_under_other_names(spark):
    df = spark.createDataFrame([("2025-01-02", "USD", "17.5")], "DIA_FECHA string, FROM_CURRENCY string, TASA_DIA string")
    got = files.conform(df, spec.DAILY_RATES).select("FECHA_TASA", "CONVERSION_RATE", "FROM_CURRENCY", "TO_CURRENCY")
    assert rows(got) == [(dt.date(2025, 1, 2), D("17.500000"), "USD", None)]


def test_require(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert files.require(df) is df
    with pytest.raises(ValueError, match="invoices has no rows"):
        files.require(df.where("a > 1"), "invoices")


def test_repeated_header_is_an_error(spark, tmp_path):
    path = write(tmp_path / "d.csv", "INVOICE_ID, invoice_id\n1,2\n")
    with pytest.raises(ValueError, match="repeated"):
        files.read_extract(spark, spec.REQUISITIONS, path)


def test_absent_input(spark, tmp_path):
    missing = str(tmp_path / "none.csv")
    optional = files.read_extract(spark, spec.TAXES_V2, missing, required=False)
    assert optional.schema.simpleString() == spec.TAXES_V2.schema.simpleString()
    assert optional.count() == 0
    with pytest.raises(AnalysisException):
        files.read_extract(spark, spec.TAXES_V2, missing)


def test_alias_only_when_target_is_absent(spark):
    both = spark.createDataFrame([("1", "a", "b")], "INVOICE_ID string, ESTATUS string, ESTATUS_PAGO string")
    assert files.conform(both, spec.INVOICES_V1).select("ESTATUS_PAGO").first()[0] == "b"
    one = both.drop("ESTATUS_PAGO")
    assert files.conform(one, spec.INVOICES_V1).select("ESTATUS_PAGO").first()[0] == "a"


def test_parquet_keys_become_text(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.sql("select 7L as INVOICE_ID, cast(8 as double) as CHECK_ID, 'Y' as NUM_PAGO").write.parquet(path)
    got = files.read_extract(spark, spec.PAYMENTS_V2, path, fmt="parquet").select("INVOICE_ID", "CHECK_ID").first()
    assert tuple(got) == ("7", "8")


def test_missing_number_stays_missing(spark):
    # a key column with gaps never turns into '123.0' or 'nan'
    df = spark.createDataFrame([(123.0,), (None,)], "INVOICE_ID double")
    assert rows(files.conform(df, spec.REQUISITIONS), "INVOICE_ID") == [(None,), ("123",)]


@pytest.mark.parametrize("zone", ["UTC", "America/Mexico_City"])
def test_offsets(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(
            [("2025-01-01T22:00:00.000-06:00",), ("2025-01-01",), ("2025-01-01 10:30:00",), ("2025-01-01T01:00:00Z",),
             ("bad",), (None,)],
            "c string",
        )
        got = df.select(
            dates.to_stamp("c", "utc").cast("string"), dates.to_stamp("c", "wall").cast("string"),
            dates.to_date("c").cast("string"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [tuple(r) for r in got] == [
        ("2025-01-02 04:00:00", "2025-01-01 22:00:00", "2025-01-01"),
        ("2025-01-01 00:00:00", "2025-01-01 00:00:00", "2025-01-01"),
        ("2025-01-01 10:30:00", "2025-01-01 10:30:00", "2025-01-01"),
        ("2025-01-01 01:00:00", "2025-01-01 01:00:00", "2025-01-01"),
        (None, None, None),
        (None, None, None),
    ]


def test_periods(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2021, 1, 3),), (None,)], "d date")
    styles = ("english", "spanish", "year_month", "number")
    got = df.select(dates.iso_week("d"), *[dates.month("d", s) for s in styles]).collect()
    assert [tuple(r) for r in got] == [
        (1, "December", "Diciembre", "2024-12", 12),
        (53, "January", "Enero", "2021-01", 1),
        (None, None, None, None, None),
    ]
    with pytest.raises(ValueError):
        dates.month("d", "roman")


def test_labels(spark):
    df = spark.createDataFrame(
        [("Y", "never approved ", " "), ("P", "CANCELLED", "u"), ("N", "Approved", None), ("?", None, ""),
         (None, "NEVER APPROVED", "u")],
        "flag string, approval string, uuid string",
    )
    got = df.select(
        text.payment_status("flag"), text.payment_status("flag", "DESCONOCIDO"), text.approval_2way("approval"),
        text.approval_2way("approval", trim=False), text.approval_3way("approval"), text.uuid_check("uuid"),
    ).collect()
    missing = "⚠️ FALTA UUID"
    assert [tuple(r) for r in got] == [
        ("PAGADO", "PAGADO", "NO VALIDADO", "VALIDADO", "NO VALIDADO", missing),
        ("PARCIAL", "PARCIAL", "VALIDADO", "VALIDADO", "CANCELADO", "OK"),
        ("PENDIENTE", "PENDIENTE", "VALIDADO", "VALIDADO", "VALIDADO", missing),
        ("PENDIENTE", "DESCONOCIDO", "VALIDADO", "VALIDADO", "NO VALIDADO", missing),
        ("PENDIENTE", "DESCONOCIDO", "NO VALIDADO", "NO VALIDADO", "NO VALIDADO", "OK"),
    ]


def test_accounts(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(text.account_string(["x", "y", "z"], "-")).first()[0] == "a--c"
    df = spark.createDataFrame([("a-b-c-d-5010-f",), ("a-b",), ("----",), (None,)], "c string")
    assert [r[0] for r in df.select(text.segment("c", 5)).collect()] == ["5010", "", "", ""]


def test_display(spark):
    df = spark.createDataFrame(
        [(D("-1234567.5"), D("18.123456"), dt.date(2025, 3, 9), "x"), (None, None, None, None)],
        "m decimal(18,2), r decimal(18,6), d date, t string",
    )
    got = [tuple(r) for r in text.presentation(df, "$").collect()]
    assert got == [("-$1,234,567.50", "18.1235", "09/03/2025", "x"), (None, None, None, None)]


def test_numbers(spark):
    df = spark.createDataFrame([("12.345",), (" 7 ",), ("1,000.5",), ("",), (None,)], "c string")
    got = [r[0] for r in df.select(numbers.to_number("c")).collect()]
    assert got == [D("12.35"), D("7.00"), None, None, None]
    df = spark.createDataFrame([(D("0"),), (None,), (D("18.5"),)], "r decimal(18,6)")
    got = df.select(numbers.rate_or_one("r"), numbers.rate_or_one("r", zero_is_one=False)).collect()
    assert [tuple(map(float, r)) for r in got] == [(1.0, 0.0), (1.0, 1.0), (18.5, 18.5)]


def test_scan_since_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select timestamp_ntz'2025-01-01 00:00:00' as CREATION_DATE, 1 as a, 2 as b").write.parquet(path)
    df = files.scan_since(spark.read.parquet(path), "CREATION_DATE", "2025-01-01").select("a", "CREATION_DATE")
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(CREATION_DATE" in plan
    assert "b:int" not in plan


def test_schema_and_peek(spark):
    df = spark.createDataFrame([("1", "2")], "INVOICE_ID string, NUEVA string")
    got = rows(files.describe_schema(df, "requisitions", spec.REQUISITIONS))
    assert got == [("requisitions", 0, "INVOICE_ID", "string", True), ("requisitions", 1, "NUEVA", "string", False)]
    assert files.peek(df.union(df).union(df).union(df)).count() == 3


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_report_sink(spark, tmp_path, fmt):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1.5, "a"), (float("nan"), "b")], "`IMPORTE MXN` double, EMPRESA string")
    sinks.write_report(df, path, fmt)
    back = spark.read.option("header", "true").format(fmt).load(path)
    assert back.columns == ["IMPORTE MXN", "EMPRESA"]
    assert back.where(F.col("IMPORTE MXN").isNull()).count() == 1
    with pytest.raises(AnalysisException):
        sinks.write_report(df, path, fmt)


# ---- CSV split between tasks ---------------------------------------------------


@pytest.fixture
def small_blocks(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "300")
    yield
    spark.conf.set(name, before)


def cell(draw):
    kind = draw.randrange(8)
    if kind == 0:
        return ""
    text = "".join(draw.choice(["a", "é", "1", " ", ",", '"', "\n", "\r\n", "x y"]) for _ in range(draw.randrange(1, 9)))
    if kind < 4:
        text = text.replace('"', "").replace(",", "").replace("\r", "").replace("\n", "")
        return text if kind < 3 else f'"{text}"'
    return '"' + text.replace('"', '""') + '"'


def csv_text(seed, rows, end):
    draw = random.Random(seed)
    lines = ["k," + ",".join(cell(draw) for _ in range(3)) for _ in range(rows)]
    head = '"id","na\nme",note,"a,b"'
    blank = lambda: end * (draw.random() < 0.05)
    return end.join([head, *(blank() + line for line in lines)]) + (end if seed % 2 else "")


def as_text(df):
    return sorted(tuple(r) for r in df.na.fill("<null>").collect())


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\n"), (3, "\r\n"), (4, "\r\n"), (5, "\n")])
def test_split_files_equal_whole_ones(spark, tmp_path, small_blocks, seed, end):
    for number in range(3):
        # a header of several lines, or of a single one: the whole read takes its line end from the first break it meets
        text = csv_text(seed * 10 + number, 60 * number, end)
        (tmp_path / f"{number}.csv").write_bytes(text.encode() if seed < 3 else text.replace("na\nme", "name").encode())
    path = str(tmp_path)
    split, whole = files.read_csv(spark, path), files.read_csv(spark, path, "free")
    assert csv_scan.lines(spark, path).rdd.getNumPartitions() > 10
    assert split.columns == whole.columns
    assert as_text(split) == as_text(whole) and split.count() == whole.count() == 180


def test_split_records_span_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f"line {i}, with a \"quote\"" for i in range(200))
    text = "a,b\n1," + '"' + long.replace('"', '""') + '"\n2,"x"\n\n3,\n'
    (tmp_path / "long.csv").write_text(text)
    found = files.read_csv(spark, str(tmp_path / "long.csv"))
    assert as_text(found) == [("1", long), ("2", "x"), ("3", "<null>")]


@pytest.mark.parametrize("text,message", [
    ('a,b\n1,5" pipe\n2,"x"\n', "never closed"),
    ('a,b\n1,5" pipe\n2,6" pipe\n', "no record"),
    ('a,b\n1,"open\n2,x\n', "never closed"),
])
def test_stray_quotes_fail_the_split_read(spark, tmp_path, text, message):
    (tmp_path / "stray.csv").write_text(text)
    with pytest.raises(Exception, match=message):
        files.read_csv(spark, str(tmp_path / "stray.csv")).count()
    assert files.read_csv(spark, str(tmp_path / "stray.csv"), "free").count() >= 1


def test_split_read_of_headers_alone_and_nothing(spark, tmp_path):
    (tmp_path / "head.csv").write_text("a,b\n")
    (tmp_path / "nothing.csv").write_text("")
    assert files.read_csv(spark, str(tmp_path / "head.csv")).columns == ["a", "b"]
    assert files.read_csv(spark, str(tmp_path / "head.csv")).count() == 0
    assert files.read_csv(spark, str(tmp_path / "nothing.csv")).columns == []
    with pytest.raises(ValueError, match="cells must be"):
        files.read_csv(spark, str(tmp_path / "head.csv"), "any")


def test_split_read_shuffles_single_lines_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    plan = files.read_csv(spark, str(tmp_path / "a.csv"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
