"""States of parts add up to the summary of the whole, and corrections take the place of what was said before."""

from __future__ import annotations

import datetime as dt
import random
import re
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cuadre.catalog import queries
from cuadre.operators import profile, summaries
from cuadre.session import SHUFFLE_FILES_GO
from tests.conftest import rows

SCHEMA = (
    "INVOICE_ID int, PAYMENT_NUM int, PROVEEDOR string, IMPORTE_BRUTO_USD decimal(18,2), IMPORTE_MXN decimal(18,2),"
    " NUM_PAGO string, SALDO_USD decimal(18,2), SALDO_MXN_CALC decimal(18,2), FECHA date"
)


def report_rows(draw, invoices):
    made = []
    for invoice in invoices:
        day = draw.choice([None, *(dt.date(2026, 1, d) for d in range(1, 5))])
        supplier = draw.choice([None, "", "a", "b", "c"])
        for number in draw.choice([[None], [1], [1, 2]]):
            due = draw.choice([None, Decimal(draw.randrange(-500, 900)) / 4])
            for _ in range(draw.choice([1, 1, 3])):
                cells = [draw.choice([None, Decimal(draw.randrange(-3, 4))]) for _ in range(2)]
                made.append((invoice, number, supplier, due, due, draw.choice([None, "p"]), *cells, day))
    return made


def frame(spark, made):
    return spark.createDataFrame(made, SCHEMA)


@pytest.mark.parametrize("seed", range(4))
def test_parts_add_up(spark, seed):
    draw = random.Random(seed)
    whole = report_rows(draw, [None, *range(30)])
    parts = [[], [], []]
    for row in whole:
        draw.choice(parts[:2]).append(row)
    found = summaries.merged(*[summaries.states(frame(spark, p)) for p in parts])
    assert found.dtypes == summaries.states(frame(spark, whole)).dtypes
    assert rows(found) == rows(summaries.states(frame(spark, whole)))
    assert rows(summaries.summary(found)) == rows(profile.report_summary(frame(spark, whole)))


@pytest.mark.parametrize("seed", range(4))
def test_corrections(spark, seed):
    draw = random.Random(seed)
    first, second, third = (report_rows(draw, ids) for ids in ([None, *range(20)], [None, 3, 4, 25], [4, 5]))
    gone = [7, 25]
    told = {}
    for part in (first, second, third):
        for invoice in {r[0] for r in part}:
            told[invoice] = [r for r in part if r[0] == invoice]
    now = [r for invoice, of in told.items() if invoice not in gone for r in of]
    states = [summaries.states(frame(spark, p)) for p in (first, second, third)]
    gone = spark.createDataFrame([(i,) for i in gone], "INVOICE_ID int")
    found = summaries.corrected(*states, gone=gone)
    assert rows(found) == rows(summaries.states(frame(spark, now)))
    assert rows(summaries.summary(found)) == rows(profile.report_summary(frame(spark, now)))


def test_a_schedule_whose_rows_have_two_days_counts_once(spark):
    made = [(1, 1, "a", Decimal(5), None, None, None, None, dt.date(2026, 1, d)) for d in (1, 2)]
    found = summaries.summary(summaries.states(frame(spark, made))).first()
    assert (found["total_usd"], found["row_total_usd"], found["invoice_count"]) == (5, 10, 1)


def test_no_rows(spark):
    none = summaries.states(frame(spark, []))
    expected = rows(profile.report_summary(frame(spark, [])))
    assert rows(summaries.summary(summaries.merged(none, none))) == rows(summaries.summary_of_days(summaries.by_day(none))) == expected
    with pytest.raises(ValueError, match="no state"):
        summaries.merged()


def test_days(spark):
    """Sums of days are exact; their sets are within three deviations, and an invoice of several days counts once."""
    n = 20_000
    made = spark.range(2 * n).select(
        F.expr(f"cast(id % {n} as int) AS INVOICE_ID"), F.expr("1 AS PAYMENT_NUM"),
        F.expr(f"case when id % 10 > 0 then concat('s', id % {n} % 7001) end AS PROVEEDOR"),
        F.expr("cast(id % 100 as decimal(18,2)) AS IMPORTE_BRUTO_USD"), F.expr("cast(null as decimal(18,2)) AS IMPORTE_MXN"),
        F.expr("'p' AS NUM_PAGO"), F.expr("cast(1 as decimal(18,2)) AS SALDO_USD"), F.expr("cast(0 as decimal(18,2)) AS SALDO_MXN_CALC"),
        F.expr("date_add(date'2026-01-01', cast(id % 40 as int)) AS FECHA"),
    )
    days = summaries.by_day(summaries.states(made))
    assert days.count() == 40
    halves = days.where(F.dayofmonth(summaries.DAY) <= 15), days.where(F.dayofmonth(summaries.DAY) > 15)
    found, expected = summaries.summary_of_days(*halves).first().asDict(), profile.report_summary(made).first().asDict()
    for c in ("invoice_count", "supplier_count"):
        assert abs(found.pop(c) / expected.pop(c) - 1) < 0.05
    # each of its days has the amount of such a schedule
    found.pop("total_usd"), expected.pop("total_usd")
    assert found == expected


def test_profile_while_writing(spark, tmp_path):
    n = 30_000
    df = spark.range(n).select(
        "id", F.expr("id % 7 AS few"), F.expr("case when id % 3 > 0 then concat('t', id % 5000) end AS `some text`"),
        F.expr("cast(null as date) AS none"), F.expr("cast(id as decimal(18,2)) / 3 AS ratio"),
    )
    along = profile.WhileWriting(df)
    along.rows.write.parquet(f"{tmp_path}/out")
    found = {r["column_name"]: r for r in along.profile().collect()}
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(df)
    assert list(found) == df.columns
    for expected in profile.profile(df).collect():
        got = found[expected["column_name"]]
        assert got[:4] == expected[:4]
        assert abs(got["distinct_count"] / expected["distinct_count"] - 1) < 0.05
    assert (found["few"]["distinct_count"], found["none"]["distinct_count"]) == (7, 1)


def test_profile_of_no_rows(spark, tmp_path):
    along = profile.WhileWriting(spark.range(0))
    along.rows.write.parquet(f"{tmp_path}/out")
    assert rows(along.profile()) == rows(profile.profile(spark.range(0))) == []


def test_report_is_landed_in_the_columns_of_its_states(spark, monkeypatch):
    """All rows are stored, but not lists and accounts that no state reads."""
    landed = []

    def write(df, path, **options):
        landed.append(df.columns)
        df.write.parquet(path)

    monkeypatch.setattr(queries.sinks, "write_report", write)
    report = spark.sql("SELECT 1 INVOICE_ID, 2 PAYMENT_NUM, 'P' PROVEEDOR, DATE'2026-01-01' FECHA, 1.5BD IMPORTE_BRUTO_USD, "
                       "2.5BD IMPORTE_MXN, 'N' NUM_PAGO, 1BD SALDO_USD, 2BD SALDO_MXN_CALC, 'long, list' ERS, 'A' CUENTA")
    (state,) = queries._landed_states(report, F.lit(True))
    assert landed[0] == ["INVOICE_ID", "PAYMENT_NUM", *summaries.READ] and "ERS" not in landed[0]
    assert rows(state) == rows(summaries.states(report))


def test_landed_states_leave_no_shuffle_files(spark):
    """A job of several writes needs no room for the shuffles of those that have ended."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    whole = report_rows(random.Random(7), range(30))

    def left():
        return {b for b in re.findall(r"shuffle_\d+_\d+_\d+", blocks.getAllBlocks().mkString(" "))}

    before = left()
    queries._landed_states(frame(spark, whole).repartition(4, "INVOICE_ID"), F.lit(True))
    for _ in range(50):
        if not left() - before:
            break
        time.sleep(0.1)
    assert not left() - before
    assert spark.conf.get(SHUFFLE_FILES_GO, None) != "true"
