"""Reports over hand-made relations, and properties over the mapped data."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cuadre.catalog.mapping import relations
from cuadre.catalog.queries import QUERIES
from cuadre.operators import aggregates as agg
from cuadre.operators import joins
from cuadre.operators.columns import ensure_money, reindex, select_ordered, select_present
from cuadre.plans import reports
from cuadre.sources import spec
from cuadre.sources.files import conform, empty
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"
DAY = dt.date(2025, 1, 6)
STAMP = dt.datetime(2025, 1, 6)


def frame(spark, relation, *records):
    """Rows given as dicts over a relation's schema, NULL where not given."""
    data = [tuple(r.get(c) for c in relation.columns) for r in records]
    return spark.createDataFrame(data, relation.schema)


@pytest.fixture(scope="module")
def v1(spark):
    return dict(
        invoices=frame(
            spark,
            spec.INVOICES_V1,
            dict(INVOICE_ID="1", FACTURA="A", IMPORTE=D(1160), FECHA=DAY, ESTATUS_PAGO="P",
                 CUENTA_GASTO="1-2-3-4-501-6", ESTATUS_APROBACION="NEVER APPROVED"),
            dict(INVOICE_ID="2", FACTURA="B", IMPORTE=D(50)),
            dict(INVOICE_ID=None, FACTURA="C", IMPORTE=D(9), ESTATUS_PAGO="Y"),
        ),
        tax_lines=frame(
            spark,
            spec.TAX_LINES_V1,
            dict(INVOICE_ID="1", TAX_RATE=D(16), TAX_AMT=D(160), TIPO_LINEA="TAX", CODIGO_IMPUESTO="IVA16"),
            dict(INVOICE_ID="1", TAX_RATE=D(4), TAX_AMT=D(-40), TIPO_LINEA="AWT", CODIGO_IMPUESTO="RET_ISR_4"),
            dict(INVOICE_ID=None, TAX_RATE=D(16), TAX_AMT=D(999), TIPO_LINEA="TAX", CODIGO_IMPUESTO="IVA16"),
        ),
        payments=frame(
            spark,
            spec.PAYMENTS_V1,
            dict(INVOICE_ID="1", NUM_PAGO="10", FECHA_PAGO=DAY, IMPORTE_PAGO=D(100), TC_PAGO=D(0)),
            dict(INVOICE_ID="1", NUM_PAGO="11", FECHA_PAGO=dt.date(2025, 1, 1), IMPORTE_PAGO=D(200), TC_PAGO=D("18.5")),
            dict(INVOICE_ID=None, NUM_PAGO="12", IMPORTE_PAGO=D(7)),
        ),
        requisitions=frame(
            spark,
            spec.REQUISITIONS,
            *[dict(INVOICE_ID="1", REQUISITION_NUMBER=n) for n in ("R2", "R1", "R3")],
        ),
    )


def test_master_rows_and_amounts(spark, v1):
    report = reports.report_master("code", **v1)
    assert report.columns == spec.MASTER_COLUMNS
    got = rows(report.where("FACTURA = 'A'"), "NUM_PAGO", "REQUISITION_NUMBER", "SUBTOTAL", "SALDO", "SALDO MXN", "ESTATUS")
    # 2 payments x 3 requisitions; a zero rate counts as 1
    assert len(got) == 6
    assert got[0] == ("10", "R1", D(1040), D(1060), D(1060), "PARCIAL")
    assert got[3] == ("11", "R1", D(1040), D(960), D(17760), "PARCIAL")
    # no taxes, no payments; and a missing key matches nothing
    rest = rows(report.where("FACTURA <> 'A'"), "FACTURA", "IVA", "IMPORTE_PAGO", "SUBTOTAL", "NUM_PAGO", "ESTATUS")
    assert rest == [("B", D(0), D(0), D(50), None, "PENDIENTE"), ("C", D(0), D(0), D(9), None, "PAGADO")]


def test_master_by_rate_keeps_zero_rate_and_missing_payment(spark, v1):
    report = reports.report_master("rate", **v1)
    got = rows(report.dropDuplicates(["FACTURA", "NUM_PAGO"]), "NUM_PAGO", "SUBTOTAL", "IMPORTE MXN", "IMPORTE_PAGO")
    assert got == [
        (None, D(50), D(50), None), (None, D(9), D(9), None), ("10", D(1000), D(0), D(100)), ("11", D(1000), D(21460), D(200)),
    ]


def test_filled_rate(spark, v1):
    plain = reports.report_master("code", **v1)
    filled = reports.report_master("code", **v1, fill_rate=True)
    assert plain.where("FACTURA = 'B'").first()["TC_PAGO"] is None
    assert filled.where("FACTURA = 'B'").first()["TC_PAGO"] == D(1)


def test_master_by_account(spark, v1):
    chart = frame(spark, spec.CHART_OF_ACCOUNTS, dict(CUENTA_NUM="501", CUENTA_DESCRIPCION="FLETES"))
    report = reports.report_master("account", **v1, chart=chart)
    assert report.columns == spec.ACCOUNT_MASTER_COLUMNS
    got = rows(report, "FACTURA", "CUENTA_GASTO", "NUM_PAGO", "REQUISITION_NUMBER", "MES", "SEMANA", "ESTATUS_APROBACION")
    assert got == [
        ("A", "501 - FLETES", "11", "R1", "Enero", 2, "NO VALIDADO"),
        ("B", " - DESC NO ENCONTRADA", None, None, None, None, "VALIDADO"),
        ("C", " - DESC NO ENCONTRADA", None, None, None, None, "VALIDADO"),
    ]
    bare = reports.report_master("account", **v1)
    assert bare.where("FACTURA = 'A'").first()["CUENTA_GASTO"] == "1-2-3-4-501-6"


def test_payment_flag_names(spark, v1):
    flagged = v1["invoices"].withColumnRenamed("ESTATUS_PAGO", "ESTATUS")
    absent = v1["invoices"].drop("ESTATUS_PAGO")
    for invoices, expected in ((flagged, {"PARCIAL", "PENDIENTE", "PAGADO"}), (absent, {"PENDIENTE"})):
        report = reports.report_master("code", **{**v1, "invoices": invoices})
        assert {r[0] for r in report.select("ESTATUS").distinct().collect()} == expected


def test_absent_inputs_are_empty_relations(spark, v1):
    report = reports.report_master(
        "code", v1["invoices"], empty(spark, spec.TAX_LINES_V1), empty(spark, spec.PAYMENTS_V1), empty(spark, spec.REQUISITIONS)
    )
    assert report.columns == spec.MASTER_COLUMNS
    assert rows(report, "FACTURA", "SALDO", "IVA") == [("A", D(1160), D(0)), ("B", D(50), D(0)), ("C", D(9), D(0))]
    assert reports.report_master("code", **{**v1, "invoices": empty(spark, spec.INVOICES_V1)}).count() == 0


def test_unknown_variant(spark, v1):
    with pytest.raises(ValueError):
        reports.report_master("other", **v1)


def test_salting_does_not_change_reports(spark, v1):
    for variant in ("rate", "code"):
        salted = reports.report_master(variant, **v1, cell_rows=1)
        assert rows(salted) == rows(reports.report_master(variant, **v1))


def test_net_payable(spark, v1):
    invoices = frame(
        spark,
        spec.INVOICES_NET,
        dict(INVOICE_ID="1", FACTURA="A", TOTAL_FACTURA="1160.00", ESTATUS_PAGO="?", UUID=" "),
        dict(INVOICE_ID="2", FACTURA="B", TOTAL_FACTURA="1,000.5", ESTATUS_PAGO="Y", UUID="u"),
    )
    report = reports.report_net_payable(invoices, v1["tax_lines"], v1["requisitions"])
    assert report.columns == spec.NET_PAYABLE_COLUMNS
    got = rows(report.drop("REQUISITION_NUMBER").distinct(), "FACTURA", "NETO_A_PAGAR", "ESTATUS_PAGO", "VALIDACION_UUID")
    assert got == [("A", D(1120), "DESCONOCIDO", "⚠️ FALTA UUID"), ("B", D(0), "PAGADO", "OK")]
    # an extract without a column gives a report without it
    assert "VALIDACION_UUID" not in reports.report_net_payable(invoices.drop("UUID"), v1["tax_lines"], v1["requisitions"]).columns


def test_historical_rates(spark):
    rates = frame(
        spark,
        spec.DAILY_RATES,
        *[dict(FECHA_TASA=DAY, FROM_CURRENCY="USD", TO_CURRENCY="MXN", CONVERSION_RATE=D(r)) for r in ("18.1", "18.5")],
        dict(FECHA_TASA=DAY, FROM_CURRENCY="EUR", TO_CURRENCY="MXN", CONVERSION_RATE=D(99)),
    )
    invoices = frame(
        spark,
        spec.FLOW_INVOICES,
        dict(INVOICE_ID="1", INVOICE_DATE="2025-01-06T00:00:00", INVOICE_AMOUNT="100", INVOICE_CURRENCY_CODE="usd"),
        dict(INVOICE_ID="2", INVOICE_DATE="2025-01-07", INVOICE_AMOUNT="10", INVOICE_CURRENCY_CODE="USD"),
        dict(INVOICE_ID="3", INVOICE_DATE="2025-01-06", INVOICE_AMOUNT="bad", INVOICE_CURRENCY_CODE=None),
    )
    payments = frame(
        spark,
        spec.FLOW_PAYMENTS,
        dict(INVOICE_ID="1", ACCOUNTING_DATE="2025-01-06", AMOUNT="40"),
        dict(INVOICE_ID="1", ACCOUNTING_DATE="2025-02-01", AMOUNT="60"),
    )
    report = reports.report_historical_fx(invoices, payments, rates)
    got = rows(report, "INVOICE_ID", "IMPORTE_FACTURA_MXN", "AMOUNT", "IMPORTE_PAGO_MXN", "RATE_MISSING")
    assert got == [
        ("1", D(1850), D(40), D(740), False),
        ("1", D(1850), D(60), D(60), True),
        ("2", D(10), D(0), D(0), True),
        ("3", D(0), D(0), D(0), False),
    ]
    # payment columns that repeat an invoice column keep both
    clash = payments.withColumn("INVOICE_AMOUNT", F.lit("1"))
    assert "INVOICE_AMOUNT_PAGO" in reports.report_historical_fx(invoices, clash, rates).columns


@pytest.fixture(scope="module")
def v2(spark):
    return dict(
        invoices=frame(
            spark,
            spec.INVOICES_V2,
            dict(INVOICE_ID="1", FACTURA="A", INVOICE_AMOUNT=D(100), TOTAL_TAX_AMOUNT=D(16), MONEDA="usd",
                 TIPO_CAMBIO_FACTURA=D(20), FECHA=STAMP, ORDEN_COMPRA="PO1", INCOME_TAX_ID="X1", ESTATUS="Cancelled "),
            dict(INVOICE_ID="2", FACTURA="B", INVOICE_AMOUNT=D(100), MONEDA=None, ORDEN_COMPRA=None),
            dict(INVOICE_ID="3", FACTURA="C", INVOICE_AMOUNT=D(10), MONEDA="EUR", ORDEN_COMPRA="PO1", ESTATUS="OK"),
        ),
        schedules=frame(
            spark,
            spec.SCHEDULES,
            dict(INVOICE_ID="1", PAYMENT_NUM=1, IMPORTE_BRUTO_USD=D(60), SALDO_USD=D(5)),
            dict(INVOICE_ID="1", PAYMENT_NUM=2, IMPORTE_BRUTO_USD=D(40), SALDO_USD=D(0)),
            dict(INVOICE_ID="2", PAYMENT_NUM=1, IMPORTE_BRUTO_USD=D(100), SALDO_USD=D(7)),
            dict(INVOICE_ID="3", PAYMENT_NUM=1, IMPORTE_BRUTO_USD=D(10), SALDO_USD=D(7)),
        ),
        payments=frame(
            spark,
            spec.PAYMENTS_V2,
            dict(INVOICE_ID="1", NUM_PAGO="10", IMPORTE_PAGO_USD=D(30), MONEDA_PAGO="USD", FECHA_APLICACION=STAMP),
            dict(INVOICE_ID="1", NUM_PAGO="11", IMPORTE_PAGO_USD=D(50), MONEDA_PAGO=None, TIPO_CAMBIO_PAGO=D(19)),
            dict(INVOICE_ID="2", NUM_PAGO="12", IMPORTE_PAGO_USD=D(5), MONEDA_PAGO="usd", TIPO_CAMBIO_PAGO=D(19)),
            dict(INVOICE_ID="3", NUM_PAGO="13", IMPORTE_PAGO_USD=D(5), MONEDA_PAGO="EUR", TIPO_CAMBIO_PAGO=D(19)),
        ),
        distributions=frame(
            spark,
            spec.DISTRIBUTIONS,
            *[
                dict(INVOICE_ID="1", DISTRIBUTION_LINE_NUMBER=i, CUENTA_CONTABLE_GASTO=f"c{5 - i}", DESCRIPTION=d)
                for i, d in enumerate((None, "first", "second", "third", None))
            ],
        ),
        taxes=frame(
            spark,
            spec.TAXES_V2,
            dict(INVOICE_ID="1", TAX_TYPE_CODE="IVA", IMPUESTO_MXN=D(320)),
            dict(INVOICE_ID="1", TAX_TYPE_CODE="ISR_4", TIPO_IMPUESTO="RETENCION_ISR", IMPUESTO_MXN=D(-5)),
        ),
        prepay_ers=frame(
            spark,
            spec.PREPAY_ERS,
            dict(INVOICE_ID="1", ADELANTO_USD=D(3), TIPO_ORIGEN="PREPAYMENT"),
            dict(INVOICE_ID="1", ADELANTO_USD=D(4), TIPO_ORIGEN="PREPAYMENT"),
            dict(ERS="R1", ORDEN_COMPRA="PO1", TIPO_ORIGEN="ERS", FECHA_APLICACION=STAMP),
            dict(ERS="R2", ORDEN_COMPRA="PO1", TIPO_ORIGEN="ERS", FECHA_APLICACION=dt.datetime(2025, 2, 1)),
            dict(ERS="R9", ORDEN_COMPRA=None, TIPO_ORIGEN="ERS"),
        ),
    )


def test_schedule_payment(spark, v2):
    report = reports.report_schedule_payment(**v2)
    assert report.columns == spec.SCHEDULE_PAYMENT_COLUMNS
    got = rows(
        report, "FACTURA", "NUM_PAGO", "IMPORTE_BRUTO_USD", "IMPORTE_MXN", "IMPORTE_PAGO_USD", "IMPORTE_PAGO_MXN", "SUBTOTAL_MXN"
    )
    assert got == [
        ("A", "10", D(40), D(800), D(30), D(600), D(1680)),
        ("A", "10", D(60), D(1200), D(30), D(600), D(1680)),
        ("A", "11", D(40), D(800), D(0), D(50), D(1680)),
        ("A", "11", D(60), D(1200), D(0), D(50), D(1680)),
        ("B", "12", D(0), D(100), D(5), D(95), D(100)),
        ("C", "13", D(0), D(0), D(0), D(0), D(10)),
    ]
    one = report.where("FACTURA = 'A' and NUM_PAGO = '10' and SALDO_USD = 5").first()
    assert one["ERS"] == "R2 | R1"
    assert one["CUENTA_CONTABLE_GASTO"] == "c5 | c4 | c3"
    assert one["DESCRIPTION"] == "first"
    assert (one["IVA_MXN"], one["RETENCION_ISR_MXN"], one["RETENCION_ISR_4_MXN"]) == (D(320), D(-5), D(0))
    assert (one["ADELANTO_USD"], one["ADELANTO_MXN"]) == (D(7), D(140))
    assert (one["RFC"], one["ESTATUS"], one["MES"], one["SEMANA"], one["MES_PAGO"]) == ("X1", "CANCELADO", "2025-01", 2, "2025-01")
    other = report.where("FACTURA = 'B'").first()
    assert (other["ERS"], other["IVA_MXN"], other["MES"], other["ESTATUS"]) == (None, None, None, "NO VALIDADO")


def test_receipts_as_rows(spark, v2):
    report = reports.report_schedule_payment(**v2, lists="rows", keep_key=True)
    cells = reports.report_schedule_payment(**v2, keep_key=True)
    assert "ERS" not in report.columns and report.columns[7] == "ORDEN_COMPRA"
    receipts = agg.receipt_values(v2["prepay_ers"]).groupBy("ORDEN_COMPRA").agg(F.count("value").alias("n"))
    joined = report.select("INVOICE_ID", "ORDEN_COMPRA").distinct().join(receipts, "ORDEN_COMPRA", "left")
    want = {r["INVOICE_ID"]: len(r["ERS"].split(" | ")) if r["ERS"] else 0 for r in cells.select("INVOICE_ID", "ERS").collect()}
    assert {r["INVOICE_ID"]: r["n"] or 0 for r in joined.collect()} == want
    with pytest.raises(ValueError):
        reports.report_schedule_payment(**v2, lists="none")


def test_an_account_twice_in_the_chart_does_not_multiply_invoices(spark):
    invoices = frame(spark, spec.INVOICES_V1, dict(INVOICE_ID="1", CUENTA_GASTO="1-2-3-4-501"))
    chart = frame(spark, spec.CHART_OF_ACCOUNTS, *[dict(CUENTA_NUM="501", CUENTA_DESCRIPCION=d) for d in ("b", "a")])
    assert rows(joins.with_account_description(invoices, chart), "CUENTA_GASTO_FULL") == [("501 - a",)]


def test_an_absurd_rate_does_not_stop_a_report(spark):
    from cuadre.functions import measures

    df = spark.createDataFrame([(D(10) ** 15, D(10) ** 11), (D(2), D(3))], "a decimal(18,2), r decimal(18,6)")
    assert rows(measures.to_mxn(df, ["a"], F.col("r")), "a MXN") == [(None,), (D(6),)]


def test_schedule_payment_salted(spark, v2):
    salted = reports.report_schedule_payment(**v2, cell_rows=1)
    assert rows(salted) == rows(reports.report_schedule_payment(**v2))


def test_summary(spark, v2):
    from cuadre.operators.profile import report_summary

    got = report_summary(reports.report_schedule_payment(**v2, keep_key=True)).first().asDict()
    assert (got["row_count"], got["invoice_count"], got["paid_rows"]) == (6, 3, 6)
    assert (got["pending_usd"], got["pending_any"]) == (2, 3)
    # two payments repeat the one schedule in USD
    assert (got["total_usd"], got["row_total_usd"]) == (D(100), D(200))


def test_summary_of_large_and_of_no_amounts(spark):
    from cuadre.operators.profile import report_summary

    schema = (
        "INVOICE_ID int, PAYMENT_NUM int, PROVEEDOR string, IMPORTE_BRUTO_USD decimal(18,2), IMPORTE_MXN decimal(18,2),"
        " NUM_PAGO string, SALDO_USD decimal(18,2), SALDO_MXN_CALC decimal(18,2), FECHA date"
    )
    big = D(9_000_000_000_000_000)
    rows_ = [(1, 1, "a", big, None, "p", D(1), None, None), (1, 2, "a", big, None, None, None, D(1), None), (2, None, None, None, None, None, None, None, None)]
    got = report_summary(spark.createDataFrame(rows_, schema)).first()
    assert (got["total_usd"], got["total_mxn"], got["invoice_count"], got["supplier_count"]) == (2 * big, None, 2, 1)
    none = report_summary(spark.createDataFrame([], schema)).collect()
    assert len(none) == 1 and none[0]["row_count"] == none[0]["invoice_count"] == 0


def test_invoice_v4(spark):
    invoices = frame(
        spark,
        spec.INVOICES_V4,
        dict(INVOICE_ID="1", FACTURA="A", IMPORTE=D(1000), FECHA=STAMP, MONEDA="MXN", ORDEN_COMPRA="mine"),
        dict(INVOICE_ID="2", FACTURA="B", IMPORTE=D(10)),
    )
    taxes = frame(spark, spec.TAXES_V4, dict(INVOICE_ID="1", CLASIFICACION_IMPUESTO="IVA", IMPUESTO_USD=D(160)))
    held = frame(
        spark,
        spec.WITHHOLDING,
        dict(INVOICE_ID="1", CLASIFICACION_RETENCION="RET_ISR_4", RETENCION_USD=D(-40)),
        dict(INVOICE_ID="1", CLASIFICACION_RETENCION="RET_IVA_6", RETENCION_USD=D(-60)),
    )
    payments = frame(
        spark,
        spec.PAYMENTS_V4,
        dict(INVOICE_ID="1", NUM_PAGO="8", IMPORTE_PAGO_USD=D(100), FECHA_APLICACION=STAMP, FECHA_PAGO=STAMP, DESCRIPTION="p"),
        dict(INVOICE_ID="1", NUM_PAGO="9", IMPORTE_PAGO_USD=D(50), FECHA_APLICACION=dt.datetime(2025, 3, 1)),
    )
    prepaid = frame(
        spark,
        spec.PREPAY_ERS_V4,
        dict(INVOICE_ID="1", ADELANTO_USD=D(7), MONEDA="USD", TIPO_ORIGEN="PREPAYMENT", ORDEN_COMPRA="theirs"),
    )
    distributions = frame(spark, spec.DISTRIBUTIONS, dict(INVOICE_ID="1", DISTRIBUTION_LINE_NUMBER=1, DESCRIPTION="d"))
    args = (invoices, taxes, held, distributions, payments, prepaid)
    report = reports.report_invoice_v4(*args)
    assert len(set(report.columns)) == len(report.columns)
    assert "INVOICE_ID" not in report.columns
    listed = [spec.INVOICE_V4_RENAMES.get(c, c) for c in spec.INVOICE_V4_COLUMNS]
    assert report.columns[: len(listed)] == listed
    one = report.where("FACTURA = 'A'").first().asDict()
    # the 6% retention stays out unless asked for
    assert (one["SUBTOTAL"], one["TOTAL_RETENCIONES"], one["SALDO"]) == (D(880), D(-40), D(843))
    assert (one["NUM_PAGO"], one["DESCRIPTION"], one["MONEDA"], one["ORDEN_COMPRA"]) == ("9, 8", "d", "MXN", "mine")
    assert (one["MES"], one["SEMANA_PAGO"], one["FECHA_APLICACION"]) == (1, 2, dt.datetime(2025, 3, 1))
    other = report.where("FACTURA = 'B'").first().asDict()
    assert (other["SUBTOTAL"], other["SALDO"], other["IVA"], other["TOTAL_RETENCIONES"]) == (D(10), D(10), None, D(0))
    with_6 = reports.report_invoice_v4(*args, include_iva_6=True).where("FACTURA = 'A'").first()
    assert (with_6["SUBTOTAL"], with_6["TOTAL_RETENCIONES"]) == (D(940), D(-100))


def test_column_lists(spark):
    df = spark.sql("select 1 as b, 2 as a, 3 as `c d`")
    assert reindex(df, ["a", "z", "c d"]).columns == ["a", "z", "c d"]
    assert select_present(df, ["z", "c d", "a"]).columns == ["c d", "a"]
    assert select_ordered(df, ["a"]).columns == ["a", "b", "c d"]
    assert select_ordered(df, ["a"], keep_rest=False).columns == ["a"]
    got = ensure_money(spark.sql("select 'x' as p, cast(null as decimal(18,2)) as q"), ["p", "q", "r"], ["t"]).first()
    assert tuple(got) == (D(0), D(0), D(0), D(1))


# ---- properties over the mapped data -----------------------------------------


@pytest.fixture(scope="module")
def r(spark):
    return relations(spark, SF_DIR)


def test_one_row_per_invoice(spark, r):
    n = r["invoices_v1"].count()
    assert QUERIES["r3"](spark, SF_DIR).count() == n
    assert QUERIES["r7"](spark, SF_DIR).count() == n


def test_fan_out_row_count(spark, r):
    per = lambda df: df.groupBy("INVOICE_ID").count()
    expected = (
        r["invoices_v1"].select("INVOICE_ID")
        .join(per(r["payments_v1"]).withColumnRenamed("count", "p"), "INVOICE_ID", "left")
        .join(per(r["requisitions"]).withColumnRenamed("count", "q"), "INVOICE_ID", "left")
        .agg(F.sum(F.coalesce("p", F.lit(1)) * F.coalesce("q", F.lit(1))))
        .first()[0]
    )
    assert QUERIES["r2"](spark, SF_DIR).count() == expected


def test_pivot_total_is_input_total(spark, r):
    pivot = QUERIES["a1_tax_pivot"](spark, SF_DIR)
    total = pivot.agg(F.sum(sum(F.col(c) for c in spec.CLASSES_BY_CODE))).first()[0]
    assert total == r["tax_lines_v1"].agg(F.sum("TAX_AMT")).first()[0]


def test_mxn_rows_have_no_usd(spark):
    report = QUERIES["r6"](spark, SF_DIR).where("upper(coalesce(MONEDA, 'MXN')) = 'MXN'")
    assert report.where("SUBTOTAL_USD <> 0 or IMPORTE_BRUTO_USD <> 0 or SALDO_USD <> 0 or ADELANTO_USD <> 0").count() == 0


def test_balance_plus_paid_is_total(spark):
    assert QUERIES["r2"](spark, SF_DIR).where("SALDO + IMPORTE_PAGO <> IMPORTE").count() == 0


def test_conformed_relations_feed_the_reports(spark, r):
    names = {"payments_v4": "payments_v4", "prepay_ers": "prepay_ers_v4"}
    by_name = {s.name: s for s in vars(spec).values() if isinstance(s, spec.RelationSpec)}
    made = {n: conform(r[n], by_name[names.get(n, n)]) for n in
            ("taxes_v4", "withholding", "distributions", "payments_v4", "prepay_ers")}
    made["invoices"] = conform(r["invoices_v2"], spec.INVOICES_V4)
    report = reports.report_invoice_v4(
        made["invoices"], made["taxes_v4"], made["withholding"], made["distributions"], made["payments_v4"], made["prepay_ers"]
    )
    assert report.count() == r["invoices_v2"].count()
