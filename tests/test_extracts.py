"""Extracts over hand-made base tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from cuadre.plans import extracts
from tests.conftest import rows

NEW = dt.datetime(2025, 3, 1)
OLD = dt.datetime(2024, 12, 31, 23, 59)


def table(spark, schema: str, *data):
    return spark.createDataFrame(list(data), schema)


@pytest.fixture(scope="module")
def t(spark):
    segments = ", ".join(f"SEGMENT{i} string" for i in range(1, 10))
    invoice = (
        "INVOICE_ID int, INVOICE_NUM string, VENDOR_ID int, ORG_ID int, TERMS_ID int, SOURCE string, "
        "PAYMENT_STATUS_FLAG string, GLOBAL_ATTRIBUTE1 string, GLOBAL_ATTRIBUTE2 string, INVOICE_DATE timestamp_ntz, "
        "INVOICE_CURRENCY_CODE string, DESCRIPTION string, INVOICE_AMOUNT decimal(18,2), CREATION_DATE timestamp_ntz, "
        "ACCTS_PAY_CODE_COMBINATION_ID int, VOUCHER_NUM string, TOTAL_TAX_AMOUNT decimal(18,2), TERMS_DATE timestamp_ntz, "
        "EXCHANGE_RATE decimal(18,6), APPROVAL_STATUS string, INVOICE_TYPE_LOOKUP_CODE string"
    )

    def header(i, vendor=1, org=1, terms=1, created=NEW):
        return (i, f"F{i}", vendor, org, terms, "S", "Y", "G1", "G2", created, "MXN", "d", D(100), created, 7, "V", D(16),
                created, None, "OK", "STANDARD")

    return {
        "AP_INVOICES_ALL": table(spark, invoice, header(1), header(2, vendor=2), header(3, vendor=9), header(4, created=OLD)),
        "POZ_SUPPLIERS": table(spark, "VENDOR_ID int, SEGMENT1 string, PARTY_ID int", (1, "S1", 11), (2, "S2", 12)),
        "POZ_SUPPLIERS_V": table(
            spark, "VENDOR_ID int, SEGMENT1 string, VENDOR_NAME string, ORGANIZATION_TYPE_LOOKUP_CODE string",
            (1, "S1", "ONE", "C"), (2, "S2", "TWO", "C"),
        ),
        "HZ_PARTIES": table(spark, "PARTY_ID int, PARTY_NAME string", (11, "ONE"), (12, "TWO")),
        "POZ_SUPPLIERS_PII": table(spark, "VENDOR_ID int, INCOME_TAX_ID string", (1, "RFC1")),
        "HR_OPERATING_UNITS": table(spark, "ORGANIZATION_ID int, NAME string", (1, "MX")),
        "HR_ALL_ORGANIZATION_UNITS_F_VL": table(spark, "ORGANIZATION_ID int, NAME string", (1, "MX")),
        "AP_TERMS_LINES": table(spark, "TERM_ID int, DUE_DAYS int", (1, 30), (1, 60)),
        "GL_CODE_COMBINATIONS": table(
            spark, f"CODE_COMBINATION_ID int, {segments}",
            (7, "a", "b", None, "d", "2100", "f", "g", "h", "i"),
            (50, "z", "b", "c", "d", "501", "f", "g", "h", "i"),
            (60, "a", "b", "c", "d", "601", "f", "g", "h", "i"),
        ),
        "AP_INVOICE_LINES_ALL": table(
            spark,
            "INVOICE_ID int, PO_LINE_LOCATION_ID int, LINE_TYPE_LOOKUP_CODE string, TAX_RATE decimal(18,6), "
            "AMOUNT decimal(18,2), TAX_RATE_CODE string, CREATION_DATE timestamp_ntz",
            (1, 100, "ITEM", None, D(10), None, NEW), (1, 101, "ITEM", None, D(10), None, NEW),
            (1, 100, "ITEM", None, D(10), None, NEW), (2, 101, "TAX", None, D(1), "IVA", NEW),
            (2, None, "AWT", D(4), D(-1), "RET", OLD),
        ),
        "PO_DISTRIBUTIONS_ALL": table(
            spark,
            "PO_DISTRIBUTION_ID int, LINE_LOCATION_ID int, PO_HEADER_ID int, CODE_COMBINATION_ID int, REQ_DISTRIBUTION_ID int",
            (1000, 100, 1, 50, 5), (1001, 101, 2, 60, 6), (1002, 100, 1, 60, None),
        ),
        "PO_HEADERS_ALL": table(spark, "PO_HEADER_ID int, SEGMENT1 string", (1, "PO1"), (2, "PO2")),
        "PO_LINE_LOCATIONS_ALL": table(spark, "LINE_LOCATION_ID int", (100,), (101,)),
        "POR_REQ_DISTRIBUTIONS_ALL": table(spark, "DISTRIBUTION_ID int, REQUISITION_LINE_ID int", (5, 55), (6, 66)),
        "POR_REQUISITION_LINES_ALL": table(spark, "REQUISITION_LINE_ID int, REQUISITION_HEADER_ID int", (55, 1), (66, 1)),
        "POR_REQUISITION_HEADERS_ALL": table(spark, "REQUISITION_HEADER_ID int, REQUISITION_NUMBER string", (1, "REQ1")),
        "AP_INVOICE_DISTRIBUTIONS_ALL": table(
            spark,
            "INVOICE_ID int, DISTRIBUTION_LINE_NUMBER int, DESCRIPTION string, AMOUNT decimal(18,2), BASE_AMOUNT decimal(18,2), "
            "DIST_CODE_COMBINATION_ID int, LINE_TYPE_LOOKUP_CODE string, WITHHOLDING_TAX_CODE_ID int, PO_DISTRIBUTION_ID int, "
            "RCV_TRANSACTION_ID int, ACCOUNTING_DATE timestamp_ntz, CREATION_DATE timestamp_ntz",
            (1, 1, "x", D(100), None, 7, "ITEM", None, 1000, 1, NEW, NEW),
            (1, 2, "x", D(100), None, 99, "ITEM", None, 1001, 2, NEW, NEW),
            (1, 3, "w", D(-8), D(-8), None, "AWT", 1, None, None, NEW, NEW),
            (1, 4, "w", D("-21.32"), None, None, "AWT", None, None, None, NEW, NEW),
            (2, 1, "w", D(-8), None, None, "AWT", 1, None, None, NEW, NEW),  # no item lines
            (3, 1, "i", D(0), None, None, "ITEM", None, None, None, OLD, OLD),
            (3, 2, "w", D(-8), None, None, "AWT", 1, None, None, NEW, NEW),  # base 0
        ),
        "RCV_TRANSACTIONS": table(
            spark,
            "TRANSACTION_ID int, SHIPMENT_HEADER_ID int, TRANSACTION_TYPE string, SOURCE_TRANSACTION_NUM string, "
            "PO_HEADER_ID int, TRANSACTION_DATE timestamp_ntz, CREATION_DATE timestamp_ntz",
            (1, 1, "RECEIVE", "T1", 1, NEW, NEW), (2, 2, "DELIVER", "T2", 1, NEW, NEW), (3, 2, "RECEIVE", "T3", None, NEW, NEW),
        ),
        "RCV_SHIPMENT_HEADERS": table(spark, "SHIPMENT_HEADER_ID int, RECEIPT_NUM string", (1, "R9"), (2, "R5")),
        "ZX_TAXES_B": table(spark, "TAX_ID int, TAX string, TAX_REGIME_CODE string", (1, "ISR", "MX")),
        "AP_INVOICE_PAYMENTS_ALL": table(
            spark,
            "INVOICE_ID int, CHECK_ID int, ACCOUNTING_DATE timestamp_ntz, AMOUNT decimal(18,2), DISCOUNT_TAKEN decimal(18,2), "
            "INVOICE_BASE_AMOUNT decimal(18,2), EXCHANGE_RATE decimal(18,6), CREATION_DATE timestamp_ntz",
            (1, 1, NEW, D(5), None, D(90), D(18), NEW), (1, 2, NEW, D(6), None, None, None, NEW), (2, 1, NEW, D(7), D(1), None, None, OLD),
        ),
        "AP_CHECKS_ALL": table(
            spark,
            "CHECK_ID int, CHECK_NUMBER string, CHECK_DATE date, BANK_ACCOUNT_NAME string, CURRENCY_CODE string, "
            "EXCHANGE_RATE decimal(18,6), STATUS_LOOKUP_CODE string",
            (1, "0010", NEW.date(), "B", "MXN", None, "CLEARED"), (2, "0020", NEW.date(), "B", "USD", D(18), "VOIDED"),
        ),
        "AP_PREPAY_HISTORY_ALL": table(
            spark, "INVOICE_ID int, PREPAY_INVOICE_ID int, ACCOUNTING_DATE timestamp_ntz, CREATION_DATE timestamp_ntz",
            (1, 2, NEW, NEW), (1, 999, NEW, NEW), (1, 2, OLD, OLD),
        ),
    }


@pytest.mark.parametrize("skew", [{}, {"cell_rows": 1}])
def test_invoices_v1(t, skew):
    got = extracts.invoices_v1(t, **skew)
    columns = ("INVOICE_ID", "EMPRESA", "PROVEEDOR", "RFC", "ERS", "CUENTA_BALANCE", "CUENTA_GASTO")
    # unknown supplier and old invoice fall out, a supplier without tax id stays;
    # the receipt is the least one, the account prefers 5…, a NULL segment is empty
    assert rows(got, *columns) == [
        (1, "MX", "ONE", "RFC1", "R5", "a-b--d-2100-f-g-h-i", "z-b-c-d-501-f-g-h-i"),
        (2, "MX", "TWO", None, None, "a-b--d-2100-f-g-h-i", "a-b-c-d-601-f-g-h-i"),
    ]


@pytest.mark.parametrize("skew", [{}, {"cell_rows": 1}])
def test_invoices_v2_has_a_row_per_terms_line(t, skew):
    got = extracts.invoices_v2(t, **skew)
    assert rows(got, "INVOICE_ID", "DUE_DAYS", "ORDEN_COMPRA", "INCOME_TAX_ID", "RFC", "UUID") == [
        (1, 30, "PO2", "RFC1", None, "G2"), (1, 60, "PO2", "RFC1", None, "G2"),
    ]


@pytest.mark.parametrize("skew", [{}, {"cell_rows": 1}])
def test_withholding(t, skew):
    got = extracts.withholding(t, **skew)
    columns = ("INVOICE_ID", "DISTRIBUTION_LINE_NUMBER", "MONTO_BASE", "PORCENTAJE_RETENCION", "CLASIFICACION_RETENCION", "NOMBRE_IMPUESTO")
    assert rows(got, *columns) == [
        (1, 3, D(200), D(4), "RET_ISR_4", "ISR"),
        (1, 4, D(200), D("10.66"), "RET_IVA", None),
        (3, 2, D(0), None, "RET_OTRO", "ISR"),
    ]


def test_tax_lines(t):
    assert rows(extracts.tax_lines_v1(t), "INVOICE_ID", "TAX_RATE", "TIPO_LINEA") == [(2, D(0), "TAX")]


def test_payments(t):
    assert rows(extracts.payments_v1(t), "INVOICE_ID", "NUM_PAGO", "MONEDA_PAGO") == [(1, "0010", "MXN")]
    every = extracts.payments_v1(t, cleared_only=False)
    assert "TC_PAGO" not in every.columns
    assert rows(every, "INVOICE_ID", "NUM_PAGO") == [(1, "0010"), (1, "0020"), (2, "0010")]
    assert rows(extracts.payments_v2(t), "NUM_PAGO", "IMPORTE_PAGO_MXN") == [("0010", D(90)), ("0020", None)]


def test_distributions_without_account_have_empty_segments(t):
    got = rows(extracts.distributions(t).where("INVOICE_ID = 1"), "DISTRIBUTION_LINE_NUMBER", "CUENTA_CONTABLE_GASTO", "CC_CUENTA")
    assert got == [(1, "a.b..d.2100", None), (2, "....", None), (3, "....", None), (4, "....", None)]


def test_prepay_ers(t):
    got = extracts.prepay_ers(t)
    assert rows(got, "TIPO_ORIGEN", "INVOICE_ID", "PREPAY_INVOICE_ID", "ADELANTO_USD", "ERS", "ORDEN_COMPRA") == [
        ("ERS", None, None, None, "T1", "PO1"), ("ERS", None, None, None, "T3", None),
        ("PREPAYMENT", 1, 2, D(100), None, None), ("PREPAYMENT", 1, 999, None, None, None),
    ]


def test_bridges(t):
    assert rows(extracts.requisition_bridge(t)) == [(1, "REQ1")]
    assert rows(extracts.account_bridge(t)) == [(1, "501")]


def test_extract_order(spark):
    df = spark.createDataFrame([("b", NEW), (None, NEW), ("a", OLD), ("a", None)], "TIPO_ORIGEN string, FECHA_APLICACION timestamp_ntz")
    got = [tuple(r) for r in extracts.in_extract_order(df, "prepay_ers").collect()]
    # ascending puts NULL last, descending first
    assert got == [("a", None), ("a", OLD), ("b", NEW), (None, NEW)]
