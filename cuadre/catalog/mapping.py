"""Payables relations and ERP base tables over the star-schema test tables.

Each entry is one SELECT in the SQL that Spark and DuckDB share, over tables
named in braces. Every mapping reads its whole tables and keeps all their rows: lines
that are no payment, prepayment or withholding get a key that matches nothing. Values
are chosen so that each rule of the reports meets its branches: missing codes, rates and
dates, other currencies, blank identifiers, orders without lines, unmatched accounts.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# the line's invoice, or a key that no invoice has
PAID = "case when l.l_returnflag = 'R' then -l.l_orderkey else l.l_orderkey end"
PREPAID = "case when l.l_returnflag = 'A' then l.l_orderkey else -l.l_orderkey end"
WITHHELD = "case when l.l_linestatus = 'O' then l.l_orderkey else -l.l_orderkey end"
PRICE = "cast(l.l_extendedprice as decimal(18,2))"
TOTAL = "cast(o.o_totalprice as decimal(18,2))"
PCT = "cast(round(l.l_tax * 100) as int)"


def _dec(x: str, p: int = 18, s: int = 2) -> str:
    return f"cast({x} as decimal({p},{s}))"


def _cents(x: str) -> str:
    """x hundredths as a rate; a product, since decimal division differs by engine."""
    return _dec(f"{_dec(x, 18, 6)} * cast(0.01 as decimal(4,2))", 18, 6)


INVOICE_FX = f"case when o.o_custkey % 5 < 2 and o.o_orderkey % 11 <> 0 then {_cents('1700 + o.o_orderkey % 300')} end"
CURRENCY = "case o.o_custkey % 5 when 0 then 'USD' when 1 then 'EUR' when 2 then null else 'mxn' end"
PAY_FLAG = (
    "case when o.o_orderkey % 17 = 0 then null when o.o_orderstatus = 'F' then 'Y' "
    "when o.o_orderstatus = 'P' then 'P' else 'N' end"
)
APPROVAL = (
    "case o.o_orderpriority when '1-URGENT' then 'never approved ' when '2-HIGH' then 'CANCELLED' "
    "when '3-MEDIUM' then null else 'APPROVED' end"
)
UUID = "case o.o_orderkey % 10 when 0 then null when 1 then '  ' else md5(cast(o.o_orderkey as string)) end"
ORDER_NO = "case when o.o_orderkey % 13 <> 0 then 'PO-' || cast(o.o_custkey as string) end"
FEW_ORDERS = "case when o.o_orderkey % 13 <> 0 then 'PO-' || cast(o.o_custkey % 50 as string) end"
TAX_CODE = (
    f"case {PCT} when 1 then 'IVA16' when 2 then 'iva8' when 3 then 'RET_ISR_4' when 4 then 'RET_ISR_10' "
    "when 5 then 'RET_IVA' when 6 then 'IEPS' when 7 then 'RET_IVA_4' when 8 then 'OTHER' end"
)
TAX_RATE = f"case {PCT} when 1 then 16 when 2 then 8 when 3 then 4 when 4 then 10 when 5 then 6 else 0 end"
TAX_AMT = (
    f"{_dec(f'{PRICE} * cast(l.l_tax as decimal(4,2))')} * (case when l.l_returnflag = 'R' then -1 else 1 end)"
)
PAY_FX = (
    f"case l.l_suppkey % 4 when 0 then null when 1 then {_cents('1700 + l.l_suppkey % 300')} "
    f"when 2 then {_dec('0', 18, 6)} else {_dec('1', 18, 6)} end"
)
PAY_CURRENCY = "case l.l_suppkey % 4 when 0 then null when 1 then 'USD' when 2 then 'EUR' else 'MXN' end"
HALF = _dec(f"{PRICE} * cast(0.5 as decimal(4,2))")
HELD = (
    "case l.l_suppkey % 6 when 0 then cast(0.04 as decimal(6,4)) when 1 then cast(0.0125 as decimal(6,4)) "
    "when 2 then cast(0.1066 as decimal(6,4)) when 3 then cast(0.10 as decimal(6,4)) "
    "when 4 then cast(0.06 as decimal(6,4)) else cast(0.03 as decimal(6,4)) end"
)
NATURAL = "(case when p.p_size % 2 = 0 then '5' else '6' end) || cast(p.p_size as string)"
TYPE_CODE = (
    f"case {PCT} when 0 then null when 1 then 'IVA' when 2 then 'RET_IVA' when 3 then 'RET_ISR' "
    "when 4 then 'RET_ISR_4' when 5 then 'ISR_4' when 6 then 'RETENCION_ISR' else 'OTHER' end"
)

# one schedule per order, a second one for orders not yet finished
TWO_ROWS = """SELECT x.*, 1 AS k FROM {orders} x
          UNION ALL SELECT x.*, 2 AS k FROM {orders} x WHERE x.o_orderstatus <> 'F'"""

RELATION_SQL = {
    "invoices_v1": f"""
        SELECT o.o_orderkey AS INVOICE_ID, r.r_name AS EMPRESA, cast(c.c_custkey as string) AS NUM_PROV,
          c.c_name AS PROVEEDOR,
          case when c.c_custkey % 7 <> 0 then 'RFC' || cast(c.c_custkey as string) end AS RFC,
          'F-' || cast(o.o_orderkey as string) AS FACTURA,
          case when o.o_orderkey % 4 = 0 then 'RCV-' || cast(o.o_orderkey % 97 as string) end AS ERS,
          o.o_orderpriority AS ORIGEN, {PAY_FLAG} AS ESTATUS, {UUID} AS UUID,
          cast(o.o_orderdate as date) AS FECHA, {CURRENCY} AS MONEDA, c.c_mktsegment AS DESCRIPTION,
          {TOTAL} AS IMPORTE, '01-00-20-S4-21' || cast(o.o_custkey % 9 as string) || '-0-0-0-0' AS CUENTA_BALANCE,
          case when o.o_orderkey % 19 = 0 then null when o.o_orderkey % 23 = 0 then '01-00-20'
            else '01-00-20-S4-' || (case when o.o_orderkey % 2 = 0 then '5' else '6' end)
              || cast(o.o_orderkey % 51 as string) || '-0-0-0-0' end AS CUENTA_GASTO,
          {APPROVAL} AS ESTATUS_APROBACION
        FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
          JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey JOIN {{region}} r ON n.n_regionkey = r.r_regionkey""",
    "invoices_net": f"""
        SELECT o.o_orderkey AS INVOICE_ID, cast(o.o_orderdate as date) AS FECHA_FACTURA,
          {PAY_FLAG} AS ESTATUS_PAGO, c.c_name AS NOMBRE_PROVEEDOR,
          'RFC' || cast(c.c_custkey as string) AS RFC_PROVEEDOR, 'F-' || cast(o.o_orderkey as string) AS FACTURA,
          {UUID} AS UUID, o.o_orderpriority AS USUARIO_CAPTURA,
          case when o.o_orderkey % 29 = 0 then '1,000.5' else cast({TOTAL} as string) end AS TOTAL_FACTURA
        FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey""",
    "invoices_v2": f"""
        SELECT o.o_orderkey AS INVOICE_ID, 'F-' || cast(o.o_orderkey as string) AS FACTURA,
          'V-' || cast(o.o_orderkey as string) AS VOUCHER_NUM, {TOTAL} AS INVOICE_AMOUNT,
          case when o.o_orderkey % 31 <> 0 then {_dec(f'{TOTAL} * cast(0.16 as decimal(4,2))')} end AS TOTAL_TAX_AMOUNT,
          case when o.o_orderkey % 37 <> 0 then o.o_orderdate end AS FECHA, o.o_orderdate AS TERMS_DATE,
          {CURRENCY} AS MONEDA, {INVOICE_FX} AS TIPO_CAMBIO_FACTURA, 'G1' AS GLOBAL_ATTRIBUTE1, {UUID} AS UUID,
          o.o_orderpriority AS ORIGEN, {APPROVAL} AS ESTATUS, 'STANDARD' AS TIPO, o.o_custkey AS VENDOR_ID,
          n.n_regionkey AS ORG_ID, o.o_custkey % 4 AS TERMS_ID, cast(c.c_custkey as string) AS NUM_PROV,
          c.c_name AS PROVEEDOR, c.c_mktsegment AS ORGANIZATION_TYPE_LOOKUP_CODE, r.r_name AS EMPRESA,
          case when c.c_custkey % 7 <> 0 then 'RFC' || cast(c.c_custkey as string) end AS INCOME_TAX_ID,
          cast(o.o_custkey % 4 as int) * 15 AS DUE_DAYS, {ORDER_NO} AS ORDEN_COMPRA, cast(null as string) AS RFC
        FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
          JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey JOIN {{region}} r ON n.n_regionkey = r.r_regionkey""",
    "tax_lines_v1": f"""
        SELECT l.l_orderkey AS INVOICE_ID, {_dec(TAX_RATE, 18, 6)} AS TAX_RATE, {_dec(TAX_AMT)} AS TAX_AMT,
          case when l.l_linestatus = 'F' then 'TAX' else 'AWT' end AS TIPO_LINEA, {TAX_CODE} AS CODIGO_IMPUESTO
        FROM {{lineitem}} l""",
    "taxes_v2": f"""
        SELECT l.l_orderkey AS INVOICE_ID, l.l_linenumber AS TRX_LINE_NUMBER, {TYPE_CODE} AS TAX_TYPE_CODE,
          {_dec(TAX_AMT)} AS IMPUESTO_USD,
          case when l.l_linenumber <> 7 then {_dec(f'{TAX_AMT} * cast(18.5 as decimal(4,2))')} end AS IMPUESTO_MXN,
          'MXN' AS TAX_CURRENCY_CODE, cast(18.5 as decimal(18,6)) AS CURRENCY_CONVERSION_RATE,
          case when l.l_suppkey % 3 = 0 then (case {PCT} when 3 then 'RETENCION_ISR' when 4 then 'RETENCION_ISR_4'
            when 6 then 'RETENCION_ISR' end) end AS TIPO_IMPUESTO,
          case when l.l_suppkey % 5 <> 0 then 'RATE-' || cast(l.l_suppkey % 40 as string) end AS TAX_RATE_CODE
        FROM {{lineitem}} l""",
    "taxes_v4": f"""
        SELECT l.l_orderkey AS INVOICE_ID,
          case {PCT} when 0 then null when 1 then 'IVA' when 2 then 'IVA' when 3 then 'IEPS' else 'OTROS_TAX' end
            AS CLASIFICACION_IMPUESTO,
          {_dec(TAX_AMT)} AS IMPUESTO_USD,
          case when l.l_linenumber <> 7 then {_dec(f'{TAX_AMT} * cast(18.5 as decimal(4,2))')} end AS IMPUESTO_MXN
        FROM {{lineitem}} l""",
    "payments_v1": f"""
        SELECT {PAID} AS INVOICE_ID, cast(l.l_suppkey as string) AS NUM_PAGO,
          cast(l.l_shipdate as date) AS FECHA_PAGO, cast(l.l_shipdate as date) AS FECHA_APLICACION,
          'BANK-' || cast(l.l_suppkey % 3 as string) AS BANCO_CUENTA, {HALF} AS IMPORTE_PAGO,
          case when l.l_linenumber % 2 = 0 then {_dec(f'{PRICE} * cast(l.l_discount as decimal(4,2))')} end
            AS ADELANTO_APLICADO,
          {PAY_CURRENCY} AS MONEDA_PAGO, {PAY_FX} AS TC_PAGO
        FROM {{lineitem}} l""",
    "payments_v4": f"""
        SELECT {PAID} AS INVOICE_ID, l.l_partkey AS CHECK_ID, cast(l.l_suppkey as string) AS NUM_PAGO,
          case when l.l_partkey % 8 <> 0 then 'BANK-' || cast(l.l_suppkey % 3 as string) end AS BANCO_CUENTA,
          case when l.l_partkey % 9 <> 0 then l.l_shipdate end AS FECHA_APLICACION, {HALF} AS IMPORTE_PAGO_USD,
          case when l.l_partkey % 5 <> 0 then {_dec(f'{HALF} * cast(18.5 as decimal(4,2))')} end AS IMPORTE_PAGO_MXN,
          {PAY_FX} AS TIPO_CAMBIO_PAGO, {PAY_CURRENCY} AS MONEDA_PAGO,
          case when l.l_partkey % 4 <> 0 then 'PAY ' || cast(l.l_partkey % 6 as string) end AS DESCRIPTION,
          l.l_shipdate AS FECHA_PAGO
        FROM {{lineitem}} l""",
    "schedules": f"""
        SELECT o.o_orderkey AS INVOICE_ID, o.k AS PAYMENT_NUM, o.o_orderdate AS FECHA_VENCIMIENTO,
          {_dec(f'{TOTAL} * cast(0.5 as decimal(4,2))')} AS IMPORTE_BRUTO_USD,
          case when o.o_orderstatus = 'F' then {_dec('0')}
            else {_dec(f'{TOTAL} * cast(0.25 as decimal(4,2))')} end AS SALDO_USD, 99 AS PAYMENT_PRIORITY
        FROM ({TWO_ROWS}) o""",
    "distributions": f"""
        SELECT l.l_orderkey AS INVOICE_ID, l.l_linenumber AS DISTRIBUTION_LINE_NUMBER,
          case when l.l_partkey % 4 <> 0 then p.p_name end AS DESCRIPTION, {PRICE} AS IMPORTE_DISTRIBUCION_USD,
          l.l_partkey AS DIST_CODE_COMBINATION_ID,
          p.p_brand || '.' || p.p_type || '.' || cast(p.p_size as string) || '.'
            || (case when p.p_size % 5 = 0 then '' else 'S4' end) || '.' || {NATURAL} AS CUENTA_CONTABLE_GASTO,
          p.p_brand AS CC_EMPRESA, case when p.p_size % 6 <> 0 then p.p_type end AS CC_DEPARTAMENTO,
          cast(p.p_size as string) AS CC_CUENTA
        FROM {{lineitem}} l JOIN {{part}} p ON l.l_partkey = p.p_partkey""",
    "withholding": f"""
        SELECT {WITHHELD} AS INVOICE_ID, 'F-' || cast(l.l_orderkey as string) AS FACTURA,
          l.l_linenumber AS DISTRIBUTION_LINE_NUMBER, {_dec(f'-b.base * {HELD}')} AS RETENCION_USD,
          case when l.l_partkey % 5 <> 0 then {_dec(f'-{PRICE}')} end AS RETENCION_MXN, b.base AS MONTO_BASE,
          case l.l_suppkey % 6 when 0 then 'RET_ISR_4' when 1 then 'RET_ISR_125' when 2 then 'RET_IVA'
            when 3 then 'RET_ISR_10' when 4 then 'RET_IVA_6' else 'RET_OTRO' end AS CLASIFICACION_RETENCION
        FROM {{lineitem}} l LEFT JOIN (SELECT f.l_orderkey,
              {_dec("sum(case when f.l_linestatus = 'F' then cast(f.l_extendedprice as decimal(18,2)) end)")} AS base
            FROM {{lineitem}} f GROUP BY f.l_orderkey) b ON l.l_orderkey = b.l_orderkey""",
    "prepay_ers": f"""
        SELECT {PREPAID} AS INVOICE_ID, l.l_partkey AS PREPAY_INVOICE_ID,
          {_dec(f'{PRICE} * cast(0.1 as decimal(4,2))')} AS ADELANTO_USD,
          case when l.l_partkey % 9 <> 0 then l.l_shipdate end AS FECHA_APLICACION,
          {PAY_CURRENCY} AS MONEDA, {PAY_FX} AS TIPO_CAMBIO, 'PREPAYMENT' AS TIPO_ORIGEN, cast(null as string) AS ERS,
          cast(null as string) AS ORDEN_COMPRA,
          case when l.l_suppkey % 8 < 3 then {PRICE} end AS ADELANTO_MXN,
          'ANT-' || cast(l.l_partkey % 12 as string) AS FACTURA_ADELANTO
        FROM {{lineitem}} l WHERE l.l_returnflag <> 'N'
        UNION ALL
        SELECT null, null, null, l.l_shipdate, null, null, 'ERS',
          case when l.l_partkey % 6 <> 0 then 'RCV-' || cast(l.l_partkey as string) end,
          'PO-' || cast(o.o_custkey + (case when o.o_custkey % 10 = 0 then 1000000 else 0 end) as string), null, null
        FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
        WHERE l.l_returnflag = 'N'""",
    "requisitions": """
        SELECT DISTINCT l.l_orderkey AS INVOICE_ID, 'REQ-' || cast(l.l_partkey % 100 as string) AS REQUISITION_NUMBER
        FROM {lineitem} l""",
    "chart_of_accounts": f"""
        SELECT DISTINCT (case when p.p_size % 7 = 0 then 'X' else '' end) || {NATURAL} AS CUENTA_NUM,
          'ACCOUNT ' || cast(p.p_size as string) AS CUENTA_DESCRIPCION
        FROM {{part}} p""",
    "daily_rates": f"""
        SELECT DISTINCT cast(o.o_orderdate as date) - (case when day(o.o_orderdate) % 7 = 0 then 36500 else 0 end)
            AS FECHA_TASA, 'USD' AS FROM_CURRENCY, 'MXN' AS TO_CURRENCY,
          {_cents('1700 + day(o.o_orderdate) * 10 + o.o_orderkey % 2')} AS CONVERSION_RATE
        FROM {{orders}} o""",
    "flow_invoices": f"""
        SELECT o.o_orderkey AS INVOICE_ID,
          cast(cast(o.o_orderdate as date) as string)
            || (case when o.o_orderkey % 2 = 0 then 'T22:00:00.000-06:00' else '' end) AS INVOICE_DATE,
          case when o.o_orderkey % 29 = 0 then 'n/a' else cast({TOTAL} as string) end AS INVOICE_AMOUNT,
          case when o.o_orderkey % 3 = 0 then lower({CURRENCY}) else {CURRENCY} end AS INVOICE_CURRENCY_CODE
        FROM {{orders}} o""",
    "flow_payments": f"""
        SELECT {PAID} AS INVOICE_ID, cast(cast(l.l_shipdate as date) as string) AS ACCOUNTING_DATE,
          case when l.l_partkey % 41 = 0 then '' else cast({HALF} as string) end AS AMOUNT
        FROM {{lineitem}} l""",
}

BASE_SQL = {
    "AP_INVOICES_ALL": f"""
        SELECT o.o_orderkey AS INVOICE_ID, 'F-' || cast(o.o_orderkey as string) AS INVOICE_NUM,
          'V-' || cast(o.o_orderkey as string) AS VOUCHER_NUM, o.o_custkey AS VENDOR_ID,
          cast(o.o_custkey % 6 as int) AS ORG_ID, cast(o.o_custkey % 4 as int) AS TERMS_ID,
          o.o_orderpriority AS SOURCE, {PAY_FLAG} AS PAYMENT_STATUS_FLAG, {UUID} AS GLOBAL_ATTRIBUTE1,
          'G2' AS GLOBAL_ATTRIBUTE2, o.o_orderdate AS INVOICE_DATE, o.o_orderdate AS TERMS_DATE,
          {CURRENCY} AS INVOICE_CURRENCY_CODE, {INVOICE_FX} AS EXCHANGE_RATE, 'text' AS DESCRIPTION,
          {TOTAL} AS INVOICE_AMOUNT, {_dec(f'{TOTAL} * cast(0.16 as decimal(4,2))')} AS TOTAL_TAX_AMOUNT,
          o.o_custkey % 230 AS ACCTS_PAY_CODE_COMBINATION_ID, {APPROVAL} AS APPROVAL_STATUS,
          'STANDARD' AS INVOICE_TYPE_LOOKUP_CODE, o.o_orderdate AS CREATION_DATE
        FROM {{orders}} o""",
    "AP_INVOICE_LINES_ALL": f"""
        SELECT l.l_orderkey AS INVOICE_ID, l.l_linenumber AS LINE_NUMBER,
          case when {PCT} <> 0 then {_dec(TAX_RATE, 18, 6)} end AS TAX_RATE, {_dec(TAX_AMT)} AS AMOUNT,
          case when l.l_returnflag = 'R' then 'ITEM' when l.l_linestatus = 'F' then 'TAX' else 'AWT' end
            AS LINE_TYPE_LOOKUP_CODE,
          {TAX_CODE} AS TAX_RATE_CODE, case when l.l_suppkey % 9 <> 0 then l.l_partkey end AS PO_LINE_LOCATION_ID,
          l.l_shipdate AS CREATION_DATE
        FROM {{lineitem}} l""",
    "AP_INVOICE_DISTRIBUTIONS_ALL": f"""
        SELECT l.l_orderkey AS INVOICE_ID, l.l_linenumber AS DISTRIBUTION_LINE_NUMBER,
          l.l_shipmode_text AS DESCRIPTION, l.amount AS AMOUNT, l.base_amount AS BASE_AMOUNT,
          l.l_partkey + l.l_partkey % 2 AS DIST_CODE_COMBINATION_ID,
          case when l.l_linestatus = 'F' then 'ITEM' else 'AWT' end AS LINE_TYPE_LOOKUP_CODE,
          l.l_suppkey % 6 AS WITHHOLDING_TAX_CODE_ID,
          case when l.l_suppkey % 7 <> 0 then l.l_partkey end AS PO_DISTRIBUTION_ID,
          case when l.l_linenumber < 3 then (l.l_partkey * 7) % 1600 end AS RCV_TRANSACTION_ID,
          l.l_shipdate AS ACCOUNTING_DATE, l.l_shipdate AS CREATION_DATE
        FROM (SELECT x.*, x.l_returnflag || '-line' AS l_shipmode_text,
            case when x.l_linestatus = 'F' then cast(x.l_extendedprice as decimal(18,2))
              else {_dec(f'-cast(coalesce(b.base, 1000) as decimal(18,2)) * {HELD.replace("l.l_", "x.l_")}')} end AS amount,
            case when x.l_suppkey % 5 <> 0 then cast(x.l_extendedprice as decimal(18,2)) end AS base_amount
          FROM {{lineitem}} x LEFT JOIN (
            SELECT f.l_orderkey AS k, {_dec('sum(cast(f.l_extendedprice as decimal(18,2)))')} AS base
            FROM {{lineitem}} f WHERE f.l_linestatus = 'F' GROUP BY f.l_orderkey) b ON x.l_orderkey = b.k) l""",
    "AP_INVOICE_PAYMENTS_ALL": f"""
        SELECT {PAID} AS INVOICE_ID, l.l_suppkey AS CHECK_ID, l.l_shipdate AS ACCOUNTING_DATE,
          {HALF} AS AMOUNT, {_dec(f'{PRICE} * cast(l.l_discount as decimal(4,2))')} AS DISCOUNT_TAKEN,
          {_dec(f'{HALF} * cast(18.5 as decimal(4,2))')} AS INVOICE_BASE_AMOUNT, {PAY_FX} AS EXCHANGE_RATE,
          l.l_shipdate AS CREATION_DATE
        FROM {{lineitem}} l""",
    "AP_CHECKS_ALL": f"""
        SELECT case when s.s_suppkey % 11 = 0 then -1 - s.s_suppkey else s.s_suppkey end AS CHECK_ID, cast(s.s_suppkey + 5000 as string) AS CHECK_NUMBER,
          cast('1998-01-01' as date) + cast(s.s_suppkey as int) AS CHECK_DATE,
          'BANK-' || cast(s.s_suppkey % 3 as string) AS BANK_ACCOUNT_NAME,
          case s.s_suppkey % 4 when 1 then 'USD' when 2 then 'EUR' else 'MXN' end AS CURRENCY_CODE,
          case when s.s_suppkey % 4 = 1 then {_cents('1700 + s.s_suppkey % 300')} end AS EXCHANGE_RATE,
          case when s.s_suppkey % 3 = 0 then 'VOIDED' when s.s_suppkey % 10 = 1 then null else 'CLEARED' end
            AS STATUS_LOOKUP_CODE
        FROM {{supplier}} s""",
    "AP_PAYMENT_SCHEDULES_ALL": f"""
        SELECT o.o_orderkey AS INVOICE_ID, o.k AS PAYMENT_NUM, o.o_orderdate AS DUE_DATE,
          {_dec(f'{TOTAL} * cast(0.5 as decimal(4,2))')} AS GROSS_AMOUNT,
          case when o.o_orderstatus = 'F' then {_dec('0')}
            else {_dec(f'{TOTAL} * cast(0.25 as decimal(4,2))')} end AS AMOUNT_REMAINING,
          99 AS PAYMENT_PRIORITY, o.o_orderdate AS CREATION_DATE
        FROM ({TWO_ROWS}) o""",
    "AP_PREPAY_HISTORY_ALL": f"""
        SELECT {PREPAID} AS INVOICE_ID, (l.l_partkey * 11) % 1700 AS PREPAY_INVOICE_ID,
          l.l_shipdate AS ACCOUNTING_DATE, l.l_shipdate AS CREATION_DATE
        FROM {{lineitem}} l""",
    "AP_TERMS_LINES": """
        SELECT cast(r.r_regionkey % 3 as int) AS TERM_ID, 15 * (r.r_regionkey + 1) AS DUE_DAYS FROM {region} r""",
    "POZ_SUPPLIERS": """
        SELECT c.c_custkey AS VENDOR_ID, 'S' || cast(c.c_custkey as string) AS SEGMENT1,
          c.c_custkey + 1000000 AS PARTY_ID FROM {customer} c""",
    "POZ_SUPPLIERS_V": """
        SELECT c.c_custkey AS VENDOR_ID, 'S' || cast(c.c_custkey as string) AS SEGMENT1, c.c_name AS VENDOR_NAME,
          c.c_mktsegment AS ORGANIZATION_TYPE_LOOKUP_CODE FROM {customer} c""",
    "POZ_SUPPLIERS_PII": """
        SELECT case when c.c_custkey % 7 = 0 then -1 - c.c_custkey else c.c_custkey end AS VENDOR_ID,
          'RFC' || cast(c.c_custkey as string) AS INCOME_TAX_ID FROM {customer} c""",
    "HZ_PARTIES": """
        SELECT case when c.c_custkey % 13 = 0 then -1 - c.c_custkey else c.c_custkey + 1000000 end AS PARTY_ID,
          c.c_name AS PARTY_NAME FROM {customer} c""",
    "HR_OPERATING_UNITS": "SELECT r.r_regionkey AS ORGANIZATION_ID, r.r_name AS NAME FROM {region} r",
    "HR_ALL_ORGANIZATION_UNITS_F_VL": "SELECT r.r_regionkey AS ORGANIZATION_ID, r.r_name AS NAME FROM {region} r",
    "GL_CODE_COMBINATIONS": f"""
        SELECT p.p_partkey AS CODE_COMBINATION_ID, p.p_brand AS SEGMENT1, p.p_type AS SEGMENT2,
          cast(p.p_size as string) AS SEGMENT3, case when p.p_size % 5 <> 0 then 'S4' end AS SEGMENT4,
          {NATURAL} AS SEGMENT5, '06' AS SEGMENT6, case when p.p_size % 3 <> 0 then '07' end AS SEGMENT7,
          '08' AS SEGMENT8, case when p.p_size % 2 = 0 then '09' end AS SEGMENT9
        FROM {{part}} p""",
    "PO_DISTRIBUTIONS_ALL": """
        SELECT p.p_partkey AS PO_DISTRIBUTION_ID, p.p_partkey - p.p_partkey % 2 AS LINE_LOCATION_ID,
          p.p_size AS PO_HEADER_ID, p.p_partkey AS CODE_COMBINATION_ID, p.p_partkey AS REQ_DISTRIBUTION_ID
        FROM {part} p""",
    "PO_HEADERS_ALL": """
        SELECT DISTINCT case when p.p_size % 7 = 0 then -p.p_size else p.p_size end AS PO_HEADER_ID,
          'PO-' || cast(p.p_size as string) AS SEGMENT1 FROM {part} p""",
    "PO_LINE_LOCATIONS_ALL": """
        SELECT DISTINCT case when p.p_partkey % 5 = 0 then -1 - p.p_partkey else p.p_partkey - p.p_partkey % 2 end
          AS LINE_LOCATION_ID FROM {part} p""",
    "POR_REQ_DISTRIBUTIONS_ALL": """
        SELECT p.p_partkey AS DISTRIBUTION_ID, p.p_partkey AS REQUISITION_LINE_ID FROM {part} p""",
    "POR_REQUISITION_LINES_ALL": """
        SELECT p.p_partkey AS REQUISITION_LINE_ID, p.p_partkey % 100 AS REQUISITION_HEADER_ID FROM {part} p""",
    "POR_REQUISITION_HEADERS_ALL": """
        SELECT DISTINCT p.p_partkey % 100 AS REQUISITION_HEADER_ID,
          'REQ-' || cast(p.p_partkey % 100 as string) AS REQUISITION_NUMBER FROM {part} p""",
    "RCV_TRANSACTIONS": """
        SELECT o.o_orderkey AS TRANSACTION_ID, o.o_custkey AS SHIPMENT_HEADER_ID,
          case when o.o_orderstatus = 'F' then 'RECEIVE' else 'DELIVER' end AS TRANSACTION_TYPE,
          'RCV-' || cast(o.o_orderkey as string) AS SOURCE_TRANSACTION_NUM,
          cast(o.o_custkey % 60 as int) AS PO_HEADER_ID, o.o_orderdate AS TRANSACTION_DATE,
          o.o_orderdate AS CREATION_DATE
        FROM {orders} o""",
    "RCV_SHIPMENT_HEADERS": """
        SELECT c.c_custkey AS SHIPMENT_HEADER_ID, 'R' || cast(c.c_custkey % 100 as string) AS RECEIPT_NUM
        FROM {customer} c""",
    "GL_DAILY_RATES": f"""
        SELECT DISTINCT o.o_orderdate AS CONVERSION_DATE,
          case when o.o_custkey % 3 = 0 then 'EUR' else 'USD' end AS FROM_CURRENCY, 'MXN' AS TO_CURRENCY,
          case when o.o_custkey % 2 = 0 then 'Spot' else 'Corporate' end AS CONVERSION_TYPE,
          {_cents('1700 + day(o.o_orderdate)')} AS CONVERSION_RATE
        FROM {{orders}} o""",
    "ZX_LINES": f"""
        SELECT l.l_orderkey AS TRX_ID, l.l_linenumber AS TRX_LINE_NUMBER, {TYPE_CODE} AS TAX_TYPE_CODE,
          case when l.l_suppkey % 13 <> 0 then {_dec(TAX_AMT)} end AS TAX_AMT,
          {_dec(f'{TAX_AMT} * cast(18.5 as decimal(4,2))')} AS TAX_AMT_FUNCL_CURR, 'MXN' AS TAX_CURRENCY_CODE,
          cast(18.5 as decimal(18,6)) AS CURRENCY_CONVERSION_RATE, l.l_shipdate AS CREATION_DATE
        FROM {{lineitem}} l""",
    "ZX_TAXES_B": """
        SELECT r.r_regionkey AS TAX_ID, 'TAX-' || r.r_name AS TAX, 'MX-' || r.r_name AS TAX_REGIME_CODE
        FROM {region} r""",
    "FND_FLEX_VALUE_SETS": """
        SELECT r.r_regionkey AS FLEX_VALUE_SET_ID,
          case when r.r_regionkey = 1 then 'Cuenta CORPORATIVO' else r.r_name end AS FLEX_VALUE_SET_NAME
        FROM {region} r""",
    "FND_FLEX_VALUES": f"""
        SELECT DISTINCT p.p_size * 10 + r.r_regionkey AS FLEX_VALUE_ID, {NATURAL} AS FLEX_VALUE,
          r.r_regionkey AS FLEX_VALUE_SET_ID, case when p.p_size % 9 = 0 then 'N' else 'Y' end AS ENABLED_FLAG
        FROM {{part}} p JOIN {{region}} r ON p.p_size % 2 = r.r_regionkey % 2""",
    "FND_FLEX_VALUES_TL": """
        SELECT DISTINCT p.p_size * 10 + r.r_regionkey AS FLEX_VALUE_ID,
          case when r.r_regionkey < 2 then 'E' else 'US' end AS LANGUAGE,
          'ACCOUNT ' || cast(p.p_size as string) AS DESCRIPTION
        FROM {part} p JOIN {region} r ON p.p_size % 2 = r.r_regionkey % 2""",
}

# few orders with many receipts each, as the receipts of one order grow with the data
RELATION_SQL["invoices_v2_few"] = RELATION_SQL["invoices_v2"].replace(ORDER_NO, FEW_ORDERS)
RELATION_SQL["prepay_ers_few"] = RELATION_SQL["prepay_ers"].replace("'PO-' || cast(o.o_custkey +", "'PO-' || cast(o.o_custkey % 50 +")
# amounts as doubles, some of them no number
RELATION_SQL["amounts_double"] = """
        SELECT l.l_orderkey AS INVOICE_ID, l.l_linenumber AS LINE,
          case when l.l_linenumber = 3 then cast('NaN' as double) else l.l_extendedprice end AS AMOUNT,
          case when l.l_linenumber = 4 then cast(null as double) else l.l_discount end AS DISCOUNT
        FROM {lineitem} l"""

# schedules as extracted later: some invoices gone, some new, some balances other
RELATION_SQL["schedules_next"] = f"""
        SELECT case when s.INVOICE_ID % 11 = 0 then s.INVOICE_ID + 100000000 else s.INVOICE_ID end AS INVOICE_ID, s.PAYMENT_NUM,
          s.FECHA_VENCIMIENTO, s.IMPORTE_BRUTO_USD,
          case when s.INVOICE_ID % 7 = 0 and s.PAYMENT_NUM = 1 then {_dec('s.SALDO_USD + 1')} else s.SALDO_USD end AS SALDO_USD,
          s.PAYMENT_PRIORITY
        FROM ({RELATION_SQL["schedules"]}) s WHERE s.INVOICE_ID % 13 <> 5"""
# what an extract file holds: text, with line breaks, quotes and commas in cells, and spellings of a missing value
RELATION_SQL["invoices_landed"] = f"""
        SELECT cast(o.o_orderkey as string) AS INVOICE_ID, 'F-' || cast(o.o_orderkey as string) AS FACTURA,
          case o.o_custkey % 5 when 0 then 'N/A' when 1 then 'null' when 2 then ' two, words ' else o.o_orderpriority end
            AS PROVEEDOR,
          case o.o_orderkey % 4 when 0 then 'line one' || chr(10) || 'says "hi", ' || o.o_orderpriority
            when 1 then chr(10) || '"' || chr(13) || chr(10) || ',,' when 2 then '' else 'plain' end AS DESCRIPTION,
          {CURRENCY} AS MONEDA,
          case when o.o_orderkey % 29 = 0 then '1,000.5' else cast({TOTAL} as string) end AS IMPORTE,
          case when o.o_orderkey % 37 = 0 then 'no date' else cast(cast(o.o_orderdate as date) as string) end AS FECHA,
          {PAY_FLAG} AS ESTATUS
        FROM {{orders}} o"""

_PLACE = re.compile(r"\{(\w+)\}")


class Mapped(dict):
    """Relations or base tables over one data directory, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, texts: dict[str, str]):
        super().__init__()
        self._spark, self._dir, self._texts = spark, sf_dir, texts
        self._tables: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._tables[name]

    def __missing__(self, name: str) -> DataFrame:
        text = self._texts[name]
        self[name] = self._spark.sql(text, **{s: self._table(s) for s in set(_PLACE.findall(text))})
        return self[name]


def relations(spark: SparkSession, sf_dir: str) -> Mapped:
    return Mapped(spark, sf_dir, RELATION_SQL)


def base_tables(spark: SparkSession, sf_dir: str) -> Mapped:
    return Mapped(spark, sf_dir, BASE_SQL)


def plain_sql(text: str) -> str:
    """A mapping's SQL over tables under their own names."""
    return _PLACE.sub(r"\1", text)
