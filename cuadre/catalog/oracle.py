"""DuckDB SQL for each registered query, written apart from the DataFrame code."""

from __future__ import annotations

from cuadre.catalog.mapping import BASE_SQL, RELATION_SQL, plain_sql

ORACLE: dict[str, str] = {}

SINCE = "TIMESTAMP '1996-06-01 00:00:00'"


def _with(names: str, body: str, steps: dict[str, str] | None = None) -> str:
    """`body` after the named mappings and further steps as CTEs."""
    texts = {**RELATION_SQL, **BASE_SQL}
    ctes = [f"{n} AS ({plain_sql(texts[n])})" for n in names.split()]
    ctes += [f"{n} AS ({sql})" for n, sql in (steps or {}).items()]
    return f"WITH {', '.join(ctes)}\n{body}"


def _add(name: str, names: str, body: str, **steps: str) -> None:
    ORACLE[name] = _with(names, body, steps)


def m2(x: str) -> str:
    return f"cast({x} as decimal(18,2))"


def _class_sums(relation: str, rule: str, classes: list[str], value: str, suffix: str = "") -> str:
    sums = ", ".join(
        f"{m2(f'coalesce(sum({value}) FILTER (WHERE k = $${c}$$), 0)')} AS \"{c}{suffix}\"" for c in classes
    )
    return f"SELECT INVOICE_ID, {sums} FROM (SELECT *, {rule} AS k FROM {relation}) z GROUP BY INVOICE_ID"


# ---- rules as SQL ------------------------------------------------------------

RULE_RATE = """case when TAX_RATE in (16, 8) and TAX_AMT > 0 then 'IVA' when TAX_RATE = 4 then 'RET_ISR_4'
  when TAX_AMT < 0 then (case when TAX_RATE = 10 then 'RET_ISR' else 'RET_IVA' end) else 'OTROS_TAX' end"""
RULE_RATE_DETAIL = """case when TAX_RATE in (16, 8) and TAX_AMT > 0 then 'IVA_' || cast(cast(TAX_RATE as int) as varchar)
  when TAX_RATE = 4 then 'RET_ISR_4'
  when TAX_AMT < 0 then (case when TAX_RATE = 10 then 'RET_ISR_10' else 'RET_IVA' end) else 'OTROS_IMPUESTOS' end"""


def rule_code(default: str = "OTROS_TAX") -> str:
    code = "upper(coalesce(CODIGO_IMPUESTO, ''))"
    return f"""case when {code} like '%IVA%' and {code} not like '%RET%' then 'IVA'
      when {code} like '%RET%' or upper(coalesce(TIPO_LINEA, '')) = 'AWT' then
        (case when {code} like '%4%' or TAX_RATE = 4 then 'RET_ISR_4' when {code} like '%ISR%' then 'RET_ISR'
          else 'RET_IVA' end)
      else '{default}' end"""


def rule_type(code: str) -> str:
    u = f"upper({code})"
    return f"""case when {code} is null then 'OTRO'
      when {u} in ('IVA', 'RETENCION_IVA', 'RETENCION_ISR', 'RETENCION_ISR_4', 'OTRO') then {u}
      when strpos({u}, 'IVA') > 0 and strpos({u}, 'RET') = 0 then 'IVA'
      when strpos({u}, 'RET') > 0 and strpos({u}, 'IVA') > 0 then 'RETENCION_IVA'
      when strpos({u}, 'RET_ISR') > 0 and strpos({u}, '4') = 0 then 'RETENCION_ISR'
      when strpos({u}, '4') > 0 and strpos({u}, 'ISR') > 0 then 'RETENCION_ISR_4' else 'OTRO' end"""


RULE_PERCENT = """case pct when 4 then 'RET_ISR_4' when 1.25 then 'RET_ISR_125' when 10.66 then 'RET_IVA'
  when 10 then 'RET_ISR_10' when 6 then 'RET_IVA_6' else 'RET_OTRO' end"""


def pct(amount: str, base: str) -> str:
    return m2(f"round(abs(cast({amount} as double)) / nullif(abs(cast({base} as double)), 0) * 100 + 1e-9, 2)")


C_RATE = ["IVA", "RET_ISR_4", "RET_ISR", "RET_IVA", "OTROS_TAX"]
C_DETAIL = ["IVA_16", "IVA_8", "RET_IVA", "RET_ISR_4", "RET_ISR_10", "OTROS_IMPUESTOS"]
C_CODE = ["IVA", "RET_IVA", "RET_ISR", "RET_ISR_4", "OTROS_TAX"]
C_TYPE = ["IVA", "RETENCION_IVA", "RETENCION_ISR", "RETENCION_ISR_4", "OTRO"]
C_HELD = ["RET_ISR_4", "RET_ISR_125", "RET_ISR_10", "RET_IVA", "RET_IVA_6", "RET_OTRO"]


def week(c: str) -> str:
    return f"cast(week({c}) as int)"


def month_es(c: str) -> str:
    names = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre",
             "Noviembre", "Diciembre")
    return f"case month({c}) " + " ".join(f"when {i} then '{n}'" for i, n in enumerate(names, 1)) + " end"


def status(c: str, default: str = "PENDIENTE") -> str:
    return f"case {c} when 'Y' then 'PAGADO' when 'P' then 'PARCIAL' when 'N' then 'PENDIENTE' else '{default}' end"


APPROVED_2 = "case when upper(trim({c})) = 'NEVER APPROVED' then 'NO VALIDADO' else 'VALIDADO' end"
APPROVED_3 = """case when {c} is null or upper(trim({c})) = 'NEVER APPROVED' then 'NO VALIDADO'
  when upper(trim({c})) = 'CANCELLED' then 'CANCELADO' else 'VALIDADO' end"""
UUID_CHECK = "case when UUID is not null and trim(UUID) <> '' then 'OK' else '⚠️ FALTA UUID' end"

CURRENCY = "upper(coalesce(MONEDA, 'MXN'))"
FX = "coalesce(TIPO_CAMBIO_FACTURA, cast(1 as decimal(18,6)))"


def usd(amount: str, code: str, other: str = "zero") -> str:
    test = f"{code} <> 'MXN'" if other == "as_usd" else f"{code} = 'USD'"
    return m2(f"case when {test} then coalesce({amount}, 0) else 0 end")


def mxn(amount: str, code: str, fx: str, other: str = "zero") -> str:
    test = f"{code} <> 'MXN'" if other == "as_usd" else f"{code} = 'USD'"
    return m2(
        f"case when {code} = 'MXN' then coalesce({amount}, 0) "
        f"when {test} then {m2(f'coalesce({amount}, 0) * cast({fx} as decimal(18,6))')} else 0 end"
    )


# ---- extracts ----------------------------------------------------------------


def _account(alias: str, n: int, sep: str) -> str:
    return f" || '{sep}' || ".join(f"coalesce({alias}.SEGMENT{i}, '')" for i in range(1, n + 1))


FIRST_RECEIPT = """
SELECT d.INVOICE_ID, min(h.RECEIPT_NUM) AS ERS
FROM AP_INVOICE_DISTRIBUTIONS_ALL d JOIN RCV_TRANSACTIONS r ON d.RCV_TRANSACTION_ID = r.TRANSACTION_ID
  JOIN RCV_SHIPMENT_HEADERS h ON r.SHIPMENT_HEADER_ID = h.SHIPMENT_HEADER_ID GROUP BY d.INVOICE_ID"""
EXPENSE_ACCOUNT = f"""
SELECT INVOICE_ID, account AS CUENTA_GASTO FROM (
  SELECT l.INVOICE_ID, {_account('g', 9, '-')} AS account, row_number() OVER (PARTITION BY l.INVOICE_ID
    ORDER BY case when g.SEGMENT5 like '5%' then 0 else 1 end, {_account('g', 9, '-')}) AS n
  FROM AP_INVOICE_LINES_ALL l JOIN PO_DISTRIBUTIONS_ALL p ON l.PO_LINE_LOCATION_ID = p.LINE_LOCATION_ID
    JOIN GL_CODE_COMBINATIONS g ON p.CODE_COMBINATION_ID = g.CODE_COMBINATION_ID) WHERE n = 1"""
MAX_PO = """
SELECT d.INVOICE_ID, max(h.SEGMENT1) AS ORDEN_COMPRA
FROM AP_INVOICE_DISTRIBUTIONS_ALL d JOIN PO_DISTRIBUTIONS_ALL p ON d.PO_DISTRIBUTION_ID = p.PO_DISTRIBUTION_ID
  JOIN PO_HEADERS_ALL h ON p.PO_HEADER_ID = h.PO_HEADER_ID GROUP BY d.INVOICE_ID"""

_add("e1a_first_receipt", "AP_INVOICE_DISTRIBUTIONS_ALL RCV_TRANSACTIONS RCV_SHIPMENT_HEADERS", FIRST_RECEIPT)
_add("e1c_expense_account", "AP_INVOICE_LINES_ALL PO_DISTRIBUTIONS_ALL GL_CODE_COMBINATIONS", EXPENSE_ACCOUNT)
_add("e2a_max_po", "AP_INVOICE_DISTRIBUTIONS_ALL PO_DISTRIBUTIONS_ALL PO_HEADERS_ALL", MAX_PO)
_add(
    "e1_invoices_v1",
    "AP_INVOICES_ALL AP_INVOICE_LINES_ALL AP_INVOICE_DISTRIBUTIONS_ALL RCV_TRANSACTIONS RCV_SHIPMENT_HEADERS "
    "PO_DISTRIBUTIONS_ALL GL_CODE_COMBINATIONS POZ_SUPPLIERS POZ_SUPPLIERS_PII HZ_PARTIES HR_OPERATING_UNITS",
    f"""
SELECT i.INVOICE_ID, u.NAME AS EMPRESA, s.SEGMENT1 AS NUM_PROV, h.PARTY_NAME AS PROVEEDOR, x.INCOME_TAX_ID AS RFC,
  i.INVOICE_NUM AS FACTURA, fr.ERS, i.SOURCE AS ORIGEN, i.PAYMENT_STATUS_FLAG AS ESTATUS, i.GLOBAL_ATTRIBUTE1 AS UUID,
  cast(i.INVOICE_DATE as date) AS FECHA, i.INVOICE_CURRENCY_CODE AS MONEDA, i.DESCRIPTION,
  i.INVOICE_AMOUNT AS IMPORTE,
  (SELECT {_account('g', 9, '-')} FROM GL_CODE_COMBINATIONS g
    WHERE g.CODE_COMBINATION_ID = i.ACCTS_PAY_CODE_COMBINATION_ID) AS CUENTA_BALANCE, ea.CUENTA_GASTO
FROM AP_INVOICES_ALL i JOIN POZ_SUPPLIERS s ON i.VENDOR_ID = s.VENDOR_ID JOIN HZ_PARTIES h ON s.PARTY_ID = h.PARTY_ID
  JOIN HR_OPERATING_UNITS u ON i.ORG_ID = u.ORGANIZATION_ID LEFT JOIN POZ_SUPPLIERS_PII x ON s.VENDOR_ID = x.VENDOR_ID
  LEFT JOIN fr ON fr.INVOICE_ID = i.INVOICE_ID LEFT JOIN ea ON ea.INVOICE_ID = i.INVOICE_ID
WHERE i.CREATION_DATE >= {SINCE}""",
    fr=FIRST_RECEIPT,
    ea=EXPENSE_ACCOUNT,
)
_add(
    "e2_invoices_v2",
    "AP_INVOICES_ALL AP_INVOICE_DISTRIBUTIONS_ALL PO_DISTRIBUTIONS_ALL PO_HEADERS_ALL POZ_SUPPLIERS_V "
    "POZ_SUPPLIERS_PII HR_ALL_ORGANIZATION_UNITS_F_VL AP_TERMS_LINES",
    f"""
SELECT b.INVOICE_ID, b.INVOICE_NUM AS FACTURA, b.VOUCHER_NUM, b.INVOICE_AMOUNT, b.TOTAL_TAX_AMOUNT,
  b.INVOICE_DATE AS FECHA, b.TERMS_DATE, b.INVOICE_CURRENCY_CODE AS MONEDA, b.EXCHANGE_RATE AS TIPO_CAMBIO_FACTURA,
  b.GLOBAL_ATTRIBUTE1, b.GLOBAL_ATTRIBUTE2 AS UUID, b.SOURCE AS ORIGEN, b.APPROVAL_STATUS AS ESTATUS,
  b.INVOICE_TYPE_LOOKUP_CODE AS TIPO, b.VENDOR_ID, b.ORG_ID, b.TERMS_ID, c.SEGMENT1 AS NUM_PROV,
  c.VENDOR_NAME AS PROVEEDOR, c.ORGANIZATION_TYPE_LOOKUP_CODE, d.NAME AS EMPRESA, e.INCOME_TAX_ID, f.DUE_DAYS,
  po.ORDEN_COMPRA, cast(null as varchar) AS RFC
FROM AP_INVOICES_ALL b JOIN POZ_SUPPLIERS_V c ON b.VENDOR_ID = c.VENDOR_ID
  JOIN HR_ALL_ORGANIZATION_UNITS_F_VL d ON d.ORGANIZATION_ID = b.ORG_ID
  JOIN POZ_SUPPLIERS_PII e ON e.VENDOR_ID = c.VENDOR_ID JOIN AP_TERMS_LINES f ON f.TERM_ID = b.TERMS_ID
  LEFT JOIN po ON po.INVOICE_ID = b.INVOICE_ID WHERE b.INVOICE_DATE >= {SINCE}""",
    po=MAX_PO,
)
_add(
    "e3_tax_lines",
    "AP_INVOICE_LINES_ALL",
    f"""
SELECT INVOICE_ID, cast(case when TAX_RATE is null then 0 else TAX_RATE end as decimal(18,6)) AS TAX_RATE,
  AMOUNT AS TAX_AMT, LINE_TYPE_LOOKUP_CODE AS TIPO_LINEA, TAX_RATE_CODE AS CODIGO_IMPUESTO
FROM AP_INVOICE_LINES_ALL
WHERE (LINE_TYPE_LOOKUP_CODE = 'TAX' OR LINE_TYPE_LOOKUP_CODE = 'AWT') AND CREATION_DATE >= {SINCE}""",
)
_add(
    "e4_taxes_nonzero",
    "ZX_LINES",
    f"""
SELECT TRX_ID AS INVOICE_ID, TRX_LINE_NUMBER, TAX_TYPE_CODE, TAX_AMT AS IMPUESTO_USD,
  {m2('TAX_AMT_FUNCL_CURR')} AS IMPUESTO_MXN, TAX_CURRENCY_CODE, CURRENCY_CONVERSION_RATE
FROM ZX_LINES WHERE TAX_AMT <> 0 AND CREATION_DATE >= {SINCE}""",
)
_add(
    "e5_payments_cleared",
    "AP_INVOICE_PAYMENTS_ALL AP_CHECKS_ALL",
    f"""
SELECT p.INVOICE_ID, c.CHECK_NUMBER AS NUM_PAGO, c.CHECK_DATE AS FECHA_PAGO,
  cast(p.ACCOUNTING_DATE as date) AS FECHA_APLICACION, c.BANK_ACCOUNT_NAME AS BANCO_CUENTA, p.AMOUNT AS IMPORTE_PAGO,
  p.DISCOUNT_TAKEN AS ADELANTO_APLICADO, c.CURRENCY_CODE AS MONEDA_PAGO, c.EXCHANGE_RATE AS TC_PAGO
FROM AP_CHECKS_ALL c, AP_INVOICE_PAYMENTS_ALL p
WHERE c.CHECK_ID = p.CHECK_ID AND c.STATUS_LOOKUP_CODE = 'CLEARED' AND p.CREATION_DATE >= {SINCE}""",
)
_add(
    "e6_payments_all",
    "AP_INVOICE_PAYMENTS_ALL AP_CHECKS_ALL",
    """
SELECT p.INVOICE_ID, c.CHECK_NUMBER AS NUM_PAGO, c.CHECK_DATE AS FECHA_PAGO,
  cast(p.ACCOUNTING_DATE as date) AS FECHA_APLICACION, c.BANK_ACCOUNT_NAME AS BANCO_CUENTA, p.AMOUNT AS IMPORTE_PAGO,
  p.DISCOUNT_TAKEN AS ADELANTO_APLICADO
FROM AP_CHECKS_ALL c, AP_INVOICE_PAYMENTS_ALL p WHERE c.CHECK_ID = p.CHECK_ID""",
)
_add(
    "e7_payments_v2",
    "AP_INVOICE_PAYMENTS_ALL AP_CHECKS_ALL",
    f"""
SELECT p.INVOICE_ID, p.CHECK_ID, c.CHECK_NUMBER AS NUM_PAGO, c.BANK_ACCOUNT_NAME AS BANCO_CUENTA,
  p.ACCOUNTING_DATE AS FECHA_APLICACION, p.AMOUNT AS IMPORTE_PAGO_USD, p.INVOICE_BASE_AMOUNT AS IMPORTE_PAGO_MXN,
  p.EXCHANGE_RATE AS TIPO_CAMBIO_PAGO, c.CURRENCY_CODE AS MONEDA_PAGO
FROM AP_CHECKS_ALL c, AP_INVOICE_PAYMENTS_ALL p WHERE c.CHECK_ID = p.CHECK_ID AND p.CREATION_DATE >= {SINCE}""",
)
_add(
    "e8_distributions",
    "AP_INVOICE_DISTRIBUTIONS_ALL GL_CODE_COMBINATIONS",
    f"""
SELECT d.INVOICE_ID, d.DISTRIBUTION_LINE_NUMBER, d.DESCRIPTION, d.AMOUNT AS IMPORTE_DISTRIBUCION_USD,
  d.DIST_CODE_COMBINATION_ID, {_account('g', 5, '.')} AS CUENTA_CONTABLE_GASTO, g.SEGMENT1 AS CC_EMPRESA,
  g.SEGMENT2 AS CC_DEPARTAMENTO, g.SEGMENT3 AS CC_CUENTA
FROM AP_INVOICE_DISTRIBUTIONS_ALL d LEFT JOIN GL_CODE_COMBINATIONS g
  ON d.DIST_CODE_COMBINATION_ID = g.CODE_COMBINATION_ID WHERE d.CREATION_DATE >= {SINCE}""",
)
_add(
    "e9_schedules",
    "AP_PAYMENT_SCHEDULES_ALL",
    f"""
SELECT INVOICE_ID, PAYMENT_NUM, DUE_DATE AS FECHA_VENCIMIENTO, GROSS_AMOUNT AS IMPORTE_BRUTO_USD,
  AMOUNT_REMAINING AS SALDO_USD, PAYMENT_PRIORITY FROM AP_PAYMENT_SCHEDULES_ALL WHERE CREATION_DATE >= {SINCE}""",
)
_add(
    "e10_requisition_bridge",
    "AP_INVOICE_LINES_ALL PO_LINE_LOCATIONS_ALL PO_DISTRIBUTIONS_ALL POR_REQ_DISTRIBUTIONS_ALL "
    "POR_REQUISITION_LINES_ALL POR_REQUISITION_HEADERS_ALL",
    """
SELECT DISTINCT a.INVOICE_ID, h.REQUISITION_NUMBER
FROM AP_INVOICE_LINES_ALL a JOIN PO_LINE_LOCATIONS_ALL b ON a.PO_LINE_LOCATION_ID = b.LINE_LOCATION_ID
  JOIN PO_DISTRIBUTIONS_ALL c ON b.LINE_LOCATION_ID = c.LINE_LOCATION_ID
  JOIN POR_REQ_DISTRIBUTIONS_ALL d ON c.REQ_DISTRIBUTION_ID = d.DISTRIBUTION_ID
  JOIN POR_REQUISITION_LINES_ALL e ON d.REQUISITION_LINE_ID = e.REQUISITION_LINE_ID
  JOIN POR_REQUISITION_HEADERS_ALL h ON e.REQUISITION_HEADER_ID = h.REQUISITION_HEADER_ID
WHERE a.LINE_TYPE_LOOKUP_CODE = 'ITEM'""",
)
_add(
    "e11_account_bridge",
    "AP_INVOICE_LINES_ALL PO_DISTRIBUTIONS_ALL GL_CODE_COMBINATIONS",
    f"""
SELECT DISTINCT a.INVOICE_ID, g.SEGMENT5 AS CUENTA_NUM
FROM AP_INVOICE_LINES_ALL a, PO_DISTRIBUTIONS_ALL p, GL_CODE_COMBINATIONS g
WHERE a.PO_LINE_LOCATION_ID = p.LINE_LOCATION_ID AND p.CODE_COMBINATION_ID = g.CODE_COMBINATION_ID
  AND g.SEGMENT5 LIKE '5%' AND a.CREATION_DATE >= {SINCE}""",
)
_add(
    "e12_chart",
    "FND_FLEX_VALUE_SETS FND_FLEX_VALUES FND_FLEX_VALUES_TL",
    """
SELECT v.FLEX_VALUE AS CUENTA_NUM, x.DESCRIPTION AS CUENTA_DESCRIPCION
FROM FND_FLEX_VALUE_SETS s, FND_FLEX_VALUES v, FND_FLEX_VALUES_TL x
WHERE s.FLEX_VALUE_SET_NAME = 'Cuenta CORPORATIVO' AND s.FLEX_VALUE_SET_ID = v.FLEX_VALUE_SET_ID
  AND v.FLEX_VALUE_ID = x.FLEX_VALUE_ID AND x.LANGUAGE = 'E' AND v.ENABLED_FLAG = 'Y'""",
)
_add(
    "e13_rates",
    "GL_DAILY_RATES",
    f"""
SELECT cast(CONVERSION_DATE as date) AS FECHA_TASA, FROM_CURRENCY, TO_CURRENCY, CONVERSION_RATE FROM GL_DAILY_RATES
WHERE FROM_CURRENCY = 'USD' AND TO_CURRENCY = 'MXN' AND CONVERSION_TYPE = 'Corporate'
  AND CONVERSION_DATE >= {SINCE}""",
)
_add(
    "e14_prepay_ers",
    "AP_PREPAY_HISTORY_ALL AP_INVOICES_ALL RCV_TRANSACTIONS PO_HEADERS_ALL",
    f"""
SELECT a.INVOICE_ID, a.PREPAY_INVOICE_ID, i.INVOICE_AMOUNT AS ADELANTO_USD, a.ACCOUNTING_DATE AS FECHA_APLICACION,
  i.INVOICE_CURRENCY_CODE AS MONEDA, i.EXCHANGE_RATE AS TIPO_CAMBIO, 'PREPAYMENT' AS TIPO_ORIGEN,
  cast(null as varchar) AS ERS, cast(null as varchar) AS ORDEN_COMPRA
FROM AP_PREPAY_HISTORY_ALL a LEFT JOIN AP_INVOICES_ALL i ON a.PREPAY_INVOICE_ID = i.INVOICE_ID
WHERE a.CREATION_DATE >= {SINCE}
UNION ALL
SELECT null, null, null, r.TRANSACTION_DATE, null, null, 'ERS', r.SOURCE_TRANSACTION_NUM, h.SEGMENT1
FROM RCV_TRANSACTIONS r LEFT JOIN PO_HEADERS_ALL h ON r.PO_HEADER_ID = h.PO_HEADER_ID
WHERE r.TRANSACTION_TYPE = 'RECEIVE' AND r.CREATION_DATE >= {SINCE}""",
)
_add(
    "e15_withholding",
    "AP_INVOICE_DISTRIBUTIONS_ALL AP_INVOICES_ALL ZX_TAXES_B",
    f"""
SELECT INVOICE_ID, FACTURA, DISTRIBUTION_LINE_NUMBER, RETENCION_USD, RETENCION_MXN, WITHHOLDING_TAX_CODE_ID,
  NOMBRE_IMPUESTO, TAX_REGIME_CODE, MONTO_BASE, pct AS PORCENTAJE_RETENCION, {RULE_PERCENT} AS CLASIFICACION_RETENCION,
  FECHA_APLICACION FROM held""",
    held=f"""
SELECT w.INVOICE_ID, i.INVOICE_NUM AS FACTURA, w.DISTRIBUTION_LINE_NUMBER, w.AMOUNT AS RETENCION_USD,
  w.BASE_AMOUNT AS RETENCION_MXN, w.WITHHOLDING_TAX_CODE_ID, x.TAX AS NOMBRE_IMPUESTO, x.TAX_REGIME_CODE,
  {m2('t.base')} AS MONTO_BASE, {pct('w.AMOUNT', 't.base')} AS pct, w.ACCOUNTING_DATE AS FECHA_APLICACION
FROM AP_INVOICE_DISTRIBUTIONS_ALL w JOIN AP_INVOICES_ALL i ON w.INVOICE_ID = i.INVOICE_ID
  LEFT JOIN ZX_TAXES_B x ON w.WITHHOLDING_TAX_CODE_ID = x.TAX_ID
  JOIN (SELECT INVOICE_ID, sum(AMOUNT) AS base FROM AP_INVOICE_DISTRIBUTIONS_ALL
    WHERE LINE_TYPE_LOOKUP_CODE = 'ITEM' GROUP BY INVOICE_ID) t ON w.INVOICE_ID = t.INVOICE_ID
WHERE w.LINE_TYPE_LOOKUP_CODE = 'AWT' AND w.CREATION_DATE >= {SINCE}""",
)

# ---- sources -----------------------------------------------------------------

_add(
    "s4_conform",
    "invoices_v1",
    """SELECT cast(INVOICE_ID as varchar) AS INVOICE_ID, EMPRESA, NUM_PROV, PROVEEDOR, RFC, FACTURA, ERS, ORIGEN,
  ESTATUS AS ESTATUS_PAGO, UUID, FECHA, MONEDA, DESCRIPTION, IMPORTE, CUENTA_BALANCE, CUENTA_GASTO, ESTATUS_APROBACION
FROM invoices_v1""",
)
_add(
    "s3_nullify",
    "flow_payments",
    """SELECT INVOICE_ID, ACCOUNTING_DATE, case when AMOUNT = '' then null else AMOUNT end AS AMOUNT
FROM flow_payments""",
)
_add(
    "p2_reindex",
    "invoices_v1",
    "SELECT FACTURA, cast(null as decimal(18,6)) AS TC_FACTURA, INVOICE_ID FROM invoices_v1",
)
_add(
    "p9_ensure_money",
    "payments_v1",
    """SELECT INVOICE_ID, NUM_PAGO, cast(coalesce(ADELANTO_APLICADO, 0) as decimal(18,2)) AS ADELANTO_APLICADO,
  cast(coalesce(TC_PAGO, 1) as decimal(18,6)) AS TC_PAGO, cast(0 as decimal(18,2)) AS RET_IVA FROM payments_v1""",
)
_add("s6_scan_since", "AP_INVOICES_ALL", f"SELECT INVOICE_ID, CREATION_DATE FROM AP_INVOICES_ALL WHERE CREATION_DATE >= {SINCE}")

# ---- classification ----------------------------------------------------------

_TAX = "INVOICE_ID, TAX_RATE, TAX_AMT, TIPO_LINEA, CODIGO_IMPUESTO"
_add("c1_rate", "tax_lines_v1", f"SELECT {_TAX}, {RULE_RATE} AS category FROM tax_lines_v1")
_add("c2_rate_detail", "tax_lines_v1", f"SELECT {_TAX}, {RULE_RATE_DETAIL} AS category FROM tax_lines_v1")
_add("c3_code", "tax_lines_v1", f"SELECT {_TAX}, {rule_code()} AS category FROM tax_lines_v1")
_add(
    "c4_type",
    "taxes_v2",
    f"SELECT INVOICE_ID, TRX_LINE_NUMBER, TAX_TYPE_CODE, {rule_type('TAX_TYPE_CODE')} AS category FROM taxes_v2",
)
_add(
    "c5_percentage",
    "withholding",
    f"SELECT INVOICE_ID, DISTRIBUTION_LINE_NUMBER, pct AS PORCENTAJE_RETENCION, {RULE_PERCENT} AS category FROM w",
    w=f"SELECT *, {pct('RETENCION_USD', 'MONTO_BASE')} AS pct FROM withholding",
)

# ---- aggregates --------------------------------------------------------------

V4_CLASS = "case when CLASIFICACION_IMPUESTO = 'IVA' then 'IVA' when CLASIFICACION_IMPUESTO is not null then 'OTROS_TAX' end"


def _two(relation: str, rule: str, classes: list[str], usd_col: str, mxn_col: str) -> str:
    a = _class_sums(relation, rule, classes, usd_col, "_USD")
    b = _class_sums(relation, rule, classes, mxn_col, "_MXN")
    return f"SELECT * FROM ({a}) a JOIN ({b}) b USING (INVOICE_ID)"


PIVOT_HELD = _two("withholding", "CLASIFICACION_RETENCION", C_HELD, "RETENCION_USD", "RETENCION_MXN")
PIVOT_V4 = _two("taxes_v4", V4_CLASS, ["IVA", "OTROS_TAX"], "IMPUESTO_USD", "IMPUESTO_MXN")


def _list(relation: str, key: str, column: str, order: str, sep: str, name: str, limit: int | None = None) -> str:
    """Distinct values by first appearance; all-NULL keys give ''."""
    keep = f"AND n <= {limit}" if limit else ""
    return f"""
SELECT k.{key}, coalesce(v.txt, '') AS {name} FROM (SELECT DISTINCT {key} FROM {relation} WHERE {key} IS NOT NULL) k
LEFT JOIN (SELECT {key}, string_agg(val, '{sep}' ORDER BY n) AS txt FROM (
    SELECT {key}, val, row_number() OVER (PARTITION BY {key} ORDER BY ord NULLS FIRST, val) AS n FROM (
      SELECT {key}, cast({column} as varchar) AS val,
        case when count(*) FILTER (WHERE {order} IS NULL) > 0 then null else min({order}) end AS ord
      FROM {relation} WHERE {column} IS NOT NULL GROUP BY ALL) q1) q2 WHERE true {keep} GROUP BY {key}) v
  ON v.{key} = k.{key}"""


def _first(column: str, order: str = "DISTRIBUTION_LINE_NUMBER") -> str:
    return f"(list({column} ORDER BY {order}, {column}) FILTER (WHERE {column} IS NOT NULL))[1]"


def mean(c: str) -> str:
    return f"cast(round(cast(sum({c}) as double) / nullif(count({c}), 0), 6) as decimal(18,6))"


AGG_DIST = f"""
SELECT a.INVOICE_ID, a.IMPORTE_DISTRIBUCION_USD, a.DESCRIPTION, b.CUENTA_CONTABLE_GASTO, c.CC_DEPARTAMENTO FROM (
  SELECT INVOICE_ID, {m2('coalesce(sum(IMPORTE_DISTRIBUCION_USD), 0)')} AS IMPORTE_DISTRIBUCION_USD,
    {_first('DESCRIPTION')} AS DESCRIPTION FROM distributions GROUP BY INVOICE_ID) a
JOIN ({_list('distributions', 'INVOICE_ID', 'CUENTA_CONTABLE_GASTO', 'DISTRIBUTION_LINE_NUMBER', ' | ',
             'CUENTA_CONTABLE_GASTO', 3)}) b USING (INVOICE_ID)
JOIN ({_list('distributions', 'INVOICE_ID', 'CC_DEPARTAMENTO', 'DISTRIBUTION_LINE_NUMBER', ' | ',
             'CC_DEPARTAMENTO', 3)}) c USING (INVOICE_ID)"""
PRINCIPAL = "SELECT INVOICE_ID, " + ", ".join(
    f"{_first(c)} AS {c}"
    for c in ("CUENTA_CONTABLE_GASTO", "CC_EMPRESA", "CC_DEPARTAMENTO", "CC_CUENTA", "DESCRIPTION")
) + " FROM distributions GROUP BY INVOICE_ID"
BACK = "-epoch_us(FECHA_APLICACION)"
AGG_PAY = f"""
SELECT * FROM (SELECT INVOICE_ID, {m2('coalesce(sum(IMPORTE_PAGO_USD), 0)')} AS IMPORTE_PAGO_USD,
    {m2('coalesce(sum(IMPORTE_PAGO_MXN), 0)')} AS IMPORTE_PAGO_MXN, {mean('TIPO_CAMBIO_PAGO')} AS TIPO_CAMBIO_PAGO,
    max(FECHA_APLICACION) AS FECHA_APLICACION, max(FECHA_PAGO) AS FECHA_PAGO FROM payments_v4 GROUP BY INVOICE_ID) a
""" + "\n".join(
    f"JOIN ({_list('payments_v4', 'INVOICE_ID', c, BACK, ', ', c)}) {c}_t USING (INVOICE_ID)"
    for c in ("NUM_PAGO", "BANCO_CUENTA", "DESCRIPTION")
)
AGG_PREP = f"""
SELECT INVOICE_ID, TIPO_ORIGEN, ERS, ORDEN_COMPRA, FACTURA_ADELANTO, ADELANTO_USD,
  case when MONEDA = 'MXN' and mxn_given = 0 then ADELANTO_USD else mxn_sum end AS ADELANTO_MXN,
  TIPO_CAMBIO, FECHA_APLICACION, MONEDA
FROM (SELECT INVOICE_ID, {m2('coalesce(sum(ADELANTO_USD), 0)')} AS ADELANTO_USD, count(ADELANTO_MXN) AS mxn_given,
    {m2('coalesce(sum(ADELANTO_MXN), 0)')} AS mxn_sum, {mean('TIPO_CAMBIO')} AS TIPO_CAMBIO,
    max(FECHA_APLICACION) AS FECHA_APLICACION,
    (list(MONEDA ORDER BY {BACK} NULLS FIRST, MONEDA) FILTER (WHERE MONEDA IS NOT NULL))[1] AS MONEDA
  FROM prepay_ers WHERE INVOICE_ID IS NOT NULL GROUP BY INVOICE_ID) a
""" + "\n".join(
    f"JOIN ({_list('prepay_ers', 'INVOICE_ID', c, BACK, ', ', c)}) {c}_t USING (INVOICE_ID)"
    for c in ("TIPO_ORIGEN", "ERS", "ORDEN_COMPRA", "FACTURA_ADELANTO")
)
PREPAID = f"""SELECT INVOICE_ID, {m2('sum(ADELANTO_USD)')} AS ADELANTO_USD FROM prepay_ers
WHERE TIPO_ORIGEN = 'PREPAYMENT' GROUP BY INVOICE_ID"""
RECEIPTS = _list(
    "(SELECT * FROM prepay_ers WHERE TIPO_ORIGEN = 'ERS') ers_only", "ORDEN_COMPRA", "ERS", BACK, " | ", "ERS"
)
PIVOT_CODE = _class_sums("tax_lines_v1", rule_code(), C_CODE, "TAX_AMT")
PIVOT_RATE = _class_sums("tax_lines_v1", RULE_RATE, C_RATE, "TAX_AMT")
PIVOT_DETAIL = _class_sums("tax_lines_v1", RULE_RATE_DETAIL, C_DETAIL, "TAX_AMT")

_add("a1_tax_pivot", "tax_lines_v1", PIVOT_CODE)
_add("a2_pivot_two", "withholding", PIVOT_HELD)
_add("a2_pivot_taxes", "taxes_v4", PIVOT_V4)
_add(
    "a3_group_sum",
    "payments_v4",
    f"SELECT INVOICE_ID, {m2('coalesce(sum(IMPORTE_PAGO_MXN), 0)')} AS paid_mxn FROM payments_v4 GROUP BY INVOICE_ID",
)
_add(
    "a4_mean_max",
    "payments_v4",
    f"""SELECT INVOICE_ID, {mean('TIPO_CAMBIO_PAGO')} AS mean_rate, max(FECHA_APLICACION) AS last_applied
FROM payments_v4 GROUP BY INVOICE_ID""",
)
_add(
    "a5_distinct_list",
    "distributions",
    _list("distributions", "INVOICE_ID", "CC_DEPARTAMENTO", "DISTRIBUTION_LINE_NUMBER", " | ", "departments", 3),
)
_add(
    "a5_distinct_list_all",
    "distributions",
    _list("distributions", "INVOICE_ID", "CC_CUENTA", "DISTRIBUTION_LINE_NUMBER", ", ", "accounts"),
)
_add(
    "a5_distinct_values",
    "distributions",
    """SELECT INVOICE_ID, 'account' AS list, CC_CUENTA AS value, min(DISTRIBUTION_LINE_NUMBER) AS first
FROM distributions WHERE CC_CUENTA IS NOT NULL GROUP BY INVOICE_ID, CC_CUENTA
UNION ALL
SELECT INVOICE_ID, 'department', CC_DEPARTAMENTO, min(DISTRIBUTION_LINE_NUMBER)
FROM distributions WHERE CC_DEPARTAMENTO IS NOT NULL GROUP BY INVOICE_ID, CC_DEPARTAMENTO""",
)
_add(
    "a6_first_non_null",
    "distributions",
    f"SELECT INVOICE_ID, {_first('DESCRIPTION')} AS description FROM distributions GROUP BY INVOICE_ID",
)
_add("a7_distinct", "distributions", "SELECT INVOICE_ID, CC_CUENTA FROM distributions GROUP BY INVOICE_ID, CC_CUENTA")
_add(
    "a9_value_counts",
    "prepay_ers",
    'SELECT TIPO_ORIGEN, count(*) AS "count" FROM prepay_ers WHERE TIPO_ORIGEN IS NOT NULL GROUP BY TIPO_ORIGEN',
)
_add(
    "a10_row_sum",
    "payments_v1",
    f"""SELECT INVOICE_ID, NUM_PAGO, IMPORTE_PAGO,
  {m2('coalesce(IMPORTE_PAGO, 0) + coalesce(ADELANTO_APLICADO, 0)')} AS total FROM payments_v1""",
)
_add("a11_distributions", "distributions", AGG_DIST)
_add("a12_principal", "distributions", PRINCIPAL)
_add("a13_payments", "payments_v4", AGG_PAY)
_add("a14_prepayments", "prepay_ers", AGG_PREP)
_add("a15_prepaid", "prepay_ers", PREPAID)
_add("a15_receipts", "prepay_ers", RECEIPTS)

# ---- joins and ordering ------------------------------------------------------

FIRST_ORDER = """FECHA_PAGO NULLS LAST, NUM_PAGO NULLS LAST, IMPORTE_PAGO NULLS LAST, FECHA_APLICACION NULLS LAST,
  BANCO_CUENTA NULLS LAST, MONEDA_PAGO NULLS LAST, TC_PAGO NULLS LAST, ADELANTO_APLICADO NULLS LAST"""
FIRST_PAYMENT = f"""SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY INVOICE_ID ORDER BY {FIRST_ORDER}) AS n FROM payments_v1) WHERE n = 1"""
RATES = """SELECT FECHA_TASA, max(CONVERSION_RATE) AS rate FROM daily_rates
WHERE FROM_CURRENCY = 'USD' AND TO_CURRENCY = 'MXN' GROUP BY FECHA_TASA"""
ACCOUNT_NUMBER = "coalesce(case when len(string_split({c}, '-')) >= 5 then string_split({c}, '-')[5] end, '')"

_add(
    "j3_fanout",
    "invoices_v1 payments_v1 requisitions",
    """SELECT i.INVOICE_ID, i.FACTURA, i.IMPORTE, p.NUM_PAGO, p.IMPORTE_PAGO, q.REQUISITION_NUMBER
FROM invoices_v1 i LEFT JOIN payments_v1 p ON i.INVOICE_ID = p.INVOICE_ID
  LEFT JOIN requisitions q ON i.INVOICE_ID = q.INVOICE_ID""",
)
_add(
    "j4_schedule_payment",
    "invoices_v2 schedules payments_v4",
    """SELECT i.INVOICE_ID, i.FACTURA, i.INVOICE_AMOUNT, s.PAYMENT_NUM, s.SALDO_USD, p.NUM_PAGO, p.IMPORTE_PAGO_USD
FROM invoices_v2 i LEFT JOIN schedules s ON i.INVOICE_ID = s.INVOICE_ID
  LEFT JOIN payments_v4 p ON i.INVOICE_ID = p.INVOICE_ID""",
)
_add(
    "j5_first",
    "invoices_v1 payments_v1",
    """SELECT i.INVOICE_ID, i.FACTURA, p.* EXCLUDE (INVOICE_ID) FROM invoices_v1 i
LEFT JOIN fp p ON i.INVOICE_ID = p.INVOICE_ID""",
    fp=FIRST_PAYMENT,
)
_add(
    "j6_master",
    "invoices_v2 distributions prepay_ers",
    """SELECT i.INVOICE_ID, i.FACTURA, d.* EXCLUDE (INVOICE_ID), a.ADELANTO_USD FROM invoices_v2 i
LEFT JOIN d ON d.INVOICE_ID = i.INVOICE_ID LEFT JOIN a ON a.INVOICE_ID = i.INVOICE_ID""",
    d=PRINCIPAL,
    a=PREPAID,
)
_add(
    "j7_account_text",
    "invoices_v1 chart_of_accounts",
    """SELECT i.INVOICE_ID, i.CTA_NUM,
  i.CTA_NUM || ' - ' || coalesce(c.CUENTA_DESCRIPCION, 'DESC NO ENCONTRADA') AS CUENTA_GASTO_FULL
FROM i LEFT JOIN chart_of_accounts c ON c.CUENTA_NUM = i.CTA_NUM""",
    i=f"SELECT INVOICE_ID, {ACCOUNT_NUMBER.format(c='CUENTA_GASTO')} AS CTA_NUM FROM invoices_v1",
)
_add(
    "j8_receipts",
    "invoices_v2 prepay_ers",
    "SELECT i.INVOICE_ID, i.ORDEN_COMPRA, e.ERS FROM invoices_v2 i LEFT JOIN e ON e.ORDEN_COMPRA = i.ORDEN_COMPRA",
    e=RECEIPTS,
)
_add(
    "j9_rate_lookup",
    "invoices_v1 daily_rates",
    "SELECT i.INVOICE_ID, i.FECHA, t.rate FROM invoices_v1 i LEFT JOIN t ON t.FECHA_TASA = i.FECHA",
    t=RATES,
)
_add("o2_first_row", "payments_v1", "SELECT INVOICE_ID, FECHA_PAGO, NUM_PAGO, IMPORTE_PAGO FROM fp", fp=FIRST_PAYMENT)
_add(
    "o4_top_rows",
    "payments_v1",
    """SELECT INVOICE_ID, NUM_PAGO, FECHA_PAGO, IMPORTE_PAGO FROM payments_v1
ORDER BY IMPORTE_PAGO DESC, INVOICE_ID, NUM_PAGO, FECHA_PAGO LIMIT 10""",
)

# ---- scalar functions --------------------------------------------------------

_add(
    "x1_account_string",
    "GL_CODE_COMBINATIONS",
    f"""SELECT CODE_COMBINATION_ID, {_account('g', 9, '-')} AS account9, {_account('g', 5, '.')} AS account5
FROM GL_CODE_COMBINATIONS g""",
)
_add("x3_to_number", "flow_invoices", "SELECT INVOICE_ID, try_cast(INVOICE_AMOUNT as decimal(18,2)) AS amount FROM flow_invoices")
_add(
    "x4_rate_or_one",
    "payments_v1",
    """SELECT INVOICE_ID, NUM_PAGO, TC_PAGO,
  cast(case when TC_PAGO is null or TC_PAGO = 0 then 1 else TC_PAGO end as decimal(18,6)) AS rate,
  cast(case when TC_PAGO is null then 1 else TC_PAGO end as decimal(18,6)) AS rate_null_only FROM payments_v1""",
)
_add(
    "x6_offsets",
    "flow_invoices",
    """SELECT INVOICE_ID,
  case when length(INVOICE_DATE) > 10 then cast(replace(substr(INVOICE_DATE, 1, 19), 'T', ' ') as timestamp)
    else cast(INVOICE_DATE as timestamp) end AS wall,
  case when length(INVOICE_DATE) > 10
    then cast(replace(substr(INVOICE_DATE, 1, 19), 'T', ' ') as timestamp) + interval 6 hour
    else cast(INVOICE_DATE as timestamp) end AS utc,
  cast(substr(INVOICE_DATE, 1, 10) as date) AS day FROM flow_invoices""",
)
_add(
    "x7_periods",
    "invoices_v2",
    f"""SELECT INVOICE_ID, {week('FECHA')} AS week, monthname(FECHA) AS english, {month_es('FECHA')} AS spanish,
  strftime(FECHA, '%Y-%m') AS year_month, cast(month(FECHA) as int) AS number FROM invoices_v2""",
)
_add("x8_segment", "invoices_v1", f"SELECT INVOICE_ID, {ACCOUNT_NUMBER.format(c='CUENTA_GASTO')} AS account FROM invoices_v1")
_add(
    "x12_payment_status",
    "invoices_net",
    f"""SELECT INVOICE_ID, {status('ESTATUS_PAGO')} AS status,
  {status('ESTATUS_PAGO', 'DESCONOCIDO')} AS status_or_unknown FROM invoices_net""",
)
_add("x13_approval2", "invoices_v1", f"SELECT INVOICE_ID, {APPROVED_2.format(c='ESTATUS_APROBACION')} AS approval FROM invoices_v1")
_add("x13_approval3", "invoices_v2", f"SELECT INVOICE_ID, {APPROVED_3.format(c='ESTATUS')} AS approval FROM invoices_v2")
_add("x14_uuid", "invoices_net", f"SELECT INVOICE_ID, {UUID_CHECK} AS uuid_check FROM invoices_net")
_add(
    "x15_display",
    "payments_v1",
    """SELECT INVOICE_ID, strftime(FECHA_PAGO, '%d/%m/%Y') AS FECHA_PAGO,
  (case when IMPORTE_PAGO < 0 then '-' else '' end) || '$' || format('{:,.2f}', cast(abs(IMPORTE_PAGO) as double))
    AS IMPORTE_PAGO,
  case when TC_PAGO is not null then format('{:,.4f}', cast(TC_PAGO as double)) end AS TC_PAGO FROM payments_v1""",
)

# ---- measures ----------------------------------------------------------------

_add(
    "m1_subtotal_vat",
    "invoices_v1 tax_lines_v1",
    f"""SELECT i.INVOICE_ID, {m2('i.IMPORTE - coalesce(t.IVA, 0)')} AS subtotal
FROM invoices_v1 i LEFT JOIN t ON t.INVOICE_ID = i.INVOICE_ID""",
    t=PIVOT_RATE,
)
VAT_RET = m2(
    "coalesce(i.IMPORTE, 0) - coalesce(t.IVA, 0) - coalesce(t.RET_IVA, 0) - coalesce(t.RET_ISR, 0) "
    "- coalesce(t.RET_ISR_4, 0)"
)
_add(
    "m2_subtotal",
    "invoices_v1 tax_lines_v1",
    f"SELECT i.INVOICE_ID, {VAT_RET} AS subtotal FROM invoices_v1 i LEFT JOIN t ON t.INVOICE_ID = i.INVOICE_ID",
    t=PIVOT_CODE,
)
HELD_5 = " + ".join(f"coalesce(h.RET_{x}_USD, 0)" for x in ("ISR_4", "ISR_125", "ISR_10", "IVA", "OTRO"))
_V4_FROM = """FROM invoices_v2 i LEFT JOIN t ON t.INVOICE_ID = i.INVOICE_ID
LEFT JOIN h ON h.INVOICE_ID = i.INVOICE_ID"""
_add(
    "m3_subtotal_v4",
    "invoices_v2 taxes_v4 withholding",
    f"""SELECT i.INVOICE_ID, {m2(f'i.INVOICE_AMOUNT - coalesce(t.IVA_USD, 0) - ({HELD_5})')} AS subtotal,
  {m2(f'i.INVOICE_AMOUNT - coalesce(t.IVA_USD, 0) - ({HELD_5}) - coalesce(h.RET_IVA_6_USD, 0)')} AS subtotal_with_6
{_V4_FROM}""",
    t=PIVOT_V4,
    h=PIVOT_HELD,
)
_add(
    "m14_gross_retentions",
    "invoices_v2 withholding taxes_v4",
    f"SELECT i.INVOICE_ID, i.INVOICE_AMOUNT AS gross, {m2(HELD_5)} AS retentions {_V4_FROM}",
    t=PIVOT_V4,
    h=PIVOT_HELD,
)
HEADER_SUBTOTAL = m2("coalesce(INVOICE_AMOUNT, 0) - coalesce(TOTAL_TAX_AMOUNT, 0)")
_add("m4_subtotal_header", "invoices_v2", f"SELECT INVOICE_ID, {HEADER_SUBTOTAL} AS subtotal FROM invoices_v2")
_add(
    "m5_balance",
    "invoices_v1 payments_v1",
    f"""SELECT i.INVOICE_ID, {m2('i.IMPORTE - coalesce(p.IMPORTE_PAGO, 0)')} AS balance
FROM invoices_v1 i LEFT JOIN payments_v1 p ON p.INVOICE_ID = i.INVOICE_ID""",
)
_add(
    "m6_balance_prepaid",
    "invoices_v2 payments_v4 prepay_ers",
    f"""SELECT i.INVOICE_ID,
  {m2('coalesce(i.INVOICE_AMOUNT, 0) - coalesce(p.paid, 0) - coalesce(a.ADELANTO_USD, 0)')} AS balance
FROM invoices_v2 i LEFT JOIN p ON p.INVOICE_ID = i.INVOICE_ID LEFT JOIN a ON a.INVOICE_ID = i.INVOICE_ID""",
    p="SELECT INVOICE_ID, sum(IMPORTE_PAGO_USD) AS paid FROM payments_v4 GROUP BY INVOICE_ID",
    a=PREPAID,
)
TC = "cast(case when TC_PAGO is null or TC_PAGO = 0 then 1 else TC_PAGO end as decimal(18,6))"
_add(
    "m7_to_mxn",
    "payments_v1",
    f"""SELECT INVOICE_ID, NUM_PAGO, IMPORTE_PAGO, ADELANTO_APLICADO, TC_PAGO,
  {m2(f'IMPORTE_PAGO * {TC}')} AS "IMPORTE_PAGO MXN", {m2(f'ADELANTO_APLICADO * {TC}')} AS "ADELANTO_APLICADO MXN"
FROM payments_v1""",
)
for _name, _other in (("m8_split_as_usd", "as_usd"), ("m9_split_zero", "zero")):
    _add(
        _name,
        "invoices_v2",
        f"""SELECT INVOICE_ID, cur AS "CURRENCY", fx AS FX_RATE, INVOICE_AMOUNT,
  {usd('INVOICE_AMOUNT', 'cur', _other)} AS amount_usd, {mxn('INVOICE_AMOUNT', 'cur', 'fx', _other)} AS amount_mxn
FROM (SELECT *, {CURRENCY} AS cur, {FX} AS fx FROM invoices_v2) x""",
    )
PAY_CUR = "upper(coalesce(p.MONEDA_PAGO, 'MXN'))"
_add(
    "m10_payment_split",
    "invoices_v2 payments_v4",
    f"""SELECT i.INVOICE_ID, i.cur AS "CURRENCY", i.fx AS FX_RATE, p.NUM_PAGO,
  {usd('p.IMPORTE_PAGO_USD', PAY_CUR)} AS IMPORTE_PAGO_USD,
  {mxn('p.IMPORTE_PAGO_USD', PAY_CUR, 'coalesce(p.TIPO_CAMBIO_PAGO, i.fx)')} AS IMPORTE_PAGO_MXN,
  p.TIPO_CAMBIO_PAGO, p.MONEDA_PAGO
FROM (SELECT *, {CURRENCY} AS cur, {FX} AS fx FROM invoices_v2) i LEFT JOIN payments_v4 p ON p.INVOICE_ID = i.INVOICE_ID""",
)
_add(
    "m11_currency_fx",
    "invoices_v2",
    f'SELECT INVOICE_ID, {CURRENCY} AS "CURRENCY", {FX} AS FX_RATE, MONEDA, TIPO_CAMBIO_FACTURA FROM invoices_v2',
)
TOTAL = "coalesce(try_cast(TOTAL_FACTURA as decimal(18,2)), 0)"
NET = m2(f"{TOTAL} + coalesce(t.RET_IVA, 0) + coalesce(t.RET_ISR_4, 0) + coalesce(t.RET_ISR_10, 0)")
_add(
    "m12_net",
    "invoices_net tax_lines_v1",
    f"""SELECT i.INVOICE_ID, {m2(TOTAL)} AS TOTAL_FACTURA, {NET} AS net
FROM invoices_net i LEFT JOIN t ON t.INVOICE_ID = i.INVOICE_ID""",
    t=PIVOT_DETAIL,
)
FLOW = f"""SELECT *, cast(substr(INVOICE_DATE, 1, 10) as date) AS day,
  {m2('coalesce(try_cast(INVOICE_AMOUNT as decimal(18,2)), 0)')} AS amount FROM flow_invoices"""
IS_USD = "coalesce(upper(f.INVOICE_CURRENCY_CODE) = 'USD', false)"
_add(
    "m13_historical",
    "flow_invoices daily_rates",
    f"""SELECT f.INVOICE_ID, f.day, t.rate, f.amount,
  {m2(f'case when {IS_USD} and t.rate is not null then {m2("f.amount * t.rate")} else f.amount end')} AS amount_mxn,
  {IS_USD} and t.rate is null AS rate_missing FROM f LEFT JOIN t ON t.FECHA_TASA = f.day""",
    f=FLOW,
    t=RATES,
)

# ---- reports -----------------------------------------------------------------


def _times(x: str, rate: str) -> str:
    return m2(f"({x}) * {rate}")


def _master(subtotal: str, rate: str, filled: bool, tc: str = "p.TC_PAGO") -> str:
    z = (lambda c: f"coalesce({c}, 0)") if filled else (lambda c: c)
    total = z("i.IMPORTE")
    paid = z("p.IMPORTE_PAGO")
    advance = z("p.ADELANTO_APLICADO")
    saldo = m2(f"{total} - coalesce(p.IMPORTE_PAGO, 0)")
    iva = "coalesce(t.IVA, 0)"
    return f"""
SELECT i.EMPRESA, i.NUM_PROV, i.PROVEEDOR, i.RFC, i.FACTURA, i.ERS, q.REQUISITION_NUMBER, i.CUENTA_GASTO,
  i.CUENTA_BALANCE, i.UUID, i.FECHA, {week('i.FECHA')} AS SEMANA, monthname(i.FECHA) AS MES, i.MONEDA, p.FECHA_PAGO,
  {week('p.FECHA_PAGO')} AS SEMANA_PAGO, monthname(p.FECHA_PAGO) AS MES_PAGO, p.NUM_PAGO, i.DESCRIPTION,
  p.BANCO_CUENTA, p.FECHA_APLICACION, {m2(advance)} AS ADELANTO_APLICADO,
  {_times(advance, rate)} AS "ADELANTO_APLICADO MXN", {m2(paid)} AS IMPORTE_PAGO,
  {_times(paid, rate)} AS "IMPORTE_PAGO MXN", {subtotal} AS SUBTOTAL, {_times(subtotal, rate)} AS "SUBTOTAL MXN",
  {m2(iva)} AS IVA, {_times(iva, rate)} AS "IVA MXN", {m2(z('t.RET_IVA'))} AS RET_IVA, {m2(z('t.RET_ISR'))} AS RET_ISR,
  {m2(z('t.RET_ISR_4'))} AS RET_ISR_4, {m2(total)} AS IMPORTE, {_times(total, rate)} AS "IMPORTE MXN", {saldo} AS SALDO,
  {_times(saldo, rate)} AS "SALDO MXN", {tc} AS TC_PAGO, i.ORIGEN, {status('i.ESTATUS')} AS ESTATUS
FROM invoices_v1 i LEFT JOIN t ON t.INVOICE_ID = i.INVOICE_ID LEFT JOIN payments_v1 p ON p.INVOICE_ID = i.INVOICE_ID
  LEFT JOIN requisitions q ON q.INVOICE_ID = i.INVOICE_ID"""


_MASTER = "invoices_v1 tax_lines_v1 payments_v1 requisitions"
RATE_1 = "coalesce(p.TC_PAGO, cast(1 as decimal(18,6)))"
RATE_2 = "coalesce(nullif(p.TC_PAGO, 0), cast(1 as decimal(18,6)))"
RATE_2 = f"cast({RATE_2} as decimal(18,6))"
_add("r1", _MASTER, _master(m2("i.IMPORTE - coalesce(t.IVA, 0)"), RATE_1, False), t=PIVOT_RATE)
_add("r2", _MASTER, _master(VAT_RET, RATE_2, True), t=PIVOT_CODE)
_add("r2_filled_rate", _MASTER, _master(VAT_RET, RATE_2, True, tc=RATE_1), t=PIVOT_CODE)


def _zero(c: str) -> str:
    return m2(f"coalesce({c}, 0)")


_R3_SALDO = m2("coalesce(i.IMPORTE, 0) - coalesce(p.IMPORTE_PAGO, 0)")
_add(
    "r3",
    "invoices_v1 tax_lines_v1 payments_v1 requisitions chart_of_accounts",
    f"""
SELECT i.EMPRESA, i.NUM_PROV, i.PROVEEDOR, i.RFC, i.FACTURA, i.ERS, q.REQUISITION_NUMBER,
  i.CTA || ' - ' || coalesce(c.CUENTA_DESCRIPCION, 'DESC NO ENCONTRADA') AS CUENTA_GASTO, i.CUENTA_BALANCE, i.UUID,
  i.FECHA, {week('i.FECHA')} AS SEMANA, {month_es('i.FECHA')} AS MES, i.MONEDA, p.FECHA_PAGO,
  {week('p.FECHA_PAGO')} AS SEMANA_PAGO, {month_es('p.FECHA_PAGO')} AS MES_PAGO, p.NUM_PAGO, i.DESCRIPTION,
  p.BANCO_CUENTA, p.FECHA_APLICACION, {_zero('p.ADELANTO_APLICADO')} AS ADELANTO_APLICADO,
  {_times('coalesce(p.ADELANTO_APLICADO, 0)', RATE_2)} AS ADELANTO_APLICADO_MXN,
  {_zero('p.IMPORTE_PAGO')} AS IMPORTE_PAGO, {_times('coalesce(p.IMPORTE_PAGO, 0)', RATE_2)} AS IMPORTE_PAGO_MXN,
  {VAT_RET} AS SUBTOTAL, {_times(VAT_RET, RATE_2)} AS SUBTOTAL_MXN, {_zero('t.IVA')} AS IVA,
  {_times('coalesce(t.IVA, 0)', RATE_2)} AS IVA_MXN, {_zero('t.RET_IVA')} AS RET_IVA, {_zero('t.RET_ISR')} AS RET_ISR,
  {_zero('t.RET_ISR_4')} AS RET_ISR_4, {_zero('i.IMPORTE')} AS IMPORTE,
  {_times('coalesce(i.IMPORTE, 0)', RATE_2)} AS IMPORTE_MXN, {_R3_SALDO} AS SALDO,
  {_times(_R3_SALDO, RATE_2)} AS SALDO_MXN, p.TC_PAGO, i.ORIGEN,
  {APPROVED_2.format(c='i.ESTATUS_APROBACION')} AS ESTATUS_APROBACION, {status('i.ESTATUS')} AS ESTATUS
FROM i LEFT JOIN chart_of_accounts c ON c.CUENTA_NUM = i.CTA LEFT JOIN t ON t.INVOICE_ID = i.INVOICE_ID
  LEFT JOIN fp p ON p.INVOICE_ID = i.INVOICE_ID LEFT JOIN q ON q.INVOICE_ID = i.INVOICE_ID""",
    i=f"SELECT *, {ACCOUNT_NUMBER.format(c='CUENTA_GASTO')} AS CTA FROM invoices_v1",
    t=_class_sums("tax_lines_v1", rule_code("OTROS"), C_CODE[:-1], "TAX_AMT"),
    fp=FIRST_PAYMENT,
    q="SELECT INVOICE_ID, min(REQUISITION_NUMBER) AS REQUISITION_NUMBER FROM requisitions GROUP BY INVOICE_ID",
)
_add(
    "r4",
    "invoices_net tax_lines_v1 requisitions",
    f"""
SELECT i.FECHA_FACTURA, {status('i.ESTATUS_PAGO', 'DESCONOCIDO')} AS ESTATUS_PAGO, i.NOMBRE_PROVEEDOR, i.RFC_PROVEEDOR,
  i.FACTURA, i.UUID, q.REQUISITION_NUMBER, {m2(TOTAL)} AS TOTAL_FACTURA, {NET} AS NETO_A_PAGAR,
  {_zero('t.IVA_16')} AS IVA_16, {_zero('t.RET_IVA')} AS RET_IVA, {_zero('t.RET_ISR_4')} AS RET_ISR_4,
  {UUID_CHECK} AS VALIDACION_UUID, i.USUARIO_CAPTURA
FROM invoices_net i LEFT JOIN t ON t.INVOICE_ID = i.INVOICE_ID LEFT JOIN requisitions q ON q.INVOICE_ID = i.INVOICE_ID""",
    t=PIVOT_DETAIL,
)
_add(
    "r5",
    "flow_invoices flow_payments daily_rates",
    f"""
SELECT f.INVOICE_ID, f.INVOICE_DATE, f.amount AS INVOICE_AMOUNT, f.INVOICE_CURRENCY_CODE, p.ACCOUNTING_DATE,
  {m2('coalesce(p.paid, 0)')} AS AMOUNT, a.rate AS TASA_FECHA_FACTURA, b.rate AS TASA_FECHA_PAGO,
  {m2(f'case when {IS_USD} and a.rate is not null then {m2("f.amount * a.rate")} else f.amount end')}
    AS IMPORTE_FACTURA_MXN,
  {m2(f'case when {IS_USD} and b.rate is not null then {m2("coalesce(p.paid, 0) * b.rate")} else coalesce(p.paid, 0) end')}
    AS IMPORTE_PAGO_MXN,
  {IS_USD} and (a.rate is null or (p.day is not null and b.rate is null)) AS RATE_MISSING
FROM f LEFT JOIN p ON p.INVOICE_ID = f.INVOICE_ID LEFT JOIN t a ON a.FECHA_TASA = f.day
  LEFT JOIN t b ON b.FECHA_TASA = p.day""",
    f=FLOW,
    p="""SELECT *, cast(ACCOUNTING_DATE as date) AS day, try_cast(AMOUNT as decimal(18,2)) AS paid FROM flow_payments""",
    t=RATES,
)


def _r6(select: str) -> str:
    return f"{select} FROM r6"


_R6_NAMES = "invoices_v2 schedules payments_v4 distributions taxes_v2 prepay_ers"
_R6_STEPS = {
    "d": AGG_DIST,
    "t": _class_sums("taxes_v2", rule_type("coalesce(TIPO_IMPUESTO, TAX_TYPE_CODE)"), C_TYPE, "IMPUESTO_MXN", "_MXN"),
    "a": PREPAID,
    "e": RECEIPTS,
    "i": f"SELECT *, {CURRENCY} AS cur, {FX} AS fx FROM invoices_v2",
    "r6": f"""
SELECT i.INVOICE_ID, i.EMPRESA, i.NUM_PROV, i.PROVEEDOR, coalesce(i.RFC, i.INCOME_TAX_ID) AS RFC, i.FACTURA, e.ERS,
  d.CUENTA_CONTABLE_GASTO, d.CC_DEPARTAMENTO, i.TIPO, i.UUID, i.FECHA, {week('i.FECHA')} AS SEMANA,
  strftime(i.FECHA, '%Y-%m') AS MES, i.MONEDA, p.FECHA_APLICACION AS FECHA_PAGO,
  {week('p.FECHA_APLICACION')} AS SEMANA_PAGO, strftime(p.FECHA_APLICACION, '%Y-%m') AS MES_PAGO, p.NUM_PAGO,
  d.DESCRIPTION, p.BANCO_CUENTA, p.FECHA_APLICACION, {usd('a.ADELANTO_USD', 'i.cur')} AS ADELANTO_USD,
  {mxn('a.ADELANTO_USD', 'i.cur', 'i.fx')} AS ADELANTO_MXN, {usd('p.IMPORTE_PAGO_USD', PAY_CUR)} AS IMPORTE_PAGO_USD,
  {mxn('p.IMPORTE_PAGO_USD', PAY_CUR, 'coalesce(p.TIPO_CAMBIO_PAGO, i.fx)')} AS IMPORTE_PAGO_MXN,
  {usd(HEADER_SUBTOTAL, 'i.cur', 'as_usd')} AS SUBTOTAL_USD, {mxn(HEADER_SUBTOTAL, 'i.cur', 'i.fx', 'as_usd')} AS SUBTOTAL_MXN,
  t.IVA_MXN, t.RETENCION_IVA_MXN, t.RETENCION_ISR_MXN, t.RETENCION_ISR_4_MXN,
  {usd('s.IMPORTE_BRUTO_USD', 'i.cur')} AS IMPORTE_BRUTO_USD, {mxn('s.IMPORTE_BRUTO_USD', 'i.cur', 'i.fx')} AS IMPORTE_MXN,
  {usd('s.SALDO_USD', 'i.cur')} AS SALDO_USD, {mxn('s.SALDO_USD', 'i.cur', 'i.fx')} AS SALDO_MXN_CALC,
  i.TIPO_CAMBIO_FACTURA, p.TIPO_CAMBIO_PAGO, i.ORIGEN, {APPROVED_3.format(c='i.ESTATUS')} AS ESTATUS
FROM i LEFT JOIN schedules s ON s.INVOICE_ID = i.INVOICE_ID LEFT JOIN payments_v4 p ON p.INVOICE_ID = i.INVOICE_ID
  LEFT JOIN d ON d.INVOICE_ID = i.INVOICE_ID LEFT JOIN t ON t.INVOICE_ID = i.INVOICE_ID
  LEFT JOIN a ON a.INVOICE_ID = i.INVOICE_ID LEFT JOIN e ON e.ORDEN_COMPRA = i.ORDEN_COMPRA""",
}
_add("r6", _R6_NAMES, "SELECT * EXCLUDE (INVOICE_ID) FROM r6", **_R6_STEPS)
_add(
    "q2_summary",
    _R6_NAMES,
    """
SELECT count(*) AS row_count, count(DISTINCT INVOICE_ID) AS invoice_count, count(DISTINCT PROVEEDOR) AS supplier_count,
  (SELECT cast(sum(u) as decimal(38,2)) FROM once) AS total_usd,
  (SELECT cast(sum(m) as decimal(38,2)) FROM once) AS total_mxn,
  cast(sum(IMPORTE_BRUTO_USD) as decimal(38,2)) AS row_total_usd, cast(sum(IMPORTE_MXN) as decimal(38,2)) AS row_total_mxn,
  count(NUM_PAGO) AS paid_rows, count(*) FILTER (WHERE SALDO_USD > 0) AS pending_usd,
  count(*) FILTER (WHERE SALDO_USD > 0 OR SALDO_MXN_CALC > 0) AS pending_any,
  min(FECHA) AS first_date, max(FECHA) AS last_date FROM r6""",
    **_R6_STEPS,
    # from the schedules themselves, not from the report
    once=f"""SELECT {usd('s.IMPORTE_BRUTO_USD', 'i.cur')} AS u, {mxn('s.IMPORTE_BRUTO_USD', 'i.cur', 'i.fx')} AS m
FROM i JOIN schedules s ON s.INVOICE_ID = i.INVOICE_ID""",
)
ORACLE["a8_merged"] = ORACLE["q2_summary"]
ORACLE["a8_corrected"] = ORACLE["q2_summary"].replace(
    plain_sql(RELATION_SQL["schedules"]), plain_sql(RELATION_SQL["schedules_next"])
)
_add(
    "a8_days",
    _R6_NAMES,
    """
SELECT w.*, "DUE_USD", "DUE_MXN" FROM (
  SELECT cast(FECHA as date) AS "DAY", count(*) AS "ROWS", cast(sum(IMPORTE_BRUTO_USD) as decimal(38,2)) AS "SUM_USD",
    cast(sum(IMPORTE_MXN) as decimal(38,2)) AS "SUM_MXN", count(NUM_PAGO) AS "PAID",
    count(*) FILTER (WHERE SALDO_USD > 0) AS "PENDING_USD",
    count(*) FILTER (WHERE SALDO_USD > 0 OR SALDO_MXN_CALC > 0) AS "PENDING_ANY", min(FECHA) AS "FIRST", max(FECHA) AS "LAST"
  FROM r6 GROUP BY 1) w
LEFT JOIN (SELECT cast(FECHA as date) AS d, cast(sum(u) as decimal(38,2)) AS "DUE_USD",
    cast(sum(m) as decimal(38,2)) AS "DUE_MXN" FROM once GROUP BY 1) o ON o.d IS NOT DISTINCT FROM w."DAY"
""",
    **_R6_STEPS,
    once=f"""SELECT i.FECHA, {usd('s.IMPORTE_BRUTO_USD', 'i.cur')} AS u, {mxn('s.IMPORTE_BRUTO_USD', 'i.cur', 'i.fx')} AS m
FROM i LEFT JOIN schedules s ON s.INVOICE_ID = i.INVOICE_ID""",
)
_HELD_OUT = (
    "h.RET_ISR_4_USD AS RETENCION_ISR_4, h.RET_ISR_125_USD AS RETENCION_ISR_125, h.RET_ISR_10_USD AS RETENCION_ISR_10, "
    "h.RET_IVA_USD AS RETENCION_IVA, h.RET_OTRO_USD AS RETENCION_OTRO"
)
_HELD_MXN = ", ".join(f"h.{c}_MXN" for c in ("RET_ISR_4", "RET_ISR_125", "RET_ISR_10", "RET_IVA", "RET_OTRO"))
_R7_NAMES = "invoices_v2 taxes_v4 withholding distributions payments_v4 prepay_ers"
_R7 = f"""
SELECT i.INVOICE_ID, i.EMPRESA, i.NUM_PROV, i.PROVEEDOR, coalesce(i.RFC, i.INCOME_TAX_ID) AS RFC, i.FACTURA, a.ERS, i.TIPO, i.UUID, i.ORIGEN, i.ESTATUS,
  d.CUENTA_CONTABLE_GASTO, d.CC_DEPARTAMENTO, i.FECHA, p.FECHA_PAGO, p.FECHA_APLICACION, {week('i.FECHA')} AS SEMANA,
  cast(month(i.FECHA) as int) AS MES, {week('p.FECHA_PAGO')} AS SEMANA_PAGO,
  cast(month(p.FECHA_PAGO) as int) AS MES_PAGO, p.NUM_PAGO, d.DESCRIPTION, p.BANCO_CUENTA, a.ADELANTO_USD AS ADELANTO,
  p.IMPORTE_PAGO_USD AS IMPORTE_PAGO,
  {m2(f'coalesce(i.INVOICE_AMOUNT, 0) - coalesce(t.IVA_USD, 0) - ({HELD_5})')} AS SUBTOTAL, t.IVA_USD AS IVA, {_HELD_OUT},
  {m2(HELD_5)} AS TOTAL_RETENCIONES, i.INVOICE_AMOUNT AS IMPORTE_BRUTO,
  {m2('coalesce(i.INVOICE_AMOUNT, 0) - coalesce(p.IMPORTE_PAGO_USD, 0) - coalesce(a.ADELANTO_USD, 0)')} AS SALDO,
  a.ADELANTO_MXN, p.IMPORTE_PAGO_MXN, t.IVA_MXN, {_HELD_MXN}, i.TIPO_CAMBIO_FACTURA, p.TIPO_CAMBIO_PAGO, i.MONEDA,
  i.INVOICE_AMOUNT AS IMPORTE, i.TOTAL_TAX_AMOUNT, i.ORDEN_COMPRA, a.FACTURA_ADELANTO, a.TIPO_ORIGEN, i.DUE_DAYS,
  i.ORGANIZATION_TYPE_LOOKUP_CODE, i.GLOBAL_ATTRIBUTE1, t.OTROS_TAX_USD, t.OTROS_TAX_MXN,
  h.RET_IVA_6_USD, h.RET_IVA_6_MXN
FROM invoices_v2 i LEFT JOIN t ON t.INVOICE_ID = i.INVOICE_ID LEFT JOIN h ON h.INVOICE_ID = i.INVOICE_ID
  LEFT JOIN d ON d.INVOICE_ID = i.INVOICE_ID LEFT JOIN p ON p.INVOICE_ID = i.INVOICE_ID
  LEFT JOIN a ON a.INVOICE_ID = i.INVOICE_ID"""
_R7_STEPS = {"t": PIVOT_V4, "h": PIVOT_HELD, "d": PRINCIPAL, "p": AGG_PAY, "a": AGG_PREP, "r7": _R7}
_add("r7", _R7_NAMES, "SELECT * EXCLUDE (INVOICE_ID) FROM r7", **_R7_STEPS)
_add(
    "r7_rows",
    _R7_NAMES,
    "SELECT * EXCLUDE (NUM_PAGO, BANCO_CUENTA, ERS, FACTURA_ADELANTO, TIPO_ORIGEN) FROM r7",
    **_R7_STEPS,
)


def _values(relation: str, key: str, column: str, name: str, where: str = "true") -> str:
    """The distinct values of a column by key, each with its first place from the latest date backwards."""
    return f"""SELECT {key}, '{name}' AS list, {column} AS "value",
  case when count(*) = count(FECHA_APLICACION) then min(-epoch_us(FECHA_APLICACION)) end AS "first"
FROM {relation} WHERE {key} IS NOT NULL AND {column} IS NOT NULL AND {where} GROUP BY {key}, {column}"""


_add(
    "r7_lists",
    "payments_v4 prepay_ers",
    " UNION ALL ".join(
        [_values("payments_v4", "INVOICE_ID", c, c) for c in ("NUM_PAGO", "BANCO_CUENTA", "DESCRIPTION")]
        + [_values("prepay_ers", "INVOICE_ID", c, c) for c in ("TIPO_ORIGEN", "ERS", "ORDEN_COMPRA", "FACTURA_ADELANTO")]
    ),
)
_add("r6_receipts", "prepay_ers_few", _values("prepay_ers_few", "ORDEN_COMPRA", "ERS", "ERS", "TIPO_ORIGEN = 'ERS'"))
_FEW = {"invoices_v2": "SELECT * FROM invoices_v2_few", "prepay_ers": "SELECT * FROM prepay_ers_few"}
_R6_ROWS = {k: v for k, v in _R6_STEPS.items() if k != "e"}
_R6_ROWS["r6"] = _R6_ROWS["r6"].replace("e.ERS,", "i.ORDEN_COMPRA,").replace(
    "LEFT JOIN e ON e.ORDEN_COMPRA = i.ORDEN_COMPRA", ""
)
_add(
    "r6_rows",
    "invoices_v2_few schedules payments_v4 distributions taxes_v2 prepay_ers_few",
    "SELECT * EXCLUDE (INVOICE_ID) FROM r6",
    **{**_FEW, **_R6_ROWS},
)


# ---- profiles ----------------------------------------------------------------

_V1_TYPES = {
    "INVOICE_ID": "bigint", **dict.fromkeys("EMPRESA NUM_PROV PROVEEDOR RFC FACTURA ERS ORIGEN ESTATUS UUID".split(), "string"),
    "FECHA": "date", "MONEDA": "string", "DESCRIPTION": "string", "IMPORTE": "decimal(18,2)",
    "CUENTA_BALANCE": "string", "CUENTA_GASTO": "string", "ESTATUS_APROBACION": "string",
}
_add(
    "q1_profile",
    "invoices_v1",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{k}' AS data_type, count(*) - count({c}) AS null_count, count({c}) AS value_count,
  count(DISTINCT {c}) + (case when count(*) > count({c}) then 1 else 0 end) AS distinct_count FROM invoices_v1"""
        for c, k in _V1_TYPES.items()
    ),
)
_add(
    "q1_while_writing",
    "invoices_v1",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{k}' AS data_type, count(*) - count({c}) AS null_count, count({c}) AS value_count
  FROM invoices_v1"""
        for c, k in _V1_TYPES.items()
    ),
)
_add(
    "q3_prepayment",
    "prepay_ers",
    """SELECT TIPO_ORIGEN, count(*) AS row_count, sum(case when ADELANTO_MXN is null then 0 else 1 end)::bigint AS with_mxn,
  sum(case when ADELANTO_MXN is null then 1 else 0 end)::bigint AS without_mxn FROM prepay_ers GROUP BY TIPO_ORIGEN""",
)
_add(
    "q4_codes",
    "taxes_v2",
    """SELECT TAX_RATE_CODE, count(*) AS "count" FROM taxes_v2
WHERE TIPO_IMPUESTO = 'RETENCION_ISR' AND TAX_RATE_CODE IS NOT NULL
GROUP BY TAX_RATE_CODE ORDER BY "count" DESC, TAX_RATE_CODE LIMIT 20""",
)
_add(
    "q4_containing",
    "taxes_v2",
    "SELECT INVOICE_ID, TAX_TYPE_CODE, IMPUESTO_MXN FROM taxes_v2 WHERE TAX_TYPE_CODE LIKE '%4%'",
)
_add(
    "q5_width",
    "invoices_v1",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name,
  cast(least(greatest({len(c)}, coalesce(max(length(cast({c} as varchar))), 0)) + 2, 50) as int) AS width FROM invoices_v1"""
        for c in _V1_TYPES
    ),
)
_EXPECTED = {"INVOICE_ID", "FACTURA", "UUID", "ESTATUS_PAGO"}
_add(
    "q7_unexpected",
    "invoices_v1",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{k}' AS data_type, count(*) - count({c}) AS null_count, count({c}) AS value_count,
  count(DISTINCT {c}) + (case when count(*) > count({c}) then 1 else 0 end) AS distinct_count FROM invoices_v1"""
        for c, k in _V1_TYPES.items()
        if c not in _EXPECTED
    ),
)
_add("s5_peek", "invoices_v1", "SELECT * FROM invoices_v1 ORDER BY INVOICE_ID LIMIT 3")
_add(
    "k2_no_nan",
    "amounts_double",
    """SELECT INVOICE_ID, LINE, case when not isnan(AMOUNT) then AMOUNT end AS AMOUNT,
  case when not isnan(DISCOUNT) then DISCOUNT end AS DISCOUNT FROM amounts_double""",
)
ORACLE["o1_extract_order"] = ORACLE["e9_schedules"]
ORACLE["r2_stored"] = ORACLE["r2"]
_COLUMNS = "INVOICE_ID, PAYMENT_NUM, FECHA_VENCIMIENTO, IMPORTE_BRUTO_USD, SALDO_USD, PAYMENT_PRIORITY"
_add(
    "s6_changes",
    "schedules schedules_next",
    f"""
SELECT {_COLUMNS}, abs(more) AS "COPIES",
  case when INVOICE_ID not in (SELECT INVOICE_ID FROM schedules) then 'inserted'
    when INVOICE_ID not in (SELECT INVOICE_ID FROM schedules_next) then 'removed' when more > 0 then 'present' else 'former' end
    AS "CHANGE"
FROM (SELECT {_COLUMNS}, cast(sum(way) as bigint) AS more FROM (
    SELECT *, 1 AS way FROM schedules_next UNION ALL SELECT *, -1 AS way FROM schedules) b GROUP BY {_COLUMNS}) d
WHERE more <> 0""",
)
_add("s6_applied", "schedules_next", "SELECT * FROM schedules_next")
_add("k1_versions", "schedules", "SELECT * FROM schedules")
ORACLE["o1_positions"] = f"""SELECT *, row_number() OVER (ORDER BY INVOICE_ID NULLS LAST, PAYMENT_NUM NULLS LAST) AS "POSITION"
FROM ({ORACLE["e9_schedules"]}) x"""
_TOKENS = "('', 'NULL', 'null', 'None', 'N/A')"
_ABSENT = "cast(null as varchar)"
_add(
    "s1_csv_extract",
    "invoices_landed",
    f"""
SELECT INVOICE_ID, {_ABSENT} AS EMPRESA, {_ABSENT} AS NUM_PROV,
  case when PROVEEDOR not in {_TOKENS} then PROVEEDOR end AS PROVEEDOR, {_ABSENT} AS RFC, FACTURA, {_ABSENT} AS ERS,
  {_ABSENT} AS ORIGEN, ESTATUS AS ESTATUS_PAGO, {_ABSENT} AS UUID, try_cast(FECHA as date) AS FECHA, MONEDA,
  case when DESCRIPTION not in {_TOKENS} then DESCRIPTION end AS DESCRIPTION,
  try_cast(IMPORTE as decimal(18,2)) AS IMPORTE, {_ABSENT} AS CUENTA_BALANCE, {_ABSENT} AS CUENTA_GASTO,
  {_ABSENT} AS ESTATUS_APROBACION
FROM invoices_landed""",
)
_add("x16_header_tokens", "daily_rates", "SELECT * FROM daily_rates")
_add(
    "k1_report_sink",
    "amounts_double",
    """
SELECT INVOICE_ID, cast(LINE as integer) AS LINE, case when not isnan(AMOUNT) then AMOUNT end AS AMOUNT,
  case when not isnan(DISCOUNT) then DISCOUNT end AS DISCOUNT FROM amounts_double""",
)
_add("s2_optional", "requisitions", "SELECT cast(INVOICE_ID as varchar) AS INVOICE_ID, REQUISITION_NUMBER FROM requisitions")
_add("f7_non_empty", "schedules", "SELECT * FROM schedules")
for _few, _name in (("a15_few", "a15_receipts"), ("j8_few", "j8_receipts")):
    ORACLE[_few] = ORACLE[_name]
    for _relation in ("invoices_v2", "prepay_ers"):
        ORACLE[_few] = ORACLE[_few].replace(plain_sql(RELATION_SQL[_relation]), plain_sql(RELATION_SQL[f"{_relation}_few"]))
