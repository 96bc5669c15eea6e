"""Relations of the payables domain: columns, types, aliases, fixed lists.

Nothing here touches data. A relation may arrive as a CSV extract with a dirty
header or as a Parquet table; `sources.files` conforms either to its spec.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 6)
TEXT = T.StringType()
#: Text that identifies something: without a decimal tail, whatever type it was stored in.
ID = "identifier"
INT = T.IntegerType()
DATE = T.DateType()
STAMP = T.TimestampNTZType()

# Text that stands for a missing value in a CSV extract, besides what a
# spreadsheet tool would already treat as missing (fixed values).
NULL_TOKENS = ("", "NULL", "null", "None")
DEFAULT_NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NaN", "n/a", "nan",
)


@dataclass(frozen=True)
class RelationSpec:
    """Schema of one relation: the declared kind of each column, a type or ID; `aliases` maps a foreign column
    name to ours. An alias whose foreign column is one of ours as well is copied, otherwise renamed."""

    name: str
    declared: dict[str, T.DataType | str]
    aliases: dict[str, str] = field(default_factory=dict)
    #: Column of ours -> (tokens of which a foreign name has one, tokens it has none of): what is found by
    #: neither name nor alias is the first foreign column whose name fits.
    tokens: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = field(default_factory=dict)

    @property
    def columns(self) -> dict[str, T.DataType]:
        return {c: TEXT if kind == ID else kind for c, kind in self.declared.items()}

    @property
    def identifiers(self) -> set[str]:
        return {c for c, kind in self.declared.items() if kind == ID}

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t) for c, t in self.columns.items()])


# ---- fixed values: the columns of the relations -------------------------------
INVOICES_V1 = RelationSpec(
    "invoices_v1",
    {
        "INVOICE_ID": ID,
        "EMPRESA": TEXT,
        "NUM_PROV": ID,
        "PROVEEDOR": TEXT,
        "RFC": TEXT,
        "FACTURA": TEXT,
        "ERS": TEXT,
        "ORIGEN": TEXT,
        "ESTATUS_PAGO": TEXT,
        "UUID": TEXT,
        "FECHA": DATE,
        "MONEDA": TEXT,
        "DESCRIPTION": TEXT,
        "IMPORTE": MONEY,
        "CUENTA_BALANCE": TEXT,
        "CUENTA_GASTO": TEXT,
        "ESTATUS_APROBACION": TEXT,
    },
    {
        "ESTATUS": "ESTATUS_PAGO",
    },
)

INVOICES_V2 = RelationSpec(
    "invoices_v2",
    {
        "INVOICE_ID": ID,
        "FACTURA": TEXT,
        "VOUCHER_NUM": ID,
        "INVOICE_AMOUNT": MONEY,
        "TOTAL_TAX_AMOUNT": MONEY,
        "FECHA": STAMP,
        "TERMS_DATE": STAMP,
        "MONEDA": TEXT,
        "TIPO_CAMBIO_FACTURA": RATE,
        "GLOBAL_ATTRIBUTE1": TEXT,
        "UUID": TEXT,
        "ORIGEN": TEXT,
        "ESTATUS": TEXT,
        "TIPO": TEXT,
        "VENDOR_ID": ID,
        "ORG_ID": ID,
        "TERMS_ID": ID,
        "NUM_PROV": ID,
        "PROVEEDOR": TEXT,
        "ORGANIZATION_TYPE_LOOKUP_CODE": TEXT,
        "EMPRESA": TEXT,
        "INCOME_TAX_ID": TEXT,
        "DUE_DAYS": INT,
        "ORDEN_COMPRA": ID,
        "RFC": TEXT,
    },
    {
        "EXCHANGE_RATE": "TIPO_CAMBIO_FACTURA",
        "INVOICE_CURRENCY_CODE": "MONEDA",
        "GLOBAL_ATTRIBUTE1": "UUID",
    },
)

INVOICES_V4 = RelationSpec(
    "invoices_v4",
    {
        "INVOICE_ID": ID,
        "FACTURA": TEXT,
        "VOUCHER_NUM": ID,
        "IMPORTE": MONEY,
        "TOTAL_TAX_AMOUNT": MONEY,
        "FECHA": STAMP,
        "TERMS_DATE": STAMP,
        "MONEDA": TEXT,
        "TIPO_CAMBIO_FACTURA": RATE,
        "GLOBAL_ATTRIBUTE1": TEXT,
        "UUID": TEXT,
        "ORIGEN": TEXT,
        "ESTATUS_APROBACION": TEXT,
        "TIPO": TEXT,
        "VENDOR_ID": ID,
        "ORG_ID": ID,
        "TERMS_ID": ID,
        "NUM_PROV": ID,
        "PROVEEDOR": TEXT,
        "ORGANIZATION_TYPE_LOOKUP_CODE": TEXT,
        "EMPRESA": TEXT,
        "INCOME_TAX_ID": TEXT,
        "DUE_DAYS": INT,
        "ORDEN_COMPRA": ID,
        "RFC": TEXT,
    },
    {
        "INVOICE_AMOUNT": "IMPORTE",
        "ESTATUS": "ESTATUS_APROBACION",
        "GLOBAL_ATTRIBUTE1": "UUID",
    },
)

INVOICES_NET = RelationSpec(
    "invoices_net",
    {
        "INVOICE_ID": ID,
        "FECHA_FACTURA": DATE,
        "ESTATUS_PAGO": TEXT,
        "NOMBRE_PROVEEDOR": TEXT,
        "RFC_PROVEEDOR": TEXT,
        "FACTURA": TEXT,
        "UUID": TEXT,
        "USUARIO_CAPTURA": TEXT,
        "TOTAL_FACTURA": TEXT,
    },
)

TAX_LINES_V1 = RelationSpec(
    "tax_lines_v1",
    {
        "INVOICE_ID": ID,
        "TAX_RATE": RATE,
        "TAX_AMT": MONEY,
        "TIPO_LINEA": TEXT,
        "CODIGO_IMPUESTO": TEXT,
    },
)

TAXES_V2 = RelationSpec(
    "taxes_v2",
    {
        "INVOICE_ID": ID,
        "TRX_LINE_NUMBER": INT,
        "TAX_TYPE_CODE": TEXT,
        "IMPUESTO_USD": MONEY,
        "IMPUESTO_MXN": MONEY,
        "TAX_CURRENCY_CODE": TEXT,
        "CURRENCY_CONVERSION_RATE": RATE,
        "TIPO_IMPUESTO": TEXT,
        "TAX_RATE_CODE": TEXT,
    },
    {
        "TAX_AMT": "IMPUESTO_USD",
        "TAX_AMT_FUNCL_CURR": "IMPUESTO_MXN",
    },
)

TAXES_V4 = RelationSpec(
    "taxes_v4",
    {
        "INVOICE_ID": ID,
        "CLASIFICACION_IMPUESTO": TEXT,
        "IMPUESTO_USD": MONEY,
        "IMPUESTO_MXN": MONEY,
    },
)

PAYMENTS_V1 = RelationSpec(
    "payments_v1",
    {
        "INVOICE_ID": ID,
        "NUM_PAGO": ID,
        "FECHA_PAGO": DATE,
        "FECHA_APLICACION": DATE,
        "BANCO_CUENTA": TEXT,
        "IMPORTE_PAGO": MONEY,
        "ADELANTO_APLICADO": MONEY,
        "MONEDA_PAGO": TEXT,
        "TC_PAGO": RATE,
    },
)

PAYMENTS_V2 = RelationSpec(
    "payments_v2",
    {
        "INVOICE_ID": ID,
        "CHECK_ID": ID,
        "NUM_PAGO": ID,
        "BANCO_CUENTA": TEXT,
        "FECHA_APLICACION": STAMP,
        "IMPORTE_PAGO_USD": MONEY,
        "IMPORTE_PAGO_MXN": MONEY,
        "TIPO_CAMBIO_PAGO": RATE,
        "MONEDA_PAGO": TEXT,
    },
    {
        "CHECK_NUMBER": "NUM_PAGO",
        "BANK_ACCOUNT_NAME": "BANCO_CUENTA",
        "ACCOUNTING_DATE": "FECHA_APLICACION",
        "AMOUNT": "IMPORTE_PAGO_USD",
        "EXCHANGE_RATE": "TIPO_CAMBIO_PAGO",
        "PAYMENT_CURRENCY_CODE": "MONEDA_PAGO",
        "CURRENCY_CODE_PAY": "MONEDA_PAGO",
    },
)

PAYMENTS_V4 = RelationSpec(
    "payments_v4",
    {
        "INVOICE_ID": ID,
        "CHECK_ID": ID,
        "NUM_PAGO": ID,
        "BANCO_CUENTA": TEXT,
        "FECHA_APLICACION": STAMP,
        "IMPORTE_PAGO_USD": MONEY,
        "IMPORTE_PAGO_MXN": MONEY,
        "TIPO_CAMBIO_PAGO": RATE,
        "MONEDA_PAGO": TEXT,
        "DESCRIPTION": TEXT,
        "FECHA_PAGO": STAMP,
    },
    {
        "CHECK_NUMBER": "NUM_PAGO",
        "BANK_ACCOUNT_NAME": "BANCO_CUENTA",
        "ACCOUNTING_DATE": "FECHA_APLICACION",
        "AMOUNT": "IMPORTE_PAGO_USD",
        "EXCHANGE_RATE": "TIPO_CAMBIO_PAGO",
        "PAYMENT_CURRENCY_CODE": "MONEDA_PAGO",
        "CURRENCY_CODE_PAY": "MONEDA_PAGO",
    },
)

SCHEDULES = RelationSpec(
    "schedules",
    {
        "INVOICE_ID": ID,
        "PAYMENT_NUM": INT,
        "FECHA_VENCIMIENTO": STAMP,
        "IMPORTE_BRUTO_USD": MONEY,
        "SALDO_USD": MONEY,
        "PAYMENT_PRIORITY": INT,
    },
    {
        "DUE_DATE": "FECHA_VENCIMIENTO",
        "AMOUNT_REMAINING": "SALDO_USD",
        "GROSS_AMOUNT": "IMPORTE_BRUTO_USD",
    },
)

DISTRIBUTIONS = RelationSpec(
    "distributions",
    {
        "INVOICE_ID": ID,
        "DISTRIBUTION_LINE_NUMBER": INT,
        "DESCRIPTION": TEXT,
        "IMPORTE_DISTRIBUCION_USD": MONEY,
        "DIST_CODE_COMBINATION_ID": ID,
        "CUENTA_CONTABLE_GASTO": TEXT,
        "CC_EMPRESA": TEXT,
        "CC_DEPARTAMENTO": TEXT,
        "CC_CUENTA": TEXT,
    },
    {
        "CONCATENATED_SEGMENTS": "CUENTA_CONTABLE_GASTO",
        "SEGMENT2": "CC_DEPARTAMENTO",
        "AMOUNT": "IMPORTE_DISTRIBUCION_USD",
    },
)

PREPAY_ERS = RelationSpec(
    "prepay_ers",
    {
        "INVOICE_ID": ID,
        "PREPAY_INVOICE_ID": ID,
        "ADELANTO_USD": MONEY,
        "FECHA_APLICACION": STAMP,
        "MONEDA": TEXT,
        "TIPO_CAMBIO": RATE,
        "TIPO_ORIGEN": TEXT,
        "ERS": TEXT,
        "ORDEN_COMPRA": ID,
    },
    {
        "INVOICE_AMOUNT": "ADELANTO_USD",
        "ACCOUNTING_DATE": "FECHA_APLICACION",
        "SEGMENT1": "ORDEN_COMPRA",
        "SOURCE_TRANSACTION_NUM": "ERS",
    },
)

PREPAY_ERS_V4 = RelationSpec(
    "prepay_ers_v4",
    {
        "INVOICE_ID": ID,
        "PREPAY_INVOICE_ID": ID,
        "ADELANTO_USD": MONEY,
        "FECHA_APLICACION": STAMP,
        "MONEDA": TEXT,
        "TIPO_CAMBIO": RATE,
        "TIPO_ORIGEN": TEXT,
        "ERS": TEXT,
        "ORDEN_COMPRA": ID,
        "ADELANTO_MXN": MONEY,
        "FACTURA_ADELANTO": TEXT,
    },
    {
        "INVOICE_AMOUNT": "ADELANTO_USD",
        "ACCOUNTING_DATE": "FECHA_APLICACION",
        "SEGMENT1": "ORDEN_COMPRA",
        "SOURCE_TRANSACTION_NUM": "ERS",
    },
)

WITHHOLDING = RelationSpec(
    "withholding",
    {
        "INVOICE_ID": ID,
        "FACTURA": TEXT,
        "DISTRIBUTION_LINE_NUMBER": INT,
        "RETENCION_USD": MONEY,
        "RETENCION_MXN": MONEY,
        "WITHHOLDING_TAX_CODE_ID": ID,
        "NOMBRE_IMPUESTO": TEXT,
        "TAX_REGIME_CODE": TEXT,
        "MONTO_BASE": MONEY,
        "PORCENTAJE_RETENCION": MONEY,
        "CLASIFICACION_RETENCION": TEXT,
        "FECHA_APLICACION": STAMP,
    },
)

REQUISITIONS = RelationSpec(
    "requisitions",
    {
        "INVOICE_ID": ID,
        "REQUISITION_NUMBER": ID,
    },
)

INVOICE_ACCOUNTS = RelationSpec(
    "invoice_accounts",
    {
        "INVOICE_ID": ID,
        "CUENTA_NUM": ID,
    },
)

CHART_OF_ACCOUNTS = RelationSpec(
    "chart_of_accounts",
    {
        "CUENTA_NUM": ID,
        "CUENTA_DESCRIPCION": TEXT,
    },
)

DAILY_RATES = RelationSpec(
    "daily_rates",
    {
        "FECHA_TASA": DATE,
        "FROM_CURRENCY": TEXT,
        "TO_CURRENCY": TEXT,
        "CONVERSION_RATE": RATE,
    },
    {
        "CONVERSION_DATE": "FECHA_TASA",
        "RATE_DATE": "FECHA_TASA",
        "FECHA": "FECHA_TASA",
        "RATE": "CONVERSION_RATE",
        "TASA": "CONVERSION_RATE",
    },
    {
        "FECHA_TASA": (("FECHA", "DATE"), ()),
        "CONVERSION_RATE": (("RATE", "TASA"), ("FECHA", "DATE")),
    },
)

FLOW_INVOICES = RelationSpec(
    "flow_invoices",
    {
        "INVOICE_ID": ID,
        "INVOICE_DATE": TEXT,
        "INVOICE_AMOUNT": TEXT,
        "INVOICE_CURRENCY_CODE": TEXT,
    },
)

FLOW_PAYMENTS = RelationSpec(
    "flow_payments",
    {
        "INVOICE_ID": ID,
        "ACCOUNTING_DATE": TEXT,
        "AMOUNT": TEXT,
    },
)
# ---- fixed values -----------------------------------------------------------
# Tax classes each rule can yield.
CLASSES_BY_RATE = ("IVA", "RET_ISR_4", "RET_ISR", "RET_IVA", "OTROS_TAX")
CLASSES_BY_RATE_DETAIL = ("IVA_16", "IVA_8", "RET_IVA", "RET_ISR_4", "RET_ISR_10", "OTROS_IMPUESTOS")
CLASSES_BY_CODE = ("IVA", "RET_IVA", "RET_ISR", "RET_ISR_4", "OTROS_TAX")
CLASSES_BY_TYPE = ("IVA", "RETENCION_IVA", "RETENCION_ISR", "RETENCION_ISR_4", "OTRO")
CLASSES_BY_PERCENTAGE = ("RET_ISR_4", "RET_ISR_125", "RET_ISR_10", "RET_IVA", "RET_IVA_6", "RET_OTRO")
CLASSES_V4_TAX = ("IVA", "OTROS_TAX")

# Report layouts: column names and their order.
MASTER_COLUMNS = [
    "EMPRESA",
    "NUM_PROV",
    "PROVEEDOR",
    "RFC",
    "FACTURA",
    "ERS",
    "REQUISITION_NUMBER",
    "CUENTA_GASTO",
    "CUENTA_BALANCE",
    "UUID",
    "FECHA",
    "SEMANA",
    "MES",
    "MONEDA",
    "FECHA_PAGO",
    "SEMANA_PAGO",
    "MES_PAGO",
    "NUM_PAGO",
    "DESCRIPTION",
    "BANCO_CUENTA",
    "FECHA_APLICACION",
    "ADELANTO_APLICADO",
    "ADELANTO_APLICADO MXN",
    "IMPORTE_PAGO",
    "IMPORTE_PAGO MXN",
    "SUBTOTAL",
    "SUBTOTAL MXN",
    "IVA",
    "IVA MXN",
    "RET_IVA",
    "RET_ISR",
    "RET_ISR_4",
    "IMPORTE",
    "IMPORTE MXN",
    "SALDO",
    "SALDO MXN",
    "TC_PAGO",
    "ORIGEN",
    "ESTATUS",
]

ACCOUNT_MASTER_COLUMNS = [
    "EMPRESA",
    "NUM_PROV",
    "PROVEEDOR",
    "RFC",
    "FACTURA",
    "ERS",
    "REQUISITION_NUMBER",
    "CUENTA_GASTO",
    "CUENTA_BALANCE",
    "UUID",
    "FECHA",
    "SEMANA",
    "MES",
    "MONEDA",
    "FECHA_PAGO",
    "SEMANA_PAGO",
    "MES_PAGO",
    "NUM_PAGO",
    "DESCRIPTION",
    "BANCO_CUENTA",
    "FECHA_APLICACION",
    "ADELANTO_APLICADO",
    "ADELANTO_APLICADO_MXN",
    "IMPORTE_PAGO",
    "IMPORTE_PAGO_MXN",
    "SUBTOTAL",
    "SUBTOTAL_MXN",
    "IVA",
    "IVA_MXN",
    "RET_IVA",
    "RET_ISR",
    "RET_ISR_4",
    "IMPORTE",
    "IMPORTE_MXN",
    "SALDO",
    "SALDO_MXN",
    "TC_PAGO",
    "ORIGEN",
    "ESTATUS_APROBACION",
    "ESTATUS",
]

NET_PAYABLE_COLUMNS = [
    "FECHA_FACTURA",
    "ESTATUS_PAGO",
    "NOMBRE_PROVEEDOR",
    "RFC_PROVEEDOR",
    "FACTURA",
    "UUID",
    "REQUISITION_NUMBER",
    "TOTAL_FACTURA",
    "NETO_A_PAGAR",
    "IVA_16",
    "RET_IVA",
    "RET_ISR_4",
    "VALIDACION_UUID",
    "USUARIO_CAPTURA",
]

SCHEDULE_PAYMENT_COLUMNS = [
    "EMPRESA",
    "NUM_PROV",
    "PROVEEDOR",
    "RFC",
    "FACTURA",
    "ERS",
    "CUENTA_CONTABLE_GASTO",
    "CC_DEPARTAMENTO",
    "TIPO",
    "UUID",
    "FECHA",
    "SEMANA",
    "MES",
    "MONEDA",
    "FECHA_PAGO",
    "SEMANA_PAGO",
    "MES_PAGO",
    "NUM_PAGO",
    "DESCRIPTION",
    "BANCO_CUENTA",
    "FECHA_APLICACION",
    "ADELANTO_USD",
    "ADELANTO_MXN",
    "IMPORTE_PAGO_USD",
    "IMPORTE_PAGO_MXN",
    "SUBTOTAL_USD",
    "SUBTOTAL_MXN",
    "IVA_MXN",
    "RETENCION_IVA_MXN",
    "RETENCION_ISR_MXN",
    "RETENCION_ISR_4_MXN",
    "IMPORTE_BRUTO_USD",
    "IMPORTE_MXN",
    "SALDO_USD",
    "SALDO_MXN_CALC",
    "TIPO_CAMBIO_FACTURA",
    "TIPO_CAMBIO_PAGO",
    "ORIGEN",
    "ESTATUS",
]

INVOICE_V4_COLUMNS = [
    "EMPRESA",
    "NUM_PROV",
    "PROVEEDOR",
    "RFC",
    "FACTURA",
    "ERS",
    "TIPO",
    "UUID",
    "ORIGEN",
    "ESTATUS_APROBACION",
    "CUENTA_CONTABLE_GASTO",
    "CC_DEPARTAMENTO",
    "FECHA",
    "FECHA_PAGO",
    "FECHA_APLICACION",
    "SEMANA",
    "MES",
    "SEMANA_PAGO",
    "MES_PAGO",
    "NUM_PAGO",
    "DESCRIPTION",
    "BANCO_CUENTA",
    "ADELANTO_USD",
    "IMPORTE_PAGO_USD",
    "SUBTOTAL",
    "IVA_USD",
    "RET_ISR_4_USD",
    "RET_ISR_125_USD",
    "RET_ISR_10_USD",
    "RET_IVA_USD",
    "RET_OTRO_USD",
    "TOTAL_RETENCIONES",
    "IMPORTE_BRUTO",
    "SALDO",
    "ADELANTO_MXN",
    "IMPORTE_PAGO_MXN",
    "IVA_MXN",
    "RET_ISR_4_MXN",
    "RET_ISR_125_MXN",
    "RET_ISR_10_MXN",
    "RET_IVA_MXN",
    "RET_OTRO_MXN",
    "TIPO_CAMBIO_FACTURA",
    "TIPO_CAMBIO_PAGO",
    "MONEDA",
    "IMPORTE",
    "TOTAL_TAX_AMOUNT",
    "ORDEN_COMPRA",
    "FACTURA_ADELANTO",
    "TIPO_ORIGEN",
    "DUE_DAYS",
    "ORGANIZATION_TYPE_LOOKUP_CODE",
]

INVOICE_V4_DROPPED = [
    "VENDOR_ID",
    "ORG_ID",
    "TERMS_ID",
    "INVOICE_ID",
    "TERMS_DATE",
    "CC_EMPRESA",
    "CC_CUENTA",
    "TIPO_CAMBIO",
    "VOUCHER_NUM",
]
INVOICE_V4_RENAMES = {
    "ESTATUS_APROBACION": "ESTATUS",
    "ADELANTO_USD": "ADELANTO",
    "IMPORTE_PAGO_USD": "IMPORTE_PAGO",
    "IVA_USD": "IVA",
    "RET_ISR_4_USD": "RETENCION_ISR_4",
    "RET_ISR_125_USD": "RETENCION_ISR_125",
    "RET_ISR_10_USD": "RETENCION_ISR_10",
    "RET_IVA_USD": "RETENCION_IVA",
    "RET_OTRO_USD": "RETENCION_OTRO",
}

MONTHS_EN = ("January", "February", "March", "April", "May", "June", "July", "August", "September",
             "October", "November", "December")
MONTHS_ES = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre",
             "Octubre", "Noviembre", "Diciembre")

PAYMENT_STATUS = {"Y": "PAGADO", "P": "PARCIAL", "N": "PENDIENTE"}
# -----------------------------------------------------------------------------
