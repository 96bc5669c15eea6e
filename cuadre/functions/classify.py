"""Tax and withholding classes as CASE expressions.

Missing text takes part as empty text and so matches no token. Branch order is
part of each rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuadre.functions.text import upper_or_empty
from cuadre.sources.spec import CLASSES_BY_TYPE


def classify_by_rate(rate: str = "TAX_RATE", amount: str = "TAX_AMT") -> Column:
    """Class of a tax line by its rate and the sign of its amount."""
    r, a = F.col(rate), F.col(amount)
    return (
        F.when(r.isin(16, 8) & (a > 0), "IVA")
        .when(r == 4, "RET_ISR_4")
        .when((a < 0) & (r == 10), "RET_ISR")
        .when(a < 0, "RET_IVA")
        .otherwise("OTROS_TAX")
    )


def classify_by_rate_detail(rate: str = "TAX_RATE", amount: str = "TAX_AMT") -> Column:
    """As classify_by_rate, with the two VAT rates apart."""
    r, a = F.col(rate), F.col(amount)
    return (
        F.when((r == 16) & (a > 0), "IVA_16")
        .when((r == 8) & (a > 0), "IVA_8")
        .when(r == 4, "RET_ISR_4")
        .when((a < 0) & (r == 10), "RET_ISR_10")
        .when(a < 0, "RET_IVA")
        .otherwise("OTROS_IMPUESTOS")
    )


def classify_by_code(
    code: str = "CODIGO_IMPUESTO",
    line_type: str = "TIPO_LINEA",
    rate: str = "TAX_RATE",
    default: str = "OTROS_TAX",
) -> Column:
    """Class by tax code; a 4 anywhere in a withholding code means the 4% one."""
    text = upper_or_empty(code)
    withheld = text.contains("RET") | (upper_or_empty(line_type) == "AWT")
    four = text.contains("4") | F.coalesce(F.col(rate) == 4, F.lit(False))
    return (
        F.when(text.contains("IVA") & ~text.contains("RET"), "IVA")
        .when(withheld & four, "RET_ISR_4")
        .when(withheld & text.contains("ISR"), "RET_ISR")
        .when(withheld, "RET_IVA")
        .otherwise(default)
    )


def classify_by_type(code: str = "TAX_TYPE_CODE") -> Column:
    """Class by tax type code; a value that already is a class stays."""
    text = upper_or_empty(code)
    has = text.contains
    return (
        F.when(text.isin(*CLASSES_BY_TYPE), text)
        .when(has("IVA") & ~has("RET"), "IVA")
        .when(has("RET") & has("IVA"), "RETENCION_IVA")
        .when(has("RET_ISR") & ~has("4"), "RETENCION_ISR")
        .when(has("4") & has("ISR"), "RETENCION_ISR_4")
        .otherwise("OTRO")
    )


def classify_by_percentage(percentage: str = "PORCENTAJE_RETENCION") -> Column:
    """Withholding class by the withheld percentage, already rounded to 2 places."""
    p = F.col(percentage)
    return (
        F.when(p == 4, "RET_ISR_4")
        .when(p == F.lit("1.25").cast("decimal(18,2)"), "RET_ISR_125")
        .when(p == F.lit("10.66").cast("decimal(18,2)"), "RET_IVA")
        .when(p == 10, "RET_ISR_10")
        .when(p == 6, "RET_IVA_6")
        .otherwise("RET_OTRO")
    )


def known_class(c: str, classes: tuple[str, ...], other: str) -> Column:
    """A class outside the fixed list folds into `other`; NULL stays NULL."""
    return F.when(F.col(c).isin(*classes), F.col(c)).when(F.col(c).isNotNull(), other)
