"""Writing reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def replace_nan(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL; other columns pass through."""
    return df.select(
        *[
            F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, (T.FloatType, T.DoubleType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def write_report(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
) -> None:
    """Write a report as a directory of Parquet or CSV files, one per task."""
    writer = replace_nan(df).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        # cells are written as they are, blanks at their ends included
        keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        writer.options(header="true", escape='"', **keep).csv(path)
    else:
        writer.format(fmt).save(path)
