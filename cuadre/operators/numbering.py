"""Positions of rows in an order, without a window that gathers a group in one task.

Rows are dealt over range partitions by group and order and written once, so that every later read sees the same
ranges. Each row's place within its partition comes with the write; the rows that stand before a partition in each
group are a running sum over one row for each group and partition. A group of any size spreads over partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of monotonically_increasing_id that number the rows of a partition.
ROW_BITS = 33


def numbered(
    df: DataFrame,
    order: list[str | Column],
    folder: str,
    group: str | None = None,
    position: str = "position",
    total: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """`df` with `position`, from 0 in each `group` by `order`, and the group's rows as `total` if named.

    A NULL group is a group of its own. Rows equal in `order` stand in the order in which `df` is read; `df` should
    be a table that is read, so that a repeated task deals its rows out as before. `folder` is new, on storage that all
    executors share, and stays in use as long as the result does.
    """
    spark, kept = df.sparkSession, df.columns
    by = [*([F.col(f"`{group}`").asc_nulls_first()] if group else []), *order, F.col("_seq")]
    dealt = df.withColumn("_seq", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(partitions, *by) if partitions else dealt.repartitionByRange(*by)
    placed = dealt.sortWithinPartitions(*by).withColumn("_row", F.monotonically_increasing_id()).drop("_seq")
    placed.write.parquet(folder)
    stored = spark.read.schema(placed.schema).parquet(folder).withColumn("_part", F.shiftright("_row", ROW_BITS))
    keys = [F.col(f"`{group}`").alias("_group")] if group else [F.lit(1).alias("_group")]
    parts = stored.groupBy(*keys, F.col("_part").alias("_of_part")).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    in_group = Window.partitionBy("_group")
    before = in_group.orderBy("_of_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "_group", "_of_part", "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(in_group).alias("_total"),
    )
    same = F.col("_part") == F.col("_of_part")
    if group:
        same &= F.col(f"`{group}`").eqNullSafe(F.col("_group"))
    found = {position: F.col("_before") + F.col("_row") - F.col("_first")} | ({total: F.col("_total")} if total else {})
    carried = [F.col(f"`{c}`") for c in kept if c not in found]
    return stored.join(parts, same).select(*carried, *[c.alias(name) for name, c in found.items()])
