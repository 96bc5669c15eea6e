"""Changes between two states of a relation that is extracted again and again.

Rows are compared by a 128-bit digest of all their columns, so that a row changes if any of them does, and counted, so that
repeated rows are told by their number. Only keys and digests are shuffled; rows themselves are read again for the changes
alone. `applied` brings an older state up to date: rows without a change pass as they are, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuadre.operators.columns import named

#: What happened to a row: its key is new or gone, or the key stays and the row is one of its former or present ones.
INSERTED, REMOVED, FORMER, PRESENT = "inserted", "removed", "former", "present"
CHANGE, COPIES = "CHANGE", "COPIES"


def _digests(columns: list[str]) -> list[Column]:
    # a hash skips NULL, so each column says whether it is
    told = [x for c in columns for x in (named(c), named(c).isNull())]
    return [F.xxhash64(F.lit(0), *told).alias("_low"), F.xxhash64(F.lit(1), *told).alias("_high")]


def changes(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows that `new` has more or fewer of than `old`, with the same columns: those columns, CHANGE and COPIES, by how many.

    NULL is a value of a key like any other. Both are read twice.
    """
    columns = new.columns
    if sorted(old.columns) != sorted(columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(columns))}")
    keys = [f"_key{i}" for i in range(len(key))]

    def narrow(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*[named(c).alias(k) for c, k in zip(key, keys)], *_digests(columns), F.lit(sign).alias("_sign"))

    both = narrow(old, -1).unionByName(narrow(new, 1))
    rows = both.groupBy(*keys, "_low", "_high").agg(
        F.sum("_sign").alias("_more"), F.max("_sign").alias("_last"), F.min("_sign").alias("_first")
    )
    # rows of a key are spread over digests; a key with very many rows is combined by digest first
    of_key = rows.groupBy(*keys).agg(F.max("_last").alias("_in_new"), F.min("_first").alias("_in_old"), F.max(F.abs("_more")).alias("_any"))
    told = rows.where("_more <> 0").join(
        of_key.where("_any > 0").select(*[F.col(k).alias(f"{k}_") for k in keys], "_in_new", "_in_old"),
        [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys],
    )
    change = (
        F.when(F.col("_in_old") > 0, INSERTED)
        .when(F.col("_in_new") < 0, REMOVED)
        .when(F.col("_more") > 0, PRESENT)
        .otherwise(FORMER)
    )
    found = told.select("_low", "_high", "_more", change.alias(CHANGE), F.abs("_more").cast("long").alias(COPIES))

    def whole(df: DataFrame, wanted: DataFrame) -> DataFrame:
        digested = df.select(*[named(c) for c in columns], *_digests(columns))
        rows_of = digested.join(wanted.drop("_more"), ["_low", "_high"])
        # equal rows stand for each other
        once = rows_of.withColumn("_n", F.row_number().over(Window.partitionBy("_low", "_high").orderBy(F.lit(0))))
        return once.where("_n = 1").select(*[named(c) for c in columns], CHANGE, COPIES)

    return whole(new, found.where("_more > 0")).unionByName(whole(old, found.where("_more < 0")))


def applied(old: DataFrame, change_set: DataFrame) -> DataFrame:
    """`old` with a change set of `changes`: what was the new state."""
    columns = old.columns
    gone = change_set.where(F.col(CHANGE).isin(REMOVED, FORMER)).select(*_digests(columns), COPIES)
    rows = old.select(*[named(c) for c in columns], *_digests(columns))
    untouched = rows.join(gone.drop(COPIES), ["_low", "_high"], "left_anti")
    touched = rows.join(gone, ["_low", "_high"])
    numbered = touched.withColumn("_n", F.row_number().over(Window.partitionBy("_low", "_high").orderBy(F.lit(0))))
    left = numbered.where(F.col("_n") > F.col(COPIES))
    came = change_set.where(F.col(CHANGE).isin(INSERTED, PRESENT))
    came = came.select(*[named(c) for c in columns], F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES))).alias("_copy"))
    keep = [named(c) for c in columns]
    return untouched.select(*keep).unionByName(left.select(*keep)).unionByName(came.select(*keep))
