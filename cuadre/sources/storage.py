"""Relations stored co-partitioned by a key, so that their joins and aggregates on it need no exchange.

`store` writes each relation that has the key in two parts. Rows of ordinary keys are bucketed and sorted by the key, one file
a bucket; all relations have the same number of buckets. Rows of hot keys, and rows without a key, are a plain table:
a bucket is one task, and these would make one task long. Which keys are hot is counted over all relations at once, by the rows
that a report makes of them (`skew.hot_keys`), so that a key is in the same part in all of them. Relations without the key are
plain tables.

`stored` opens them again, in any session: the bucketed parts as external tables over their files. A report over invoices is the
report over the bucketed parts, with plain joins, and the report over the others, with salted joins, one after the other
(`over_parts`).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cuadre.operators.columns import named
from cuadre.operators.skew import hot_keys, key_counts
from cuadre.session import input_bytes

#: A bucket is one task, so there is one for so many bytes of the files that the relations are read from.
BUCKET_BYTES = 16 * 1024 * 1024
#: A key is hot when the product of its rows in the relations is beyond this.
HOT_WORK = 1_000_000


@dataclass(frozen=True)
class Stored:
    """`bucketed` and `rest` have the parts of the relations with the key, `plain` the other relations."""

    bucketed: dict[str, DataFrame]
    rest: dict[str, DataFrame]
    plain: dict[str, DataFrame]

    def whole(self, name: str) -> DataFrame:
        """All rows of a relation; not co-partitioned."""
        if name in self.plain:
            return self.plain[name]
        return self.bucketed[name].unionByName(self.rest[name])


def store(relations: dict[str, DataFrame], folder: str, buckets: int, key: str = "INVOICE_ID", hot_work: int = HOT_WORK) -> None:
    """Writes `relations` under `folder`, a new one that all executors share. Each is read twice; they should be tables.

    There are `buckets` buckets at least, and more where the input is large: a task's memory does not grow with the data."""
    spark = next(iter(relations.values())).sparkSession
    buckets = buckets_for(spark, relations, buckets)
    keyed = {name: df for name, df in relations.items() if key in df.columns}
    hot = hot_keys([key_counts(df, key) for df in keyed.values()], key, hot_work).select(key)
    hot.write.parquet(f"{folder}/_hot")
    listed = F.broadcast(spark.read.parquet(f"{folder}/_hot"))  # fewer than skew.SHARES
    layout = []
    for name, df in relations.items():
        if name not in keyed:
            df.write.parquet(f"{folder}/{name}/plain")
            layout.append((name, key, 0, df.schema.json()))
            continue
        cold = df.where(named(key).isNotNull()).join(listed, key, "left_anti").select(*[named(c) for c in df.columns])
        table = _table_name()
        writer = cold.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{folder}/{name}/bucketed").saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")  # the files stay
        apart = df.join(listed.withColumn("_hot", F.lit(True)), key, "left").where(F.col("_hot") | named(key).isNull())
        apart.select(*[named(c) for c in df.columns]).write.parquet(f"{folder}/{name}/rest")
        layout.append((name, key, buckets, df.schema.json()))
    # written last: a folder without a layout is no store
    spark.createDataFrame(layout, "name string, key string, buckets int, schema string").coalesce(1).write.parquet(f"{folder}/_layout")


def buckets_for(spark: SparkSession, relations: dict[str, DataFrame], least: int) -> int:
    """Buckets for relations, by the bytes of the files that they are read from."""
    paths = sorted({path for df in relations.values() for path in df.inputFiles()})
    return max(least, -(-input_bytes(spark, paths) // BUCKET_BYTES))


def _table_name() -> str:
    return f"cuadre_{uuid.uuid4().hex}"


def stored(spark: SparkSession, folder: str) -> Stored:
    """What `store` wrote to `folder`."""
    found = Stored({}, {}, {})
    for name, key, buckets, text in spark.read.parquet(f"{folder}/_layout").collect():  # a row for each relation
        schema = StructType.fromJson(json.loads(text))
        if not buckets:
            found.plain[name] = spark.read.schema(schema).parquet(f"{folder}/{name}/plain")
            continue
        table = _table_name()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
            f" LOCATION '{folder}/{name}/bucketed'"
        )
        found.bucketed[name] = spark.table(table)
        found.rest[name] = spark.read.schema(schema).parquet(f"{folder}/{name}/rest")
    return found


def over_parts(build: Callable[..., DataFrame], relations: Stored, whole: tuple[str, ...] = (), **options) -> DataFrame:
    """A report that joins by the key alone, over the bucketed parts with plain joins and over the others with salted ones.

    `whole` names relations of which the report needs all rows in either, as they also join by another column.
    """
    shared = {name: relations.whole(name) for name in (*relations.plain, *whole)}
    ordinary = build(**{**relations.bucketed, **shared}, salted=False, **options)
    return ordinary.unionByName(build(**{**relations.rest, **shared}, **options))
