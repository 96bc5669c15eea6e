"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.

    Where it is unset, a temporary folder, which only a single-machine session may use.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    import tempfile

    folder = f"file://{tempfile.mkdtemp(prefix='cuadre-')}"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: cuts the lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learn_fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; the crc32 of a null id counts as 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")), F.lit(0)) % folds


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [b"" if value is None else value for value in column.cast(pa.binary()).to_pylist()]


def kinds(df: DataFrame, carried: list[str], added: str) -> StructType:
    """The schema of the columns `carried` of `df`, followed by those that the DDL text `added` names."""
    return StructType([df.schema[c] for c in carried] + StructType.fromDDL(added).fields)


#: Rows that Spark hands to a Python worker at once: texts may be long, and several workers share an executor.
BATCH_ROWS = 1_000


def per_batch(
    df: DataFrame, schema: str | StructType, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], most_rows: int = BATCH_ROWS
) -> DataFrame:
    """Maps Arrow batches of `df`, in slices of `most_rows`; `make` builds the mapping once per task.

    The session's Arrow batches are limited to BATCH_ROWS from here on.
    """
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(limit)) <= BATCH_ROWS:
        df.sparkSession.conf.set(limit, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            for start in range(0, batch.num_rows, most_rows):
                yield one(batch.slice(start, most_rows))
        # workers are kept for later tasks: they should not keep this one's memory
        del one
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def row_keys(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """row_a and row_b, two 64-bit hashes that stand for a row's id and text. Rows equal in both share them."""
    number, content = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return F.xxhash64(number, content).alias("row_a"), F.xxhash64(content, F.lit("b"), number).alias("row_b")


#: Beyond so many rows of ids or row keys a side is joined by a shuffle and no longer broadcast.
BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, a table of a few longs a row, marked for a broadcast if its counted size permits."""
    return F.broadcast(df) if df.count() <= rows else df
