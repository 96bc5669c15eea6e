"""Session settings the plans in this package are written for."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # zone-less timestamps and ISO weeks must not depend on the machine
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits hot keys of plain dimension joins; fan-out and lookup joins are
    # salted in operators/skew.py because AQE cannot split those
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a side is broadcast only when its measured size is below this
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
}

#: Parquet weighs a page and a row group only after 100 to 10,000 rows, a number that it guesses from the rows before. Lists of
#: megabytes that follow rows without one were all held until then; with these a writer holds few rows beyond its limits.
LONG_CELLS = {
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "4",
    "parquet.block.size.row.check.min": "1",
    "parquet.block.size.row.check.max": "4",
    # cells that repeat are written once in a dictionary, up to so many bytes, and as numbers in the rows; whether a dictionary pays is
    # judged by the first page, which by its plain size has to hold a cell several times
    "parquet.dictionary.page.size": str(128 * 1024 * 1024),
    "parquet.page.size": str(32 * 1024 * 1024),
    # a row group has its own dictionaries, so this bounds those of columns with many short values
    "parquet.block.row.count.limit": "50000",
}


#: Spark removes the shuffle files of a query when it ends; a lost file would be made again.
SHUFFLE_FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def sized_for(input_bytes: int, partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Settings that keep scan and shuffle partitions near `partition_bytes`, however large the input.

    AQE starts from the number of shuffle partitions and merges small ones.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(-(-input_bytes // partition_bytes), 200)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
    }


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of all files under `paths`; a path that does not exist has none."""
    jvm, conf, total = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        store = place.getFileSystem(conf)
        if store.exists(place):
            total += store.getContentSummary(place).getLength()
    return total


def size_session(spark: SparkSession, paths: list[str]) -> None:
    """Sizes the partitions of a session for inputs that it is about to read."""
    for key, value in sized_for(input_bytes(spark, paths)).items():
        spark.conf.set(key, value)


def expect_long_cells(spark: SparkSession) -> None:
    """Settings of a session whose results have cells that grow with the data, for whoever writes them."""
    for key, value in LONG_CELLS.items():
        spark.conf.set(key, value)


@contextmanager
def shuffles_end_with_the_write(spark: SparkSession) -> Iterator[None]:
    """What is written here leaves no shuffle files behind: each write removes its own as it ends. Else they lie on the executors'
    disks until the driver happens to collect its garbage, and a job of several writes needs room for the shuffles of all."""
    before = spark.conf.get(SHUFFLE_FILES_GO, None)
    spark.conf.set(SHUFFLE_FILES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_FILES_GO)
        else:
            spark.conf.set(SHUFFLE_FILES_GO, before)


def build_session(
    master: str | None = None,
    app: str = "cuadre",
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with SETTINGS, overridden by `settings`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, under spark.checkpoint.dir; only a session of a single machine may leave it unset."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        top = f"file://{tempfile.mkdtemp(prefix='cuadre-')}"
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"
