"""CSV files cut into records by many tasks, also where quoted cells hold line breaks.

By RFC 4180 a line break stands inside a cell just where the quotes before it, from the file's beginning, are odd in
number. Files are read as lines, in blocks that Spark splits them into: one pass counts the lines with an odd number of
quotes in each block, a running sum over one row for each block tells how many stand before it in its file, and within a
block a running sum cuts the lines into records. Nearly all records are single lines and go straight to the parser; the lines
of the others are put together by the number of their record, wherever their blocks lie.

Where a quote stands in a cell that is not quoted, the count means nothing. Each record is held against the grammar, and the
read fails on the first that is none, as it does on a quote that is never closed: rows are never cut in the wrong place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
#: A cell in quotes, those in it doubled, or one without quotes; possessive, so that a cell of any length needs no stack.
_CELL = '(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
GRAMMAR = f"^{_CELL}(?:,{_CELL})*+$"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: value, file, block (the byte at which its block begins), line (increasing within a block), and
    odd: 1 if the line has an odd number of quotes."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit(QUOTE), F.lit("")))
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        (quotes % 2).alias("odd"),
    )


def _blocks(read: DataFrame) -> DataFrame:
    """(_file, _block, before, crlf): odd lines of the file before each block, and whether the file's first line ends with a
    carriage return and a line feed."""
    counts = read.groupBy("file", "block").agg(
        F.sum("odd").alias("odds"), F.min_by(F.endswith(F.col("value"), F.lit("\r")), "line").alias("crlf")
    )
    in_file = Window.partitionBy("file")
    so_far = in_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    open_quote = F.raise_error(F.concat(F.lit("a quote is never closed in "), F.col("file"))).cast("long")
    before = F.coalesce(F.sum("odds").over(so_far), F.lit(0))
    return counts.select(
        F.col("file").alias("_file"), F.col("block").alias("_block"),
        F.when(F.sum("odds").over(in_file) % 2 == 1, open_quote).otherwise(before).alias("before"),
        F.first("crlf").over(in_file.orderBy("block")).alias("crlf"),
    )


def _is_record(record: Column) -> Column:
    """True; fails on text that is no record."""
    wrong = F.raise_error(F.concat(F.lit("no record by RFC 4180, read the file with one task: "), F.substring(record, 1, 200)))
    return F.when(record.rlike(GRAMMAR), F.lit(True)).otherwise(wrong.cast("boolean"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the files under `path` but the first of each, as text (`record`); blank lines between records are none.
    In a file whose lines end with a carriage return and a line feed, those in cells become line feeds, as in Spark's own reader."""
    read = lines(spark, path)
    same = (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    in_block = Window.partitionBy("file", "block").orderBy("line")
    inside = F.coalesce(F.sum("odd").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = read.withColumns({"inside": inside, "top": (F.row_number().over(in_block) == 1) & (F.col("block") == 0)})
    placed = placed.join(_blocks(read), same).withColumn("odds", F.col("before") + F.col("inside"))
    # the first line of a record of several has an even number of odd lines before it, its other lines the next odd number
    several = (F.col("odd") == 1) | (F.col("odds") % 2 == 1)
    # line ends of two characters count as one, in cells as well
    text = F.when(F.col("crlf"), F.replace(F.regexp_replace("value", "\r$", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("value"))

    def kept(left_out: Column) -> Column:
        # one CASE: parts of a conjunction might be checked on lines that are no records
        return F.when(left_out | (F.trim(text) == ""), F.lit(False)).otherwise(_is_record(text))

    singles = placed.where(kept(several | F.col("top"))).select(text.alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined = (
        placed.where(several)
        .groupBy("file", F.expr("odds div 2").alias("record"))
        .agg(parts.alias("parts"), F.max("top").alias("top"), F.first("crlf").alias("crlf"))
        .select("top", "crlf", F.array_join("parts.value", "\n").alias("value"))
        .where(kept(F.col("top")))
        .select(text.alias("record"))
    )
    return singles.unionAll(joined)


def read_split(spark: SparkSession, path: str, options: dict[str, str], schema: T.StructType | None = None) -> DataFrame:
    """CSV files with a header, as text or by `schema`, read by many tasks each. `options` are those of Spark's reader; records
    end with a line feed, after a carriage return or not, and the text is UTF-8."""
    if schema is None:
        # the header of one file, read as far as it goes
        names = spark.read.options(**options, multiLine="true").csv(path).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if not schema.fields:
        return spark.createDataFrame([], schema)
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    cells = F.from_csv("record", ddl, {k: v for k, v in options.items() if k != "header"})
    parsed = records(spark, path).select(cells.alias("cells"))
    return parsed.select(*[F.col("cells").getField(f.name).alias(f.name) for f in schema.fields])
