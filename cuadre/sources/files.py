"""Reading extracts and tables, and conforming them to a RelationSpec."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuadre.functions import dates, numbers
from cuadre.sources.csv_scan import read_split
from cuadre.sources.spec import DEFAULT_NULL_TOKENS, NULL_TOKENS, RelationSpec

# RFC 4180 quoting: a quote inside a quoted cell is doubled.
CSV_OPTIONS = {"header": "true", "escape": '"', "encoding": "UTF-8"}


def fold_headers(df: DataFrame) -> DataFrame:
    """Trim and upper-case column names; two names that fold together are an error."""
    names = [c.strip().upper() for c in df.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"columns repeated after folding the header: {repeated}")
    return df.toDF(*names)


def nullify_tokens(df: DataFrame, tokens=NULL_TOKENS + DEFAULT_NULL_TOKENS) -> DataFrame:
    """Text cells that spell a missing value become NULL; the match is exact."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[
            F.when(~_named(c).isin(*tokens), _named(c)).alias(c) if c in text else _named(c)
            for c in df.columns
        ]
    )


def conform(df: DataFrame, spec: RelationSpec, offsets: str = "wall") -> DataFrame:
    """Columns of `spec` in order and type; aliases apply only if the target is absent.

    Values that do not parse become NULL. `offsets` says what a timestamp text
    with a zone offset means, see `dates.to_stamp`.
    """
    renames: dict[str, str] = {}
    for source, target in spec.aliases.items():
        if source in df.columns and target not in df.columns and target not in renames.values():
            renames[source] = target
    for target, (wanted, unwanted) in spec.tokens.items():
        if target not in df.columns and target not in renames.values():
            free = [c for c in df.columns if c not in spec.columns and c not in renames]
            fit = [c for c in free if any(t in c for t in wanted) and not any(t in c for t in unwanted)]
            renames.update({fit[0]: target} if fit else {})
    copies = {target: _named(source) for source, target in renames.items() if source in spec.columns}
    df = df.withColumns(copies) if copies else df
    df = df.withColumnsRenamed({s: t for s, t in renames.items() if s not in spec.columns})
    source_types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            _typed(name, source_types.get(name), target, offsets, name in spec.identifiers).alias(name)
            for name, target in spec.columns.items()
        ]
    )


def _typed(name: str, source: T.DataType | None, target: T.DataType, offsets: str, identifies: bool) -> Column:
    if source is None:
        return F.lit(None).cast(target)
    col = _named(name)
    if isinstance(target, T.StringType):
        return numbers.canonical_id(col, source) if identifies else col.cast(target)
    if source == target:
        return col
    if isinstance(source, T.StringType):
        if isinstance(target, T.DateType):
            return dates.to_date(col)
        if isinstance(target, T.TimestampNTZType):
            return dates.to_stamp(col, offsets)
    return col.try_cast(target)


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def read_extract(
    spark: SparkSession,
    spec: RelationSpec,
    path: str,
    *,
    required: bool = True,
    fmt: str = "csv",
    offsets: str = "wall",
    cells: str = "quoted",
) -> DataFrame:
    """One extract as its relation; an absent optional one is an empty relation.

    CSV is read as text and parsed per value, so no inference pass runs over the
    file. `cells` is as in read_csv.
    """
    try:
        if fmt == "csv":
            raw = read_csv(spark, path, cells)
        else:
            raw = spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND" and not required:
            return empty(spark, spec)
        raise
    return conform(nullify_tokens(fold_headers(raw)), spec, offsets)


def read_csv(spark: SparkSession, path: str, cells: str = "quoted", schema: T.StructType | None = None) -> DataFrame:
    """A CSV file or folder with a header, as text or by `schema`. What `cells` may hold decides how files are read:

    "quoted": line breaks, in quotes (RFC 4180). Files are split between tasks (`csv_scan`); the read fails on a record
    that is none.
    "one_line": no line breaks. Files are split between tasks, in one pass; the read fails on a line that is not a
    whole record.
    "free": also quotes in cells that are not quoted, and line ends that are a carriage return alone. Each file is one task.
    """
    if cells == "quoted":
        return read_split(spark, path, CSV_OPTIONS, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if cells == "free":
        return reader.options(**CSV_OPTIONS, multiLine="true").csv(path)
    if cells != "one_line":
        raise ValueError(f"cells must be 'quoted', 'one_line' or 'free', not {cells!r}")
    options = {**CSV_OPTIONS, "multiLine": "false", "mode": "FAILFAST"}
    raw = reader.options(**options).csv(path)
    # without all columns in use the parser would not check a line
    whole = [F.coalesce(_named(c).cast("string"), F.lit("")) for c in raw.columns]
    return raw.where(F.length(F.concat(*whole)) >= 0) if whole else raw


def require(df: DataFrame, name: str = "relation") -> DataFrame:
    """`df`, or an error where it has no row."""
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df


def empty(spark: SparkSession, spec: RelationSpec) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in spec.columns.items()])


def scan_since(df: DataFrame, column: str, since: dt.date | str) -> DataFrame:
    """Rows created on or after a date; the literal is pushed to the Parquet scan."""
    if isinstance(since, str):
        since = dt.date.fromisoformat(since)
    if not isinstance(df.schema[column].dataType, T.DateType):
        # a literal of the column's own type keeps the filter free of casts
        midnight = dt.datetime.combine(since, dt.time())
        return df.where(F.col(column) >= F.lit(midnight).cast(df.schema[column].dataType))
    return df.where(F.col(column) >= F.lit(since))


def describe_schema(df: DataFrame, relation: str = "", spec: RelationSpec | None = None) -> DataFrame:
    """Columns of a relation as rows; `expected` is false for unlisted ones."""
    known = set(spec.columns) if spec else set(df.columns)
    rows = [
        (relation, i, f.name, f.dataType.simpleString(), f.name in known)
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "relation string, position int, name string, type string, expected boolean"
    )


def peek(df: DataFrame, n: int = 3) -> DataFrame:
    """The first rows of an extract, as they come."""
    return df.limit(n)
