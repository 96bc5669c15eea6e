"""Date expressions: parsing, ISO week, month in four styles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuadre.sources.spec import MONTHS_EN, MONTHS_ES

# A clock time followed by a zone offset, at the end of a timestamp text.
OFFSET = r":\d\d(\.\d+)?\s*(Z|[+-]\d{1,2}(:?\d\d)?)$"


def to_date(c: Column | str) -> Column:
    """The first 10 characters as a date; NULL when they are not one."""
    return F.substring(_col(c), 1, 10).try_cast("date")


def to_stamp(c: Column | str, offsets: str = "wall") -> Column:
    """Timestamp text to a zone-less timestamp, value by value.

    offsets="wall" keeps the clock time as written and drops the offset;
    offsets="utc" converts to UTC first. Neither depends on the session zone.
    """
    wall = _col(c).try_cast("timestamp_ntz")
    if offsets == "wall":
        return wall
    if offsets == "utc":
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        since_epoch = F.unix_micros(_col(c).try_cast("timestamp"))
        utc = F.timestamp_add("MICROSECOND", since_epoch, epoch)
        return F.when(F.trim(_col(c)).rlike(OFFSET), utc).otherwise(wall)
    raise ValueError(f"offsets must be 'wall' or 'utc', not {offsets!r}")


def iso_week(c: Column | str) -> Column:
    return F.weekofyear(_col(c))


def month(c: Column | str, style: str) -> Column:
    """Month as "english" or "spanish" name, "year_month" text or "number"."""
    col = _col(c)
    # names by index and text by cast: a formatter per row costs several times more
    if style in ("english", "spanish"):
        names = MONTHS_EN if style == "english" else MONTHS_ES
        # not element_at: on a literal array it answers a NULL index with a value
        return F.get(F.array(*[F.lit(m) for m in names]), F.month(col) - 1)
    if style == "year_month":
        return F.substring(col.cast("date").cast("string"), 1, 7)
    if style == "number":
        return F.month(col)
    raise ValueError(f"unknown month style {style!r}")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
