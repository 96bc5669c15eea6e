"""Left joins that stay balanced when one key holds much of a relation.

AQE splits a skewed partition only on the preserved side of an outer join, and
only where a shuffle feeds the join directly. Two shapes of this domain fall
outside that: an invoice with very many payments and requisitions (the rows that
come out are their product), and many rows looking up an aggregated side (no
shuffle right below the join). Both are salted here, exactly: no row is dropped,
capped or sampled.

Hot keys are found by counting (partial aggregation, key column only). The work
of a key is the number of rows that the join yields for it. A key is hot when its
work is over `cell_rows` and it is among the SHARES keys with the most work, of
whose work it has over 1/SHARES. It is cut into cells of about that much work. So
there are fewer than SHARES hot keys, however large the relations are, and their
list may be broadcast; and what a key that is not hot gives to a task is less than
an even share of SHARES tasks. Each side is counted once: the list and the work
that it is measured by come out of one aggregation.

Cells come from hashes of the key and of given columns, nothing else: the plans stay
deterministic, so filters and column pruning reach the scans, and a rerun task
repeats them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuadre.operators.columns import left_join, named, settle_clash

CELL_ROWS = 10_000
SHARES = 100_000
#: Rows without a key match nothing; they spread over so many cells.
LOOSE_CELLS = 2**31 - 1
#: 0 in rows of a side, the number of the relation in those that ride along with it.
FLAT = "_flat"


def key_counts(df: DataFrame, on: str) -> DataFrame:
    """(key, _rows) of the keys of `df`."""
    return df.where(named(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_rows"))


def hot_keys(counts: list[DataFrame], on: str, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(key, _size0, _size1, …): hot keys and into how many cells each side is cut; fewer than SHARES rows.

    `counts` has a (key, _rows) relation for each side. The product of a key's sizes is about its work by the
    work of one cell. A size is NULL where a side is not cut.
    """
    sides = range(len(counts))
    tagged = [c.where(F.col("_rows") > 1).withColumn("_side", F.lit(i)) for i, c in zip(sides, counts)]
    by_side = [F.max(F.when(F.col("_side") == i, F.col("_rows"))) for i in sides]
    rows = [F.coalesce(F.col(f"_rows{i}"), F.lit(1)).cast("double") for i in sides]
    work = reduce(lambda a, b: a * b, rows)
    merged = reduce(DataFrame.unionByName, tagged).groupBy(on)
    merged = merged.agg(*[c.alias(f"_rows{i}") for i, c in zip(sides, by_side)]).withColumn("_work", work)
    most = merged.where(F.col("_work") > cell_rows).orderBy(F.desc("_work"), on).limit(SHARES)
    # at most SHARES rows, and already in one partition
    of_all = F.sum("_work").over(Window.partitionBy())
    hot = most.withColumn("_cell_work", F.greatest(F.lit(float(cell_rows)), of_all / SHARES))
    hot = hot.where(F.col("_work") > F.col("_cell_work"))
    sizes = [F.ceil(r / _rows_per_cell(rows, i)).cast("int") for i, r in zip(sides, rows)]
    return hot.select(on, *[F.when(s > 1, s).alias(f"_size{i}") for i, s in zip(sides, sizes)])


def _rows_per_cell(rows: list[Column], i: int) -> Column:
    """Rows of side i in a cell, so that the product over the sides is about the work of a cell."""
    work = F.col("_cell_work")
    if len(rows) == 1:
        return work
    if len(rows) == 2:
        # the smaller side is cut less: it may fit a cell whole
        small = F.least(F.least(*rows), F.sqrt(work))
        is_small = rows[0] <= rows[1] if i == 0 else rows[1] < rows[0]
        return F.when(is_small, small).otherwise(work / small)
    return F.pow(work, F.lit(1 / len(rows)))


def fan_out(
    base: DataFrame,
    sides: list[DataFrame],
    on: str,
    clash: str = "left",
    after: list[Callable[[DataFrame], DataFrame]] = (),
    cell_rows: int = CELL_ROWS,
    spread: list[list[str]] | None = None,
    counted: list[DataFrame | None] | None = None,
    salted: bool = True,
    derived: list[Callable[[DataFrame], DataFrame] | None] = (),
    flat: list[DataFrame] = (),
) -> DataFrame:
    """base LEFT JOIN side LEFT JOIN side … on one key, every combination kept.

    A hot key is cut into a grid of cells, with a dimension for each side. A row of
    side i sits in one cell of its own dimension and in all cells of the others; the
    base row sits in all cells. Every pair of side rows of a key then meets in
    exactly one cell. All relations are shuffled once, on (key, cells). The
    copies made are few against the combinations that the join yields. A base
    row whose cell has no row of a cut side is a by-product and is dropped: the
    side being cut, it does have rows of the key in other cells.

    `spread[i]` names columns that tell the rows of a key in side i apart; rows that agree in
    all of them share a cell. Without it all columns of the side count. `counted[i]` stands in
    for side i when keys are counted: a table with the same keys that costs less to read.
    `after[i]` adds columns once side i is joined, before the next side
    multiplies the rows. `derived[0]` adds columns to the base and `derived[i + 1]` to side i, at their own grain and behind the
    shuffle, so that the columns are not shuffled. Without `salted` the joins are plain ones on the key: for relations known to
    have no hot key, which may then use a common partitioning (`storage`).

    Relations in `flat` have one row per key, and their columns join the base's; of columns that clash the base's stay. They ride
    with the first side through its shuffle (`_with_flat`): joined to the base beforehand, they would have it shuffled by the
    key alone first, and all its columns once more than needed. `derived[0]` does not see their columns, `after` does.
    """
    derive = [None] * (1 + len(sides))
    derive[: len(derived)] = derived
    own_flat, taken = [], [*base.columns]
    for part in flat:
        own_flat.append(part.drop(*[c for c in part.columns if c in taken and c != on]))
        taken += [c for c in own_flat[-1].columns if c != on]
    if not salted:
        base = reduce(lambda rows, part: left_join(rows, part, on), own_flat, base)
        result = derive[0](base) if derive[0] else base
        for i, side in enumerate(sides):
            side = derive[i + 1](side) if derive[i + 1] else side
            result = left_join(result, side, on, clash)
            result = after[i](result) if i < len(after) else result
        return result
    sizes = [f"_size{i}" for i in range(len(sides))]
    cells = [f"_cell{i}" for i in range(len(sides))]
    counted = counted or [None] * len(sides)
    counts = [key_counts(side if c is None else c, on) for side, c in zip(sides, counted)]
    hot = F.broadcast(hot_keys(counts, on, cell_rows))

    def place(df: DataFrame, own: int | None, told_apart: list[str] | None = None) -> DataFrame:
        placed = df.join(hot, on, "left")
        others = [F.coalesce(F.col(size), F.lit(1)) for i, size in enumerate(sizes) if i != own]
        # a clash may have renamed or dropped some
        columns = [] if own is None else [c for c in (spread[own] if spread else []) if c in df.columns] or told_apart or df.columns
        mine = None if own is None else _own_cell([on, *columns], F.coalesce(F.col(sizes[own]), F.lit(1)))
        rides = FLAT in df.columns
        if others or rides:
            # copies are numbered, and a cell is a digit of the number: what makes them is generated code, for rows of keys that
            # are not hot too. No copy number is missing, so the outer form only saves a filter on the sequence
            copies = reduce(lambda a, b: a * b, others, F.lit(1))
            if rides:
                # a row that rides along sits in all cells of the side's own dimension too, which is the last place of its number
                whole = F.coalesce(F.col(sizes[own]), F.lit(1))
                copies = F.when(F.col(FLAT) > 0, copies * whole).otherwise(copies)
                mine = F.when(F.col(FLAT) > 0, _digits(F.col("_at"), [*others, whole])[-1]).otherwise(mine)
            placed = placed.withColumn("_at", F.explode_outer(_range(copies)))
        digits = iter(_digits(F.col("_at"), others))
        at = {cell: mine if i == own else next(digits) for i, cell in enumerate(cells)}
        if own is None:
            # only the base still has NULL keys when it is joined; they match nothing, anywhere
            loose = _own_cell(df.columns[:3], F.lit(LOOSE_CELLS))
            at = {cell: F.when(named(on).isNull(), loose).otherwise(digit) for cell, digit in at.items()}
        return placed.withColumns(at).drop("_at")

    result = place(base, None)
    if derive[0]:
        result = derive[0](result.repartition(*[named(c) for c in (on, *cells)]))
    for i, side in enumerate(sides):
        added = derive[i + 1](side).columns if derive[i + 1] else []
        rides = own_flat if i == 0 else []
        late = bool(added) and not rides and not {c for c in added if c != on} & {*result.columns}
        if added and not late:
            side = derive[i + 1](side)  # a clash may drop or rename what the columns are derived from
        side = settle_clash(result, side, [on], clash)
        if rides:
            side = reduce(lambda own, part: settle_clash(part, own, [on], clash), rides, side)
            ready = _with_flat(side, rides, on, cells, lambda rows: place(rows, 0, side.columns).drop(*sizes))
        else:
            ready = place(side, i).drop(*sizes)
            if late:
                ready = derive[i + 1](ready.repartition(*[named(c) for c in (on, *cells)]))
            ready = ready.withColumn("_match", F.lit(True))
        # many rows come out of few: spread them by a shuffle, also where a side would fit a broadcast
        result = result.join(ready.hint("shuffle_merge"), [on, *cells], "left")
        result = result.where(F.col(sizes[i]).isNull() | F.col("_match")).drop("_match")
        if i < len(after):
            result = after[i](result)
    return result.drop(*sizes, *cells)


def _with_flat(side: DataFrame, flat: list[DataFrame], on: str, cells: list[str], place: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of `side` in their cells, each with the columns of the one-row relations `flat`; a single row of these alone where a cell
    has no row of the side, which `_match` marks.

    All are one union, so that a single exchange takes them to the cells, in which the columns are handed on within the key.
    """
    handed = [c for part in flat for c in part.columns if c != on]
    parts = [df.where(named(on).isNotNull()).withColumn(FLAT, F.lit(i)) for i, df in enumerate([side, *flat])]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    here = Window.partitionBy(on, *cells)
    # one row of a key has the column at most
    known = {c: F.max(named(c)).over(here) for c in handed}
    rows = place(union).withColumns({**known, "_least": F.min(FLAT).over(here)}).where(F.col(FLAT) == F.col("_least"))
    return rows.withColumn("_match", F.when(F.col(FLAT) == 0, True)).drop(FLAT, "_least")


def join_lookup(
    left: DataFrame,
    right: DataFrame,
    on: str,
    spread: list[str],
    how: str = "left",
    clash: str = "left",
    counted: DataFrame | None = None,
    cell_rows: int = CELL_ROWS,
    salted: bool = True,
) -> DataFrame:
    """Join to a side with few rows per key, where left keys may be hot or NULL.

    Left rows of a hot key are spread over its cells by a hash of `spread` and
    its right rows are copied to each cell. NULL keys match nothing and are
    spread too, so they do not gather in one task. `how` is left or inner.

    Needed where the right side is an aggregate or a join on the same key: AQE
    splits a hot left key only if a shuffle feeds the join on both sides. A side
    read from a table needs no more than a plain join.

    `counted` stands in for `left` when hot keys are counted: a table with the
    same keys that costs less to read than `left` costs to compute. `salted` is that of fan_out; orders
    and suppliers may be hot where invoices are not, so this join is salted in any case.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    counts = key_counts(left if counted is None else counted, on)
    hot = F.broadcast(hot_keys([counts], on, cell_rows))
    size = F.when(named(on).isNull(), LOOSE_CELLS).otherwise(F.coalesce(F.col("_size0"), F.lit(1)))
    placed = left.join(hot, on, "left").withColumn("_cell", _own_cell(spread, size)).drop("_size0")
    copied = (
        settle_clash(left, right, [on], clash)
        .join(hot, on, "left")
        .withColumn("_cell", F.explode(_range(F.coalesce(F.col("_size0"), F.lit(1)))))
        .drop("_size0")
    )
    return placed.join(copied, [on, "_cell"], how).drop("_cell")


def _own_cell(columns: list[str], size: Column) -> Column:
    return F.pmod(F.xxhash64(*[named(c) for c in columns]), size).cast("int")


def _range(size: Column) -> Column:
    return F.sequence(F.lit(0), size - 1)


def _digits(number: Column, sizes: list[Column]) -> list[Column]:
    """The digits of a number whose places have `sizes` values, the lowest first: all their combinations as the number runs."""
    digits, place = [], F.lit(1)
    for size in sizes:
        digits.append((F.call_function("div", number, place) % size).cast("int"))
        place = place * size
    return digits
