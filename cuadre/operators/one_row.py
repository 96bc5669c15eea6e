"""One row per key out of many relations by one aggregation.

Where several relations are summed by the same key and joined, each costs an exchange, and each join a sort. Here their rows,
cut down to a few shared columns and marked by the relation they come from, are one union, which is dealt out by the key and
then combined by conditional aggregates: a single exchange takes the place of one for each relation, and a
single join that of one for each. The narrow rows are what is shuffled: the aggregates of a key, a column for each class and
amount, are many times as wide, and a map task that meets most keys once has nothing to combine. A key that a relation does not have gets NULL from it, as a left join gives.

All aggregates are over numbers and dates, so the union is aggregated in hash tables and never sorted.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuadre.operators.columns import named, read_whole


@dataclass(frozen=True)
class Side:
    """A relation of the union. `slots` says what stands in the shared columns; rows may be of one of `classes` by `category`."""

    rows: DataFrame
    slots: dict[str, Column]
    category: Column | None = None
    classes: tuple[str, ...] = ()


class Tagged:
    """The union of `sides` by `key`; `types` are the shared columns and what they hold. A row is marked by one small number for its
    relation and class, as text would be shuffled with each.

    The rows are dealt out by key. With `shared` all who read some of their columns read the same exchange.
    """

    def __init__(self, key: str, types: dict[str, T.DataType], sides: dict[str, Side], shared: bool = False):
        self.key, self.numbers, first = key, {}, 0
        parts = []
        for name, side in sides.items():
            self.numbers[name] = {None: first, **{c: first + i for i, c in enumerate(side.classes, 1)}}
            first += 1 + len(side.classes)
            slots = [
                (side.slots[slot].cast(kind) if slot in side.slots else F.lit(None).cast(kind)).alias(slot)
                for slot, kind in types.items()
            ]
            number = F.lit(self.numbers[name][None])
            if side.category is not None:
                classed = side.rows.withColumn("_class", side.category.cast("string"))
                number = F.coalesce(*[F.when(F.col("_class") == c, self.numbers[name][c]) for c in side.classes], number)
            else:
                classed = side.rows
            parts.append(classed.where(named(key).isNotNull()).select(named(key), number.cast("smallint").alias("_side"), *slots))
        self.rows = reduce(DataFrame.unionByName, parts)
        self.rows = self.rows.repartition(named(key))
        if shared:
            self.rows = read_whole(self.rows)

    def is_of(self, side: str) -> Column:
        """Whether a row is of one relation, whatever its class."""
        numbers = self.numbers[side].values()
        return F.col("_side").between(min(numbers), max(numbers))

    def of(self, side: str, slot: str, category: str | None = None) -> Column:
        """A slot in the rows of one relation, and of one class where there is one; NULL in the others."""
        mine = self.is_of(side) if category is None else F.col("_side") == self.numbers[side][category]
        return F.when(mine, F.col(slot))

    def aggregated(self, outputs: dict[str, dict[str, Column]]) -> DataFrame:
        """One row per key: for each relation its named aggregates, NULL where it has no row of the key."""
        there = {side: F.max(self.is_of(side)) for side in outputs}
        columns = [F.when(there[side], c).alias(name) for side, own in outputs.items() for name, c in own.items()]
        return self.rows.groupBy(self.key).agg(*columns)
