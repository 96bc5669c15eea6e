"""Old state and change set give the new state."""

from __future__ import annotations

import random

import pytest

from cuadre.sources.changes import applied, changes
from tests.conftest import rows

SCHEMA = "k int, a string, b string"


def states(seed):
    draw = random.Random(seed)
    row = lambda: (draw.choice([None, *range(6)]), draw.choice([None, "x", "y"]), draw.choice([None, "x"]))
    old = [row() for _ in range(draw.choice([0, 30]))]
    new = [r for r in old if draw.random() < 0.8] + [row() for _ in range(draw.choice([0, 12]))]
    return old, new


@pytest.mark.parametrize("seed", range(8))
def test_old_and_changes_give_new(spark, seed):
    old, new = states(seed)
    before, after = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    found = changes(before, after, ["k"])
    assert rows(applied(before, found)) == rows(after)
    keys_before, keys_after = {r[0] for r in old}, {r[0] for r in new}
    expected = []
    for r in set(old) | set(new):
        more = new.count(r) - old.count(r)
        if more:
            kind = ("present" if r[0] in keys_before else "inserted") if more > 0 else ("former" if r[0] in keys_after else "removed")
            expected.append((*r, kind, abs(more)))
    assert rows(found) == sorted(expected, key=lambda t: [(v is not None, str(v)) for v in t])


def test_null_cells_are_told_apart(spark):
    before = spark.createDataFrame([(1, None, "x")], SCHEMA)
    after = spark.createDataFrame([(1, "x", None)], SCHEMA)
    assert rows(changes(before, after, ["k"]), "CHANGE", "a") == [("former", None), ("present", "x")]


def test_columns_must_agree(spark):
    with pytest.raises(ValueError, match="columns differ"):
        changes(spark.range(1), spark.range(1).toDF("x"), ["id"])
