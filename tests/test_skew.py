"""Salted joins give the rows of the plain joins, whatever is hot."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cuadre.session import LONG_CELLS, sized_for
from cuadre.operators import skew
from cuadre.operators.joins import with_receipts
from cuadre.operators.skew import fan_out, hot_keys, join_lookup, key_counts
from tests.conftest import rows

SCHEMA_A = "k int, a int"
SCHEMA_B = "k int, b int"
SCHEMA_C = "k int, c int"


def plain(base, b, c):
    return base.join(b, "k", "left").join(c, "k", "left").select("k", "a", "b", "c")


def salted(base, b, c, **options):
    return fan_out(base, [b, c], "k", **options).select("k", "a", "b", "c")


def test_digits_are_all_cells_once(spark):
    digits = [c.alias(f"d{i}") for i, c in enumerate(skew._digits(F.col("id"), [F.lit(2), F.lit(3), F.lit(1), F.lit(4)]))]
    cells = {tuple(r) for r in spark.range(24).select(*digits).collect()}
    assert cells == {(a, b, 0, d) for a in range(2) for b in range(3) for d in range(4)}


@pytest.mark.parametrize("cell_rows", [1, 3, 10**6])
@pytest.mark.parametrize("hot_b,hot_c", [(40, 0), (0, 40), (40, 30), (1, 40), (0, 0)])
def test_one_hot_key(spark, hot_b, hot_c, cell_rows):
    base = spark.createDataFrame([(i, 10 * i) for i in range(6)] + [(None, 9)], SCHEMA_A)
    b = spark.createDataFrame([(2, i) for i in range(hot_b)] + [(1, 5), (1, 5), (None, 0)], SCHEMA_B)
    c = spark.createDataFrame([(2, i) for i in range(hot_c)] + [(1, 6), (4, 7)], SCHEMA_C)
    assert rows(salted(base, b, c, cell_rows=cell_rows)) == rows(plain(base, b, c))


def test_copies_on_a_hot_key(spark):
    base = spark.createDataFrame([(1, 0), (1, 0), (2, 0)], SCHEMA_A)
    b = spark.createDataFrame([(1, 7)] * 25, SCHEMA_B)
    c = spark.createDataFrame([(1, 8)] * 3 + [(2, 1)], SCHEMA_C)
    got = salted(base, b, c, cell_rows=2)
    assert rows(got) == rows(plain(base, b, c))
    assert got.where("k = 1").count() == 2 * 25 * 3


def test_product_of_a_key_is_spread(spark):
    base = spark.createDataFrame([(1, 0)], SCHEMA_A)
    b = spark.range(300).selectExpr("1 AS k", "cast(id as int) AS b")
    c = spark.range(300).selectExpr("1 AS k", "cast(id as int) AS c")
    # neither side has as many rows as a cell has work; their product does
    sizes = hot_keys([key_counts(b, "k"), key_counts(c, "k")], "k", 1_000).first()
    assert sizes["_size0"] >= 9 and sizes["_size1"] >= 9
    got = salted(base, b, c, cell_rows=1_000)
    assert got.count() == 90_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = salted(base, b, c, cell_rows=1_000).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) == 4 and max(r["count"] for r in parts) < 0.4 * 90_000


pairs = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 9))), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=pairs, b=pairs, c=pairs, cell_rows=st.integers(1, 4))
def test_any_data(spark, a, b, c, cell_rows):
    base, side_b, side_c = (
        spark.createDataFrame(data, schema) for data, schema in ((a, SCHEMA_A), (b, SCHEMA_B), (c, SCHEMA_C))
    )
    got = salted(base, side_b, side_c, cell_rows=cell_rows)
    assert rows(got) == rows(plain(base, side_b, side_c))


def test_columns_between_sides(spark):
    base = spark.createDataFrame([(1, 2), (2, 3)], SCHEMA_A)
    b = spark.createDataFrame([(1, 5), (1, 6)], SCHEMA_B)
    c = spark.createDataFrame([(1, 7)], SCHEMA_C)
    got = fan_out(base, [b, c], "k", after=[lambda df: df.withColumn("ab", F.col("a") * F.col("b"))], cell_rows=1)
    assert rows(got, "k", "ab", "c") == [(1, 10, 7), (1, 12, 7), (2, None, None)]


def test_clashing_columns(spark):
    base = spark.createDataFrame([(1, 2)], SCHEMA_A)
    side = spark.createDataFrame([(1, 3)], SCHEMA_A)
    assert rows(fan_out(base, [side], "k")) == [(1, 2)]
    assert fan_out(base, [side], "k", clash="_PAY").columns == ["k", "a", "a_PAY"]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("cell_rows", [1, 5, 10**6])
def test_lookup(spark, how, cell_rows):
    random.seed(1)
    data = [(7, i) for i in range(50)] + [(None, i) for i in range(20)] + [(random.randint(0, 9), i) for i in range(20)]
    left = spark.createDataFrame(data, SCHEMA_A)
    right = spark.createDataFrame([(i, i * i) for i in range(3, 12)], SCHEMA_B)
    got = join_lookup(left, right, "k", ["a"], how, cell_rows=cell_rows).select("k", "a", "b")
    assert rows(got) == rows(left.join(right, "k", how).select("k", "a", "b"))


def test_lookup_rejects_other_joins(spark):
    df = spark.createDataFrame([(1, 1)], SCHEMA_A)
    with pytest.raises(ValueError):
        join_lookup(df, df, "k", ["a"], "full")


def sizes_of(df, cell_rows):
    return rows(hot_keys([key_counts(df, "k")], "k", cell_rows))


def test_hot_keys(spark):
    df = spark.createDataFrame([(k, 0) for k in (1, 1, 1, 2, 2, 3, 3, 4, None, None, None, None)], SCHEMA_A)
    assert sizes_of(df, 1) == [(1, 3), (2, 2), (3, 2)]
    assert sizes_of(df, 2) == [(1, 2)]
    assert sizes_of(df, 3) == []


def test_there_are_fewer_hot_keys_than_shares(spark, monkeypatch):
    """However many keys are large: a key is hot only beyond an even share of all the work."""
    monkeypatch.setattr(skew, "SHARES", 8)
    df = spark.range(400).selectExpr("cast(id % 20 as int) AS k", "0 AS a").union(
        spark.range(90).selectExpr("99 AS k", "0 AS a")
    )
    assert sizes_of(df, 1) == [(99, 4)]  # of the 8 largest keys, with 230 rows: a share is 29


def test_partition_sizes():
    few, many = sized_for(10**9), sized_for(10**14)
    assert few["spark.sql.shuffle.partitions"] == "200"
    assert many["spark.sql.shuffle.partitions"] == str(-(-(10**14) // 2**27))
    assert sized_for(2**40)["spark.sql.shuffle.partitions"] == "8192"


def test_writers_of_copied_lists_hold_few_rows(spark, tmp_path):
    """Row groups are cut by their bytes also where rows without a list come first."""
    for key in LONG_CELLS:
        spark.conf.unset(key)
    invoices = spark.range(2_000).selectExpr("id AS INVOICE_ID", "case when id >= 1500 then 'PO-1' end AS ORDEN_COMPRA")
    receipts = spark.range(1).selectExpr("'PO-1' AS ORDEN_COMPRA", "repeat('x', 100000) AS ERS")
    joined = with_receipts(invoices, receipts).coalesce(1).sortWithinPartitions(F.col("ERS").isNotNull(), "INVOICE_ID")
    plain = {"parquet.block.size": 2**22, "parquet.enable.dictionary": "false", "compression": "none"}
    joined.write.options(**plain).parquet(f"{tmp_path}/lists")
    groups = [
        file.metadata.row_group(i).total_byte_size
        for file in map(pq.ParquetFile, tmp_path.glob("lists/*.parquet")) for i in range(file.metadata.num_row_groups)
    ]
    assert sum(groups) > 500 * 100_000 and max(groups) < 2**22 + 5 * 100_000


@pytest.mark.parametrize("cell_rows", [1, 3, 10_000])
@pytest.mark.parametrize("sides", [1, 2])
def test_flat_relations_ride_with_the_first_side(spark, cell_rows, sides):
    """They join the base as a left join does: keys that are hot, without rows in a side, repeated or NULL included."""
    draw = random.Random(cell_rows + sides)
    keys = [None, *range(12)]
    some = lambda n: [(draw.choice(keys), draw.choice([None, "x", "y", f"v{i}"])) for i in range(n)]
    base = spark.createDataFrame([*some(20), (1, "a"), (1, "a"), (None, None)], "k int, a string")
    b = spark.createDataFrame([*some(30), *[(1, f"b{i}") for i in range(25)]], "k int, b string")
    c = spark.createDataFrame([*some(30), *[(1, f"c{i}") for i in range(9)], *[(2, f"c{i}") for i in range(40)]], "k int, c string")
    f = spark.createDataFrame([(k, None if k == 3 else k * 10, "not this") for k in range(8)], "k int, f int, a string")
    g = spark.createDataFrame([(k, f"g{k}") for k in range(1, 20, 2)], "k int, g string")
    found = fan_out(base, [b, c][:sides], "k", cell_rows=cell_rows, flat=[f, g])
    wanted = base.join(f.drop("a"), "k", "left").join(g, "k", "left").join(b, "k", "left")
    wanted = wanted.join(c, "k", "left") if sides == 2 else wanted
    assert rows(found, *wanted.columns) == rows(wanted)
    plain = fan_out(base, [b, c][:sides], "k", flat=[f, g], salted=False)
    assert rows(plain, *wanted.columns) == rows(wanted)


def test_cells_that_repeat_are_written_once(spark, tmp_path):
    """Each invoice of an order has its whole list; a file holds the list once for many rows, and it is read back in each."""
    draw = random.Random(5)
    lists = [(f"o{i}", "".join(draw.choices("0123456789abcdef", k=1_000_000))) for i in range(3)]
    receipts = spark.createDataFrame(lists, "ORDEN_COMPRA string, ERS string")
    invoices = spark.range(400).selectExpr("id AS INVOICE_ID", "concat('o', id % 4) AS ORDEN_COMPRA")
    found = with_receipts(invoices, receipts)
    found.coalesce(1).write.parquet(str(tmp_path / "out"))
    assert sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet")) < 5 * 1_000_000
    back = spark.read.parquet(str(tmp_path / "out"))
    counts = {r[0]: (r[1], r[2]) for r in back.groupBy("ORDEN_COMPRA").agg(F.count("*"), F.max(F.xxhash64("ERS"))).collect()}
    wanted = {r[0]: (100, r[1]) for r in receipts.select("ORDEN_COMPRA", F.xxhash64("ERS")).collect()}
    assert counts == {**wanted, "o3": (100, 42)}
