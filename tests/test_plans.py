"""What the plans may and may not contain."""

from __future__ import annotations

import pytest

from cuadre.catalog.mapping import base_tables, relations
from cuadre.catalog.queries import QUERIES
from cuadre.operators import aggregates
from cuadre.operators.skew import SHARES
from cuadre.plans import extracts

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    assert "Scan ExistingRDD" not in plan


@pytest.mark.parametrize("name", ["r1", "r2", "r6", "j3_fanout"])
def test_beyond_broadcast_size_only_bounded_sides_are_broadcast(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES[name](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("BroadcastExchange") >= 1
    # each broadcast is a list of hot keys, at most SHARES
    for part in plan.split("BroadcastExchange")[1:]:
        assert "_cell_work" in part and f"TakeOrderedAndProject(limit={SHARES}" in part


def test_fan_out_shuffles_each_relation_once_on_key_and_cells(spark):
    plan = plan_of(QUERIES["j3_fanout"](spark, SF_DIR))
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line and "_cell" in line]
    exchanges = [line for line in plan.splitlines() if "hashpartitioning" in line and "_cell" in line]
    assert len(joins) == 2
    assert len(exchanges) == 3


def test_pivot_is_one_aggregation(spark):
    plan = plan_of(QUERIES["a2_pivot_taxes"](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "pivotfirst" not in plan


def test_date_bound_and_columns_reach_the_scan(spark):
    t = base_tables(spark, SF_DIR)
    plan = plan_of(extracts.payments_v2(t))
    assert "GreaterThanOrEqual(l_shipdate" in plan
    assert "l_discount" not in plan.split("ReadSchema")[1]


def test_limited_lists_are_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(QUERIES["a5_distinct_list"](spark, SF_DIR))
    assert "WindowGroupLimit" in plan_of(QUERIES["o2_first_row"](spark, SF_DIR))


def test_reports_are_pruned(spark):
    """A column that the report's reader does not ask for is not computed."""
    plan = plan_of(QUERIES["r2"](spark, SF_DIR).select("FACTURA"))
    assert "IVA16" not in plan and "l_extendedprice" not in plan and "l_tax" not in plan


def test_date_bound_on_a_report_reaches_the_invoice_scan(spark):
    plan = plan_of(QUERIES["r2"](spark, SF_DIR).where("FECHA >= DATE'1997-01-01'"))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "o_totalprice" in line]
    assert scans and all("GreaterThanOrEqual(o_orderdate" in line for line in scans)


def test_bound_on_a_computed_date_is_checked_at_the_scan(spark):
    """The invoice date of r6 is a CASE, which no scan can be given: the rows go right behind the scan."""
    plan = plan_of(QUERIES["r6"](spark, SF_DIR).where("FECHA >= DATE'1997-01-01'")).splitlines()
    filters = [i for i, line in enumerate(plan) if "Filter (" in line and "o_orderdate" in line]
    assert filters and all(any("FileScan" in line for line in plan[i + 1 : i + 3]) for i in filters)


@pytest.mark.parametrize("name,columns", [("a11_distributions", 2), ("a13_payments", 3), ("a14_prepayments", 4)])
def test_lists_shuffle_keys_and_values_alone(spark, name, columns):
    """What is grouped by value is narrow, and sums are combined by map tasks into one row per key."""
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    grouped = [line for line in plan.splitlines() if "HashAggregate(keys=[" in line and "partial_min(" in line and "_value" in line]
    assert len(grouped) == 1 and "partial_sum" not in grouped[0]
    assert "partial_sum" in plan and "Generate inline" in plan


@pytest.mark.parametrize("name,scans", [("j3_fanout", 12), ("r2", 13), ("r6", 32)])
def test_keys_of_each_side_are_counted_once(spark, name, scans):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert plan.count("FileScan") <= scans and "Subquery" not in plan


def test_summary_copies_no_rows_for_distinct_counts(spark):
    plan = plan_of(QUERIES["q2_summary"](spark, SF_DIR))
    assert "Expand" not in plan and "collect_list" not in plan


@pytest.mark.parametrize("name,table", [
    ("payments_v1", "lineitem"), ("payments_v4", "lineitem"), ("flow_payments", "lineitem"), ("withholding", "lineitem"),
    ("taxes_v2", "lineitem"), ("distributions", "lineitem"), ("prepay_ers", "lineitem"), ("invoices_v2", "orders"),
])
def test_mappings_keep_all_rows(spark, name, table):
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    assert relations(spark, SF_DIR)[name].count() == rows


def test_one_row_report_is_one_union(spark):
    """Sums of four relations share an exchange; with the lists, the accounts and the invoices there are five, the mapping's
    own join of withheld lines aside."""
    plan = plan_of(QUERIES["r7"](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") <= 8
    sums = [line for line in plan.splitlines() if "partial_sum" in line and "_side" in line]
    assert len(sums) == 1 and "HashAggregate" in sums[0]
    assert "partial_sum" in plan_of(QUERIES["r7_rows"](spark, SF_DIR))


@pytest.mark.parametrize("name,dealt", [("r7", 3), ("r7_rows", 2), ("a11_distributions", 2), ("a12_principal", 1)])
def test_wide_states_are_not_shuffled(spark, name, dealt):
    """Rows are dealt out by invoice before they meet aggregates as wide as these; no other exchange follows a sum or a first value."""
    plan = plan_of(QUERIES[name](spark, SF_DIR)).splitlines()
    exchanges = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(INVOICE_ID" in line]
    by_hand = [i for i in exchanges if "REPARTITION_BY_COL" in plan[i]]
    assert len(by_hand) == dealt
    assert all("partial_sum" not in plan[i + 1] and "partial_min" not in plan[i + 1] for i in exchanges)


@pytest.mark.parametrize("name", ["r1", "r2", "r6", "r6_rows"])
def test_periods_of_payments_are_not_shuffled(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR)).splitlines()
    weeks = [i for i, line in enumerate(plan) if "weekofyear" in line]
    assert weeks
    assert all(any("REPARTITION_BY_COL" in line and "_cell0" in line for line in plan[i + 1 : i + 5]) for i in weeks)


@pytest.mark.parametrize("name", ["r1", "r2", "r2_filled_rate", "r6_rows"])
def test_cells_are_made_by_generated_code(spark, name):
    """A row of a key that is not hot passes no lambda, which Spark would interpret, and no filter on its cells."""
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    made = [line for line in plan.splitlines() if "Generate" in line and "_size" in line]
    assert len(made) == 3 and all("explode(sequence(" in line and ", true, [_at" in line for line in made)
    assert "lambda" not in plan.split("inline(")[0]


@pytest.mark.parametrize("name", ["r6_rows", "a11_distributions", "a5_distinct_list"])
def test_limited_lists_are_not_collected(spark, name):
    assert "collect_list" not in plan_of(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", ["r6", "r6_rows"])
def test_headers_are_shuffled_to_their_cells_alone(spark, name):
    """Sums and accounts of an invoice ride with its schedules, so that no exchange by invoice takes the headers to them."""
    plan = plan_of(QUERIES[name](spark, SF_DIR)).splitlines()
    exchanges = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(INVOICE_ID" in line and "_cell" not in line]
    assert exchanges and not any("AS UUID" in plan[i + 1] for i in exchanges)
    assert not any("partial_sum" in plan[i + 1] and "IMPUESTO_MXN" in plan[i + 1] for i in exchanges)


@pytest.mark.parametrize("name,dealt", [("a11_distributions", 1), ("r7", 2)])
def test_readers_of_dealt_rows_share_an_exchange(spark, name, dealt):
    """Sums and lists of the same rows are two aggregations of one shuffle; each would be given a shuffle of its own columns."""
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    ran = [line for line in plan_of(df).split("== Initial Plan ==")[0].splitlines() if "REPARTITION_BY_COL" in line]
    assert len([line for line in ran if "ReusedExchange" not in line]) == dealt
    assert len([line for line in ran if "ReusedExchange" in line]) == 1


def test_a_row_of_amounts_is_marked_by_a_number(spark):
    r = relations(spark, SF_DIR)
    union = aggregates._invoice_rows(r["taxes_v4"], r["withholding"], r["payments_v4"], r["prepay_ers"])
    assert [name for name, kind in union.rows.dtypes if kind == "string"] == []
