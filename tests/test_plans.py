"""What the plans must look like at any scale."""

import pytest
from helpers import SMALL, plan_text

from freightmill.registry import QUERIES


@pytest.fixture
def no_broadcast(spark):
    """Sizes as on a cluster: no table is small enough to broadcast by size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def reads(text, table):
    """ReadSchema lines of the scans of one table."""
    blocks = [b for b in text.split("\n\n") if f"/{table}.parquet]" in b]
    return [line for b in blocks for line in b.splitlines() if line.startswith("ReadSchema")]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python_no_forced_broadcast(spark, no_broadcast, name):
    text = plan_text(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text
    # Only the surrogate offsets are broadcast by hint: at most 4,096 rows by construction.
    assert ("BroadcastHashJoin" in text) == (name == "dim_carrier_surrogate")


def test_scans_read_only_the_columns_in_use(spark):
    text = plan_text(QUERIES["delay_breakdown"](spark, SMALL))
    (lines,) = reads(text, "lineitem")
    for unused in ("l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_tax"):
        assert unused not in lines
    (orders,) = reads(text, "orders")
    assert "o_custkey" not in orders and "o_orderstatus" not in orders


def test_destination_is_joined_only_when_asked_for(spark):
    assert reads(plan_text(QUERIES["gold_carrier_scorecard"](spark, SMALL)), "customer") == []
    assert len(reads(plan_text(QUERIES["gold_warehouse_monthly"](spark, SMALL)), "customer")) == 1


def path_from_scan(text, scan):
    """Operator names from one table's scan up to the root of the plan tree."""
    tree = [line for line in text.split("\n\n")[0].splitlines() if "(" in line]
    number = next(
        b.strip().split(")")[0].lstrip("(") for b in text.split("\n\n") if f"/{scan}.parquet]" in b
    )
    at = next(i for i, line in enumerate(tree) if line.rstrip().endswith(f"({number})"))
    depth = len(tree[at]) - len(tree[at].lstrip(" :+-"))
    names = []
    for line in reversed(tree[:at]):
        own = len(line) - len(line.lstrip(" :+-*"))
        if own < depth:
            names.append(line.strip(" :+-*").split(" (")[0])
            depth = own
    return names


@pytest.mark.parametrize(
    "name",
    [
        "gold_carrier_scorecard",
        "gold_supplier_reliability",
        "gold_warehouse_monthly",
        "report_region_matrix",
        "report_delay_decomposition",
        "rls_supplier_manager",
        "measures_otif",
        "dq_orphans",
    ],
)
def test_facts_are_combined_before_they_move_again(spark, no_broadcast, name):
    """Past the order join the next shuffle carries partial totals, not line items."""
    names = path_from_scan(plan_text(QUERIES[name](spark, SMALL)), "lineitem")
    after_join = names[names.index("SortMergeJoin Inner") + 1 :]
    assert after_join.index("HashAggregate") < after_join.index("Exchange")
    assert names[: names.index("SortMergeJoin Inner")].count("Exchange") == 1


def test_batch_day_reaches_the_orders_scan(spark):
    text = plan_text(QUERIES["fact_load_batch"](spark, SMALL))
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters")]
    assert any("o_orderdate" in line for line in pushed)


def test_yoy_reads_the_fact_once(spark):
    assert len(reads(plan_text(QUERIES["freight_yoy"](spark, SMALL)), "lineitem")) == 1


def test_the_largest_reason_comes_from_the_same_totals(spark):
    """The maximum is a subquery over the grouped totals. The plan that ran shows that their
    exchange is used again, so the fact is read once, and that no window gathers the reasons."""
    sheet = QUERIES["delay_breakdown_pct"](spark, SMALL)
    assert sheet.collect()
    ran = sheet._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in ran and "ReusedExchange" in ran
    assert "Window" not in ran


@pytest.mark.parametrize("name", ["freight_yoy", "monthly_delivery_trend", "order_intake_monthly"])
def test_calendar_reports_read_the_orders_once(spark, no_broadcast, name):
    assert len(reads(plan_text(QUERIES[name](spark, SMALL)), "orders")) == 1
