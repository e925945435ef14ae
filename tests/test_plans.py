"""Shape of the physical plans: pushdown, pruning, no cross joins, no Python in batch queries."""

import pytest
from pyspark.sql import functions as F

from marketlake.operators import clean
from marketlake.plans import reports
from marketlake.plans.lake_queries import QUERIES as LAKE_QUERIES
from marketlake.plans.lake_reports import QUERIES as LAKE_REPORTS
from marketlake.plans.queries import QUERIES
from marketlake.sources import tables as t

# These write files or fit a model when called, or score with numpy inside tasks.
EAGER = {*LAKE_QUERIES, *LAKE_REPORTS, "r2_als_factors"}
NUMPY = {
    "a14_list_summary", "j8_scored_with_metadata", "j9_unseen_scores", "r4_o5_personal_scores", "r6_category_rows", "r9_fallback_rows",
    "r11_bulk_lists", "r2_held_out_measures", "r12_w4_recommendations", "r13_w7_display_rows",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_python(spark, tables, name):
    text = plan(QUERIES[name](spark, tables))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in NUMPY:
        assert "Python" not in text and "Pandas" not in text


def test_filters_and_columns_reach_the_scan(spark, tables, tmp_path):
    t.orders(spark, tables).write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    text = plan(clean.confirmed(orders).groupBy("customer_id").agg(F.count("*")))
    assert "EqualTo(status,confirmed)" in text
    assert "ReadSchema: struct<customer_id:bigint,status:string>" in text


def test_reports_read_only_their_columns(spark, tables):
    text = plan(QUERIES["q6_cohort_retention"](spark, tables))
    assert "o_totalprice" not in text and "o_orderpriority" not in text


@pytest.mark.parametrize(
    "name,column",
    [("p7_recent_orders", "o_orderdate"), ("q1_daily_revenue", "o_orderdate"), ("q2_o2_top_products", "o_orderdate"),
     ("q9_click_funnel", "ts"), ("q10_hourly_orders", "o_orderdate")],
)
def test_report_dates_reach_the_scan(spark, tables, name, column):
    text = plan(QUERIES[name](spark, tables))
    assert f"GreaterThanOrEqual({column}," in text and "Subquery" not in text


def test_report_dates_prune_partitions(spark, tables, tmp_path):
    """Over a table stored by day, a report lists only the days it needs."""
    orders = t.orders(spark, tables)
    orders.write.partitionBy("order_date").parquet(str(tmp_path / "orders"))
    last = orders.agg(F.max("order_date")).first()[0]
    hourly = reports.hourly_orders(spark.read.parquet(str(tmp_path / "orders")), last)
    assert "PartitionFilters: [isnotnull(order_date" in plan(hourly) and "Subquery" not in plan(hourly)
    assert [*hourly.collect()] == [*reports.hourly_orders(orders, last).collect()]


def test_nested_fields_are_pruned(spark, tables, tmp_path):
    t.nested_orders(spark, tables).write.parquet(str(tmp_path / "nested"))
    items = clean.explode_items(spark.read.parquet(str(tmp_path / "nested"))).select("product_id")
    assert "unit_price" not in plan(items).split("ReadSchema")[1]


def test_velocity_groups_by_slot(spark, tables):
    text = plan(QUERIES["w2_orders_last_hour"](spark, tables))
    assert "hashpartitioning(k" in text and "slot" in text
