"""Registered queries over a lake that is built by runs: its curated tables, and the reports on its stored views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions.numeric import round_half_up
from marketlake.operators import clean
from marketlake.plans import reports
from marketlake.plans.incremental import LakeRuns
from marketlake.plans.lake_queries import click_bodies, once, order_bodies
from marketlake.session import working_path
from marketlake.sources import lake as zones
from marketlake.sources import tables as t

RUNS = 3


def _raw_orders_by_run(spark: SparkSession, d: str, path: str) -> None:
    """Order events in folders run=0, 1, ... by time; those of one day a month come again a run later."""
    bodies = order_bodies(spark, d)
    day = F.unix_date(F.to_date(F.substring(F.get_json_object("body", "$.created_at"), 1, 10)))
    dated = bodies.select("body", day.alias("day"))
    ordered = t.orders(spark, d).select(F.unix_date(F.to_date("created_at")).alias("day"))
    ends = ordered.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    length = (ends["last"] - ends["first"]) // RUNS + 1 if ends["first"] is not None else 1
    run = F.floor((F.col("day") - F.lit(ends["first"] or 0)) / F.lit(length))
    again = F.when((F.dayofmonth(F.date_from_unix_date("day")) == 15) & (run < RUNS - 1), F.array(run, run + 1))
    split = dated.select("body", F.explode(F.coalesce(again, F.array(run))).alias("run"))
    zones.write_ndjson(split, path, "run")


def _build(spark: SparkSession, d: str) -> LakeRuns:
    lake = zones.Lake(working_path(spark, "lake-by-runs"))
    _raw_orders_by_run(spark, d, lake.raw("orders"))
    job = LakeRuns(spark, lake, buckets=8, every=1)
    for run in range(RUNS):
        job.update(f"{lake.raw('orders')}/run={run}", run)
    job.publish()
    zones.write_ndjson(click_bodies(spark, d), lake.raw("clickstream"))
    clicks = zones.read_ndjson(spark, lake.raw("clickstream"), schemas.CLICK_EVENT)
    zones.write_by_day(clean.clean_clicks(clicks), lake.processed("clickstream"), "event_date")
    return job


def _job(spark: SparkSession, d: str) -> LakeRuns:
    return once(spark, d, "lake-by-runs", _build)


def _numbers(df: DataFrame, *ids: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in ids})


def daily_kpis(spark: SparkSession, d: str) -> DataFrame:
    return _job(spark, d).table("daily_kpis")


def customer_clv(spark: SparkSession, d: str) -> DataFrame:
    ends = {c: F.col(c).cast("timestamp_ntz") for c in ("first_order", "last_order")}
    return _numbers(_job(spark, d).table("customer_clv"), "customer_id").withColumns(ends)


def product_interactions(spark: SparkSession, d: str) -> DataFrame:
    out = _numbers(_job(spark, d).table("product_interactions"), "customer_id", "product_id")
    return out.withColumn("implicit_rating", round_half_up(F.col("implicit_rating"), 6))


def state_revenue(spark: SparkSession, d: str) -> DataFrame:
    return _job(spark, d).table("state_revenue")


def _report(make: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query that registers the lake's views and makes a report from them by name."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        zones.register_views(spark, _job(spark, d).lake)
        return make(spark.table)

    return query


def _last(df: DataFrame, column: str):
    return df.agg(F.max(column)).first()[0]


def _last_order(view: Callable[[str], DataFrame]):
    return _last(view("curated_daily_kpis"), "order_date")


def _top_products(view: Callable[[str], DataFrame]) -> DataFrame:
    return reports.top_products(_numbers(view("order_items"), "product_id"), _last_order(view))


def _funnel(view: Callable[[str], DataFrame]) -> DataFrame:
    clicks = view("processed_clickstream")
    return reports.click_funnel(clicks, _last(clicks, "event_date"))


REPORTS: dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]] = {
    "q1_daily_revenue": lambda view: reports.daily_revenue(view("curated_daily_kpis"), _last_order(view)),
    "q1_o4_latest_revenue": lambda view: reports.latest_daily_revenue(view("curated_daily_kpis")),
    "q2_o2_top_products": _top_products,
    "q3_category_revenue": lambda view: reports.category_revenue(view("order_items")),
    "q3_o3_top_categories": lambda view: reports.category_revenue(view("order_items"), top=15),
    "q4_state_revenue": lambda view: reports.revenue_by_state(view("curated_state_revenue")),
    "q5_w1_payment_breakdown": lambda view: reports.payment_breakdown(view("processed_orders")),
    "q6_cohort_retention": lambda view: reports.cohort_retention(view("processed_orders")),
    "q7_freight_by_state": lambda view: reports.freight_by_state(view("order_items")),
    "q8_fraud_by_day": lambda view: reports.fraud_by_day(view("processed_orders")),
    "q8_w8_fraud_trend": lambda view: reports.fraud_trend(view("processed_orders")),
    "q9_click_funnel": _funnel,
    "q9_w6_funnel_share": lambda view: reports.funnel_share(view("processed_clickstream")),
    "q10_hourly_orders": lambda view: reports.hourly_orders(view("processed_orders"), _last_order(view)),
    "q11_clv_segments": lambda view: reports.clv_segments(view("curated_customer_clv")),
}

#: The query whose rows each of these must give.
SAME_AS: dict[str, str] = {
    "s9_runs_daily_kpis": "a1_daily_kpis",
    "s9_runs_customer_clv": "a2_customer_clv",
    "s9_runs_product_interactions": "a3_product_interactions",
    "s9_runs_state_revenue": "a5_state_revenue",
    **{f"s11_{name}": name for name in REPORTS},
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "s9_runs_daily_kpis": daily_kpis,
    "s9_runs_customer_clv": customer_clv,
    "s9_runs_product_interactions": product_interactions,
    "s9_runs_state_revenue": state_revenue,
    **{f"s11_{name}": _report(make) for name, make in REPORTS.items()},
}
