"""The report library. Inputs are zone tables; amounts are rounded half-up for display.

`as_of` is the last day of a report: a date, a date string, or a scalar column (for example
`orders.agg(F.max("order_date")).scalar()`). A literal prunes partitions at planning time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.numeric import count_when, exact_avg, exact_sum, ratio, round_half_up, units
from marketlake.functions.timefn import hour_label, month_of, months_apart, parse_ts
from marketlake.operators.clean import confirmed, confirmed_with_state

Day = Column | dt.date | str | None


def _day(as_of: Day) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def since(df: DataFrame, column: str, as_of: Day, days: int) -> DataFrame:
    """Rows dated `as_of - days` or later."""
    return df.filter(F.col(column) >= F.date_sub(_day(as_of), days))


def _kpi_columns() -> list[Column]:
    return [
        F.col("order_date"),
        F.col("total_orders"),
        round_half_up(F.col("gross_revenue")).alias("gross_revenue"),
        round_half_up(F.col("avg_order_value")).alias("avg_order_value"),
        F.col("unique_customers"),
        round_half_up(F.col("conversion_rate") * 100.0, 1).alias("conversion_rate_pct"),
        round_half_up(F.col("fraud_rate") * 100.0, 2).alias("fraud_rate_pct"),
    ]


def daily_revenue(kpis: DataFrame, as_of: Day, days: int = 30) -> DataFrame:
    return since(kpis, "order_date", as_of, days).select(*_kpi_columns()).orderBy(F.desc("order_date"))


def latest_daily_revenue(kpis: DataFrame, n: int = 30) -> DataFrame:
    """The newest n days, oldest first."""
    return kpis.select(*_kpi_columns()).orderBy(F.desc("order_date")).limit(n).orderBy("order_date")


def top_products(items: DataFrame, as_of: Day, days: int = 7, n: int = 20) -> DataFrame:
    """Best products by confirmed revenue; `items` are item rows with status and order_date."""
    recent = since(confirmed(items), "order_date", as_of, days)
    return (
        recent.groupBy("product_id", "category")
        .agg(
            F.count_distinct("order_id").alias("order_appearances"),
            F.sum("quantity").alias("units_sold"),
            round_half_up(exact_sum(F.col("quantity") * F.col("unit_price"))).alias("revenue"),
            round_half_up(exact_avg(F.col("freight_value"))).alias("avg_freight"),
        )
        .orderBy(F.desc("revenue"), "product_id")
        .limit(n)
    )


def category_revenue(items: DataFrame, top: int | None = None) -> DataFrame:
    """Confirmed revenue by category with the share of freight in the price."""
    price, freight = exact_avg(F.col("unit_price")), exact_avg(F.col("freight_value"))
    out = (
        confirmed(items)
        .groupBy("category")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("quantity").alias("units_sold"),
            round_half_up(exact_sum(F.col("quantity") * F.col("unit_price"))).alias("gross_revenue"),
            round_half_up(price).alias("avg_unit_price"),
            round_half_up(freight).alias("avg_freight"),
            round_half_up(100.0 * freight / F.nullif(price, F.lit(0.0)), 1).alias("freight_to_price_pct"),
        )
        .orderBy(F.desc("gross_revenue"), "category")
    )
    return out if top is None else out.limit(top)


def revenue_by_state(states: DataFrame) -> DataFrame:
    """Display form of the state_revenue table with revenue per customer."""
    return states.select(
        "shipping_state",
        "total_orders",
        round_half_up(F.col("gross_revenue")).alias("gross_revenue"),
        round_half_up(F.col("avg_order_value")).alias("avg_order_value"),
        "unique_customers",
        round_half_up(ratio(F.col("gross_revenue"), F.col("unique_customers"))).alias("revenue_per_customer"),
    ).orderBy(F.desc("gross_revenue"), "shipping_state")


def payment_breakdown(orders: DataFrame) -> DataFrame:
    """Confirmed orders by payment method with each method's share.

    The share is taken over the grouped rows: one per payment method.
    """
    everything = Window.partitionBy(F.lit(1))
    return (
        confirmed(orders)
        .groupBy("payment_method")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            round_half_up(exact_avg(F.col("total"))).alias("avg_order_value"),
            round_half_up(exact_sum(F.col("total"))).alias("total_revenue"),
            round_half_up(exact_avg(F.col("fraud_score")), 4).alias("avg_fraud_score"),
        )
        .withColumn(
            "share_pct",
            round_half_up(100.0 * F.col("order_count") / F.sum("order_count").over(everything), 1),
        )
        .orderBy(F.desc("order_count"), "payment_method")
    )


def cohorts(orders: DataFrame) -> DataFrame:
    """(customer_id, activity_month, cohort_month) for every month with a confirmed order.

    Orders are reduced to distinct customer-months first, so the window that finds the first
    month sees at most one row per month of a customer, and no self-join is needed.
    """
    months = confirmed(orders).select("customer_id", month_of(F.col("order_date")).alias("activity_month")).distinct()
    first = F.min("activity_month").over(Window.partitionBy("customer_id"))
    return months.withColumn("cohort_month", first)


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Customers active per cohort month and months since; customer-months are already distinct."""
    return (
        cohorts(orders)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("cohort_month", months_apart(F.col("cohort_month"), F.col("activity_month")).alias("period_number"))
        .agg(F.count(F.lit(1)).alias("active_customers"))
        .orderBy("cohort_month", "period_number")
    )


def freight_by_state(items: DataFrame) -> DataFrame:
    """Freight per state; the average order value is weighted by item rows."""
    freight, value = exact_avg(F.col("freight_value")), exact_avg(F.col("total"))
    return (
        confirmed_with_state(items)
        .groupBy("shipping_state")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            round_half_up(value).alias("avg_order_value"),
            round_half_up(freight).alias("avg_freight"),
            round_half_up(100.0 * freight / F.nullif(value, F.lit(0.0)), 1).alias("freight_pct_of_order"),
        )
        .orderBy(F.desc("avg_freight"), "shipping_state")
    )


def fraud_by_day(orders: DataFrame, n: int = 30, flag_at: float = 0.5) -> DataFrame:
    """Flagged orders of the newest n days."""
    flagged = F.col("fraud_score") >= flag_at
    return (
        orders.groupBy("order_date")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            count_when(flagged).alias("flagged_orders"),
            round_half_up(100.0 * count_when(flagged) / F.count(F.lit(1)), 2).alias("fraud_rate_pct"),
            round_half_up(exact_avg(F.col("fraud_score")), 4).alias("avg_fraud_score"),
            round_half_up(F.coalesce(exact_sum(F.when(flagged, F.col("total"))), F.lit(0.0))).alias("flagged_revenue"),
        )
        .orderBy(F.desc("order_date"))
        .limit(n)
    )


def fraud_trend(orders: DataFrame, n: int = 14) -> DataFrame:
    """The newest n days, oldest first, with the mean rate over those rows as reference line."""
    rows = Window.partitionBy(F.lit(1))
    mean = F.sum(units(F.col("fraud_rate_pct"))).over(rows) / F.count(F.lit(1)).over(rows) / 10_000.0
    return (
        fraud_by_day(orders, n)
        .select("order_date", "total_orders", "flagged_orders", "avg_fraud_score", "fraud_rate_pct")
        .withColumn("mean_fraud_pct", round_half_up(mean, 4))
        .orderBy("order_date")
    )


def click_funnel(clicks: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    """Clicks, sessions and known customers per day and action."""
    return (
        since(clicks, "event_date", as_of, days)
        .groupBy("event_date", "action")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("session_id").alias("unique_sessions"),
            F.count_distinct("customer_id").alias("authenticated_users"),
            round_half_up(F.avg("duration_ms") / 1000.0, 1).alias("avg_duration_sec"),
        )
        .orderBy("event_date", F.desc("event_count"), "action")
    )


def funnel_share(clicks: DataFrame) -> DataFrame:
    """All-time clicks per action, as a share of the largest step.

    The share is taken over the grouped rows: one per action.
    """
    largest = F.max("event_count").over(Window.partitionBy(F.lit(1)))
    return (
        clicks.groupBy("action")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("session_id").alias("sessions"),
            round_half_up(F.avg("duration_ms") / 1000.0, 1).alias("avg_sec"),
        )
        .withColumn("share_of_first", round_half_up(F.col("event_count") / largest, 4))
        .orderBy(F.desc("event_count"), "action")
    )


def hourly_orders(orders: DataFrame, as_of: Day, days: int = 1) -> DataFrame:
    return (
        since(orders, "order_date", as_of, days)
        .groupBy(hour_label(parse_ts(F.col("created_at"))).alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            round_half_up(exact_sum(F.col("total"))).alias("revenue"),
            F.count_distinct("customer_id").alias("customers"),
        )
        .orderBy(F.desc("hour"))
    )


def clv_segments(clv: DataFrame) -> DataFrame:
    return (
        clv.groupBy("clv_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            round_half_up(exact_avg(F.col("total_spend"))).alias("avg_clv"),
            round_half_up(F.avg("order_count"), 1).alias("avg_orders"),
            round_half_up(F.min("total_spend")).alias("min_spend"),
            round_half_up(F.max("total_spend")).alias("max_spend"),
        )
        .orderBy(F.desc("avg_clv"))
    )
