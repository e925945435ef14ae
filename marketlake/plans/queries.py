"""The registered queries: every operator over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.config import AlarmRule, AlsParams, TierRules, VelocityRules
from marketlake.functions import text, timefn
from marketlake.functions.lookups import order_status, payment_method
from marketlake.functions.numeric import round_half_up
from marketlake.functions.vectors import dot, norm
from marketlake.operators import (
    alarms,
    builder,
    clean,
    curated,
    display,
    evaluation,
    fraud,
    inventory,
    recommend,
    scoring,
    sessions,
    training,
    upsert,
    velocity,
)
from marketlake.plans import lake_queries, lake_reports, reports
from marketlake.sources import lake
from marketlake.sources import tables as t

Query = Callable[[SparkSession, str], DataFrame]

# The events hold small amounts, so the spend limit is lowered for them.
EVENT_VELOCITY = VelocityRules(max_spend=150.0)
ORDER_VELOCITY = VelocityRules(max_spend=1000.0)
EVENT_ERRORS = AlarmRule("errors", 300, "sum", "ge", 5.0, 1)
EVENT_BACKLOG = AlarmRule("backlog", 3600, "max", "gt", 20.0, 3)
EVENT_MEAN = AlarmRule("mean", 3600, "avg", "gt", 15.0, 2)


def _ntz(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the tables store them."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if d == "timestamp" else F.col(c) for c, d in df.dtypes])


def _last_day(df: DataFrame, column: str) -> dt.date | None:
    """One value, read when the report is built: only a literal reaches the scan and prunes partitions."""
    return df.agg(F.max(column)).first()[0]


# ---- cleaning and projections -------------------------------------------------------------


def clean_clicks(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_clicks(t.delivered_clicks(spark, d)).drop("processed_at")


def clean_orders(spark: SparkSession, d: str) -> DataFrame:
    out = clean.clean_orders(t.delivered_orders(spark, d))
    return out.select(
        "order_id", "customer_id", "status", "total", "fraud_score", "order_date", "shipping_state", "shipping_city"
    )


def enrich_clicks(spark: SparkSession, d: str) -> DataFrame:
    out = clean.enrich_clicks(t.clicks(spark, d))
    return out.select("event_id", "hour_of_day", "day_of_week", "is_weekend", "is_authenticated")


def explode_items(spark: SparkSession, d: str) -> DataFrame:
    return clean.explode_items(t.nested_orders(spark, d))


def unnest_sql(spark: SparkSession, d: str) -> DataFrame:
    t.nested_orders(spark, d).createOrReplaceTempView("unnest_orders")
    return spark.sql(
        """
        SELECT o.order_id, item.product_id, item.quantity * item.unit_price AS line_value
        FROM unnest_orders o LATERAL VIEW explode(o.items) x AS item
        WHERE o.status = 'confirmed'
        """
    )


def confirmed_orders(spark: SparkSession, d: str) -> DataFrame:
    return clean.confirmed(t.orders(spark, d)).select("order_id", "customer_id", "total")


def recent_orders(spark: SparkSession, d: str) -> DataFrame:
    orders = t.orders(spark, d)
    return reports.since(orders, "order_date", _last_day(orders, "order_date"), 30).select(
        "order_id", "order_date", "total"
    )


def confirmed_with_state(spark: SparkSession, d: str) -> DataFrame:
    return clean.confirmed_with_state(t.with_state(t.orders(spark, d), spark, d)).select(
        "order_id", "shipping_state", "total"
    )


def training_orders(spark: SparkSession, d: str) -> DataFrame:
    return t.source_orders(spark, d).filter(F.col("order_status").isin(*builder.TRAINING_STATUSES))


def primary_payments(spark: SparkSession, d: str) -> DataFrame:
    return builder.primary_payments(t.source_payments(spark, d))


def product_categories(spark: SparkSession, d: str) -> DataFrame:
    return builder.product_categories(t.source_products(spark, d), t.translations(spark))


def value_maps(spark: SparkSession, d: str) -> DataFrame:
    heads = t.source_orders(spark, d).join(primary_payments(spark, d), "order_id")
    return heads.select(
        "order_id",
        payment_method(F.col("payment_type")).alias("payment_method"),
        order_status(F.col("order_status")).alias("status"),
    )


def live_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders not older than 90 days at the time of the newest one."""
    scored = t.scored_orders(spark, d)
    stored = fraud.stored_order(scored, F.col("created_at").cast("timestamp"))
    newest = scored.agg(F.max(F.unix_timestamp("created_at"))).scalar()
    return fraud.live_orders(stored, newest).select("order_id", "total", "fraud_score", "item_count", "ttl")


# ---- joins --------------------------------------------------------------------------------


def catalogue(spark: SparkSession, d: str) -> DataFrame:
    return builder.catalogue(t.source_products(spark, d), t.translations(spark), t.source_items(spark, d))


def customer_tiers(spark: SparkSession, d: str) -> DataFrame:
    out = builder.customer_tiers(t.source_customers(spark, d), t.source_orders(spark, d), rules=t.TABLE_TIERS)
    return out.select("customer_id", "order_count", "tier")


def orders_with_payment(spark: SparkSession, d: str) -> DataFrame:
    return builder.with_payment(t.source_orders(spark, d), t.source_payments(spark, d))


def training_interactions(spark: SparkSession, d: str) -> DataFrame:
    return builder.training_interactions(
        t.source_items(spark, d), t.source_orders(spark, d), t.source_customers(spark, d)
    )


def built_orders(spark: SparkSession, d: str) -> DataFrame:
    """Whole order events; the oracle compares their flat fields and the item totals."""
    tiers = builder.customer_tiers(t.source_customers(spark, d), t.source_orders(spark, d), rules=t.TABLE_TIERS)
    orders = t.source_orders(spark, d)
    rates = orders.select(
        "order_id", F.try_element_at(F.array(*[F.lit(x) for x in (0.0, 0.0, 0.0, 0.05, 0.10)]), (F.col("order_id") % 5 + 1).cast("int")).alias("discount_rate")
    )
    events = builder.build_orders(
        orders,
        t.source_payments(spark, d),
        t.source_items(spark, d),
        t.products(spark, d),
        tiers,
        F.lit("2024-01-01T00:00:00+00:00"),
        rates,
    )
    return events.select(
        "order_id",
        "customer_id",
        "customer_tier",
        F.size("items").alias("item_count"),
        "subtotal",
        "discount",
        "total",
        "payment_method",
        F.col("shipping_address.city").alias("city"),
        F.col("shipping_address.state").alias("state"),
        "status",
        "is_suspicious",
    )


def cohort_activity(spark: SparkSession, d: str) -> DataFrame:
    return reports.cohorts(t.orders(spark, d))


def scored_with_metadata(spark: SparkSession, d: str) -> DataFrame:
    products = t.priced_products(spark, d)
    top = scoring.top_scores(t.user_factors(spark, d), t.item_factors(spark, d), 5, metadata=products)
    return top.select("customer_id", "rank", "product_id", "category", "unit_price", "stock_level")


def _seen(spark: SparkSession, d: str) -> DataFrame:
    return t.order_items(spark, d, categories=False).select("customer_id", "product_id")


def unseen_scores(spark: SparkSession, d: str) -> DataFrame:
    top = scoring.top_scores(t.user_factors(spark, d), t.item_factors(spark, d), 20, _seen(spark, d))
    return top.select("customer_id", "product_id", round_half_up(F.col("score"), 6).alias("score"), "rank")


def product_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = display.with_label(t.item_rows(spark, d))
    return rows.groupBy("category", "product_label").agg(
        F.count(F.lit(1)).alias("n"), F.min("unit_price").alias("lowest"), F.max("unit_price").alias("highest")
    )


def order_history(spark: SparkSession, d: str) -> DataFrame:
    out = velocity.trailing_activity(t.event_orders(spark, d))
    return out.select("order_id", "customer_id", "orders_in_window", "spend_in_window")


# ---- aggregates ---------------------------------------------------------------------------


def daily_kpis(spark: SparkSession, d: str) -> DataFrame:
    return curated.daily_kpis(t.scored_orders(spark, d)).orderBy("order_date")


def customer_clv(spark: SparkSession, d: str) -> DataFrame:
    return curated.customer_clv(t.orders(spark, d))


def product_interactions(spark: SparkSession, d: str) -> DataFrame:
    out = curated.product_interactions(t.order_items(spark, d, categories=False))
    return out.withColumn("implicit_rating", round_half_up(F.col("implicit_rating"), 6))


def training_ratings(spark: SparkSession, d: str) -> DataFrame:
    out = training_interactions(spark, d)
    return out.withColumn("implicit_rating", round_half_up(F.col("implicit_rating").cast("double"), 4))


def state_revenue(spark: SparkSession, d: str) -> DataFrame:
    return curated.state_revenue(t.with_state(t.orders(spark, d), spark, d)).orderBy(F.desc("gross_revenue"))


def median_prices(spark: SparkSession, d: str) -> DataFrame:
    out = builder.median_prices(t.source_items(spark, d))
    return out.withColumn("unit_price", round_half_up(F.col("unit_price"), 4))


def order_tiers(spark: SparkSession, d: str) -> DataFrame:
    counts = builder.order_counts(t.source_orders(spark, d))
    return counts.withColumn("tier", builder.tier_of(F.col("order_count"), TierRules()))


def collected_items(spark: SparkSession, d: str) -> DataFrame:
    rows = builder.items_with_category(t.source_items(spark, d), t.products(spark, d))
    nested = builder.collect_items(rows)
    ids = F.transform("items", lambda i: i["product_id"].cast("string"))
    return nested.select("order_id", F.size("items").alias("n_items"), F.array_join(ids, ",").alias("product_ids"))


def order_totals(spark: SparkSession, d: str) -> DataFrame:
    rows = builder.items_with_category(t.source_items(spark, d), t.products(spark, d))
    return builder.order_totals(rows)


def spend_per_item(spark: SparkSession, d: str) -> DataFrame:
    return curated.spend_per_item(t.with_item_count(t.orders(spark, d), spark, d))


def conditional_rates(spark: SparkSession, d: str) -> DataFrame:
    return (
        t.scored_orders(spark, d)
        .groupBy("payment_method")
        .agg(
            F.count_if(F.col("status") == "confirmed").alias("confirmed"),
            F.count_if(F.col("status") == "failed").alias("failed"),
            F.count_if("is_fraud").alias("flagged"),
            round_half_up(100.0 * F.count_if("is_fraud") / F.count(F.lit(1)), 2).alias("flagged_pct"),
        )
    )


def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return t.order_items(spark, d, categories=False).agg(
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("product_id").alias("products"),
        F.count_distinct("order_date").alias("days"),
    )


def interaction_counts(spark: SparkSession, d: str) -> DataFrame:
    return curated.interaction_counts(training_interactions(spark, d))


# ---- windows, order, scalar functions --------------------------------------------------------


def orders_last_hour(spark: SparkSession, d: str) -> DataFrame:
    return order_history(spark, d).select("order_id", "orders_in_window")


def spend_last_day(spark: SparkSession, d: str) -> DataFrame:
    return order_history(spark, d).select("order_id", "spend_in_window")


def first_months(spark: SparkSession, d: str) -> DataFrame:
    return cohort_activity(spark, d).select("customer_id", "cohort_month").distinct()


def time_functions(spark: SparkSession, d: str) -> DataFrame:
    ts = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    parsed = t.clicks(spark, d).select("event_id", timefn.parse_ts(ts).alias("ts"))
    return parsed.select(
        "event_id",
        F.to_date("ts").alias("day"),
        F.hour("ts").alias("hour"),
        timefn.hour_label(F.col("ts")).alias("hour_label"),
        timefn.month_of(F.to_date("ts")).alias("month"),
        timefn.weekday_name(F.col("ts")).alias("weekday"),
        timefn.is_weekend(F.col("ts")).alias("weekend"),
        timefn.months_apart(F.lit("2023-11-01").cast("date"), timefn.month_of(F.to_date("ts"))).alias("months"),
    )


def number_functions(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("l_extendedprice")
    return t.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        round_half_up(x / 7.0, 0).alias("r0"),
        round_half_up(x / 7.0, 1).alias("r1"),
        round_half_up(x / 7.0, 3).alias("r3"),
        round_half_up(F.log1p("l_quantity"), 6).alias("log1p_qty"),
        (x / F.nullif(F.col("l_discount"), F.lit(0.0))).alias("guarded"),
        F.least(F.col("l_discount") * 20.0, F.lit(1.0)).alias("capped"),
        F.greatest(F.col("l_quantity") - 25.0, F.lit(0.0)).alias("floored"),
        F.col("l_extendedprice").between(F.lit(20000.0) * 0.4, F.lit(20000.0) * 1.6).alias("in_band"),
    )


def text_functions(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit(" "), F.upper("p_name"), F.lit(" "))
    return t.table(spark, d, "part").select(
        "p_partkey",
        text.category_key(name).alias("key"),
        text.category_matches(F.lower("p_name"), F.lit("ring")).alias("has_ring"),
        text.title_label(F.translate("p_name", " ", "_")).alias("label"),
        text.short_id(F.col("p_name")).alias("short"),
        text.whole_number(F.col("p_retailprice") / 2.0).alias("whole"),
    )


def json_fields(spark: SparkSession, d: str) -> DataFrame:
    return t.table(spark, d, "events").select(
        "event_id", F.from_json("props", "k int")["k"].alias("k"), F.get_json_object("props", "$.k").alias("k_text")
    )


def array_functions(spark: SparkSession, d: str) -> DataFrame:
    """Item arrays of each order: length, and value folded inside the array."""
    rows = t.nested_orders(spark, d).withColumn("items", F.coalesce("items", F.expr("filter(array(items[0]), x -> false)")))
    cents = F.aggregate(
        "items",
        F.lit(0).cast("bigint"),
        lambda acc, i: acc + F.floor(i["quantity"] * i["unit_price"] * 100.0 + 0.5),
    )
    return rows.select("order_id", F.size("items").alias("n_items"), (cents / F.lit(100.0)).alias("value"))


def vector_functions(spark: SparkSession, d: str) -> DataFrame:
    vectors = t.table(spark, d, "embeddings")
    return vectors.select(
        "vec_id",
        round_half_up(norm(F.col("embedding")), 6).alias("norm"),
        round_half_up(dot(F.col("embedding"), F.reverse("embedding")), 6).alias("dot_reversed"),
    )


# ---- fraud, sessions, stock, alarms ------------------------------------------------------------


def fraud_scores(spark: SparkSession, d: str) -> DataFrame:
    return t.scored_orders(spark, d).select(
        "order_id",
        round_half_up(F.col("fraud_score"), 4).alias("fraud_score"),
        F.array_join("fraud_flags", ",").alias("fraud_flags"),
        "is_fraud",
    )


def stored_orders(spark: SparkSession, d: str) -> DataFrame:
    stored = fraud.stored_order(t.scored_orders(spark, d), F.col("created_at").cast("timestamp"))
    return stored.select(
        "order_id", "customer_id", "status", "total", "fraud_score", "payment_method", "item_count", "ttl"
    )


def fraud_alerts(spark: SparkSession, d: str) -> DataFrame:
    alerts = fraud.fraud_alerts(t.scored_orders(spark, d), F.col("created_at"))
    return alerts.select(
        "order_id", "customer_id", "total", round_half_up(F.col("fraud_score"), 4).alias("fraud_score"), "timestamp"
    )


def order_events(spark: SparkSession, d: str) -> DataFrame:
    return fraud.order_events(t.scored_orders(spark, d), F.col("created_at"))


def _decision_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "order_id",
        "orders_in_window",
        "spend_in_window",
        "fraud_decision",
        "combined_fraud_score",
        F.array_join("all_fraud_flags", ",").alias("all_fraud_flags"),
    )


def fraud_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Flagged orders checked against all orders."""
    alerts = t.scored_orders(spark, d).filter("is_fraud")
    history = t.orders(spark, d).select("customer_id", "created_at", "total")
    return _decision_columns(fraud.decide(alerts, history, ORDER_VELOCITY))


def event_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Error events as alerts, checked against all events as orders."""
    events = t.table(spark, d, "events")
    alerts = events.filter(F.col("event_type") == "error").select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("created_at"),
        F.col("value").alias("total"),
        (F.get_json_object("props", "$.k").cast("double") / 100.0).alias("fraud_score"),
        F.array(F.lit("error_event")).alias("fraud_flags"),
    )
    return _decision_columns(fraud.decide(alerts, t.event_orders(spark, d), EVENT_VELOCITY))


def latest_orders(spark: SparkSession, d: str) -> DataFrame:
    """Order log with a second, confirmed version of each pending order."""
    log = t.orders(spark, d).select("order_id", "customer_id", "status", "total", F.lit(1).alias("version"))
    later = log.filter(F.col("status") == "pending").withColumns({"status": F.lit("confirmed"), "version": F.lit(2)})
    return upsert.latest(log.unionByName(later), ["order_id", "customer_id"], "version")


def merged_decisions(spark: SparkSession, d: str) -> DataFrame:
    scored = t.scored_orders(spark, d)
    alerts = scored.filter("is_fraud")
    decisions = fraud.decide(alerts, t.orders(spark, d), ORDER_VELOCITY)
    merged = upsert.merge_decisions(scored.select("order_id", "customer_id", "total"), decisions)
    return merged.select("order_id", "customer_id", "total", "fraud_decision", "combined_fraud_score")


def click_sessions(spark: SparkSession, d: str) -> DataFrame:
    return _ntz(sessions.sessionize(t.clicks(spark, d)))


def latest_stock(spark: SparkSession, d: str) -> DataFrame:
    return inventory.latest_stock(t.stock_events(spark, d))


def stock_alerts(spark: SparkSession, d: str) -> DataFrame:
    return inventory.stock_alerts(t.stock_events(spark, d))


def stocked_products(spark: SparkSession, d: str) -> DataFrame:
    return inventory.apply_stock(t.priced_products(spark, d), inventory.latest_stock(t.stock_events(spark, d)))


def error_alarms(spark: SparkSession, d: str) -> DataFrame:
    return alarms.alarms(t.metrics(spark, d), EVENT_ERRORS)


def backlog_alarms(spark: SparkSession, d: str) -> DataFrame:
    return alarms.alarms(t.metrics(spark, d), EVENT_BACKLOG)


def mean_alarms(spark: SparkSession, d: str) -> DataFrame:
    return alarms.alarms(t.metrics(spark, d), EVENT_MEAN)


def metric_series(spark: SparkSession, d: str) -> DataFrame:
    return alarms.metric_series(t.metrics(spark, d), 300, "sum")


# ---- recommendations --------------------------------------------------------------------------


def dense_ids(spark: SparkSession, d: str) -> DataFrame:
    ids = training.dense_ids(t.source_items(spark, d), "product_id", "item")
    return ids.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("item").alias("n_ids"),
        F.min("item").alias("lowest"),
        F.max("item").alias("highest"),
    )


def als_factors(spark: SparkSession, d: str) -> DataFrame:
    """Fits the full-size model; the rows say how many factors of which length it has."""
    factors = training.fit_factors(spark, training_interactions(spark, d), AlsParams())

    def summary(df: DataFrame, kind: str) -> DataFrame:
        return df.agg(
            F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"), F.min(F.size("factors")).alias("length")
        )

    return summary(factors.users, "customer").unionByName(summary(factors.items, "product"))


def held_out_measures(spark: SparkSession, d: str) -> DataFrame:
    """The stored factors' 20 best new products, against what customers bought first in the last fifth of the purchases."""
    bought = lake.stored(t.order_items(spark, d, categories=False).select("customer_id", "product_id", "order_date"), "purchases")
    seen, held_out = evaluation.split_pairs(bought, evaluation.split_day(bought))
    found = evaluation.evaluate(t.user_factors(spark, d), t.item_factors(spark, d), seen, held_out)
    rounded = {c: round_half_up(F.col(c), 6) for c in ("recall", "hit_rate", "mean_rank", "mean_reciprocal_rank")}
    return found.withColumns(rounded)


def personal_scores(spark: SparkSession, d: str) -> DataFrame:
    top = scoring.top_scores(t.user_factors(spark, d), t.item_factors(spark, d), 40)
    return top.select("customer_id", "product_id", round_half_up(F.col("score"), 6).alias("score"), "rank")


def popular_items(spark: SparkSession, d: str) -> DataFrame:
    top = scoring.popular_items(t.item_factors(spark, d), 200)
    return top.withColumn("score", round_half_up(F.col("score"), 6))


def _stored_products(spark: SparkSession, d: str) -> DataFrame:
    """The product table the recommender reads: seeded once per session, like any stored table."""
    return lake_queries.once(spark, d, "products", lambda s, f: lake.stored(t.priced_products(s, f), "products"))


def _answers(spark: SparkSession, d: str) -> DataFrame:
    spend = curated.spend_per_item(t.with_item_count(t.orders(spark, d), spark, d))
    return recommend.recommend(
        t.requests(spark, d), t.user_factors(spark, d), t.item_factors(spark, d), _stored_products(spark, d), spend
    )


def request_options(spark: SparkSession, d: str) -> DataFrame:
    return recommend.normalise_requests(t.requests(spark, d))


def recommendations(spark: SparkSession, d: str) -> DataFrame:
    return _answers(spark, d).drop("n", "asked_category")


def category_rows(spark: SparkSession, d: str) -> DataFrame:
    """Answers to requests that asked for a category."""
    return _answers(spark, d).filter(F.col("asked_category") != "").drop("n")


def fallback_rows(spark: SparkSession, d: str) -> DataFrame:
    return recommendations(spark, d).filter(F.col("strategy") == "catalog_fallback")


def list_summary(spark: SparkSession, d: str) -> DataFrame:
    out = recommend.list_summary(_answers(spark, d)).drop("n", "asked_category")
    return out.withColumn("categories", F.array_join("categories", ","))


def display_rows(spark: SparkSession, d: str) -> DataFrame:
    return display.display_rows(_answers(spark, d))


def bulk_lists(spark: SparkSession, d: str) -> DataFrame:
    lists = recommend.bulk_lists(
        t.user_factors(spark, d), t.item_factors(spark, d), _stored_products(spark, d), _seen(spark, d)
    )
    return lists.select(
        "customer_id",
        F.size("popular_fallback").alias("n_popular"),
        F.posexplode("recommendations").alias("pos", "r"),
    ).select("customer_id", "n_popular", (F.col("pos") + 1).alias("rank"), "r.*")


# ---- reports -------------------------------------------------------------------------------------


def report_daily_revenue(spark: SparkSession, d: str) -> DataFrame:
    return reports.daily_revenue(daily_kpis(spark, d), _last_day(t.orders(spark, d), "order_date"))


def report_latest_revenue(spark: SparkSession, d: str) -> DataFrame:
    return reports.latest_daily_revenue(curated.daily_kpis(t.scored_orders(spark, d)))


def report_top_products(spark: SparkSession, d: str) -> DataFrame:
    return reports.top_products(t.order_items(spark, d), _last_day(t.orders(spark, d), "order_date"))


def report_category_revenue(spark: SparkSession, d: str) -> DataFrame:
    return reports.category_revenue(t.order_items(spark, d))


def report_top_categories(spark: SparkSession, d: str) -> DataFrame:
    return reports.category_revenue(t.order_items(spark, d), top=15)


def report_state_revenue(spark: SparkSession, d: str) -> DataFrame:
    return reports.revenue_by_state(state_revenue(spark, d))


def report_payments(spark: SparkSession, d: str) -> DataFrame:
    return reports.payment_breakdown(t.scored_orders(spark, d))


def report_cohorts(spark: SparkSession, d: str) -> DataFrame:
    return reports.cohort_retention(t.orders(spark, d))


def report_freight(spark: SparkSession, d: str) -> DataFrame:
    return reports.freight_by_state(t.order_items(spark, d, state=True, categories=False))


def report_fraud_days(spark: SparkSession, d: str) -> DataFrame:
    return reports.fraud_by_day(t.scored_orders(spark, d))


def report_fraud_trend(spark: SparkSession, d: str) -> DataFrame:
    return reports.fraud_trend(t.scored_orders(spark, d))


def _dated_clicks(spark: SparkSession, d: str) -> DataFrame:
    return t.clicks(spark, d).withColumn("event_date", F.to_date("timestamp"))


def report_funnel(spark: SparkSession, d: str) -> DataFrame:
    clicks = _dated_clicks(spark, d)
    return reports.click_funnel(clicks, _last_day(clicks, "event_date"))


def report_funnel_share(spark: SparkSession, d: str) -> DataFrame:
    return reports.funnel_share(t.clicks(spark, d))


def report_hourly(spark: SparkSession, d: str) -> DataFrame:
    orders = t.orders(spark, d)
    return reports.hourly_orders(orders, _last_day(orders, "order_date"))


def report_segments(spark: SparkSession, d: str) -> DataFrame:
    return reports.clv_segments(customer_clv(spark, d))


QUERIES: dict[str, Query] = {
    "p1_clean_clicks": clean_clicks,
    "p2_clean_orders": clean_orders,
    "p3_enrich_clicks": enrich_clicks,
    "p4_explode_items": explode_items,
    "p5_unnest_sql": unnest_sql,
    "p6_confirmed_orders": confirmed_orders,
    "p7_recent_orders": recent_orders,
    "p8_confirmed_with_state": confirmed_with_state,
    "p9_training_orders": training_orders,
    "p10_primary_payments": primary_payments,
    "p11_j1_product_categories": product_categories,
    "p12_value_maps": value_maps,
    "p13_live_orders": live_orders,
    "j2_catalogue": catalogue,
    "j3_customer_tiers": customer_tiers,
    "j4_orders_with_payment": orders_with_payment,
    "j5_training_interactions": training_interactions,
    "j6_built_orders": built_orders,
    "j7_cohort_activity": cohort_activity,
    "j8_scored_with_metadata": scored_with_metadata,
    "j9_unseen_scores": unseen_scores,
    "j10_product_labels": product_labels,
    "j11_order_history": order_history,
    "a1_daily_kpis": daily_kpis,
    "a2_customer_clv": customer_clv,
    "a3_product_interactions": product_interactions,
    "a4_training_ratings": training_ratings,
    "a5_state_revenue": state_revenue,
    "a6_median_prices": median_prices,
    "a7_order_tiers": order_tiers,
    "a8_collected_items": collected_items,
    "a9_order_totals": order_totals,
    "a10_spend_per_item": spend_per_item,
    "a11_conditional_rates": conditional_rates,
    "a12_distinct_counts": distinct_counts,
    "a13_interaction_counts": interaction_counts,
    "a14_list_summary": list_summary,
    "w2_orders_last_hour": orders_last_hour,
    "w3_spend_last_day": spend_last_day,
    "w5_first_months": first_months,
    "f1_f7_time_functions": time_functions,
    "f8_f13_number_functions": number_functions,
    "f14_array_functions": array_functions,
    "f15_f17_text_functions": text_functions,
    "f18_vector_functions": vector_functions,
    "f22_json_fields": json_fields,
    "t1_fraud_scores": fraud_scores,
    "t2_stored_orders": stored_orders,
    "t3_fraud_alerts": fraud_alerts,
    "t4_order_events": order_events,
    "t5_fraud_decisions": fraud_decisions,
    "t5_event_decisions": event_decisions,
    "s12_latest_orders": latest_orders,
    "s13_merged_decisions": merged_decisions,
    "t8_click_sessions": click_sessions,
    "t9_latest_stock": latest_stock,
    "t9_stock_alerts": stock_alerts,
    "t9_stocked_products": stocked_products,
    "t10_error_alarms": error_alarms,
    "t10_backlog_alarms": backlog_alarms,
    "t10_mean_alarms": mean_alarms,
    "t10_metric_series": metric_series,
    "r1_dense_ids": dense_ids,
    "r2_als_factors": als_factors,
    "r2_held_out_measures": held_out_measures,
    "r4_o5_personal_scores": personal_scores,
    "r5_o6_popular_items": popular_items,
    "r6_category_rows": category_rows,
    "r9_fallback_rows": fallback_rows,
    "r10_request_options": request_options,
    "r11_bulk_lists": bulk_lists,
    "r12_w4_recommendations": recommendations,
    "r13_w7_display_rows": display_rows,
    "q1_daily_revenue": report_daily_revenue,
    "q1_o4_latest_revenue": report_latest_revenue,
    "q2_o2_top_products": report_top_products,
    "q3_category_revenue": report_category_revenue,
    "q3_o3_top_categories": report_top_categories,
    "q4_state_revenue": report_state_revenue,
    "q5_w1_payment_breakdown": report_payments,
    "q6_cohort_retention": report_cohorts,
    "q7_freight_by_state": report_freight,
    "q8_fraud_by_day": report_fraud_days,
    "q8_w8_fraud_trend": report_fraud_trend,
    "q9_click_funnel": report_funnel,
    "q9_w6_funnel_share": report_funnel_share,
    "q10_hourly_orders": report_hourly,
    "q11_clv_segments": report_segments,
    **lake_queries.QUERIES,
    **lake_reports.QUERIES,
}
