"""Rule scores, velocity checks and decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.config import RETENTION_DAYS, FraudRules, VelocityRules
from marketlake.functions.numeric import UNIT, round_half_up
from marketlake.functions.text import whole_number
from marketlake.operators.velocity import trailing_activity


def _weigh(checks: list[tuple[Column, float]]) -> Column:
    score = F.lit(0.0)
    for cond, weight in checks:
        score = score + F.when(cond, F.lit(weight)).otherwise(F.lit(0.0))
    return score


def _flags(checks: list[tuple[Column, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(cond, text) for cond, text in checks]))


def score_orders(orders: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    """Adds fraud_score (capped at 1.0), fraud_flags and is_fraud.

    Plain column expressions, so the same code runs on a batch and on a stream. The number
    of items comes from `items`, or from `item_count` where the array is not kept. A missing
    suspicion flag, payment method or item list counts as no signal.
    """
    if "items" in orders.columns:
        n_items = F.coalesce(F.size("items"), F.lit(0))
    else:
        n_items = F.coalesce(F.col("item_count"), F.lit(0))
    total = F.col("total")
    high = total > rules.high_value
    checks = [
        ("known_risky_customer", F.coalesce("is_suspicious", F.lit(False)), rules.w_known_risk),
        ("high_value_order", high, rules.w_high_value),
        ("unusual_payment_method", F.col("payment_method").isin(*rules.risky_payments), rules.w_payment),
        ("tier_amount_mismatch", (F.col("customer_tier") == "bronze") & (total > rules.bronze_value), rules.w_tier),
        ("bulk_purchase", (n_items > rules.bulk_items) & high, rules.w_bulk),
    ]
    uncapped = _weigh([(cond, weight) for _, cond, weight in checks])
    return orders.withColumns(
        {
            "_uncapped": uncapped,
            "fraud_flags": _flags([(cond, F.lit(name)) for name, cond, _ in checks]),
        }
    ).select(
        *orders.columns,
        F.least("_uncapped", F.lit(1.0)).alias("fraud_score"),
        "fraud_flags",
        (F.col("_uncapped") >= rules.flag_at).alias("is_fraud"),
    )


def stored_order(scored: DataFrame, now: Column | None = None) -> DataFrame:
    """The stored order row: amounts as text, item count, and the time it expires."""
    now = F.current_timestamp() if now is None else now
    n_items = F.coalesce(F.size("items"), F.lit(0)) if "items" in scored.columns else F.col("item_count")
    return scored.select(
        "order_id",
        "customer_id",
        "status",
        F.col("total").cast("string").alias("total"),
        round_half_up(F.col("fraud_score"), 4).cast("string").alias("fraud_score"),
        "fraud_flags",
        "payment_method",
        n_items.cast("int").alias("item_count"),
        "created_at",
        now.alias("processed_at"),
        (F.unix_timestamp(now) + RETENTION_DAYS * 86400).alias("ttl"),
    )


def live_orders(stored: DataFrame, as_of_epoch: Column) -> DataFrame:
    """Stored orders whose retention has not run out."""
    return stored.filter(F.col("ttl") > as_of_epoch)


def fraud_alerts(scored: DataFrame, stamp: Column) -> DataFrame:
    return scored.filter("is_fraud").select(
        "order_id", "customer_id", "total", "fraud_score", "fraud_flags", stamp.alias("timestamp")
    )


def order_events(scored: DataFrame, stamp: Column) -> DataFrame:
    return scored.select("order_id", "customer_id", "status", "total", stamp.alias("timestamp"))


def velocity_flags(df: DataFrame, rules: VelocityRules = VelocityRules()) -> DataFrame:
    """Adds velocity_score and velocity_flags from orders_in_window and spend_in_window."""
    spend = F.col("spend_in_window") + F.col("total") if rules.include_current else F.col("spend_in_window")
    spend = round_half_up(spend, 4)
    fast = F.col("orders_in_window") >= rules.max_orders
    heavy = spend > rules.max_spend
    texts = [
        (fast, F.concat(F.lit("velocity_orders_"), F.col("orders_in_window").cast("string"), F.lit("_in_1h"))),
        (heavy, F.concat(F.lit("spend_limit_exceeded_"), whole_number(spend))),
    ]
    return df.withColumns(
        {
            "velocity_score": F.least(_weigh([(fast, rules.w_orders), (heavy, rules.w_spend)]), F.lit(1.0)),
            "velocity_flags": _flags(texts),
        }
    )


def decide(alerts: DataFrame, orders: DataFrame | None = None, rules: VelocityRules = VelocityRules()) -> DataFrame:
    """Velocity check and BLOCK / REVIEW / PASS for each alert.

    `orders` is the order log the alerts are checked against; by default the alerts themselves.
    Windows end at the order's own created_at.
    """
    return decide_checked(trailing_activity(alerts, orders, rules), rules)


def decide_checked(windowed: DataFrame, rules: VelocityRules = VelocityRules()) -> DataFrame:
    """The decision on orders that have orders_in_window and spend_in_window; plain expressions, batch or stream."""
    checked = velocity_flags(windowed, rules)
    existing = F.coalesce(F.col("fraud_score"), F.lit(0.0))
    checked = checked.withColumn("_combined", F.least(existing + F.col("velocity_score"), F.lit(1.0)))
    combined = F.col("_combined")
    return checked.withColumns(
        {
            "fraud_decision": F.when(combined >= rules.block_at, "BLOCK")
            .when(combined >= rules.review_at, "REVIEW")
            .otherwise("PASS"),
            "combined_fraud_score": round_half_up(combined, 4),
            "all_fraud_flags": F.concat(F.coalesce("fraud_flags", F.array().cast("array<string>")), "velocity_flags"),
        }
    ).drop("_combined")


__all__ = [
    "UNIT",
    "decide",
    "decide_checked",
    "fraud_alerts",
    "live_orders",
    "order_events",
    "score_orders",
    "stored_order",
    "velocity_flags",
]
