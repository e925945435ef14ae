"""Cleaning of raw clicks and orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.numeric import finite
from marketlake.functions.timefn import earliest_first, is_weekend, parse_ts, weekday_name
from marketlake.operators.velocity import MOST_BITS, may_be_among


def keep_first(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key: the least by `order`, then by a hash of the whole row.

    This is an aggregate, not a window: every task first reduces the copies it holds,
    so a key that owns a third of the rows reaches the shuffle as one row per task.
    """
    cols = df.columns
    smallest = F.min(F.struct(order.alias("_o"), F.xxhash64(*cols).alias("_h"), F.struct(*cols).alias("_r")))
    return df.groupBy(*keys).agg(smallest.alias("_m")).select("_m._r.*")


def keep_first_of_copies(df: DataFrame, key: str, order: Column) -> DataFrame:
    """`keep_first` where most keys occur once: keys alone are counted, and only rows that may have a copy are shuffled.

    `df` is read three times, so it should be files.
    """
    copied = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key)
    marked = may_be_among(df, copied, (key,), MOST_BITS, "_copied")
    some = keep_first(marked.filter("_copied").drop("_copied"), [key], order)
    return marked.filter("NOT _copied").drop("_copied").unionByName(some)


def keep_last(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key: the greatest by `order`; reduced before the shuffle as above."""
    cols = df.columns
    greatest = F.max(F.struct(order.alias("_o"), F.xxhash64(*cols).alias("_h"), F.struct(*cols).alias("_r")))
    return df.groupBy(*keys).agg(greatest.alias("_m")).select("_m._r.*")


def clean_clicks(raw: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Deduplicated clicks with event_date, event_hour, is_authenticated, processed_at.

    `timestamp` is ISO text or already a timestamp. Text that cannot be parsed gives null parts.
    """
    first = keep_first(raw.filter(F.col("event_id").isNotNull()), ["event_id"], earliest_first(F.col("timestamp")))
    ts = parse_ts(F.col("timestamp"))
    return first.withColumns(
        {
            "event_date": F.to_date(ts),
            "event_hour": F.hour(ts),
            "is_authenticated": F.col("customer_id").isNotNull(),
            "processed_at": F.current_timestamp() if stamp is None else stamp,
        }
    )


def _usable(raw: DataFrame) -> DataFrame:
    typed = raw.withColumn("total", finite(F.col("total").try_cast("double")))
    return typed.filter(F.col("order_id").isNotNull() & F.col("total").isNotNull())


def order_days(raw: DataFrame) -> DataFrame:
    """(order_id, order_date) of the cleaned orders; only ids and times are shuffled, as copies of one time are of one day."""
    times = _usable(raw).select("order_id", "created_at")
    first = keep_first(times, ["order_id"], earliest_first(F.col("created_at")))
    return first.select("order_id", F.to_date(parse_ts(F.col("created_at"))).alias("order_date"))


def clean_orders(raw: DataFrame, stamp: Column | None = None, few_copies: bool = False) -> DataFrame:
    """Deduplicated orders with typed amounts, order_date and the flattened address.

    Orders without id or without a usable total are left out. `few_copies` is for raw files in which most orders occur
    once: the same rows, but whole orders are shuffled only if they may have a copy.
    """
    typed = _usable(raw).withColumn("fraud_score", finite(F.col("fraud_score").try_cast("double")))
    by_time = earliest_first(F.col("created_at"))
    first = keep_first_of_copies(typed, "order_id", by_time) if few_copies else keep_first(typed, ["order_id"], by_time)
    return first.withColumns(
        {
            "order_date": F.to_date(parse_ts(F.col("created_at"))),
            "shipping_state": F.col("shipping_address.state"),
            "shipping_city": F.col("shipping_address.city"),
            "processed_at": F.current_timestamp() if stamp is None else stamp,
        }
    )


def enrich_clicks(clicks: DataFrame, now: Column | None = None) -> DataFrame:
    """Time parts and the authentication flag of each click; a missing timestamp counts as now."""
    now = F.current_timestamp() if now is None else now
    ts = F.when(F.col("timestamp").isNull(), now).otherwise(parse_ts(F.col("timestamp")).cast("timestamp"))
    return (
        clicks.withColumn("_ts", ts)
        .withColumns(
            {
                "hour_of_day": F.hour("_ts"),
                "day_of_week": weekday_name(F.col("_ts")),
                "is_weekend": is_weekend(F.col("_ts")),
                "is_authenticated": F.col("customer_id").isNotNull(),
                "enriched_at": now,
            }
        )
        .drop("_ts")
    )


def explode_items(orders: DataFrame, *carry: str) -> DataFrame:
    """One row per order item; `freight` becomes `freight_value`. Orders without items vanish."""
    keep = carry or ("order_id", "customer_id")
    return orders.select(*keep, F.explode("items").alias("item")).select(
        *keep,
        "item.product_id",
        "item.category",
        "item.unit_price",
        "item.quantity",
        F.col("item.freight").alias("freight_value"),
    )


def confirmed(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status") == "confirmed")


def confirmed_with_state(orders: DataFrame) -> DataFrame:
    return orders.filter((F.col("status") == "confirmed") & F.col("shipping_state").isNotNull())
