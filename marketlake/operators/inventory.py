"""Stock levels and low-stock alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.timefn import earliest_first, parse_ts

from marketlake.config import StockRules


def stock_alerts(events: DataFrame, rules: StockRules = StockRules()) -> DataFrame:
    """Events at or below the low threshold, with severity and a subject line. Stateless."""
    severity = F.when(F.col("current_stock") <= rules.critical, "CRITICAL").otherwise("WARNING")
    category = F.coalesce("category", F.lit("unknown"))
    return (
        events.filter(F.col("current_stock") <= rules.low)
        .withColumns(
            {
                "severity": severity,
                "category": category,
                "warehouse_id": F.coalesce("warehouse_id", F.lit("unknown")),
            }
        )
        .select(
            "product_id",
            "category",
            "current_stock",
            "delta",
            "severity",
            "warehouse_id",
            "timestamp",
            F.concat(
                F.lit("Low Inventory ["),
                F.col("severity"),
                F.lit("] — "),
                F.col("category"),
                F.lit(" / "),
                F.col("product_id").cast("string"),
            ).alias("subject"),
        )
    )


def latest_stock(events: DataFrame) -> DataFrame:
    """Newest stock and warehouse per product, and the first category seen for it.

    A struct maximum and minimum: both combine map-side, so a product with very many
    updates reaches the shuffle as one row per task.
    """
    return stock_view(stock_changes(events))


def stock_changes(events: DataFrame) -> DataFrame:
    """Updates of one batch reduced to a row per product: its newest state and first category."""
    at = parse_ts(F.col("timestamp")).cast("timestamp").alias("at")
    newest = F.struct(
        at, "timestamp", "event_id", F.col("current_stock").alias("stock_level"),
        F.coalesce("warehouse_id", F.lit("unknown")).alias("warehouse_id"),
    )
    oldest = F.struct(earliest_first(F.col("timestamp")).alias("at"), "timestamp", "event_id", F.coalesce("category", F.lit("unknown")).alias("category"))
    return events.groupBy("product_id").agg(F.max(newest).alias("newest"), F.min(oldest).alias("oldest"))


def fold_changes(changes: DataFrame) -> DataFrame:
    """Changes of any number of batches, one row per product again."""
    return changes.groupBy("product_id").agg(F.max("newest").alias("newest"), F.min("oldest").alias("oldest"))


def stock_view(changes: DataFrame) -> DataFrame:
    """Current state per product over any number of batches of changes."""
    return fold_changes(changes).select(
        "product_id",
        "oldest.category",
        "newest.stock_level",
        F.col("newest.timestamp").alias("last_updated"),
        "newest.warehouse_id",
    )


def apply_stock(products: DataFrame, updates: DataFrame) -> DataFrame:
    """Products with the updates written over them; unknown products are added.

    A known category is kept, stock and warehouse are replaced. Both inputs have one row per
    product, so the merge is one grouped union with at most two rows per group.
    """
    old = products.select(
        "product_id",
        F.lit(0).alias("age"),
        F.col("category"),
        F.col("unit_price"),
        F.col("stock_level"),
        F.lit(None).cast(dict(updates.dtypes)["last_updated"]).alias("last_updated"),
        F.lit(None).cast("string").alias("warehouse_id"),
    )
    new = updates.select(
        "product_id",
        F.lit(1).alias("age"),
        "category",
        F.lit(None).cast("double").alias("unit_price"),
        F.col("stock_level").cast("int").alias("stock_level"),
        "last_updated",
        "warehouse_id",
    )
    return (
        old.unionByName(new)
        .groupBy("product_id")
        .agg(
            F.min_by("category", F.when(F.col("category").isNotNull(), F.col("age"))).alias("category"),
            F.max("unit_price").alias("unit_price"),
            F.max_by("stock_level", "age").alias("stock_level"),
            F.max("last_updated").alias("last_updated"),
            F.max("warehouse_id").alias("warehouse_id"),
        )
    )
