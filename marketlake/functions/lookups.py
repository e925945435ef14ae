"""Fixed value maps and the label table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Source payment type -> payment method. Anything else is credit_card.
PAYMENT_METHODS = {
    "credit_card": "credit_card",
    "boleto": "bank_transfer",
    "voucher": "paypal",
    "debit_card": "debit_card",
    "not_defined": "credit_card",
}
DEFAULT_PAYMENT_METHOD = "credit_card"

# Source order status -> order status. Anything else is confirmed.
ORDER_STATUSES = {
    "delivered": "confirmed",
    "shipped": "confirmed",
    "approved": "confirmed",
    "processing": "pending",
    "created": "pending",
    "canceled": "failed",
    "unavailable": "failed",
    "invoiced": "pending",
}
DEFAULT_ORDER_STATUS = "confirmed"

# Source statuses whose items count as purchases in training.
TRAINING_STATUSES = ("delivered", "shipped", "approved", "invoiced")

# Category -> (price from, price below, label).
LABEL_TIERS = {
    "toys": [(0, 30, "Budget Toy Set"), (30, 70, "Activity Play Set"), (70, 999, "Premium RC Toy")],
    "health_beauty": [(0, 25, "Daily Skincare Kit"), (25, 60, "Beauty Essentials Set"), (60, 999, "Premium Beauty Bundle")],
    "furniture_decor": [(0, 40, "Decorative Accent"), (40, 80, "Home Décor Set"), (80, 999, "Statement Furniture Piece")],
    "garden_tools": [(0, 30, "Garden Hand Tool"), (30, 70, "Garden Tool Set"), (70, 999, "Pro Garden Kit")],
    "bed_bath_table": [(0, 40, "Bath Essentials Pack"), (40, 80, "Bedroom Comfort Set"), (80, 999, "Premium Linen Set")],
    "telephony": [(0, 50, "Phone Accessory"), (50, 150, "Mobile Device Kit"), (150, 999, "Smartphone Bundle")],
    "watches_gifts": [(0, 50, "Fashion Watch"), (50, 150, "Gift Set"), (150, 999, "Premium Timepiece")],
    "computers_accessories": [(0, 50, "PC Accessory"), (50, 150, "Computer Peripheral Kit"), (150, 999, "Tech Bundle")],
    "sports_leisure": [(0, 40, "Sports Accessory"), (40, 100, "Fitness Set"), (100, 999, "Premium Sports Kit")],
    "housewares": [(0, 40, "Kitchen Essential"), (40, 80, "Home Utility Set"), (80, 999, "Premium Kitchenware")],
    "auto": [(0, 50, "Car Accessory"), (50, 150, "Auto Care Kit"), (150, 999, "Premium Auto Set")],
    "books_general_interest": [(0, 30, "Bestseller Book"), (30, 60, "Book Collection"), (60, 999, "Special Edition Set")],
    "cool_stuff": [(0, 40, "Novelty Item"), (40, 80, "Lifestyle Gadget"), (80, 999, "Premium Lifestyle Set")],
    "perfumery": [(0, 30, "Fragrance Sample Set"), (30, 80, "Eau de Toilette"), (80, 999, "Designer Perfume")],
    "office_furniture": [(0, 50, "Desk Organiser"), (50, 150, "Office Furniture Piece"), (150, 999, "Executive Office Set")],
}

# Recommendation strategy -> heading, and row source -> short label.
STRATEGY_LABELS = {
    "als_personalised": "🤖 ALS personalised",
    "als_popular": "⭐ Trending (new customer)",
    "catalog_fallback": "📦 Catalog browse",
}
SOURCE_LABELS = {
    "als_personalised": "ALS",
    "als_popular": "Trending",
    "catalog_fallback": "Catalog",
    "dynamodb_live": "DynamoDB",
}


def map_value(key: Column, table: Mapping[str, str], default: Column) -> Column:
    """Look a value up in a small fixed map, with a default for unknown and null keys."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), default)


def payment_method(source_type: Column) -> Column:
    return map_value(source_type, PAYMENT_METHODS, F.lit(DEFAULT_PAYMENT_METHOD))


def order_status(source_status: Column) -> Column:
    return map_value(source_status, ORDER_STATUSES, F.lit(DEFAULT_ORDER_STATUS))


def label_tiers(spark: SparkSession) -> DataFrame:
    """One row per category with its price tiers as an array: a constant of 15 rows."""
    rows = [(cat, [(float(lo), float(hi), label) for lo, hi, label in tiers]) for cat, tiers in LABEL_TIERS.items()]
    return spark.createDataFrame(
        rows, "label_key string, tiers array<struct<lo: double, hi: double, label: string>>"
    )
