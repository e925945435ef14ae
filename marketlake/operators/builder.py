"""Orders, customers and the catalogue built from the source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.config import DEFAULT_PRICE, TierRules
from marketlake.functions.lookups import TRAINING_STATUSES, order_status, payment_method
from marketlake.functions.numeric import exact_sum, round_half_up


def product_categories(products: DataFrame, translations: DataFrame) -> DataFrame:
    """(product_id, category): the translation, else the source name, else 'other'.

    The translation table is small; Catalyst broadcasts it by its known size.
    """
    return products.join(translations, "product_category_name", "left").select(
        "product_id",
        F.coalesce("product_category_name_english", "product_category_name", F.lit("other")).alias("category"),
    )


def median_prices(items: DataFrame, price: str = "price") -> DataFrame:
    """Exact median price per product.

    Equal prices are counted first, map-side, so a product that owns a third of the items
    brings only its distinct prices to the percentile.
    """
    counted = items.filter(F.col(price).isNotNull()).groupBy("product_id", price).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("product_id").agg(F.percentile(price, 0.5, F.col("n")).alias("unit_price"))


def catalogue(products: DataFrame, translations: DataFrame, items: DataFrame) -> DataFrame:
    """Product catalogue: category, median price (50.0 when never sold, 2 decimals), stock 0."""
    return (
        product_categories(products.filter(F.col("product_id").isNotNull()), translations)
        .join(median_prices(items), "product_id", "left")
        .select(
            "product_id",
            "category",
            round_half_up(F.coalesce("unit_price", F.lit(DEFAULT_PRICE))).alias("unit_price"),
            F.lit(0).alias("stock_level"),
        )
    )


def tier_of(count: Column, rules: TierRules = TierRules()) -> Column:
    return (
        F.when(count >= rules.platinum, "platinum")
        .when(count >= rules.gold, "gold")
        .when(count >= rules.silver, "silver")
        .otherwise("bronze")
    )


def order_counts(orders: DataFrame, key: str = "customer_id") -> DataFrame:
    return orders.groupBy(key).agg(F.count(F.lit(1)).alias("order_count"))


def customer_tiers(
    customers: DataFrame, orders: DataFrame, key: str = "customer_id", rules: TierRules = TierRules()
) -> DataFrame:
    """Customers with order_count (1 when no order is known) and tier.

    `key` names the person across orders; pass the stable id where the source has one.
    """
    joined = customers.join(order_counts(orders, key), key, "left")
    counted = joined.withColumn("order_count", F.coalesce("order_count", F.lit(1)))
    return counted.withColumn("tier", tier_of(F.col("order_count"), rules))


def primary_payments(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("payment_sequential") == 1).select("order_id", "payment_type", "payment_value")


def with_payment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their first payment's type; credit_card when there is none."""
    first = primary_payments(payments).select("order_id", "payment_type")
    return orders.join(first, "order_id", "left").withColumn(
        "payment_type", F.coalesce("payment_type", F.lit("credit_card"))
    )


def items_with_category(items: DataFrame, categories: DataFrame) -> DataFrame:
    """Order item rows in event form: quantity 1, amounts to the cent, category 'other' when unknown."""
    return items.join(categories.select("product_id", "category"), "product_id", "left").select(
        "order_id",
        "product_id",
        F.coalesce("category", F.lit("other")).alias("category"),
        F.lit(1).alias("quantity"),
        round_half_up(F.col("price")).alias("unit_price"),
        round_half_up(F.col("freight_value")).alias("freight"),
    )


def collect_items(item_rows: DataFrame) -> DataFrame:
    """(order_id, items): the nested array of the order event, in a fixed order."""
    item = F.struct("product_id", "category", "quantity", "unit_price", "freight")
    return item_rows.groupBy("order_id").agg(F.sort_array(F.collect_list(item)).alias("items"))


def order_totals(item_rows: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """(order_id, subtotal, discount, total, item_count) summed from item rows.

    `rates` holds a discount rate per order; orders without one pay the full subtotal.
    """
    sums = item_rows.groupBy("order_id").agg(
        round_half_up(exact_sum(F.col("unit_price"))).alias("subtotal"), F.count(F.lit(1)).alias("item_count")
    )
    sums = sums.withColumn("discount_rate", F.lit(0.0)) if rates is None else sums.join(rates, "order_id", "left")
    discount = round_half_up(F.col("subtotal") * F.coalesce("discount_rate", F.lit(0.0)))
    return sums.withColumn("discount", discount).select(
        "order_id",
        "subtotal",
        "discount",
        round_half_up(F.col("subtotal") - F.col("discount")).alias("total"),
        "item_count",
    )


def is_suspicious(total: Column, method: Column, tier: Column) -> Column:
    return (total > 500) | (method == "crypto") | ((tier == "bronze") & (total > 200))


def build_orders(
    orders: DataFrame,
    payments: DataFrame,
    items: DataFrame,
    categories: DataFrame,
    tiers: DataFrame,
    created_at: Column,
    rates: DataFrame | None = None,
) -> DataFrame:
    """Order events from the source tables; an order without items gives none.

    Items are grouped once by order for both the array and the totals.
    """
    rows = items_with_category(items, categories)
    item = F.struct("product_id", "category", "quantity", "unit_price", "freight")
    per_order = rows.groupBy("order_id").agg(
        F.sort_array(F.collect_list(item)).alias("items"),
        round_half_up(exact_sum(F.col("unit_price"))).alias("subtotal"),
    )
    if rates is not None:
        per_order = per_order.join(rates, "order_id", "left")
    else:
        per_order = per_order.withColumn("discount_rate", F.lit(0.0))
    people = tiers.select(
        "customer_id",
        F.col("customer_city").alias("_city"),
        F.col("customer_state").alias("_state"),
        F.col("tier").alias("_tier"),
    )
    joined = with_payment(orders, payments).join(per_order, "order_id").join(people, "customer_id", "left")
    discount = round_half_up(F.col("subtotal") * F.coalesce("discount_rate", F.lit(0.0)))
    return (
        joined.withColumn("discount", discount)
        .withColumns(
            {
                "total": round_half_up(F.col("subtotal") - F.col("discount")),
                "customer_tier": F.coalesce("_tier", F.lit("bronze")),
                "payment_method": payment_method(F.col("payment_type")),
                "status": order_status(F.col("order_status")),
                "created_at": created_at,
            }
        )
        .select(
            F.lit("ORDER_PLACED").alias("event_type"),
            F.concat(F.lit("order-"), F.col("order_id").cast("string")).alias("event_id"),
            "order_id",
            "customer_id",
            "customer_tier",
            "items",
            "subtotal",
            "discount",
            "total",
            "payment_method",
            F.struct(
                F.coalesce("_city", F.lit("unknown")).alias("city"),
                F.coalesce("_state", F.lit("XX")).alias("state"),
                F.lit("BR").alias("country"),
            ).alias("shipping_address"),
            "status",
            "created_at",
            is_suspicious(F.col("total"), F.col("payment_method"), F.col("customer_tier")).alias("is_suspicious"),
        )
    )


def training_interactions(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Interactions for training: bought items per stable customer id, rating log1p(count).

    Only (product, price) leave the items scan; both joins are inner and the last grouping
    combines map-side, so a best-selling product is reduced before it is shuffled.
    """
    bought = orders.filter(F.col("order_status").isin(*TRAINING_STATUSES)).select("order_id", "customer_id")
    joined = (
        items.select("order_id", "product_id", "price")
        .join(bought, "order_id")
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
    )
    return (
        joined.groupBy(F.col("customer_unique_id").alias("customer_id"), "product_id")
        .agg(F.count("order_id").alias("purchase_count"), exact_sum(F.col("price")).alias("total_spend"))
        .withColumn("implicit_rating", F.log1p("purchase_count").cast("float"))
    )
