"""Display columns of recommendation lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.config import RecoRules
from marketlake.functions.lookups import SOURCE_LABELS, STRATEGY_LABELS, label_tiers, map_value
from marketlake.functions.text import short_id, title_label


def _rounded(x: Column) -> Column:
    return F.floor(x + 0.5).cast("string")


def with_label(rows: DataFrame, category: str = "category", price: str = "unit_price") -> DataFrame:
    """Adds product_label: the category's tier that holds the price, else its last tier.

    A category without tiers shows its own name in title form. The tier table has 15 rows
    and is broadcast.
    """
    tiers = F.broadcast(label_tiers(rows.sparkSession))
    key = F.translate(F.lower(F.coalesce(F.col(category), F.lit(""))), " ", "_")
    joined = rows.withColumn("label_key", key).join(tiers, "label_key", "left")
    amount = F.coalesce(F.col(price), F.lit(0.0))
    hit = F.filter("tiers", lambda t: (amount >= t["lo"]) & (amount < t["hi"]))
    tier = F.coalesce(F.try_element_at(hit, F.lit(1)), F.try_element_at("tiers", F.lit(-1)))
    plain = title_label(F.coalesce(F.when(F.col(category) != "", F.col(category)), F.lit("Product")))
    return joined.withColumn("product_label", F.coalesce(tier["label"], plain)).drop("label_key", "tiers")


def display_rows(rows: DataFrame, rules: RecoRules = RecoRules()) -> DataFrame:
    """Recommendation rows as a page would show them. A request has at most 20 rows."""
    request = Window.partitionBy("customer_id", "n", "asked_category")
    rows = rows.withColumn("_best", F.max("score").over(request))
    spend = F.col("avg_spend_per_item")
    band = F.concat(
        F.lit(" · avg spend R$"), _rounded(spend), F.lit("/item · band R$"),
        _rounded(spend * rules.strict[0]), F.lit("–R$"), _rounded(spend * rules.strict[1]),
    )
    personal = (F.col("strategy") == "als_personalised") & (F.col("_best") > 0) & F.col("score").isNotNull()
    percent = F.greatest(F.lit(1), F.floor(F.col("score") / F.col("_best") * 99.0 + 0.5).cast("int"))
    stock = F.col("stock_level")
    return with_label(rows).select(
        "customer_id",
        "rank",
        "product_label",
        F.translate(F.coalesce("category", F.lit("unknown")), "_", " ").alias("category_text"),
        F.concat(short_id(F.col("product_id")), F.lit("…")).alias("short_id"),
        F.when(personal, percent).alias("match_pct"),
        F.coalesce(F.concat(F.lit("R$ "), F.col("unit_price").cast("decimal(18,2)").cast("string")), F.lit("—")).alias("price_text"),
        F.when(stock > 0, F.concat(F.lit("✓ "), stock.cast("string"), F.lit(" in stock")))
        .when(stock == 0, "Low stock")
        .otherwise("")
        .alias("stock_text"),
        map_value(F.col("source"), SOURCE_LABELS, F.coalesce("source", F.lit("live"))).alias("source_text"),
        map_value(F.col("strategy"), STRATEGY_LABELS, F.coalesce("strategy", F.lit("Live"))).alias("strategy_text"),
        F.coalesce(band, F.lit("")).alias("band_text"),
    )
