"""The star-schema Parquet tables seen through the commerce model.

Every view reads its whole table; Catalyst prunes columns and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.config import TierRules
from marketlake.functions.lookups import ORDER_STATUSES, PAYMENT_METHODS, map_value
from marketlake.functions.numeric import round_half_up
from marketlake.operators.builder import is_suspicious, median_prices, order_counts, tier_of
from marketlake.operators.fraud import score_orders

# How the star schema's codes stand for the model's source values.
SOURCE_STATUSES = {"F": "delivered", "O": "processing", "P": "canceled"}
SOURCE_PAYMENTS = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "voucher",
    "4-NOT SPECIFIED": "crypto",
    "5-LOW": "debit_card",
}
CATEGORY_NAMES = {
    "ECONOMY": "housewares",
    "LARGE": "furniture_decor",
    "MEDIUM": "computers_accessories",
    "PROMO": "toys",
    "STANDARD": "health_beauty",
}
# Customers here order about ten times each, so the tiers are cut higher.
TABLE_TIERS = TierRules(platinum=15, gold=10, silver=5)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _created_at() -> Column:
    return F.timestamp_add("SECOND", F.col("o_orderkey") * 7919 % 86400, F.col("o_orderdate"))


def source_orders(spark: SparkSession, folder: str) -> DataFrame:
    """(order_id, customer_id, order_status) as the source system writes them."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        map_value(F.col("o_orderstatus"), SOURCE_STATUSES, F.col("o_orderstatus")).alias("order_status"),
    )


def source_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Two payments per order; the second, a voucher, is not the primary one."""
    orders = table(spark, folder, "orders")
    kind = map_value(F.col("o_orderpriority"), SOURCE_PAYMENTS, F.col("o_orderpriority"))
    parts = F.array(
        F.struct(F.lit(1).alias("payment_sequential"), kind.alias("payment_type")),
        F.struct(F.lit(2).alias("payment_sequential"), F.lit("voucher").alias("payment_type")),
    )
    return orders.select(
        F.col("o_orderkey").alias("order_id"), F.explode(parts).alias("p"), F.col("o_totalprice").alias("payment_value")
    ).select("order_id", "p.payment_sequential", "p.payment_type", "payment_value")


def source_items(spark: SparkSession, folder: str) -> DataFrame:
    """(order_id, product_id, price, freight_value): prices to the cent."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        round_half_up(F.col("l_extendedprice") / F.col("l_quantity") / 100.0).alias("price"),
        round_half_up(F.col("l_extendedprice") * F.col("l_tax") / 100.0).alias("freight_value"),
    )


def source_customers(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("person-"), F.col("c_custkey").cast("string")).alias("customer_unique_id"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("c_nationkey").alias("n_nationkey"),
    )
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("customer_state"))
    return customers.join(nations, "n_nationkey", "left").drop("n_nationkey")


def source_products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name")
    )


def translations(spark: SparkSession) -> DataFrame:
    """Category translation: a constant of five rows, with one category left out."""
    return spark.createDataFrame(
        list(CATEGORY_NAMES.items()), "product_category_name string, product_category_name_english string"
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """(product_id, category) with translated names."""
    raw = source_products(spark, folder)
    name = F.col("product_category_name")
    return raw.select("product_id", F.coalesce(map_value(name, CATEGORY_NAMES, name), F.lit("other")).alias("category"))


def priced_products(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue rows with median price; stock is the part size."""
    stock = table(spark, folder, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_size").alias("stock_level"))
    prices = median_prices(source_items(spark, folder))
    return (
        products(spark, folder)
        .join(stock, "product_id")
        .join(prices, "product_id", "left")
        .select("product_id", "category", round_half_up(F.coalesce("unit_price", F.lit(50.0))).alias("unit_price"), "stock_level")
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with status, total, times and payment method; 'crypto' stays unmapped."""
    statuses = {code: ORDER_STATUSES[status] for code, status in SOURCE_STATUSES.items()}
    methods = {code: PAYMENT_METHODS.get(kind, kind) for code, kind in SOURCE_PAYMENTS.items()}
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        map_value(F.col("o_orderstatus"), statuses, F.lit("confirmed")).alias("status"),
        round_half_up(F.col("o_totalprice") / 800.0).alias("total"),
        map_value(F.col("o_orderpriority"), methods, F.lit("credit_card")).alias("payment_method"),
        _created_at().alias("created_at"),
        F.to_date("o_orderdate").alias("order_date"),
    )


def with_state(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Adds shipping_state: the nation's name, none for nation 0."""
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"), "c_nationkey")
    nations = table(spark, folder, "nation").filter(F.col("n_nationkey") != 0)
    states = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return df.join(states.select("customer_id", F.col("n_name").alias("shipping_state")), "customer_id", "left")


#: Copies of a small row that is joined to a key that may be hot.
SALTS = 8


def with_tier(df: DataFrame, spark: SparkSession, folder: str, rules: TierRules = TABLE_TIERS) -> DataFrame:
    counts = order_counts(source_orders(spark, folder))
    tiers = counts.select("customer_id", tier_of(F.col("order_count"), rules).alias("customer_tier"))
    # salted: the tiers are a sum by the join key, so without it a hot customer's orders would meet in one task
    salt = F.pmod(F.xxhash64("order_id"), F.lit(SALTS)).alias("_salt")
    tiers = tiers.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return df.withColumn("_salt", salt).join(tiers, ["customer_id", "_salt"], "left").drop("_salt")


def with_item_count(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    counts = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("order_id"))
    return df.join(counts.agg(F.count(F.lit(1)).alias("item_count")), "order_id", "left").withColumn(
        "item_count", F.coalesce("item_count", F.lit(0))
    )


def scored_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with tier, item count, suspicion flag and fraud score."""
    full = with_item_count(with_tier(orders(spark, folder), spark, folder), spark, folder)
    flag = is_suspicious(F.col("total"), F.col("payment_method"), F.col("customer_tier"))
    return score_orders(full.withColumn("is_suspicious", flag))


def delivered_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Raw orders as text fields with a nested address, each delivered twice, a second apart."""
    scored = with_state(scored_orders(spark, folder), spark, folder)
    second = F.timestamp_add("SECOND", F.col("copy"), F.col("created_at"))
    return scored.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        "order_id",
        "customer_id",
        "status",
        F.col("total").cast("string").alias("total"),
        F.col("fraud_score").cast("string").alias("fraud_score"),
        F.date_format(second, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.struct(F.col("payment_method").alias("city"), F.col("shipping_state").alias("state")).alias("shipping_address"),
    )


def item_rows(spark: SparkSession, folder: str, categories: bool = True) -> DataFrame:
    """(order_id, product_id, category, quantity, unit_price, freight_value).

    A left join is not removed when its columns go unused, so `categories` says if they are wanted.
    """
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        round_half_up(F.col("l_extendedprice") / F.col("l_quantity") / 100.0).alias("unit_price"),
        round_half_up(F.col("l_extendedprice") * F.col("l_tax") / 100.0).alias("freight_value"),
    )
    if not categories:
        return lines
    return lines.join(products(spark, folder), "product_id", "left").withColumn(
        "category", F.coalesce("category", F.lit("other"))
    )


def nested_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their items array, as the processed zone stores them."""
    item = F.struct("product_id", "category", "quantity", "unit_price", F.col("freight_value").alias("freight"))
    items = item_rows(spark, folder).groupBy("order_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return orders(spark, folder).join(items, "order_id", "left")


def order_items(spark: SparkSession, folder: str, state: bool = False, categories: bool = True) -> DataFrame:
    """Item rows with their order's customer, status, date and total (and state)."""
    heads = orders(spark, folder).select("order_id", "customer_id", "status", "order_date", "total")
    if state:
        heads = with_state(heads, spark, folder)
    return item_rows(spark, folder, categories).join(heads, "order_id")


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    """Click events; three users in ten are not logged in."""
    user = F.col("user_id")
    return table(spark, folder, "events").select(
        F.col("event_id"),
        user.alias("session_id"),
        F.when(user % 10 >= 3, user.cast("string")).alias("customer_id"),
        F.col("event_type").alias("action"),
        F.floor(F.col("value") * 1000.0 + 0.5).alias("duration_ms"),
        F.col("ts").alias("timestamp"),
    )


def delivered_clicks(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks delivered twice, the second copy one second later."""
    again = F.array(F.lit(0), F.lit(1))
    return (
        clicks(spark, folder)
        .withColumn("copy", F.explode(again))
        .withColumn("timestamp", F.timestamp_add("SECOND", F.col("copy"), F.col("timestamp")))
        .drop("copy")
    )


def event_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Events as orders (customer_id, created_at, total), for the velocity windows."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("created_at"),
        F.col("value").alias("total"),
    )


def stock_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as stock updates: the product is the user, the stock comes from the JSON props."""
    stock = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("product_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("category"),
        stock.alias("current_stock"),
        (stock - F.lit(50)).alias("delta"),
        F.concat(F.lit("wh-"), (F.col("event_id") % 7).cast("string")).alias("warehouse_id"),
        F.col("ts").alias("timestamp"),
    )


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(F.col("event_type").alias("metric"), "ts", "value")


def user_factors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("customer_id"), F.col("embedding").alias("factors"))


def item_factors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("product_id"), F.col("embedding").alias("factors"))


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """One recommendation request per customer; some without n, some with a category."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("customer_id"),
        F.when(key % 26 != 0, (key % 26).cast("int")).alias("n"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(" Toys "))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit("computers ACC"))
        .when(F.col("c_mktsegment") == "BUILDING", F.lit("no such thing"))
        .alias("category"),
    )
