"""Registered queries that write files or run a stream over the given tables and read the outcome."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.config import AlarmRule, VelocityRules
from marketlake.functions.numeric import round_half_up
from marketlake.operators import builder, curated, training
from marketlake.operators.training import collecting
from marketlake.plans import batch_job
from marketlake.session import working_path
from marketlake.sources import lake as zones
from marketlake.sources import messages
from marketlake.sources import tables as t
from marketlake.sources.csv_tables import read_csv_tables
from marketlake.streaming import clicks as click_jobs
from marketlake.streaming import orders as order_jobs
from marketlake.streaming import sinks
from marketlake.streaming.alarms import AlarmJob
from marketlake.streaming.inventory import StockJob
from marketlake.streaming.velocity_state import StateDecisionJob

PIECES = 5
#: Messages in a file of a stream's input, about; a compressed file is read by one task.
FILE_MESSAGES = 200_000


def _iso(ts: str):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _shuffled_text(bodies: DataFrame, name: str, messages: int, copies: int = 1) -> tuple[str, int]:
    """Message bodies in several gzip files, in an order that has nothing to do with their times; the files in a piece.

    Copies of a message are made behind the shuffle. There are `PIECES` files for few messages, and as many times more
    as keep them small.
    """
    path = working_path(bodies.sparkSession, name)
    times = max(1, -(-messages * copies // (PIECES * FILE_MESSAGES)))
    dealt = bodies.repartition(PIECES * times, F.xxhash64("body"))
    dealt = dealt.select(F.explode(F.array_repeat("body", copies)).alias("body")) if copies > 1 else dealt
    dealt.write.option("compression", "gzip").text(path)
    return path, times


def _written_text(bodies: DataFrame, name: str) -> str:
    """Message bodies as text files, as a queue consumer would find them."""
    path = working_path(bodies.sparkSession, name)
    bodies.write.text(path)
    return path


def order_bodies(spark: SparkSession, d: str, copies: int = 1) -> DataFrame:
    """Order events as JSON text: items, tier, address and suspicion flag from the tables."""
    item = F.struct(
        F.col("product_id").cast("string").alias("product_id"), "category", "quantity", "unit_price",
        F.col("freight_value").alias("freight"),
    )
    items = t.item_rows(spark, d).groupBy("order_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    scored = t.with_state(t.scored_orders(spark, d), spark, d).join(items, "order_id", "left")
    event = F.struct(
        F.lit("ORDER_PLACED").alias("event_type"),
        F.col("order_id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        "customer_tier",
        "items",
        "total",
        "payment_method",
        F.struct(F.lit("city").alias("city"), F.col("shipping_state").alias("state"), F.lit("BR").alias("country")).alias("shipping_address"),
        "status",
        _iso("created_at").alias("created_at"),
        "is_suspicious",
        "fraud_score",
    )
    return scored.select(F.explode(F.array_repeat(F.to_json(event), copies)).alias("body"))


def click_bodies(spark: SparkSession, d: str) -> DataFrame:
    event = F.struct(
        F.lit("PAGE_VIEW").alias("event_type"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("session_id").cast("string").alias("session_id"),
        "customer_id",
        "action",
        _iso("timestamp").alias("timestamp"),
        F.col("duration_ms").cast("int").alias("duration_ms"),
    )
    return t.clicks(spark, d).select(F.to_json(event).alias("body"))


def _stock_bodies(spark: SparkSession, d: str) -> DataFrame:
    event = F.struct(
        F.lit("INVENTORY_UPDATE").alias("event_type"),
        F.format_string("%012d", "event_id").alias("event_id"),
        F.col("product_id").cast("string").alias("product_id"),
        "category",
        "current_stock",
        "delta",
        "warehouse_id",
        _iso("timestamp").alias("timestamp"),
    )
    return t.stock_events(spark, d).select(F.to_json(event).alias("body"))


# ---- files --------------------------------------------------------------------------------------


def ndjson_scan(spark: SparkSession, d: str) -> DataFrame:
    """Raw orders as NDJSON, scanned with the raw schema."""
    path = _written_text(order_bodies(spark, d), "raw-orders")
    raw = zones.read_ndjson(spark, path, schemas.RAW_ORDER)
    return raw.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        "status",
        F.col("total").cast("double").alias("total"),
        F.col("shipping_address.state").alias("state"),
        F.coalesce(F.size("items"), F.lit(0)).alias("n_items"),
    )


def click_scan(spark: SparkSession, d: str) -> DataFrame:
    """Raw clicks as NDJSON in nested folders, scanned recursively."""
    root = working_path(spark, "raw-clicks")
    bodies = click_bodies(spark, d)
    bodies.write.text(f"{root}/2024/all")
    zones.read_ndjson(spark, root, schemas.CLICK_EVENT).createOrReplaceTempView("raw_clicks")
    return spark.sql("SELECT CAST(event_id AS BIGINT) AS event_id, action, duration_ms, customer_id FROM raw_clicks")


def csv_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue built from CSV files with a header."""
    root = working_path(spark, "csv")
    sources = {
        "orders": t.source_orders(spark, d),
        "order_items": t.source_items(spark, d),
        "payments": t.source_payments(spark, d),
        "customers": t.source_customers(spark, d),
        "products": t.source_products(spark, d),
        "sellers": t.table(spark, d, "supplier").select(F.col("s_suppkey").alias("seller_id")),
        "translations": t.translations(spark),
    }
    for name, df in sources.items():
        df.write.option("header", True).csv(f"{root}/{name}")
    csv = read_csv_tables(spark, root, "{table}")
    out = builder.catalogue(csv["products"], csv["translations"], csv["order_items"])
    return out.withColumn("product_id", F.col("product_id").cast("bigint"))


def stored_interactions(spark: SparkSession, d: str) -> DataFrame:
    """The interaction table written to the curated zone and scanned again."""
    lake = zones.Lake(working_path(spark, "lake"))
    path = lake.curated("product_interactions")
    interactions = curated.product_interactions(t.order_items(spark, d, categories=False))
    zones.write_unless_empty(interactions, lambda df: zones.write_table(df, path))
    back = zones.read_parquet(spark, path)
    return back.withColumn("implicit_rating", round_half_up(F.col("implicit_rating"), 6))


def partitioned_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """Clicks written by day, one day written again; the other days must stay."""
    path = working_path(spark, "clicks-by-day")
    dated = t.clicks(spark, d).withColumn("event_date", F.to_date("timestamp"))
    zones.write_by_day(dated, path, "event_date")
    first = dated.agg(F.min("event_date")).scalar()
    zones.write_by_day(dated.filter(F.col("event_date") == first), path, "event_date")
    return spark.read.parquet(path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_ids")
    )


_BUILT: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, d: str, name: str, build: Callable[[SparkSession, str], object]):
    """Build a lake or run a stream once per session and folder, for all queries that read its tables."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _BUILT:
        _BUILT[key] = build(spark, d)
    return _BUILT[key]


def _built_lake(spark: SparkSession, d: str) -> zones.Lake:
    return once(spark, d, "lake", _build_lake)


def _build_lake(spark: SparkSession, d: str) -> zones.Lake:
    lake = zones.Lake(working_path(spark, "lake"))
    zones.write_ndjson(order_bodies(spark, d, copies=2), lake.raw("orders"))
    zones.write_ndjson(click_bodies(spark, d), lake.raw("clickstream"))
    batch_job.run(spark, lake)
    return lake


def lake_kpis(spark: SparkSession, d: str) -> DataFrame:
    """The whole lake job from raw NDJSON (orders delivered twice) to the curated KPIs."""
    return zones.read_parquet(spark, _built_lake(spark, d).curated("daily_kpis"))


def sql_over_views(spark: SparkSession, d: str) -> DataFrame:
    """Plain SQL over the registered zone tables, with an unnested items column."""
    zones.register_views(spark, _built_lake(spark, d))
    return spark.sql(
        """
        SELECT item.category AS category, count(DISTINCT o.order_id) AS total_orders, sum(item.quantity) AS units_sold,
               max(item.freight_value) AS max_freight
        FROM processed_orders o LATERAL VIEW explode(o.items) x AS item
        WHERE o.status = 'confirmed'
        GROUP BY item.category
        """
    )


def stored_catalogue(spark: SparkSession, d: str) -> DataFrame:
    return zones.stored(t.priced_products(spark, d), "catalogue")


def factor_tables(spark: SparkSession, d: str) -> DataFrame:
    """Factor tables saved and loaded again."""
    path = working_path(spark, "factors")
    training.save_factors(training.Factors(t.user_factors(spark, d), t.item_factors(spark, d)), path)
    loaded = training.load_factors(spark, path)
    return loaded.users.select(
        F.col("customer_id"), F.size("factors").alias("length"), round_half_up(F.col("factors")[0].cast("double"), 6).alias("first")
    )


def envelope_alerts(spark: SparkSession, d: str) -> DataFrame:
    """Alerts in envelopes (error events) and bare (others), with events of value below 1 unreadable."""
    alert = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("order_id"),
            F.col("user_id").cast("string").alias("customer_id"),
            F.col("value").alias("total"),
        )
    )
    text = F.when(F.col("value") < 1.0, F.concat(F.lit("{broken "), alert)).when(
        F.col("event_type") == "error", F.to_json(F.struct(alert.alias("Message")))
    ).otherwise(alert)
    parsed = messages.parse_alerts(t.table(spark, d, "events").select("event_id", text.alias("body")))
    return parsed.select(
        "event_id", F.col("event.customer_id").alias("customer_id"), F.col("event.total").alias("total"), "problem"
    )


def quarantined_messages(spark: SparkSession, d: str) -> DataFrame:
    """Messages with a broken text, a wrong type or a missing field, by event."""
    user = F.col("user_id").cast("string")
    good = F.to_json(F.struct(user.alias("product_id"), F.get_json_object("props", "$.k").cast("int").alias("current_stock")))
    body = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("no json "), good))
        .when(F.col("event_type") == "signup", F.to_json(F.struct(user.alias("product_id"), F.lit("many").alias("current_stock"))))
        .when(F.col("event_type") == "view", F.to_json(F.struct(F.col("value").alias("other"))))
        .when(F.col("value") >= 1.0, good)
    )
    parsed = messages.parse(
        t.table(spark, d, "events").select("event_id", body.alias("body")),
        schemas.INVENTORY_EVENT,
        ["product_id", "current_stock"],
    )
    return messages.bad(parsed).select("event_id", "problem")


# ---- streams ------------------------------------------------------------------------------------


def _order_job(spark: SparkSession, d: str) -> order_jobs.OrderJob:
    return once(spark, d, "orders", _run_orders)


def _run_orders(spark: SparkSession, d: str) -> order_jobs.OrderJob:
    """Orders, each delivered twice, in several files and batches out of time order, run through the order stream."""
    path, times = _shuffled_text(order_bodies(spark, d), "order-messages", t.table(spark, d, "orders").count(), copies=2)
    job = order_jobs.OrderJob(spark, working_path(spark, "order-job"), VelocityRules(max_spend=1000.0), log_by="month", every=2)
    with collecting(spark):
        sinks.run_now(job.start(messages.message_stream(spark, path, files_per_batch=2 * times)))
    return job


def order_stream(spark: SparkSession, d: str) -> DataFrame:
    return _order_job(spark, d).orders().select(
        F.col("order_id").cast("bigint").alias("order_id"),
        round_half_up(F.col("fraud_score"), 4).alias("fraud_score"),
        F.array_join("fraud_flags", ",").alias("fraud_flags"),
        "is_fraud",
    )


def decision_stream(spark: SparkSession, d: str) -> DataFrame:
    return _order_job(spark, d).decisions().select(
        F.col("order_id").cast("bigint").alias("order_id"),
        "orders_in_window",
        "spend_in_window",
        "fraud_decision",
        "combined_fraud_score",
        F.array_join("all_fraud_flags", ",").alias("all_fraud_flags"),
    )


def state_decisions(spark: SparkSession, d: str) -> DataFrame:
    """The decisions of the order stream by keyed state: each order delivered twice, in several files out of time order."""
    path, times = _shuffled_text(order_bodies(spark, d), "order-messages", t.table(spark, d, "orders").count(), copies=2)
    job = StateDecisionJob(spark, working_path(spark, "state-job"), VelocityRules(max_spend=1000.0))
    job.start(messages.message_stream(spark, path, files_per_batch=2 * times)).awaitTermination()
    return job.decisions().select(
        F.col("order_id").cast("bigint").alias("order_id"),
        "orders_in_window",
        "spend_in_window",
        "fraud_decision",
        "combined_fraud_score",
        F.array_join("all_fraud_flags", ",").alias("all_fraud_flags"),
    )


def order_event_stream(spark: SparkSession, d: str) -> DataFrame:
    return _order_job(spark, d).events().groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("order_id").alias("n_orders")
    )


def enriched_click_stream(spark: SparkSession, d: str) -> DataFrame:
    path = _written_text(click_bodies(spark, d), "click-messages")
    out = working_path(spark, "enriched")
    stream = click_jobs.click_stream(messages.message_stream(spark, path))
    click_jobs.start_enriched(stream, f"{out}/clicks", f"{out}/checkpoint").awaitTermination()
    schema = "event_id string, hour_of_day int, day_of_week string, is_weekend boolean, is_authenticated boolean"
    back = spark.read.schema(schema).option("basePath", f"{out}/clicks").json(f"{out}/clicks")
    return back.select(
        F.col("event_id").cast("bigint").alias("event_id"), "hour_of_day", "day_of_week", "is_weekend", "is_authenticated"
    )


def unique_click_stream(spark: SparkSession, d: str) -> DataFrame:
    """Clicks delivered twice, deduplicated on the stream."""
    path, times = _shuffled_text(click_bodies(spark, d), "click-messages", t.table(spark, d, "events").count(), copies=2)
    out = working_path(spark, "unique")
    stream = click_jobs.unique_clicks(click_jobs.click_stream(messages.message_stream(spark, path, files_per_batch=2 * times)))
    sinks.start_files(stream, f"{out}/clicks", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/clicks").select(
        F.col("event_id").cast("bigint").alias("event_id"), "action", "duration_ms"
    )


def session_stream(spark: SparkSession, d: str) -> DataFrame:
    """All sessions after the last of several batches out of time order."""
    path, times = _shuffled_text(click_bodies(spark, d), "click-messages", t.table(spark, d, "events").count())
    job = click_jobs.ClickJob(spark, working_path(spark, "click-job"), every=1)
    sinks.run_now(job.start(messages.message_stream(spark, path, files_per_batch=2 * times)))
    return job.sessions().select(
        F.col("session_id").cast("bigint").alias("session_id"),
        F.col("first_seen").cast("timestamp_ntz").alias("first_seen"),
        F.col("last_seen").cast("timestamp_ntz").alias("last_seen"),
        "event_count",
        "expires_at",
        "customer_id",
    )


def _stock_job(spark: SparkSession, d: str) -> StockJob:
    return once(spark, d, "stock", _run_stock)


def _run_stock(spark: SparkSession, d: str) -> StockJob:
    path, times = _shuffled_text(_stock_bodies(spark, d), "stock-messages", t.table(spark, d, "events").count())
    job = StockJob(spark, working_path(spark, "stock-job"), every=1)
    sinks.run_now(job.start(messages.message_stream(spark, path, files_per_batch=2 * times)))
    return job


def stock_level_stream(spark: SparkSession, d: str) -> DataFrame:
    return _stock_job(spark, d).stock().select(
        F.col("product_id").cast("bigint").alias("product_id"),
        "category",
        "stock_level",
        F.to_timestamp("last_updated").cast("timestamp_ntz").alias("last_updated"),
        "warehouse_id",
    )


def stock_alert_stream(spark: SparkSession, d: str) -> DataFrame:
    return _stock_job(spark, d).alerts().select(
        F.col("product_id").cast("bigint").alias("product_id"),
        "category",
        "current_stock",
        "delta",
        "severity",
        "warehouse_id",
        F.to_timestamp("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "subject",
    )


def alarm_stream(spark: SparkSession, d: str) -> DataFrame:
    """Alarms over all windows after the last batch."""
    source = spark.readStream.schema("event_type string, ts timestamp_ntz, value double").option(
        "pathGlobFilter", "events.parquet"
    ).parquet(d)
    metrics = source.select(F.col("event_type").alias("metric"), "ts", "value")
    job = AlarmJob(spark, working_path(spark, "alarms"), AlarmRule("backlog", 3600, "max", "gt", 20.0, 3))
    job.start(metrics).awaitTermination()
    return job.alarms().select("alarm", "metric", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "stat")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "s1_click_scan": click_scan,
    "s2_ndjson_scan": ndjson_scan,
    "s4_stored_interactions": stored_interactions,
    "s5_csv_catalogue": csv_catalogue,
    "s7_envelope_alerts": envelope_alerts,
    "s8_partitioned_overwrite": partitioned_overwrite,
    "s9_lake_kpis": lake_kpis,
    "s11_sql_over_views": sql_over_views,
    "s14_stored_catalogue": stored_catalogue,
    "s15_quarantined_messages": quarantined_messages,
    "r3_factor_tables": factor_tables,
    "t2_order_stream": order_stream,
    "t4_order_event_stream": order_event_stream,
    "t5_decision_stream": decision_stream,
    "t5_state_decisions": state_decisions,
    "t6_enriched_click_stream": enriched_click_stream,
    "t7_session_stream": session_stream,
    "t9_stock_level_stream": stock_level_stream,
    "t9_stock_alert_stream": stock_alert_stream,
    "t10_alarm_stream": alarm_stream,
    "t12_unique_click_stream": unique_click_stream,
}
