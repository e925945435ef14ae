"""The whole lake job: raw zone to processed zone to curated zone."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.functions.timefn import parse_ts
from marketlake.operators import clean, curated
from marketlake.operators.training import collecting
from marketlake.sources import lake as zones


def run(spark: SparkSession, lake: zones.Lake) -> dict[str, int]:
    """Builds every table of the lake and returns the rows written to each.

    Each cleaned frame is written once and read back for what follows; row counts come from the
    writes themselves. Failures are raised. An empty raw folder skips what depends on it. The driver collects garbage
    meanwhile, so that the shuffles of a table that is written do not lie beside those of the next.
    """
    with collecting(spark):
        return _run(spark, lake)


def _run(spark: SparkSession, lake: zones.Lake) -> dict[str, int]:
    rows: dict[str, int] = {}
    clicks = zones.read_ndjson(spark, lake.raw("clickstream"), schemas.CLICK_EVENT)
    rows["clickstream"] = zones.write_unless_empty(
        clicks,
        lambda df: zones.write_by_day(clean.clean_clicks(df), lake.processed("clickstream"), "event_date"),
    )
    orders = zones.read_ndjson(spark, lake.raw("orders"), schemas.RAW_ORDER)
    rows["orders"] = zones.write_unless_empty(
        orders, lambda df: zones.write_by_day(clean.clean_orders(df), lake.processed("orders"), "order_date")
    )
    if rows["orders"]:
        rows.update(curate(spark, lake))
    return rows


def curate(spark: SparkSession, lake: zones.Lake) -> dict[str, int]:
    """The curated tables from processed orders; each scan reads only the columns it needs."""
    orders = zones.read_parquet(spark, lake.processed("orders"))
    parsed = orders.withColumn("created_at", parse_ts(F.col("created_at")))
    tables = {
        "daily_kpis": curated.daily_kpis(orders),
        "customer_clv": curated.customer_clv(parsed),
        "product_interactions": curated.product_interactions(clean.explode_items(orders)),
        "state_revenue": curated.state_revenue(orders),
    }
    return {name: zones.write_table(df, lake.curated(name)) for name, df in tables.items()}
