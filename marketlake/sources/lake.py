"""The three zones of the lake: raw NDJSON, processed Parquet by day, curated Parquet."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.session import working_path


@dataclass(frozen=True)
class Lake:
    """Paths below one root. Streamed clicks have a folder of their own."""

    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def processed(self, name: str) -> str:
        return f"{self.root}/processed/{name}"

    def curated(self, name: str) -> str:
        return f"{self.root}/curated/{name}"


#: Messages in one file of the raw zone, at most.
FILE_ROWS = 20_000

# Zone tables and the names under which SQL finds them.
VIEWS = {
    "processed_orders": ("processed", "orders"),
    "processed_clickstream": ("processed", "clickstream"),
    "curated_daily_kpis": ("curated", "daily_kpis"),
    "curated_customer_clv": ("curated", "customer_clv"),
    "curated_product_interactions": ("curated", "product_interactions"),
    "curated_state_revenue": ("curated", "state_revenue"),
}


def read_ndjson(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All NDJSON files below a folder, typed by the schema; nothing is inferred."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)


def write_ndjson(bodies: DataFrame, path: str, *by: str) -> None:
    """Messages, one a line, as gzip files; a compressed file is read by one task, so long ones are cut."""
    bodies.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS).partitionBy(*by).text(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_by_day(df: DataFrame, path: str, day: str) -> int:
    """Overwrite the days present in `df`, leaving other days alone; returns rows written.

    Rows are rebalanced by day: adaptive execution joins small days and cuts large ones by size, and
    nothing upstream runs twice for a sample. The row count is observed during the write.
    """
    spread = df.hint("rebalance", F.col(day))
    seen = Observation("written")
    (
        spread.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    return seen.get["rows"]


def write_table(df: DataFrame, path: str) -> int:
    """Overwrite an unpartitioned table; returns rows written, counted during the write."""
    seen = Observation("written")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def write_unless_empty(df: DataFrame, write: Callable[[DataFrame], int]) -> int:
    """Run `write`, or skip it and return 0 when there is no input row.

    `isEmpty` stops at the first row it finds.
    """
    return 0 if df.isEmpty() else write(df)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once below the shared folder and read it back.

    Used where several parts of a query need the same result: the lineage is cut, and a lost
    executor costs no recomputation.
    """
    path = working_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Register the zone tables that exist, and `order_items`, for SQL; returns the names.

    The items of `processed_orders` carry the freight under both `freight` and `freight_value`.
    """
    done = []
    for view, (zone, name) in VIEWS.items():
        path = getattr(lake, zone)(name)
        if not _exists(spark, path):
            continue
        df = spark.read.parquet(path)
        if view == "processed_orders":
            df = df.withColumn(
                "items", F.transform("items", lambda i: i.withField("freight_value", i["freight"]))
            )
            items = df.select("order_id", "customer_id", "status", "order_date", "total", "shipping_state", F.inline("items"))
            items.createOrReplaceTempView("order_items")
            done.append("order_items")
        df.createOrReplaceTempView(view)
        done.append(view)
    return done


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
