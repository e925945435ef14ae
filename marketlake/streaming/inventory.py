"""Stock stream: low-stock alerts and the current stock of every product."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake import schemas
from marketlake.config import StockRules
from marketlake.operators import inventory
from marketlake.sources import messages
from marketlake.streaming import sinks
from marketlake.streaming.snapshots import Snapshot, bucket_of

REQUIRED = ("product_id", "current_stock")


def parsed(bodies: DataFrame) -> DataFrame:
    return messages.parse(bodies, schemas.INVENTORY_EVENT, REQUIRED, time="timestamp")


def stock_stream(bodies: DataFrame) -> DataFrame:
    return messages.good(parsed(bodies))


def quarantine_stream(bodies: DataFrame) -> DataFrame:
    return messages.bad(parsed(bodies))


class StockJob:
    """Writes alerts, the stock state, and a quarantine of bad records below one folder.

    A batch adds one row per product; batches are folded into versions by product bucket, and a fold rewrites
    only the buckets its batches touch.
    """

    def __init__(
        self, spark: SparkSession, root: str, rules: StockRules = StockRules(), buckets: int = 16, every: int = 16
    ):
        self.spark = spark
        self.root = root
        self.rules = rules
        self.bucket = bucket_of("product_id", buckets)
        empty = spark.createDataFrame([], schemas.INVENTORY_EVENT)
        schema = self._placed(inventory.stock_changes(empty)).schema
        self.changes = Snapshot(
            spark, self.path("changes"), schema, "bucket", lambda rows: self._placed(inventory.fold_changes(rows)), every
        )

    def _placed(self, changes: DataFrame) -> DataFrame:
        return changes.withColumn("bucket", self.bucket)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def on_batch(self, events: DataFrame, batch_id: int) -> None:
        self.changes.add(self._placed(inventory.stock_changes(events)), batch_id)

    def start(self, bodies: DataFrame, available_now: bool = True) -> list[StreamingQuery]:
        events = stock_stream(bodies)
        alerts = inventory.stock_alerts(events, self.rules)
        return [
            sinks.start_files(alerts, self.path("alerts"), self.path("checkpoints/alerts"), available_now=available_now),
            sinks.start(events, self.on_batch, self.path("checkpoints/changes"), available_now),
            sinks.start_files(
                quarantine_stream(bodies), self.path("quarantine"), self.path("checkpoints/quarantine"), available_now=available_now
            ),
        ]

    def alerts(self) -> DataFrame:
        return self.spark.read.parquet(self.path("alerts"))

    def quarantine(self) -> DataFrame:
        return self.spark.read.parquet(self.path("quarantine"))

    def stock(self) -> DataFrame:
        """Current stock per product over all batches: the newest version and the batches after it."""
        return inventory.stock_view(self.changes.read())
