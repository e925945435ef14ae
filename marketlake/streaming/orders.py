"""Order stream: score, store, alert, publish, and decide on flagged orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake import schemas
from marketlake.config import LATE_DATA, RETENTION_DAYS, FraudRules, VelocityRules
from marketlake.functions.timefn import parse_ts
from marketlake.operators import fraud
from marketlake.operators.upsert import latest
from marketlake.sources import messages
from marketlake.streaming import sinks
from marketlake.streaming.snapshots import Snapshot, bucket_of

RETENTION = dt.timedelta(days=RETENTION_DAYS)
REQUIRED = ("order_id", "customer_id", "customer_tier", "total", "status", "payment_method", "created_at")

_EVENT = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.ORDER_EVENT.fields)
LOG_SCHEMA = (
    f"{_EVENT}, ts timestamp, fraud_score double, fraud_flags array<string>, is_fraud boolean, "
    "processed_at timestamp, log_day date, batch_id int"
)
DECISION_SCHEMA = (
    "order_id string, customer_id string, orders_in_window bigint, spend_in_window double, "
    "fraud_decision string, combined_fraud_score double, all_fraud_flags array<string>, "
    "fraud_reviewed_at timestamp, batch_id int, bucket int"
)
ALERT_SCHEMA = (
    "order_id string, customer_id string, total double, fraud_score double, fraud_flags array<string>, "
    "timestamp timestamp, batch_id int"
)
PEOPLE_SCHEMA = "customer_id string, first timestamp, last timestamp"
EVENT_SCHEMA = "order_id string, customer_id string, total double, timestamp timestamp, status string, batch_id int"


def parsed(bodies: DataFrame) -> DataFrame:
    return messages.parse(bodies, schemas.ORDER_EVENT, REQUIRED, time="created_at")


def scored_stream(bodies: DataFrame, rules: FraudRules = FraudRules(), late: str = LATE_DATA) -> DataFrame:
    """Good, deduplicated, scored orders. Copies of an order that arrive within the late-data limit are dropped."""
    timed = messages.good(parsed(bodies)).withColumn("ts", parse_ts(F.col("created_at")).cast("timestamp"))
    return fraud.score_orders(sinks.arrived_once(timed, ["order_id"], late), rules)


def quarantine_stream(bodies: DataFrame) -> DataFrame:
    """Records that cannot be processed, including those whose time cannot be read."""
    return messages.bad(parsed(bodies))


def last_decisions(rows: DataFrame) -> DataFrame:
    return latest(rows, ["order_id"], "batch_id")


class OrderJob:
    """Writes order log, alerts, order events and decisions below one folder.

    One micro-batch: the scored orders are written to the log; alerts and events are read back
    from there; flagged orders are checked against the log, which already holds them. An order that
    arrives after later ones of its customer may change their decisions: flagged orders whose windows
    it falls into are decided again, so the decisions do not depend on how the input is cut in batches.
    Only the time parts of the log that the windows can reach are listed and read.

    The log's batches are folded into versions by time part, the decisions' by bucket of the order_id (the last
    decision on each order stays). `expire` deletes what was processed too long ago.
    """

    def __init__(
        self, spark: SparkSession, root: str, velocity: VelocityRules = VelocityRules(), log_by: str = "day",
        buckets: int = 16, every: int = 16,
    ):
        """`log_by` is the width of the log's time partitions: 'day', or 'month' for sparse data."""
        self.spark = spark
        self.root = root
        self.velocity = velocity
        self.log_by = log_by
        self.reach = dt.timedelta(seconds=max(velocity.order_window_s, velocity.spend_window_s))
        self.buckets = buckets
        self.log = Snapshot(spark, self.path("order_log"), LOG_SCHEMA, sinks.DAY, every=every)
        self.decided = Snapshot(spark, self.path("fraud_decisions"), DECISION_SCHEMA, "bucket", last_decisions, every)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def near(self, days: list[dt.date]) -> set[dt.date]:
        """The log's parts within the windows' reach of these parts."""
        reach = -(-self.reach // dt.timedelta(days=1))
        width = 31 if self.log_by == "month" else 1
        around = {d + dt.timedelta(days=k) for d in days for k in range(-reach, width + reach)}
        return {d.replace(day=1) if self.log_by == "month" else d for d in around}

    def on_batch(self, scored: DataFrame, batch_id: int) -> None:
        day = F.to_date(F.date_trunc(self.log_by, F.col("ts")))
        stamped = scored.withColumns({"processed_at": F.current_timestamp(), sinks.DAY: day, sinks.LOG: F.lit(batch_id)})
        self.log.add(stamped, batch_id)
        days = [dt.date.fromisoformat(part) for part in self.log.batch_parts(batch_id)]
        mine = self.log.batch(batch_id)
        alerts = fraud.fraud_alerts(mine, F.col("processed_at"))
        sinks.write_batch(alerts, self.path("fraud_alerts"), batch_id)
        sinks.write_batch(fraud.order_events(mine, F.col("processed_at")), self.path("order_events"), batch_id, by="status")
        self.review(mine, days, batch_id)

    def review(self, mine: DataFrame, days: list[dt.date], batch_id: int) -> None:
        log = self.log.read(self.near(days))
        log = log.filter(F.col("batch_id") <= batch_id)
        # Stored first: a join to an aggregate on its own key cannot be split where a customer is hot.
        people = mine.groupBy("customer_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
        stored = self.spark.read.schema(PEOPLE_SCHEMA).parquet(
            sinks.write_batch(people, self.path("batch_customers"), batch_id % 2)
        )
        reach = F.lit(self.reach)
        touched = log.filter("is_fraud").join(stored, "customer_id")
        touched = touched.filter((F.col("ts") >= F.col("first")) & (F.col("ts") <= F.col("last") + reach))
        targets = touched.select(
            "order_id", "customer_id", "total", "fraud_score", "fraud_flags", F.col("ts").alias("created_at")
        )
        around = log.select("customer_id", "ts", "total").join(stored, "customer_id").filter(
            (F.col("ts") >= F.col("first") - reach) & (F.col("ts") <= F.col("last") + reach)
        )
        recent = around.select("customer_id", F.col("ts").alias("created_at"), "total")
        decided = fraud.decide(targets, recent, self.velocity)
        rows = decided.select(
            "order_id",
            "customer_id",
            "orders_in_window",
            "spend_in_window",
            "fraud_decision",
            "combined_fraud_score",
            "all_fraud_flags",
            F.current_timestamp().alias("fraud_reviewed_at"),
            F.lit(batch_id).alias(sinks.LOG),
            bucket_of("order_id", self.buckets).alias("bucket"),
        )
        self.decided.add(rows, batch_id)

    def start(self, bodies: DataFrame, rules: FraudRules = FraudRules(), available_now: bool = True) -> list[StreamingQuery]:
        good = sinks.start(scored_stream(bodies, rules), self.on_batch, self.path("checkpoints/orders"), available_now)
        bad = sinks.start_files(
            quarantine_stream(bodies), self.path("quarantine"), self.path("checkpoints/quarantine"), available_now=available_now
        )
        return [good, bad]

    def order_log(self) -> DataFrame:
        """Every order as it was processed, with its batch and time part."""
        return self.log.read()

    def alerts(self) -> DataFrame:
        return sinks.read_log(self.spark, self.path("fraud_alerts"), ALERT_SCHEMA)

    def events(self) -> DataFrame:
        return sinks.read_log(self.spark, self.path("order_events"), EVENT_SCHEMA)

    def decisions(self) -> DataFrame:
        """The last decision on every flagged order."""
        return self.decided.read()

    def orders(self, as_of: dt.datetime | None = None) -> DataFrame:
        """The last stored version of every order, or of those whose retention has not run out at a time."""
        stored = latest(self.order_log(), ["order_id", "customer_id"], "batch_id")
        return stored if as_of is None else stored.filter(F.col("processed_at") > F.lit(as_of - RETENTION))

    def customer_orders(self, customer_id: str, first: dt.date, last: dt.date) -> DataFrame:
        """A customer's orders of some days, newest first; only these days' parts are listed and read."""
        starts = {first + dt.timedelta(days=k) for k in range((last - first).days + 1)}
        parts = {d.replace(day=1) if self.log_by == "month" else d for d in starts}
        mine = self.log.read(parts).filter((F.col("customer_id") == customer_id) & F.to_date("ts").between(first, last))
        return latest(mine, ["order_id", "customer_id"], "batch_id").orderBy(F.desc("ts"), "order_id")

    def expire(self, as_of: dt.datetime) -> int:
        """Delete folders that hold only orders and decisions whose retention has run out; returns how many."""
        return self.log.expire(as_of - RETENTION) + self.decided.expire(as_of - RETENTION)

