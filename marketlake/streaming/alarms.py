"""Metric stream: windowed statistics and alarms over runs of windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.config import AlarmRule
from marketlake.operators.alarms import breaches, fold_parts, metric_parts
from marketlake.streaming import sinks

SERIES_SCHEMA = (
    "metric string, window_start timestamp, units bigint, n bigint, top double, log_day date, batch_id int"
)
ALARM_SCHEMA = "alarm string, metric string, window_start timestamp, stat double, batch_id int"


class AlarmJob:
    """Adds each batch to its windows and checks at once every run of windows the batch can have changed.

    No window waits to be closed and no row is too late: what a batch adds goes to the series log, and
    a window's statistic is folded from the log's days within reach.
    """

    def __init__(self, spark: SparkSession, root: str, rule: AlarmRule):
        self.spark = spark
        self.root = root
        self.rule = rule
        self.reach = dt.timedelta(seconds=rule.periods * rule.period_s)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def on_batch(self, metrics: DataFrame, batch_id: int) -> None:
        path = self.path("series")
        added = sinks.rebalancing(self.spark, metric_parts(metrics, self.rule.period_s), self.path(f"series{sinks.STAGED}"))
        sinks.write_parts(added, path, batch_id, F.to_date("window_start"))
        days = sinks.parts_of(self.spark, path, batch_id)
        reach = -(-self.reach // dt.timedelta(days=1))
        near = {d + dt.timedelta(days=k) for d in days for k in range(-reach, reach + 1)}
        log = sinks.read_parts(self.spark, path, SERIES_SCHEMA, near).filter(F.col("batch_id") <= batch_id)
        mine = sinks.read_parts(self.spark, path, SERIES_SCHEMA, days, batch_id)
        first, last = mine.agg(F.min("window_start"), F.max("window_start")).first()
        found = breaches(fold_parts(log, self.rule.statistic), self.rule)
        changed = F.col("window_start").between(F.lit(first), F.lit(last) + F.lit(self.reach)) if days else F.lit(False)
        sinks.write_batch(found.filter(changed), self.path("alarms"), batch_id)

    def start(self, metrics: DataFrame, available_now: bool = True) -> StreamingQuery:
        timed = metrics.withColumn("ts", F.col("ts").cast("timestamp"))
        return sinks.start(timed, self.on_batch, self.path("checkpoint"), available_now)

    def raised(self) -> DataFrame:
        """Alarms as each batch found them; a window still filling may appear in several batches."""
        return sinks.read_log(self.spark, self.path("alarms"), ALARM_SCHEMA)

    def alarms(self) -> DataFrame:
        """The alarms that hold after the last batch."""
        series = sinks.read_log(self.spark, self.path("series"), SERIES_SCHEMA)
        return breaches(fold_parts(series, self.rule.statistic), self.rule)
