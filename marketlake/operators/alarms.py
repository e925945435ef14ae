"""Windowed metric alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.config import AlarmRule
from marketlake.functions.numeric import UNIT, exact_avg, exact_sum, units


def metric_series(metrics: DataFrame, period_s: int, statistic: str) -> DataFrame:
    """(metric, window_start, stat) over tumbling windows; windows without rows do not appear."""
    value = F.col("value")
    stats = {"sum": exact_sum(value), "max": F.max(value), "avg": exact_avg(value)}
    return (
        metrics.groupBy("metric", F.window("ts", f"{period_s} seconds").alias("w"))
        .agg(stats[statistic].alias("stat"))
        .select("metric", F.col("w.start").alias("window_start"), "stat")
    )


def metric_parts(metrics: DataFrame, period_s: int) -> DataFrame:
    """What one batch adds to each tumbling window: sum in units, number and greatest value."""
    value = F.col("value")
    return (
        metrics.groupBy("metric", F.window("ts", f"{period_s} seconds").alias("w"))
        .agg(F.sum(units(value)).alias("units"), F.count(value).alias("n"), F.max(value).alias("top"))
        .select("metric", F.col("w.start").alias("window_start"), "units", "n", "top")
    )


def fold_parts(parts: DataFrame, statistic: str) -> DataFrame:
    """The series of `metric_series` from the parts of any number of batches."""
    total = F.sum("units")
    stats = {"sum": total / F.lit(float(UNIT)), "max": F.max("top"), "avg": total / F.sum("n") / F.lit(float(UNIT))}
    return parts.groupBy("metric", "window_start").agg(stats[statistic].alias("stat"))


def breaches(series: DataFrame, rule: AlarmRule) -> DataFrame:
    """Windows of a series at which the rule is in alarm.

    The last `periods` windows must all breach. A missing window does not breach, so window
    starts are compared, not row positions. Rows per metric are bounded by time, not by volume.
    """
    breach = F.col("stat") >= rule.threshold if rule.comparator == "ge" else F.col("stat") > rule.threshold
    breaching = series.filter(breach)
    if rule.periods > 1:
        back = rule.periods - 1
        by_time = Window.partitionBy("metric").orderBy("window_start")
        span = F.make_dt_interval(secs=F.lit(float(back * rule.period_s)))
        run = F.lag("window_start", back).over(by_time) == F.col("window_start") - span
        breaching = breaching.withColumn("_run", run).filter("_run").drop("_run")
    return breaching.select(F.lit(rule.name).alias("alarm"), "metric", "window_start", "stat")


def alarms(metrics: DataFrame, rule: AlarmRule) -> DataFrame:
    """Alarms over raw metric rows (metric, ts, value)."""
    return breaches(metric_series(metrics, rule.period_s, rule.statistic), rule)
