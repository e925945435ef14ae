"""Click sessions in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.config import SessionRules
from marketlake.functions.timefn import micros, parse_ts


def sessionize(clicks: DataFrame, rules: SessionRules = SessionRules()) -> DataFrame:
    """One row per session: a new one starts after more than `gap_s` without a click.

    `timestamp` is ISO text or a timestamp; clicks without a readable time are left out.
    """
    return merge_slots(session_slots(clicks, rules), rules)


def session_slots(clicks: DataFrame, rules: SessionRules = SessionRules()) -> DataFrame:
    """One row per (session_id, slot).

    Two clicks in the same gap-wide slot of time are never further apart than the gap, so clicks are
    first reduced to one row per slot, map-side.
    """
    gap_us = rules.gap_s * 1_000_000
    us = micros(parse_ts(F.col("timestamp")))
    first = F.struct(F.col("us"), F.col("event_id"), F.col("customer_id"))
    return (
        clicks.select("session_id", "event_id", "customer_id", us.alias("us"))
        .filter(F.col("session_id").isNotNull() & F.col("us").isNotNull())
        .groupBy("session_id", F.floor(F.col("us") / F.lit(gap_us)).alias("slot"))
        .agg(
            F.min("us").alias("start"),
            F.max("us").alias("end"),
            F.count(F.lit(1)).alias("n"),
            F.min(first).alias("first"),
        )
    )


def fold_slots(slots: DataFrame) -> DataFrame:
    """Slots gathered in several batches, one row for each again."""
    return slots.groupBy("session_id", "slot").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"), F.min("first").alias("first")
    )


def _numbered(slots: DataFrame, rules: SessionRules) -> DataFrame:
    """Slots with the number of their session. Only slots are put in order per session_id: at most one per slot of time."""
    gap_us = rules.gap_s * 1_000_000
    by_time = Window.partitionBy("session_id").orderBy("slot")
    opens = F.coalesce(F.col("start") - F.lag("end").over(by_time) > gap_us, F.lit(True))
    return slots.withColumn("opens", opens.cast("int")).withColumn("no", F.sum("opens").over(by_time))


def live_slots(slots: DataFrame, as_of_epoch: Column, rules: SessionRules = SessionRules()) -> DataFrame:
    """The slots of sessions that have not expired; a session goes or stays as a whole."""
    last = F.max("end").over(Window.partitionBy("session_id", "no"))
    numbered = _numbered(slots, rules).withColumn("last", last)
    return numbered.filter(F.floor(F.col("last") / F.lit(1_000_000)) + rules.gap_s > as_of_epoch).select(*slots.columns)


def merge_slots(slots: DataFrame, rules: SessionRules = SessionRules()) -> DataFrame:
    """Sessions from slots."""
    return (
        _numbered(slots, rules).groupBy("session_id", "no")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("n").alias("event_count"),
            F.min("first").alias("first"),
        )
        .select(
            "session_id",
            F.timestamp_micros("start").alias("first_seen"),
            F.timestamp_micros("end").alias("last_seen"),
            "event_count",
            (F.floor(F.col("end") / F.lit(1_000_000)) + rules.gap_s).alias("expires_at"),
            F.coalesce("first.customer_id", F.lit(rules.anonymous)).alias("customer_id"),
        )
    )
