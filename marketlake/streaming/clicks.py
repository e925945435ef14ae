"""Click stream: enrichment to hourly folders, deduplication, live sessions and a quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake import schemas
from marketlake.config import LATE_DATA, SessionRules
from marketlake.functions.timefn import parse_ts
from marketlake.operators import sessions
from marketlake.operators.clean import enrich_clicks
from marketlake.sources import messages
from marketlake.streaming import sinks
from marketlake.streaming.snapshots import Snapshot, bucket_of

REQUIRED = ("session_id",)
HOURLY = ("year", "month", "day", "hour")
SLOT_SCHEMA = (
    "session_id string, slot bigint, start bigint, end bigint, n bigint, "
    "first struct<us: bigint, event_id: string, customer_id: string>, bucket int"
)


def parsed(bodies: DataFrame) -> DataFrame:
    return messages.parse(bodies, schemas.CLICK_EVENT, REQUIRED, time="timestamp")


def click_stream(bodies: DataFrame) -> DataFrame:
    """Typed clicks from message bodies."""
    return messages.good(parsed(bodies))


def quarantine_stream(bodies: DataFrame) -> DataFrame:
    """Clicks that cannot be processed, including those whose time cannot be read."""
    return messages.bad(parsed(bodies))


def unique_clicks(clicks: DataFrame, late: str = LATE_DATA) -> DataFrame:
    """Clicks without copies that arrive within `late`; a click without event_id is a copy only of an equal one."""
    key = F.coalesce("event_id", F.concat(F.lit("row:"), F.sha2(F.to_json(F.struct(*clicks.columns)), 256)))
    return sinks.arrived_once(clicks.withColumn("_key", key), ["_key"], late).drop("_key")


def start_enriched(clicks: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Enriched clicks as NDJSON below year= / month= / day= / hour= of processing time."""
    now = F.col("enriched_at")
    parts = {
        "year": F.date_format(now, "yyyy"),
        "month": F.date_format(now, "MM"),
        "day": F.date_format(now, "dd"),
        "hour": F.date_format(now, "HH"),
    }
    return sinks.start_files(enrich_clicks(clicks).withColumns(parts), path, checkpoint, "json", HOURLY, available_now)


class ClickJob:
    """Writes enriched clicks, session parts and a quarantine of bad records below one folder.

    A batch reduces its clicks to a row per session and slot of time, and sessions are a view over these
    rows: every session can be read right after its click, late clicks count, and the cut in batches does
    not matter. A click without time counts at its arrival.

    Batches are folded into versions by bucket of the session_id. With `keep_s`, a session leaves the state so long
    after it expired; without, none does.
    """

    def __init__(
        self, spark: SparkSession, root: str, rules: SessionRules = SessionRules(), keep_s: int | None = None,
        buckets: int = 16, every: int = 16,
    ):
        self.spark = spark
        self.root = root
        self.rules = rules
        self.keep_s = keep_s
        self.buckets = buckets
        self.slots = Snapshot(spark, self.path("session_slots"), SLOT_SCHEMA, "bucket", self._folded, every)

    def _folded(self, slots: DataFrame) -> DataFrame:
        folded = self._placed(sessions.fold_slots(slots))
        if self.keep_s is None:
            return folded
        return sessions.live_slots(folded, F.unix_timestamp() - self.keep_s, self.rules)

    def _placed(self, slots: DataFrame) -> DataFrame:
        return slots.withColumn("bucket", bucket_of("session_id", self.buckets))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def on_batch(self, clicks: DataFrame, batch_id: int) -> None:
        self.slots.add(self._placed(sessions.session_slots(clicks, self.rules)), batch_id)

    def start(self, bodies: DataFrame, available_now: bool = True) -> list[StreamingQuery]:
        good = click_stream(bodies)
        arrival = F.coalesce(parse_ts(F.col("timestamp")).cast("timestamp"), F.current_timestamp())
        timed = good.withColumn("timestamp", arrival)
        return [
            start_enriched(good, self.path("clicks"), self.path("checkpoints/clicks"), available_now),
            sinks.start(timed, self.on_batch, self.path("checkpoints/sessions"), available_now),
            sinks.start_files(
                quarantine_stream(bodies), self.path("quarantine"), self.path("checkpoints/quarantine"), available_now=available_now
            ),
        ]

    def sessions(self, as_of: int | None = None) -> DataFrame:
        """Every session up to the last batch, or those that have not expired at a time in epoch seconds."""
        found = sessions.merge_slots(self.slots.read(), self.rules)
        return found if as_of is None else found.filter(F.col("expires_at") > as_of)

    def session(self, session_id: str) -> DataFrame:
        """The sessions of one id; only its bucket is listed and read."""
        bucket = self.spark.range(1).select(bucket_of(F.lit(session_id), self.buckets)).first()[0]
        return sessions.merge_slots(self.slots.read([bucket]).filter(F.col("session_id") == session_id), self.rules)

    def quarantine(self) -> DataFrame:
        return self.spark.read.parquet(self.path("quarantine"))
