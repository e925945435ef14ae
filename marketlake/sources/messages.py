"""JSON messages: text in, typed events out, bad records kept apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.timefn import parse_ts
from marketlake.schemas import FRAUD_ALERT

_CORRUPT = "_corrupt_record"


def message_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of message bodies from text files, one JSON document per line."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.text(path).withColumnRenamed("value", "body")


def parse(
    messages: DataFrame, schema: T.StructType, required: Sequence[str], body: Column | None = None, time: str | None = None
) -> DataFrame:
    """Adds `event` (typed struct) and `problem` (null for a good record).

    Text that is no JSON object, fields of a wrong type, missing required fields and a text in the
    field `time` that is no time are problems of that one record; the others are not touched. Works
    on batches and streams alike.
    """
    body = F.col("body") if body is None else body
    full = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = messages.withColumn("_e", F.from_json(body, full, options))
    missing = F.array_compact(
        F.array(*[F.when(F.col(f"_e.{name}").isNull(), F.lit(name)) for name in required], F.lit(None).cast("string"))
    )
    problem = F.when(F.col("_e").isNull() | F.col(f"_e.{_CORRUPT}").isNotNull(), "unreadable").when(
        F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ","))
    )
    if time:
        no_time = F.col(f"_e.{time}").isNotNull() & parse_ts(F.col(f"_e.{time}")).isNull()
        problem = F.coalesce(problem, F.when(no_time, F.lit(f"unreadable {time}")))
    event = F.struct(*[F.col(f"_e.{f.name}").alias(f.name) for f in schema.fields])
    return parsed.withColumns({"problem": problem, "event": event}).drop("_e")


def good(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNull()).select("event.*")


def bad(parsed: DataFrame) -> DataFrame:
    """Records to set aside, with what identifies them and why they failed."""
    return parsed.filter(F.col("problem").isNotNull()).drop("event")


def alert_body(body: Column) -> Column:
    """The alert inside a notification envelope, or the text itself when there is none."""
    return F.coalesce(F.get_json_object(body, "$.Message"), body)


def parse_alerts(messages: DataFrame) -> DataFrame:
    required = ["order_id", "customer_id", "total"]
    return parse(messages, FRAUD_ALERT, required, alert_body(F.col("body")))
