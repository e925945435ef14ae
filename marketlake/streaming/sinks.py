"""Idempotent outputs of micro-batches.

Every batch owns the folders of its id and overwrites them, so a batch that is run again after a
failure leaves the same rows. A log that is read by time has its time parts outermost: a batch then
lists only the parts it asks for, however many batches went before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LOG = "batch_id"
DAY = "log_day"
STAGED = "_staged"
ADAPTIVE = "spark.sql.adaptive.enabled"


def write_batch(df: DataFrame, path: str, batch_id: int, by: str | None = None) -> str:
    folder = f"{path}/{LOG}={batch_id}"
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(by)
    writer.parquet(folder)
    return folder


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all batches with their batch_id."""
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def rebalancing(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    """The rows as a frame whose rebalance hints take effect.

    A micro-batch with state runs without adaptive execution, which ignores the hint: each of its tasks would write a
    file for each part. Its rows are written once as they come and read back in the job's own session.
    """
    if rows.sparkSession.conf.get(ADAPTIVE) == "true":
        return rows
    rows.write.mode("overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def write_parts(df: DataFrame, path: str, batch_id: int, day: Column) -> None:
    """Rows of one batch below log_day= / batch_id=; the same batch written again replaces its own folders."""
    parts = df.withColumns({DAY: day, LOG: F.lit(batch_id)}).hint("rebalance", DAY)
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, LOG).parquet(path)


def parts_of(spark: SparkSession, path: str, batch_id: int) -> list[dt.date]:
    """The log days that a batch has written, from folder names alone."""
    found = _matching(spark, f"{path}/{DAY}=*/{LOG}={batch_id}")
    return sorted(dt.date.fromisoformat(p.split(f"{DAY}=")[1][:10]) for p in found)


def read_parts(spark: SparkSession, path: str, schema: str, days: Iterable[dt.date], batch_id: int | None = None) -> DataFrame:
    """The rows of some log days, of all batches or of one. Other days are neither listed nor read."""
    tail = "" if batch_id is None else f"/{LOG}={batch_id}"
    found = _matching(spark, f"{path}/{DAY}={{{','.join(sorted(d.isoformat() for d in days))}}}{tail}")
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*found)


def matching(spark: SparkSession, pattern: str) -> list:
    """The file system's status of each path that matches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or [])


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    return [status.getPath().toString() for status in matching(spark, pattern)]


def arrived_once(stream: DataFrame, keys: list[str], within: str) -> DataFrame:
    """Drops copies that arrive within a time of each other.

    The watermark follows the time of arrival, so no time inside a record, however late or far in
    the future, makes another record late. Rows are never dropped as late.
    """
    stamped = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return stamped.dropDuplicatesWithinWatermark(keys).drop("_arrived")


def start(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    form: str = "parquet",
    partitions: tuple[str, ...] = (),
    available_now: bool = True,
) -> StreamingQuery:
    writer = stream.writeStream.format(form).option("checkpointLocation", checkpoint).outputMode("append")
    if partitions:
        writer = writer.partitionBy(*partitions)
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)


def run_now(queries: list[StreamingQuery]) -> None:
    """Wait until all available input is processed."""
    for query in queries:
        query.awaitTermination()
