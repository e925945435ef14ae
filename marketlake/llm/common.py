"""Helpers shared by the operators: tables, stored frames, document text as Arrow bytes, components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import working_path


#: Rows of text that a Python worker is sent at once: texts are long, and two workers share an executor's memory.
ROWS = 2_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: short lineage that outlives executors."""
    spark = df.sparkSession
    path = working_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ROWS:
        spark.conf.set(key, str(ROWS))


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id and the text as bytes; a null text is empty."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *extra)


def bytes_of(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values end to end as uint8, and the n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], most: int, rows: int = 60_000, column: str = "text") -> Iterator[pa.Table]:
    """Batches cut and put together to tables of about `most` bytes in `column` and `rows` rows at most.

    A single longer value is a table of its own.
    """
    held, size, count = [], 0, 0
    for batch in batches:
        ends = np.cumsum(_lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = int(np.searchsorted(ends, before + most - size, side="right"))
            end = min(max(end, start + 1), start + rows - count, batch.num_rows)
            held.append(batch.slice(start, end - start))
            size, count, start = size + int(ends[end - 1]) - before, count + end - start, end
            if size >= most or count >= rows or start < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size, count = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)
    release()


def release() -> None:
    """Give freed memory back to the system: Python workers live on from stage to stage beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value for each run of `data`; ends: where the runs end, in items."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * data.itemsize
    raw = pa.py_buffer(np.ascontiguousarray(data))
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), raw]).cast(pa.binary())


def _lengths(column: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64)


def components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """Connected components: (node, component) with the least node of each, for nodes that have an edge.

    `edges` has columns a, b. Large-star and small-star steps alternate until no edge changes; each node
    ends as a leaf of its least node. Every round is one shuffle of the edges, written to the shared folder.
    A hub never meets its leaves in one task: a step joins each edge to its node's least neighbour.
    """
    pairs = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    now = stored(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    before = None
    for k in range(1, rounds):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(down, "a")
        small = (
            moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(moved.select("a", F.col("m").alias("b")))
            .distinct()
        )
        now = stored(small, f"{name}-{k}")
        sums = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if sums == before or not sums[0]:
            break
        before = sums
    else:
        raise RuntimeError("components: not settled")
    leaves = now.groupBy("a").agg(F.min("b").alias("component"))
    return leaves.select(F.col("a").alias("node"), "component").union(
        leaves.select(F.col("component").alias("node"), "component").distinct()
    )
