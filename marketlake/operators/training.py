"""Integer ids, implicit ALS and the factor tables."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.config import AlsParams
from marketlake.session import working_path


def dense_ids(df: DataFrame, column: str, out: str, buckets: int = 1024) -> DataFrame:
    """(column, out): numbers 0..n-1 for the distinct values, the same on every run.

    Values are hashed into buckets and numbered inside each; a bucket's first number is the
    running count of the buckets before it. Only the bucket counts, a fixed number of rows,
    are brought together.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    bucketed = values.withColumn("_b", F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int"))
    sizes = bucketed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(1)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(column))
    return (
        bucketed.withColumn("_i", inside)
        .join(F.broadcast(starts), "_b")
        .select(column, (F.col("_start") + F.col("_i") - 1).cast("int").alias(out))
    )


@dataclass(frozen=True)
class Factors:
    """Latent factors under the original ids: (customer_id, factors) and (product_id, factors)."""

    users: DataFrame
    items: DataFrame


@contextmanager
def collecting(spark: SparkSession, every: float = 10.0) -> Iterator[None]:
    """Lets the driver collect its garbage every few seconds and at the end.

    Spark deletes a shuffle's files when nothing on the driver names it any more, and a small heap may not be
    collected during a whole fit, so the files of all its iterations would lie beside each other.
    """
    over = threading.Event()

    def collect() -> None:
        while not over.wait(every):
            spark.sparkContext._jvm.java.lang.System.gc()

    thread = threading.Thread(target=collect, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()
        spark.sparkContext._jvm.java.lang.System.gc()


#: Ratings in one of the fit's blocks; a task holds a block and the factors of the other side that it meets.
BLOCK = 1_000_000


def fit_blocks(ratings: int) -> int:
    """Blocks of users and of items: Spark's ten, or as many as keep them within a size."""
    return max(10, -(-ratings // BLOCK))


def fit_factors(
    spark: SparkSession, interactions: DataFrame, params: AlsParams = AlsParams(), rating: str = "implicit_rating"
) -> Factors:
    """Implicit-feedback ALS over (customer_id, product_id, rating).

    Interactions and id maps are written once to the shared folder, so neither the fit nor a
    lost executor recomputes what is upstream of them. ALS cuts its own lineage by checkpoint, in every
    iteration, so that the shuffles of earlier ones can be deleted while it goes on. The number of its blocks follows
    the ratings, so a task's memory does not grow with them. The factors are written too, so nothing of the fit stays.
    """
    base = working_path(spark, "als")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{base}/checkpoints")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    pairs = written(interactions.select("customer_id", "product_id", F.col(rating).cast("float").alias("rating")), "pairs")
    users = written(dense_ids(pairs, "customer_id", "user"), "users")
    items = written(dense_ids(pairs, "product_id", "item"), "items")
    ratings = written(
        pairs.join(users, "customer_id").join(items, "product_id").select("user", "item", "rating"), "ratings"
    )
    blocks = fit_blocks(ratings.count())
    als = ALS(
        rank=params.rank,
        maxIter=params.max_iter,
        regParam=params.reg,
        alpha=params.alpha,
        seed=params.seed,
        implicitPrefs=True,
        coldStartStrategy="drop",
        userCol="user",
        itemCol="item",
        ratingCol="rating",
        checkpointInterval=1,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
    )
    with collecting(spark):
        model = als.fit(ratings)
        user_factors = written(model.userFactors, "user_factors")
        item_factors = written(model.itemFactors, "item_factors")
        del model
    return Factors(
        user_factors.join(users, F.col("id") == F.col("user")).select("customer_id", F.col("features").alias("factors")),
        item_factors.join(items, F.col("id") == F.col("item")).select("product_id", F.col("features").alias("factors")),
    )


def save_factors(factors: Factors, path: str) -> None:
    factors.users.write.mode("overwrite").parquet(f"{path}/user_factors")
    factors.items.write.mode("overwrite").parquet(f"{path}/item_factors")


def load_factors(spark: SparkSession, path: str) -> Factors:
    return Factors(spark.read.parquet(f"{path}/user_factors"), spark.read.parquet(f"{path}/item_factors"))
