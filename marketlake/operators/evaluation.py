"""How well recommendations foresee later purchases: a split by time and ranking measures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.scoring import top_scores


def split_day(purchases: DataFrame, day: str = "order_date", share: float = 0.8) -> dt.date | None:
    """The first day that has at least `share` of the purchases before it, or the last day; None without purchases.

    Purchases are counted by day; the window runs over the days alone.
    """
    days = purchases.filter(F.col(day).isNotNull()).groupBy(day).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.lit(1)).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    counted = days.select(day, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("all"))
    late = F.col("before") >= F.lit(share) * F.col("all")
    return counted.agg(F.coalesce(F.min(F.when(late, F.col(day))), F.max(day)).alias("day")).first().day


def split_pairs(purchases: DataFrame, cutoff: dt.date, day: str = "order_date") -> tuple[DataFrame, DataFrame]:
    """(customer_id, product_id) bought before a day, and those bought from it on for the first time."""
    pairs = purchases.filter(F.col(day).isNotNull()).groupBy("customer_id", "product_id").agg(F.min(day).alias("first"))
    early = F.col("first") < F.lit(cutoff)
    return tuple(pairs.filter(c).select("customer_id", "product_id") for c in (early, ~early))


def ranking_measures(top: DataFrame, held_out: DataFrame) -> DataFrame:
    """One row: how the lists `top` (customer_id, product_id, rank) meet the pairs held out.

    pairs, customers: held out; hits: pairs in their customer's list; recall = hits / pairs; hit_rate: customers with
    a hit / customers; mean_rank: of the hits; mean_reciprocal_rank: of each customer's best hit, 0 without one.
    A customer or product the model does not know is a miss. Ratios are null without pairs, mean_rank without hits.
    """
    met = held_out.join(top.select("customer_id", "product_id", "rank"), ["customer_id", "product_id"], "left")
    each = met.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("pairs"), F.count("rank").alias("hits"), F.sum("rank").alias("ranks"), F.min("rank").alias("best")
    )
    total = each.agg(
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"),
        F.count(F.lit(1)).alias("customers"),
        F.coalesce(F.sum("hits"), F.lit(0)).alias("hits"),
        F.sum("ranks").alias("ranks"),
        F.count("best").alias("with_hit"),
        F.avg(F.coalesce(F.lit(1.0) / F.col("best"), F.lit(0.0))).alias("mean_reciprocal_rank"),
    )
    ratio = {
        "recall": F.try_divide("hits", "pairs"),
        "hit_rate": F.try_divide("with_hit", "customers"),
        "mean_rank": F.try_divide("ranks", "hits"),
    }
    return total.withColumns(ratio).select("pairs", "customers", "hits", "recall", "hit_rate", "mean_rank", "mean_reciprocal_rank")


def evaluate(users: DataFrame, items: DataFrame, seen: DataFrame, held_out: DataFrame, n: int = 20) -> DataFrame:
    """Measures of the n best unseen items by factors that were fitted on what came before the split."""
    asked = held_out.select("customer_id").distinct()
    return ranking_measures(top_scores(users.join(asked, "customer_id", "left_semi"), items, n, seen), held_out)
