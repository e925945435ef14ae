"""Recommendations for many requests at once, and the bulk lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.config import RecoRules
from marketlake.functions.numeric import round_half_up
from marketlake.functions.text import category_key, category_matches
from marketlake.operators.scoring import popular_items, top_scores

_META = ("category", "unit_price", "stock_level")


def _usable(rules: RecoRules) -> Column:
    named = F.coalesce(F.col("customer_id").cast("string"), F.lit("")) != ""
    return named & (F.coalesce(F.col("n"), F.lit(rules.default_n)) >= 1)


def normalise_requests(requests: DataFrame, rules: RecoRules = RecoRules()) -> DataFrame:
    """Requests with n (5 when absent, 20 at most) and the category in search form.

    A customer and an n above 0 are required; other requests are left out (see `rejected_requests`).
    """
    return requests.filter(_usable(rules)).withColumns(
        {
            "n": F.least(F.coalesce("n", F.lit(rules.default_n)), F.lit(rules.max_n)),
            "category": category_key(F.coalesce("category", F.lit(""))),
        }
    )


def rejected_requests(requests: DataFrame, rules: RecoRules = RecoRules()) -> DataFrame:
    return requests.filter(~_usable(rules))


def _pool_entry() -> Column:
    return F.struct("score", "product_id", *_META, "on_shelf")


def _as_list(ranked: DataFrame, order: list[Column]) -> DataFrame:
    """One row holding a short, already limited frame as an ordered array."""
    keyed = ranked.select(F.struct(*order, _pool_entry().alias("c")).alias("e"))
    return keyed.agg(F.transform(F.sort_array(F.collect_list("e")), lambda e: e["c"]).alias("pool"))


def _popular_list(item_factors: DataFrame, products: DataFrame, k: int) -> DataFrame:
    """The k most popular items with metadata, as one row; cut to k before the join."""
    top = popular_items(item_factors, k).join(products.select("product_id", *_META), "product_id", "left")
    return _as_list(top.withColumn("on_shelf", F.lit(False)), [(-F.col("score")).alias("o"), F.col("product_id").alias("p")])


def _shelf_list(products: DataFrame, n: int) -> DataFrame:
    """The first n catalogue products, without score, as one row."""
    first = products.select("product_id", *_META).orderBy("product_id").limit(n)
    first = first.withColumns({"score": F.lit(None).cast("double"), "on_shelf": F.lit(True)})
    return _as_list(first, [F.col("product_id").alias("p")])


def personal_pools(
    user_factors: DataFrame, item_factors: DataFrame, products: DataFrame, rules: RecoRules = RecoRules()
) -> DataFrame:
    """(customer_id, pool): each user's best candidates in order, at most `max_pool`, or `most` where the users have it."""
    top = top_scores(
        user_factors,
        item_factors,
        rules.max_pool,
        metadata=products.select("product_id", *_META),
        user_block=rules.user_block,
        item_block=rules.item_block,
    ).withColumn("on_shelf", F.lit(False))
    ordered = F.sort_array(F.collect_list(F.struct("rank", _pool_entry().alias("c"))))
    return top.groupBy("customer_id").agg(F.transform(ordered, lambda e: e["c"]).alias("pool"))


def _in_band(price: Column, spend: Column, band: tuple[float, float]) -> Column:
    """No price or no spend known: no price filter."""
    free = price.isNull() | F.coalesce(spend == 0.0, F.lit(True))
    return free | price.between(spend * band[0], spend * band[1])


def recommend(
    requests: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    products: DataFrame,
    avg_spend: DataFrame,
    rules: RecoRules = RecoRules(),
) -> DataFrame:
    """Recommendation rows for every distinct request (customer_id, n, asked_category).

    Known customers draw from their own pool of min(8n, 200) best items, others from the most
    popular ones. Candidates in the strict price band come first, then those in the relaxed
    band, in score order; a request left with none gets the first n catalogue products.

    Equal requests have equal answers, so they are answered once; that also removes a customer
    who asks very often as a hot key. The two shared lists (200 and 20 entries at most) reach
    the rows as scalar subqueries, so no cross join is needed. A request's candidates stay a list in
    its row: they are filtered and cut to n there, so no candidate is a row that is shuffled or sorted.
    Of a customer's own list no more is made than its largest request reaches.
    """
    wanted = normalise_requests(requests, rules).select("customer_id", "n", F.col("category").alias("asked_category"))
    wanted = wanted.distinct()
    pool_size = F.least(F.col("n") * rules.pool_factor, F.lit(rules.max_pool))
    asked = user_factors.join(wanted.groupBy("customer_id").agg(F.max(pool_size).alias("most")), "customer_id")
    pools = personal_pools(asked, item_factors, products, rules)
    popular = _popular_list(item_factors, products, rules.max_pool)
    shelf = _shelf_list(products, rules.max_n)

    spend = F.col("spend")

    def step(c: Column) -> Column:
        fits = category_matches(c["category"], F.col("asked_category"))
        return F.when(fits & _in_band(c["unit_price"], spend, rules.strict), 1).when(
            fits & _in_band(c["unit_price"], spend, rules.relaxed), 2
        )

    answered = (
        wanted.join(pools, "customer_id", "left")
        .join(avg_spend, "customer_id", "left")
        .select(
            "customer_id",
            "n",
            "asked_category",
            F.col("avg_spend_per_item").alias("spend"),
            F.when(F.col("pool").isNotNull(), "als_personalised").otherwise("als_popular").alias("model"),
            F.slice(F.coalesce(F.col("pool"), popular.scalar()), F.lit(1), pool_size).alias("own"),
        )
        .withColumn("stepped", F.transform("own", lambda c: F.struct(step(c).alias("step"), c.alias("c"))))
        .withColumn("found", F.concat(F.filter("stepped", lambda s: s["step"] == 1), F.filter("stepped", lambda s: s["step"] == 2)))
        .withColumn("found", F.slice(F.transform("found", lambda s: s["c"]), F.lit(1), F.col("n")))
        .withColumn("on_shelf", F.size("found") == 0)
        .withColumn("found", F.when(F.col("on_shelf"), F.slice(shelf.scalar(), F.lit(1), F.col("n"))).otherwise(F.col("found")))
    )
    request = ["customer_id", "n", "asked_category"]
    # The outer form: Spark would put a filter on the list's size before the plain one and make the list for it again.
    ranked = answered.select(
        *request, "spend", "model", F.col("on_shelf").alias("from_shelf"), F.size("found").alias("count"), F.posexplode_outer("found").alias("pos", "c")
    ).filter(F.col("pos").isNotNull()).select(*request, "spend", "model", "from_shelf", "count", "c.*", (F.col("pos") + 1).alias("rank"))
    strategy = F.when(F.col("from_shelf"), "catalog_fallback").otherwise(F.col("model"))
    return ranked.select(
        *request,
        "count",
        strategy.alias("strategy"),
        F.when(spend != 0.0, round_half_up(spend)).alias("avg_spend_per_item"),
        "product_id",
        round_half_up(F.when(F.col("score") > rules.score_cap, rules.score_cap).otherwise(F.col("score")), 3).alias("score"),
        "rank",
        "category",
        "unit_price",
        "stock_level",
        strategy.alias("source"),
    )


def responses(rows: DataFrame) -> DataFrame:
    """Recommendation rows nested to one response per request, in rank order."""
    entry = F.struct("rank", "product_id", "score", "category", "unit_price", "stock_level", "source")
    return rows.groupBy(
        "customer_id", "n", "asked_category", "count", "strategy", "avg_spend_per_item"
    ).agg(F.sort_array(F.collect_list(entry)).alias("recommendations"))


def list_summary(rows: DataFrame) -> DataFrame:
    """Up to three categories (in alphabetical order) and the price range of each list."""
    category = F.when(F.col("category") != "", F.col("category"))
    price = F.when(F.col("unit_price") != 0.0, F.col("unit_price"))
    return rows.groupBy("customer_id", "n", "asked_category").agg(
        F.slice(F.sort_array(F.collect_set(category)), 1, 3).alias("categories"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    )


def bulk_lists(
    user_factors: DataFrame, item_factors: DataFrame, products: DataFrame, seen: DataFrame, rules: RecoRules = RecoRules()
) -> DataFrame:
    """(customer_id, recommendations, popular_fallback) for every customer of the model.

    Bought products are left out before the cut to 20. The popular list is limited to 20
    entries and attached as a scalar subquery.
    """
    top = top_scores(
        user_factors,
        item_factors,
        rules.bulk_n,
        seen,
        products.select("product_id", "category", "unit_price"),
        rules.user_block,
        rules.item_block,
    )
    entry = F.struct(
        F.col("rank"),
        F.struct("product_id", round_half_up(F.col("score"), 4).alias("score"), "category", "unit_price").alias("c"),
    )
    lists = top.groupBy("customer_id").agg(
        F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["c"]).alias("recommendations")
    )
    fallback = _popular_list(item_factors, products, rules.bulk_n).select(
        F.transform(
            "pool",
            lambda c: F.struct(
                c["product_id"].alias("product_id"),
                F.lit(rules.popular_score).alias("score"),
                c["category"].alias("category"),
                c["unit_price"].alias("unit_price"),
            ),
        ).alias("popular_fallback")
    )
    empty = F.array().cast(lists.schema["recommendations"].dataType)
    return (
        user_factors.select("customer_id")
        .join(lists, "customer_id", "left")
        .select(
            "customer_id",
            F.coalesce("recommendations", empty).alias("recommendations"),
            fallback.scalar().alias("popular_fallback"),
        )
    )
