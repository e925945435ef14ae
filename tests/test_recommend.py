"""Scoring, request handling, lists, display and training."""

import datetime as dt
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.config import AlsParams, RecoRules
from marketlake.operators import display, evaluation, recommend, scoring, training

USERS = "customer_id string, factors array<float>"
ITEMS = "product_id string, factors array<float>"


def model(spark):
    users = spark.createDataFrame([("u1", [1.0, 0.0]), ("u2", [0.0, 1.0])], USERS)
    items = spark.createDataFrame(
        [("a", [0.9, 0.1]), ("b", [0.5, 0.5]), ("c", [0.5, 3.0]), ("d", [0.2, 0.0]), ("e", [2.0, 0.2])], ITEMS)
    products = spark.createDataFrame(
        [("a", "toys", 40.0, 3), ("b", "toys", 160.0, 0), ("c", "auto", 20.0, 1), ("d", "auto", None, None), ("e", "toys_big", 301.0, 9)],
        "product_id string, category string, unit_price double, stock_level int")
    return users, items, products


def ask(spark, requests, spend=None, rules=RecoRules()):
    users, items, products = model(spark)
    frame = spark.createDataFrame(requests, "customer_id string, n int, category string")
    avg = spark.createDataFrame(spend or [], "customer_id string, avg_spend_per_item double")
    rows = recommend.recommend(frame, users, items, products, avg, rules)
    out = {}
    for r in sorted(rows.collect(), key=lambda r: r["rank"]):
        out.setdefault((r.customer_id, r.n, r.asked_category), []).append(r)
    return out


def ids(rows):
    return [r.product_id for r in rows]


def test_personal_order_ties_and_cap(spark):
    got = ask(spark, [("u1", None, None), ("u2", 2, "")])
    mine = got[("u1", 5, "")]
    assert ids(mine) == ["e", "a", "b", "c", "d"]           # b and c tie at 0.5
    assert [r.score for r in mine] == [0.99, 0.9, 0.5, 0.5, 0.2]
    assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5] and {r.source for r in mine} == {"als_personalised"}
    assert ids(got[("u2", 2, "")]) == ["c", "b"] and got[("u2", 2, "")][0]["count"] == 2


def test_price_bands_strict_before_relaxed(spark):
    got = ask(spark, [("u1", 5, None)], [("u1", 100.0)])[("u1", 5, "")]
    # strict 40..160 and unpriced d first; relaxed 20..300 adds c; e at 301 is out
    assert ids(got) == ["a", "b", "d", "c"]
    assert got[0].avg_spend_per_item == 100.0
    free = ask(spark, [("u1", 5, None)], [("u1", 0.0)])[("u1", 5, "")]
    assert len(free) == 5 and free[0].avg_spend_per_item is None


def test_strict_items_fill_n_first(spark):
    assert ids(ask(spark, [("u1", 3, None)], [("u1", 100.0)])[("u1", 3, "")]) == ["a", "b", "d"]


def test_categories(spark):
    got = ask(spark, [("u1", 5, " TOYS big "), ("u1", 5, "toys"), ("u2", 3, "nothing like it")])
    assert ids(got[("u1", 5, "toys_big")]) == ["e"]
    assert ids(got[("u1", 5, "toys")]) == ["e", "a", "b"]
    shelf = got[("u2", 3, "nothing_like_it")]
    assert ids(shelf) == ["a", "b", "c"] and shelf[0].strategy == "catalog_fallback" and shelf[0].score is None


def test_unknown_customers_get_popular_items(spark):
    got = ask(spark, [("new", 2, None)])[("new", 2, "")]
    assert ids(got) == ["c", "e"] and {r.strategy for r in got} == {"als_popular"}


def test_pool_is_eight_times_n(spark):
    rules = RecoRules(pool_factor=1)
    got = ask(spark, [("u1", 2, "auto")], rules=rules)[("u1", 2, "auto")]
    assert got[0].strategy == "catalog_fallback"            # the two best are toys


def test_request_limits(spark, rows):
    frame = spark.createDataFrame([("u", 99, None), ("v", None, " A b "), (None, 1, None), ("", 1, None), ("w", -1, None), ("w", 0, None)], "customer_id string, n int, category string")
    assert rows(recommend.normalise_requests(frame)) == [("u", 20, ""), ("v", 5, "a_b")]
    assert recommend.rejected_requests(frame).count() == 4


def test_equal_requests_are_answered_once(spark):
    assert len(ask(spark, [("u1", 5, None)] * 50)[("u1", 5, "")]) == 5


def test_nested_responses_and_summary(spark):
    users, items, products = model(spark)
    frame = spark.createDataFrame([("u1", 5, None)], "customer_id string, n int, category string")
    rows = recommend.recommend(frame, users, items, products, spark.createDataFrame([], "customer_id string, avg_spend_per_item double"))
    nested = recommend.responses(rows).first()
    assert [r.product_id for r in nested.recommendations] == ["e", "a", "b", "c", "d"]
    summary = recommend.list_summary(rows).first()
    assert (summary.categories, summary.min_price, summary.max_price) == (["auto", "toys", "toys_big"], 20.0, 301.0)
    shown = {r["rank"]: r for r in display.display_rows(rows).collect()}
    assert [shown[i].match_pct for i in range(1, 6)] == [99, 90, 50, 50, 20]
    assert shown[1].product_label == "Toys Big" and shown[2].product_label == "Activity Play Set"
    assert shown[3].product_label == "Premium RC Toy" and shown[4].product_label == "Car Accessory"
    assert shown[3].stock_text == "Low stock" and shown[2].stock_text == "✓ 3 in stock" and shown[5].stock_text == ""
    assert shown[5].price_text == "—" and shown[2].price_text == "R$ 40.00" and shown[2].source_text == "ALS"


def test_label_tiers(spark, rows):
    df = spark.createDataFrame([("toys", 29.99), ("toys", 30.0), ("toys", 5000.0), ("Home Decor", 1.0), (None, 1.0), ("auto", None)],
                               "category string, unit_price double")
    got = {(r.category, r.unit_price): r.product_label for r in display.with_label(df).collect()}
    assert got == {("toys", 29.99): "Budget Toy Set", ("toys", 30.0): "Activity Play Set", ("toys", 5000.0): "Premium RC Toy",
                   ("Home Decor", 1.0): "Home Decor", (None, 1.0): "Product", ("auto", None): "Car Accessory"}


@pytest.mark.parametrize("blocks", [(4096, 16384), (7, 5)])
def test_top_scores_match_brute_force(spark, blocks):
    rng = np.random.default_rng(3)
    users, items = rng.integers(-3, 4, (30, 6)), rng.integers(-3, 4, (40, 6))
    seen = {(f"u{i:02d}", f"i{j:02d}") for i in range(30) for j in range(40) if rng.random() < (0.9 if i == 0 else 0.1)}
    uf = spark.createDataFrame([(f"u{i:02d}", [float(x) for x in v]) for i, v in enumerate(users)], USERS)
    itf = spark.createDataFrame([(f"i{j:02d}", [float(x) for x in v]) for j, v in enumerate(items)], ITEMS)
    sf = spark.createDataFrame(sorted(seen) * 2, "customer_id string, product_id string")

    def brute(skip):
        out = set()
        for i, u in enumerate(users):
            best = sorted((-(u @ v), f"i{j:02d}") for j, v in enumerate(items) if (f"u{i:02d}", f"i{j:02d}") not in skip)[:6]
            out |= {(f"u{i:02d}", p, float(-s), k + 1) for k, (s, p) in enumerate(best)}
        return out

    def got(df):
        return {(r.customer_id, r.product_id, r.score, r["rank"]) for r in df.collect()}

    size = {"user_block": blocks[0], "item_block": blocks[1]}
    assert got(scoring.top_scores(uf, itf, 6, **size)) == brute(set())
    assert got(scoring.top_scores(uf, itf, 6, sf, **size)) == brute(seen)


def test_bounds_prune_blocks(spark):
    """Items whose norms fall off: the same rows, for a small part of the block pairs, with ties at the k-th score."""
    rng = np.random.default_rng(5)
    users = rng.integers(-3, 4, (80, 8)).astype(float)
    items = (rng.integers(-4, 5, (300, 8)) * 2.0 ** -(np.arange(300)[:, None] // 15)).astype(float)
    items[200:210] = items[0:10]                            # equal items in far blocks, and equal scores
    uf = spark.createDataFrame([(f"u{i:02d}", v.tolist()) for i, v in enumerate(users)], USERS)
    itf = spark.createDataFrame([(f"i{j:03d}", v.tolist()) for j, v in enumerate(items)], ITEMS)
    bought = {(f"u{i:02d}", f"i{j:03d}") for i in range(80) for j in range(300) if rng.random() < (0.95 if i < 4 else 0.05)}
    sf = spark.createDataFrame(sorted(bought), "customer_id string, product_id string")
    for skip, frame in ((set(), None), (bought, sf)):
        want = set()
        for i, u in enumerate(users):
            best = sorted((-(u @ v), f"i{j:03d}") for j, v in enumerate(items) if (f"u{i:02d}", f"i{j:03d}") not in skip)[:5]
            want |= {(f"u{i:02d}", p, float(-s), n + 1) for n, (s, p) in enumerate(best)}
        report = {}
        got = scoring.top_scores(uf, itf, 5, frame, user_block=32, item_block=10, report=report).collect()
        assert {(r.customer_id, r.product_id, r.score, r["rank"]) for r in got} == want
        assert report["pairs"] >= 80 * 25 and report["multiplied"] < 0.4 * report["pairs"]


def test_equal_norms_prune_nothing_and_lose_nothing(spark):
    items = spark.createDataFrame([(f"i{j:02d}", [float(np.cos(j)), float(np.sin(j))]) for j in range(60)], ITEMS)
    users = spark.createDataFrame([("u", [1.0, 0.0]), ("none", [0.0, 0.0])], USERS)
    got = {(r.customer_id, r["rank"]): r.product_id for r in scoring.top_scores(users, items, 2, item_block=7).collect()}
    assert got == {("u", 1): "i00", ("u", 2): "i44", ("none", 1): "i00", ("none", 2): "i01"}


def test_copies_of_metadata_are_not_broadcast(spark, tmp_path):
    """A table that looks small before it is copied for each salt; products outside the model are not copied at all."""
    users = spark.createDataFrame([(u, [1.0, float(u)]) for u in range(6)], "customer_id bigint, factors array<double>")
    items = spark.createDataFrame([(p, [1.0, float(p)]) for p in range(4)], "product_id bigint, factors array<double>")
    spark.createDataFrame([(p, f"c{p}") for p in (*range(3), *range(100, 140))], "product_id bigint, category string").write.parquet(str(tmp_path / "m"))
    metadata = spark.read.parquet(str(tmp_path / "m"))
    out = scoring.top_scores(users, items, 2, metadata=metadata)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[product_id#\d+L?, _salt", text)
    assert not re.search(r"Broadcast\w+ \[product_id#\d+L?, _salt", text)
    assert {(r.customer_id, r.rank, r.product_id, r.category) for r in out.filter("customer_id = 5").collect()} == {(5, 1, 3, None), (5, 2, 2, "c2")}
    assert "LeftSemi" in text


def test_model_is_absent(spark):
    """Empty factor tables: no scores, and every request gets the catalogue."""
    assert scoring.top_scores(spark.createDataFrame([], USERS), spark.createDataFrame([], ITEMS), 3).count() == 0
    _, _, products = model(spark)
    frame = spark.createDataFrame([("u1", 2, None)], "customer_id string, n int, category string")
    spend = spark.createDataFrame([], "customer_id string, avg_spend_per_item double")
    rows = recommend.recommend(frame, spark.createDataFrame([], USERS), spark.createDataFrame([], ITEMS), products, spend).collect()
    assert [r.product_id for r in sorted(rows, key=lambda r: r["rank"])] == ["a", "b"] and {r.strategy for r in rows} == {"catalog_fallback"}


def test_bulk_lists(spark):
    users, items, products = model(spark)
    seen = spark.createDataFrame([("u1", "e"), *[("u2", p) for p in "abcde"]], "customer_id string, product_id string")
    got = {r.customer_id: r for r in recommend.bulk_lists(users, items, products, seen, RecoRules(bulk_n=2)).collect()}
    assert [(r.product_id, r.score) for r in got["u1"].recommendations] == [("a", 0.9), ("b", 0.5)]
    assert got["u2"].recommendations == []
    assert [(r.product_id, r.score, r.category) for r in got["u2"].popular_fallback] == [("c", 0.5, "auto"), ("e", 0.5, "toys_big")]


def test_dense_ids(spark):
    df = spark.createDataFrame([(f"v{i % 37}",) for i in range(200)] + [(None,)], "v string")
    ids = training.dense_ids(df, "v", "id", buckets=5)
    got = {r.v: r.id for r in ids.collect()}
    assert sorted(got.values()) == list(range(37))
    assert got == {r.v: r.id for r in training.dense_ids(df.repartition(3), "v", "id", buckets=5).collect()}


def test_als_prefers_the_planted_group_and_is_repeatable(spark, tmp_path):
    rng = random.Random(1)
    pairs = {(f"c{g}{i}", f"p{g}{rng.randrange(8)}") for g in range(2) for i in range(10) for _ in range(6)}
    inter = spark.createDataFrame([(c, p, 1.0) for c, p in sorted(pairs)], "customer_id string, product_id string, implicit_rating double")
    params = AlsParams(rank=4, max_iter=8)
    factors = training.fit_factors(spark, inter, params)
    training.save_factors(factors, str(tmp_path / "model"))
    loaded = training.load_factors(spark, str(tmp_path / "model"))
    assert loaded.users.count() == len({c for c, _ in pairs}) and loaded.items.count() == len({p for _, p in pairs})
    top = scoring.top_scores(loaded.users, loaded.items, 3).collect()
    assert all(r.customer_id[1] == r.product_id[1] for r in top)
    unseen = scoring.top_scores(loaded.users, loaded.items, 20, inter).collect()
    assert not {(r.customer_id, r.product_id) for r in unseen} & pairs
    again = {r.customer_id: r.factors for r in training.fit_factors(spark, inter, params).users.collect()}
    assert again == {r.customer_id: r.factors for r in loaded.users.collect()}


def test_shuffles_of_a_fit_do_not_grow_with_its_iterations(spark):
    """Files of finished iterations are deleted; those of the last ones stay as long as the factors are in use."""
    pairs = [(f"c{i}", f"p{(i * k) % 23}", 1.0) for i in range(30) for k in range(1, 5)]
    inter = spark.createDataFrame(pairs, "customer_id string, product_id string, implicit_rating double")
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left(iterations):
        before = blocks.getAllFiles().size()
        factors = training.fit_factors(spark, inter, AlsParams(rank=2, max_iter=iterations))
        sizes = []
        for _ in range(12):                                 # deletion goes on beside the fit
            sizes.append(blocks.getAllFiles().size())
            time.sleep(0.5)
        assert factors.users.count() == 30
        return min(sizes) - before

    few = left(2)
    assert left(12) <= few + 60


def test_als_foresees_held_out_purchases_better_than_random_factors(spark):
    """Customers of two groups buy their group's products; each one's last purchases are held out."""
    rng = random.Random(4)
    bought = []
    for g in range(2):
        for i in range(20):
            for at, p in enumerate(rng.sample(range(12), 8)):
                bought.append((f"c{g}{i}", f"p{g}{p}", dt.date(2024, 1, 1 + at)))
    frame = spark.createDataFrame(bought, "customer_id string, product_id string, order_date date")
    cutoff = evaluation.split_day(frame, share=0.75)
    assert cutoff == dt.date(2024, 1, 7)
    seen, held_out = evaluation.split_pairs(frame, cutoff)
    assert (seen.count(), held_out.count()) == (240, 80)
    factors = training.fit_factors(spark, seen.withColumn("implicit_rating", F.lit(1.0)), AlsParams(rank=4, max_iter=8))
    fitted = evaluation.evaluate(factors.users, factors.items, seen, held_out, 6).first()
    noise = np.random.default_rng(1)

    def shuffled(df, key):
        return spark.createDataFrame([(r[0], noise.normal(size=4).tolist()) for r in df.select(key).collect()], f"{key} string, factors array<double>")

    chance = evaluation.evaluate(shuffled(factors.users, "customer_id"), shuffled(factors.items, "product_id"), seen, held_out, 6).first()
    expected = 6 / 18  # six of the eighteen products that a customer has not bought
    assert fitted.recall > 2 * expected and chance.recall < 1.5 * expected
    assert fitted.mean_reciprocal_rank > chance.mean_reciprocal_rank


def test_ranking_measures_by_hand(spark):
    top = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 1)], "customer_id string, product_id int, rank int")
    held = spark.createDataFrame([("a", 2), ("a", 9), ("b", 5), ("unknown", 1)], "customer_id string, product_id int")
    got = evaluation.ranking_measures(top, held).first().asDict()
    assert got == {"pairs": 4, "customers": 3, "hits": 1, "recall": 0.25, "hit_rate": 1 / 3, "mean_rank": 2.0, "mean_reciprocal_rank": 0.5 / 3}
    empty = evaluation.ranking_measures(top, held.limit(0)).first()
    assert (empty.pairs, empty.hits, empty.recall, empty.mean_rank) == (0, 0, None, None)
    assert evaluation.split_day(spark.createDataFrame([], "order_date date")) is None


def test_candidates_of_a_request_are_not_rows(spark):
    """No window over requests, and a customer's list is made no longer than its largest request reaches."""
    users, items, products = model(spark)
    frame = spark.createDataFrame([("u1", 1, None), ("u1", 2, "toys"), ("new", 2, None)], "customer_id string, n int, category string")
    spend = spark.createDataFrame([], "customer_id string, avg_spend_per_item double")
    out = recommend.recommend(frame, users, items, products, spend, RecoRules(pool_factor=1))
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    asked = users.join(spark.createDataFrame([("u1", 2), ("u2", 4)], "customer_id string, most int"), "customer_id")
    pools = {r.customer_id: [c.product_id for c in r.pool] for r in recommend.personal_pools(asked, items, products).collect()}
    assert pools == {"u1": ["e", "a"], "u2": ["c", "b", "e", "a"]}
    assert {(r.customer_id, r.n, r["rank"], r.product_id) for r in out.collect()} == {
        ("u1", 1, 1, "e"), ("u1", 2, 1, "e"), ("u1", 2, 2, "a"), ("new", 2, 1, "c"), ("new", 2, 2, "e")}


def test_items_are_sent_once_to_each_task(spark):
    """Users stay: whatever their blocks, an item is not copied for each of them."""
    users = spark.createDataFrame([(u, [1.0, float(u)]) for u in range(900)], "customer_id bigint, factors array<double>")
    items = spark.createDataFrame([(p, [1.0, float(p)]) for p in range(40)], "product_id bigint, factors array<double>")
    out = scoring.top_scores(users, items, 2, user_block=10)
    assert "CoGroup" not in out._jdf.queryExecution().toString() and "Window" not in out._jdf.queryExecution().toString()
    assert {(r.customer_id, r.rank, r.product_id) for r in out.filter("customer_id in (0, 899)").collect()} == {(0, 1, 0), (0, 2, 1), (899, 1, 39), (899, 2, 38)}


def test_equal_scores_and_repeated_ids(spark):
    """Many equal scores are cut by product; rows that share a customer share one list."""
    items = spark.createDataFrame([(p, [0.0, 1.0]) for p in range(3000)], "product_id bigint, factors array<double>")
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (None, [0.0, 2.0])], "customer_id bigint, factors array<double>")
    got = {(r.customer_id, r["rank"]): (r.product_id, r.score) for r in scoring.top_scores(users, items, 3, item_block=700).collect()}
    assert got == {(1, 1): (0, 0.0), (1, 2): (1, 0.0), (1, 3): (2, 0.0), (2, 1): (0, 1.0), (2, 2): (0, 1.0), (2, 3): (1, 1.0),
                   (None, 1): (0, 2.0), (None, 2): (1, 2.0), (None, 3): (2, 2.0)}


def test_blocks_of_a_fit_follow_its_ratings():
    assert training.fit_blocks(1_000) == 10 and training.fit_blocks(70_000_000) == 70
