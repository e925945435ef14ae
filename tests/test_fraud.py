"""Rule scores, velocity windows and decisions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlake.config import VelocityRules
from marketlake.operators import fraud, upsert, velocity
from marketlake.operators.velocity import trailing_activity

ITEM = ("p", "c", 1, 10.0, 1.0)
SCHEMA = (
    "order_id string, customer_tier string, total double, payment_method string, is_suspicious boolean, "
    "items array<struct<product_id: string, category: string, quantity: int, unit_price: double, freight: double>>"
)

CASES = [
    # tier, total, method, suspicious, items -> score, flags, fraud
    ("silver", 49.9, "credit_card", False, 1, 0.0, [], False),
    ("bronze", 600.0, "crypto", True, 2, 1.0,
     ["known_risky_customer", "high_value_order", "unusual_payment_method", "tier_amount_mismatch"], True),
    ("silver", 80.0, "bank_transfer", False, 1, 0.0, [], False),
    ("bronze", 600.0, "crypto", True, 4, 1.0,
     ["known_risky_customer", "high_value_order", "unusual_payment_method", "tier_amount_mismatch", "bulk_purchase"], True),
    ("bronze", 200.0, "credit_card", False, 1, 0.0, [], False),
    ("bronze", 200.01, "credit_card", False, 1, 0.25, ["tier_amount_mismatch"], False),
    ("gold", 500.0, "credit_card", False, 9, 0.0, [], False),
    ("gold", 500.01, "credit_card", False, 3, 0.2, ["high_value_order"], False),
    ("gold", 500.01, "credit_card", False, 4, 0.3, ["high_value_order", "bulk_purchase"], False),
    ("bronze", 500.01, "credit_card", False, 1, 0.45, ["high_value_order", "tier_amount_mismatch"], False),
    ("gold", 45.0, None, None, None, 0.0, [], False),
    ("silver", 10.0, "credit_card", True, 0, 0.4, ["known_risky_customer"], False),
]


def test_score_cases(spark):
    data = [
        (str(i), tier, total, method, sus, None if n is None else [ITEM] * n)
        for i, (tier, total, method, sus, n, *_rest) in enumerate(CASES)
    ]
    got = {r.order_id: r for r in fraud.score_orders(spark.createDataFrame(data, SCHEMA)).collect()}
    for i, case in enumerate(CASES):
        row = got[str(i)]
        assert row.fraud_score == pytest.approx(case[5]), case
        assert row.fraud_flags == case[6]
        assert row.is_fraud is case[7]


def test_item_count_replaces_items(spark):
    df = spark.createDataFrame([("a", "gold", 600.0, "credit_card", False, 5)],
                               "order_id string, customer_tier string, total double, payment_method string, is_suspicious boolean, item_count int")
    assert fraud.score_orders(df).first().fraud_flags == ["high_value_order", "bulk_purchase"]


def test_stored_order_and_retention(spark):
    data = [("a", "silver", 600.0, "crypto", False, [ITEM])]
    scored = fraud.score_orders(spark.createDataFrame(data, SCHEMA)).withColumns(
        {"customer_id": F.lit("c"), "status": F.lit("confirmed"), "created_at": F.lit("2024-01-01T00:00:00Z")}
    )
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    stored = fraud.stored_order(scored, now)
    row = stored.first()
    assert (row.total, row.fraud_score, row.item_count) == ("600.0", "0.35", 1)
    epoch = int(dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc).timestamp())
    assert row.ttl == epoch + 90 * 86400
    assert fraud.live_orders(stored, F.lit(row.ttl)).count() == 0
    assert fraud.live_orders(stored, F.lit(row.ttl - 1)).count() == 1


def _orders(spark, data):
    return spark.createDataFrame(
        [(i, c, dt.datetime.fromisoformat(t), v) for i, (c, t, v) in enumerate(data)],
        "order_id long, customer_id string, created_at timestamp_ntz, total double",
    )


def test_window_edges_are_closed(spark):
    df = _orders(spark, [
        ("a", "2024-01-01T10:00:00", 1.0),
        ("a", "2024-01-01T11:00:00", 2.0),
        ("a", "2024-01-01T11:00:00.000001", 4.0),
        ("a", "2024-01-02T10:00:00", 8.0),
        ("a", "2024-01-02T10:00:00", 16.0),
        ("a", "2024-01-02T10:00:00.000001", 32.0),
        ("b", "2024-01-01T10:30:00", 64.0),
    ])
    got = {r.order_id: (r.orders_in_window, r.spend_in_window) for r in trailing_activity(df).collect()}
    assert got == {
        0: (1, 1.0), 1: (2, 3.0), 2: (2, 7.0), 3: (2, 31.0), 4: (2, 31.0), 5: (3, 62.0), 6: (1, 64.0),
    }


@pytest.mark.parametrize("rules", [
    VelocityRules(),
    VelocityRules(order_window_s=7200, spend_window_s=10800, slot_s=3600),
    VelocityRules(order_window_s=1800, spend_window_s=5400, slot_s=600),
])
def test_windows_match_brute_force_with_a_hot_customer(spark, rules):
    rng = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    orders = []
    for i in range(600):
        who = "hot" if rng.random() < 0.4 else f"c{rng.randrange(40)}"
        at = base + dt.timedelta(seconds=rng.randrange(0, 4 * 86400, 300))
        orders.append((i, who, at, round(rng.random() * 100, 2)))
    schema = "order_id long, customer_id string, created_at timestamp_ntz, total double"
    history = spark.createDataFrame(orders, schema)
    targets = spark.createDataFrame([o for o in orders if o[0] % 3 == 0] + [(9999, "new", base, 5.0)], schema)

    def brute(o):
        def within(s):
            return [h for h in orders if h[1] == o[1] and o[2] - dt.timedelta(seconds=s) <= h[2] <= o[2]]
        return len(within(rules.order_window_s)), round(sum(h[3] for h in within(rules.spend_window_s)), 2)

    own = {r.order_id: (r.orders_in_window, round(r.spend_in_window, 2)) for r in trailing_activity(history, None, rules).collect()}
    assert own == {o[0]: brute(o) for o in orders}
    some = {r.order_id: (r.orders_in_window, round(r.spend_in_window, 2)) for r in trailing_activity(targets, history, rules).collect()}
    assert some == {**{o[0]: brute(o) for o in orders if o[0] % 3 == 0}, 9999: (0, 0.0)}


@pytest.mark.parametrize("spread_s", [3600, 1])
def test_a_burst_of_one_customer_is_cut_in_parts(spark, spread_s):
    """A third of all rows in one hour, or in one second of it: same windows, and no sorted group holds more than is allowed."""
    rng = random.Random(8)
    base = dt.datetime(2024, 1, 5)
    orders = [(i, "hot", base + dt.timedelta(microseconds=rng.randrange(spread_s * 1_000_000)), float(rng.randrange(100))) for i in range(300)]
    orders += [(1000 + i, rng.choice(["hot", "a", "b"]), base + dt.timedelta(seconds=rng.randrange(-90_000, 90_000)), 2.0) for i in range(600)]
    schema = "order_id long, customer_id string, created_at timestamp_ntz, total double"
    history = spark.createDataFrame(orders, schema)
    rules = VelocityRules(busy=40)
    slot_us = rules.slot_s * 1_000_000
    timed = history.select(F.col("customer_id").alias("k"), F.unix_micros(F.col("created_at").cast("timestamp")).alias("us"))
    timed = timed.withColumn("slot", F.floor(F.col("us") / slot_us).cast("long"))
    parts = velocity.parts_needed(timed, slot_us, rules.busy)
    assert parts == (1 << 10 if spread_s == 3600 else 1 << 20)
    assert timed.groupBy("k", "slot", velocity._part(slot_us, parts)).count().agg(F.max("count")).first()[0] <= rules.busy

    def brute(o):
        near = [h for h in orders if h[1] == o[1] and h[2] <= o[2]]
        hour, day = (sum(1 for h in near if h[2] >= o[2] - dt.timedelta(hours=1)), sum(h[3] for h in near if h[2] >= o[2] - dt.timedelta(days=1)))
        return hour, round(day, 2)

    want = {o[0]: brute(o) for o in orders}
    own = trailing_activity(history, None, rules).collect()
    assert {r.order_id: (r.orders_in_window, round(r.spend_in_window, 2)) for r in own} == want
    targets = history.filter("order_id % 3 = 0").unionByName(spark.createDataFrame([(9999, "new", base, 5.0), (9998, None, base, 5.0)], schema))
    some = trailing_activity(targets, history, rules).collect()
    assert {r.order_id: (r.orders_in_window, round(r.spend_in_window, 2)) for r in some} == {**{i: w for i, w in want.items() if i % 3 == 0}, 9999: (0, 0.0), 9998: (0, 0.0)}


def test_rows_without_customer_or_time_have_no_window(spark, rows):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, None, at, 5.0), (2, None, at, 5.0), (3, "a", None, 5.0), (4, "a", at, 5.0), (5, None, None, 5.0)],
                               "order_id long, customer_id string, created_at timestamp_ntz, total double")
    for history in (None, df):
        got = rows(trailing_activity(df, history), "order_id", "orders_in_window", "spend_in_window")
        assert got == [(1, 0, 0.0), (2, 0, 0.0), (3, 0, 0.0), (4, 1, 5.0), (5, 0, 0.0)]


def test_windows_must_fit_the_slots(spark):
    with pytest.raises(ValueError):
        trailing_activity(_orders(spark, [("a", "2024-01-01T00:00:00", 1.0)]), rules=VelocityRules(slot_s=1000))


def _decide(spark, orders, scores, rules=VelocityRules()):
    history = _orders(spark, orders)
    alerts = history.withColumns({
        "fraud_score": F.try_element_at(F.array(*[F.lit(s) for s in scores]), (F.col("order_id") + 1).cast("int")),
        "fraud_flags": F.array(F.lit("x")),
    })
    return {r.order_id: r for r in fraud.decide(alerts, history, rules).collect()}


def test_decisions_follow_the_rules(spark):
    orders = [
        ("a", "2024-01-01T10:00:00", 10.0),
        ("a", "2024-01-01T10:10:00", 10.0),
        ("a", "2024-01-01T10:20:00", 10.0),
        ("b", "2024-01-01T10:00:00", 750.0),     # 750 in the window + 750 again: exactly 1500
        ("c", "2024-01-01T10:00:00", 750.01),    # 1500.02
        ("d", "2024-01-01T10:00:00", 1.0),
    ]
    got = _decide(spark, orders, [0.5, 0.3, 0.3, 0.5, 0.5, 0.4999])
    assert [got[i].fraud_decision for i in range(6)] == ["REVIEW", "PASS", "BLOCK", "REVIEW", "BLOCK", "PASS"]
    assert got[2].all_fraud_flags == ["x", "velocity_orders_3_in_1h"]
    assert got[3].all_fraud_flags == ["x"]
    assert got[4].all_fraud_flags == ["x", "spend_limit_exceeded_1500"]
    assert got[4].combined_fraud_score == 0.85
    once = _decide(spark, orders, [0.5] * 6, VelocityRules(include_current=False))
    assert once[4].all_fraud_flags == ["x"]


def test_scores_are_capped_at_one(spark):
    got = _decide(spark, [("a", "2024-01-01T10:00:00", 2000.0)] * 3, [1.0] * 3)
    assert {r.combined_fraud_score for r in got.values()} == {1.0}


def test_latest_and_merged_orders(spark, rows):
    log = spark.createDataFrame(
        [("o1", "c", "pending", 1), ("o1", "c", "confirmed", 2), ("o2", "c", "failed", 1)],
        "order_id string, customer_id string, status string, batch_id int")
    now = upsert.latest(log, ["order_id", "customer_id"], "batch_id")
    assert rows(now, "order_id", "status") == [("o1", "confirmed"), ("o2", "failed")]
    decisions = spark.createDataFrame([("o1", "c", "BLOCK", 0.9)],
                                      "order_id string, customer_id string, fraud_decision string, combined_fraud_score double")
    merged = upsert.merge_decisions(now, decisions)
    assert rows(merged, "order_id", "fraud_decision") == [("o1", "BLOCK"), ("o2", None)]
    again = upsert.merge_decisions(merged, spark.createDataFrame([("o2", "c", "PASS", 0.1)], decisions.schema))
    assert rows(again, "order_id", "fraud_decision") == [("o1", "BLOCK"), ("o2", "PASS")]


def test_a_history_is_cut_to_the_reach_of_its_targets(spark, rows):
    """Rows that pass the filter follow the targets; keys of another type meet all the same."""
    hour = 3_600_000_000
    events = spark.range(200_000).select((F.col("id") % 2000).alias("k"), (F.floor(F.col("id") / 2000) * hour).alias("us"))
    events = events.withColumn("slot", F.floor(F.col("us") / hour))
    met = spark.createDataFrame([(7, 50), (7, 51), (1999, 99)], "k long, slot long")
    bits = velocity.filter_bits(3)
    needed = events.filter("(k = 7 and slot between 26 and 51) or (k = 1999 and slot between 75 and 99)")
    near = velocity.in_reach(events, met, 24, bits)
    assert needed.exceptAll(near).isEmpty()
    assert near.count() < 600
    exact = velocity.seen(events, met, ("k", "slot"), bits)
    assert {(7, 50), (7, 51), (1999, 99)} <= set(rows(exact, "k", "slot")) and exact.count() < 400
    targets = spark.createDataFrame([(1, 5, dt.datetime(2024, 1, 1, 10), 1.0)], "order_id long, customer_id int, created_at timestamp_ntz, total double")
    history = spark.createDataFrame([(5, dt.datetime(2024, 1, 1, 9, 30), 2.0)], "customer_id long, created_at timestamp_ntz, total double")
    assert rows(trailing_activity(targets, history), "orders_in_window", "spend_in_window") == [(1, 2.0)]
