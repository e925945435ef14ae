"""Cleaning, building, aggregates, sessions, stock and alarms on small exact cases."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.config import BACKLOG_ALARM, ERROR_ALARM
from marketlake.functions import lookups, text
from marketlake.functions.numeric import exact_avg, exact_sum, round_half_up
from marketlake.operators import alarms, builder, clean, curated, inventory, sessions
from marketlake.plans import reports

AT = dt.datetime.fromisoformat


def clicks(spark, data):
    return spark.createDataFrame(data, "event_id string, session_id string, customer_id string, timestamp string")


def test_click_cleaning_keeps_the_earliest_copy(spark, rows):
    raw = clicks(spark, [
        ("e1", "s", "c", "2026-04-13T14:30:01+00:00"),
        ("e1", "s", "c", "2026-04-13T14:30:00+00:00"),
        ("e2", "s", None, "2026-04-13T20:00:00Z"),
        (None, "s", None, "2026-04-13T20:00:00Z"),
        ("e3", "s", "c", "not a time"),
        ("e4", "s", "c", None),
    ])
    got = rows(clean.clean_clicks(raw), "event_id", "timestamp", "event_date", "event_hour", "is_authenticated")
    day = dt.date(2026, 4, 13)
    assert got == sorted([
        ("e1", "2026-04-13T14:30:00+00:00", day, 14, True),
        ("e2", "2026-04-13T20:00:00Z", day, 20, False),
        ("e3", "not a time", None, None, True),
        ("e4", None, None, None, True),
    ], key=repr)


def test_click_enrichment(spark, rows):
    raw = clicks(spark, [("e1", "s", "c", "2026-04-13T14:30:00+00:00"), ("e2", "s", None, "2026-04-18T23:59:59Z"), ("e3", "s", None, None)])
    now = F.lit("2026-04-19 01:00:00").cast("timestamp")
    got = rows(clean.enrich_clicks(raw, now), "event_id", "hour_of_day", "day_of_week", "is_weekend", "is_authenticated")
    assert got == [("e1", 14, "Monday", False, True), ("e2", 23, "Saturday", True, False), ("e3", 1, "Sunday", True, False)]


def test_order_cleaning(spark, rows):
    address = ("rio", "RJ", "BR")
    def order(oid, total, at="2024-01-01T10:00:00Z", score="0.5"):
        return {"order_id": oid, "total": total, "created_at": at, "fraud_score": score, "status": "confirmed", "shipping_address": address}
    raw = spark.createDataFrame(
        [order("o1", "10.5"), order("o1", "10.5", "2024-01-02T10:00:00Z"), order("o2", None), order(None, "1"),
         order("o3", "abc"), order("o4", "NaN"), order("o5", "7", score="x")], schemas.RAW_ORDER)
    got = rows(clean.clean_orders(raw), "order_id", "total", "fraud_score", "order_date", "shipping_state", "shipping_city")
    assert got == [("o1", 10.5, 0.5, dt.date(2024, 1, 1), "RJ", "rio"), ("o5", 7.0, None, dt.date(2024, 1, 1), "RJ", "rio")]


def test_explode_items_renames_freight_and_drops_empty_orders(spark, rows):
    orders = spark.createDataFrame(
        [("o1", "c", [("p1", "x", 2, 3.0, 0.5), ("p2", "y", 1, 4.0, 0.25)]), ("o2", "c", []), ("o3", "c", None)],
        "order_id string, customer_id string, items array<struct<product_id: string, category: string, quantity: int, unit_price: double, freight: double>>")
    assert rows(clean.explode_items(orders)) == [("o1", "c", "p1", "x", 3.0, 2, 0.5), ("o1", "c", "p2", "y", 4.0, 1, 0.25)]


def test_builder_fixture(spark):
    products = spark.createDataFrame([("abc123", "health_beauty"), ("def456", "computers_accessories"), ("ghi789", "bed_bath_table")], "product_id string, category string")
    tiers = spark.createDataFrame([("cust-aaa", "sao paulo", "SP", "gold"), ("cust-bbb", "rio de janeiro", "RJ", "bronze"), ("cust-ccc", "belo horizonte", "MG", "platinum")],
                                  "customer_id string, customer_city string, customer_state string, tier string")
    orders = spark.createDataFrame(
        [("ord-111", "cust-aaa", "delivered"), ("ord-222", "cust-bbb", "processing"), ("ord-333", "cust-ccc", "canceled"),
         ("ord-big", "cust-bbb", "delivered"), ("ord-none", "cust-aaa", "delivered"), ("ord-xyz", "nobody", "strange")],
        "order_id string, customer_id string, order_status string")
    payments = spark.createDataFrame(
        [("ord-111", 1, "credit_card", 1.0), ("ord-222", 1, "boleto", 1.0), ("ord-222", 2, "voucher", 1.0), ("ord-333", 1, "voucher", 1.0), ("ord-big", 1, "new_kind", 1.0)],
        "order_id string, payment_sequential int, payment_type string, payment_value double")
    items = spark.createDataFrame(
        [("ord-111", "abc123", 49.90, 5.0), ("ord-222", "def456", 120.0, 15.0), ("ord-333", "ghi789", 75.0, 8.0),
         ("ord-big", "abc123", 300.0, 10.0), ("ord-big", "def456", 300.0, 10.0), ("ord-xyz", "gone", 10.0, 1.0)],
        "order_id string, product_id string, price double, freight_value double")
    rates = spark.createDataFrame([("ord-111", 0.10)], "order_id string, discount_rate double")
    got = {r.order_id: r for r in builder.build_orders(orders, payments, items, products, tiers, F.lit("t"), rates).collect()}
    assert set(got) == {"ord-111", "ord-222", "ord-333", "ord-big", "ord-xyz"}
    for row in got.values():
        assert row.total == round(row.subtotal - row.discount, 2)
        assert row.subtotal == pytest.approx(sum(i.unit_price * i.quantity for i in row["items"]))
        assert row.shipping_address.country == "BR"
        assert row.payment_method in {"credit_card", "bank_transfer", "paypal", "debit_card"}
    assert (got["ord-111"].subtotal, got["ord-111"].discount, got["ord-111"].total) == (49.9, 4.99, 44.91)
    assert (got["ord-222"].payment_method, got["ord-222"].status) == ("bank_transfer", "pending")
    assert (got["ord-333"].payment_method, got["ord-333"].status) == ("paypal", "failed")
    assert got["ord-big"].is_suspicious and not got["ord-111"].is_suspicious
    odd = got["ord-xyz"]
    assert (odd.customer_tier, odd.shipping_address.city, odd.shipping_address.state, odd.status) == ("bronze", "unknown", "XX", "confirmed")
    assert odd["items"][0].category == "other"


def test_catalogue_and_tiers(spark, rows):
    products = spark.createDataFrame([("p1", "brinquedos"), ("p2", "sem"), ("p3", None), (None, "x")], "product_id string, product_category_name string")
    words = spark.createDataFrame([("brinquedos", "toys")], "product_category_name string, product_category_name_english string")
    items = spark.createDataFrame([("p1", 1.0), ("p1", 4.0), ("p1", 2.5), ("p2", 1.0), ("p2", 2.005), ("p2", None)], "product_id string, price double")
    assert rows(builder.catalogue(products, words, items)) == [("p1", "toys", 2.5, 0), ("p2", "sem", 1.5, 0), ("p3", "other", 50.0, 0)]
    people = spark.createDataFrame([(c,) for c in "abcde"], "customer_id string")
    orders = spark.createDataFrame([(c,) for c, n in zip("abcd", (5, 3, 2, 1)) for _ in range(n)], "customer_id string")
    assert rows(builder.customer_tiers(people, orders)) == [
        ("a", 5, "platinum"), ("b", 3, "gold"), ("c", 2, "silver"), ("d", 1, "bronze"), ("e", 1, "bronze")]


def test_training_interactions(spark, rows):
    items = spark.createDataFrame([("o1", "p", 1.5), ("o1", "p", 1.5), ("o2", "p", 2.0), ("o3", "p", 9.0)], "order_id string, product_id string, price double")
    orders = spark.createDataFrame([("o1", "c1", "invoiced"), ("o2", "c2", "shipped"), ("o3", "c1", "canceled")], "order_id string, customer_id string, order_status string")
    people = spark.createDataFrame([("c1", "u"), ("c2", "u")], "customer_id string, customer_unique_id string")
    (row,) = rows(builder.training_interactions(items, orders, people))
    assert row[:4] == ("u", "p", 3, 5.0) and row[4] == pytest.approx(math.log1p(3), rel=1e-6)


def orders_frame(spark, data):
    return spark.createDataFrame(
        [(o, c, s, t, f, st, AT(at), AT(at).date()) for o, c, s, t, f, st, at in data],
        "order_id string, customer_id string, status string, total double, fraud_score double, shipping_state string, created_at timestamp_ntz, order_date date")


def test_kpis_clv_state(spark):
    orders = orders_frame(spark, [
        ("o1", "a", "confirmed", 100.0, 0.5, "SP", "2024-01-01T01:00:00"),
        ("o2", "a", "confirmed", 50.0, 0.49, None, "2024-01-01T02:00:00"),
        ("o3", "b", "failed", 10.0, 0.0, "SP", "2024-01-01T03:00:00"),
        ("o4", "b", "confirmed", 500.0, None, "SP", "2024-01-02T03:00:00"),
        ("o5", None, "confirmed", 500.01, 0.9, "RJ", "2024-01-02T04:00:00"),
    ])
    kpi = {r.order_date.day: r for r in curated.daily_kpis(orders).collect()}
    assert (kpi[1].total_orders, kpi[1].gross_revenue, kpi[1].unique_customers, kpi[1].confirmed_orders, kpi[1].failed_orders, kpi[1].flagged_orders) == (3, 160.0, 2, 2, 1, 1)
    assert kpi[1].conversion_rate == pytest.approx(2 / 3) and kpi[1].fraud_rate == pytest.approx(1 / 3)
    assert kpi[2].unique_customers == 1 and kpi[2].avg_fraud_score == 0.9
    clv = {r.customer_id: r for r in curated.customer_clv(orders).collect()}
    assert [clv[c].clv_segment for c in ("a", "b", None)] == ["low", "medium", "high"]
    assert (clv["a"].order_count, clv["a"].active_days, clv["a"].first_order) == (2, 1, AT("2024-01-01T01:00:00"))
    state = {r.shipping_state: r for r in curated.state_revenue(orders).collect()}
    assert set(state) == {"SP", "RJ"} and state["SP"].gross_revenue == 600.0 and state["SP"].unique_customers == 2


def test_interactions_and_spend(spark, rows):
    items = spark.createDataFrame([("o1", "c", "p", 2, 10.0), ("o2", "c", "p", 3, 20.0)], "order_id string, customer_id string, product_id string, quantity int, unit_price double")
    (row,) = rows(curated.product_interactions(items))
    assert row[:5] == ("c", "p", 2, 5, 80.0) and row[5] == pytest.approx(math.log1p(10))
    orders = spark.createDataFrame([("a", 30.0, 2), ("a", None, None), ("b", 9.0, 0)], "customer_id string, total double, item_count int")
    assert rows(curated.spend_per_item(orders)) == [("a", 10.0), ("b", 9.0)]


def test_cohorts_skip_unconfirmed_first_orders(spark, rows):
    orders = orders_frame(spark, [
        ("o1", "a", "confirmed", 1.0, 0.0, "SP", "2024-01-15T00:00:00"),
        ("o2", "a", "confirmed", 1.0, 0.0, "SP", "2024-01-20T00:00:00"),
        ("o3", "a", "confirmed", 1.0, 0.0, "SP", "2024-03-02T00:00:00"),
        ("o4", "b", "failed", 1.0, 0.0, "SP", "2023-12-15T00:00:00"),
        ("o5", "b", "confirmed", 1.0, 0.0, "SP", "2024-01-31T00:00:00"),
        ("o6", None, "confirmed", 1.0, 0.0, "SP", "2024-01-31T00:00:00"),
    ])
    jan = dt.date(2024, 1, 1)
    assert rows(reports.cohort_retention(orders)) == [(jan, 0, 2), (jan, 2, 1)]


def test_report_windows(spark):
    orders = orders_frame(spark, [(f"o{i}", "a", "confirmed", 10.0, 0.6 if i % 2 else 0.1, "SP", f"2024-01-{i:02d}T05:00:00") for i in range(1, 21)])
    hourly = reports.hourly_orders(orders, "2024-01-20").collect()
    assert [r.hour for r in hourly] == ["2024-01-20 05:00", "2024-01-19 05:00"]
    trend = reports.fraud_trend(orders, 3).collect()
    assert [r.order_date.day for r in trend] == [18, 19, 20] and trend[0].mean_fraud_pct == 33.3333
    revenue = reports.latest_daily_revenue(curated.daily_kpis(orders), 2).collect()
    assert [r.order_date.day for r in revenue] == [19, 20]
    assert reports.daily_revenue(curated.daily_kpis(orders), dt.date(2024, 1, 20), 5).count() == 6


def test_payment_shares(spark):
    orders = spark.createDataFrame([("confirmed", "x", 10.0, 0.1)] * 2 + [("confirmed", "y", 5.0, None)] + [("failed", "z", 1.0, 0.0)],
                                   "status string, payment_method string, total double, fraud_score double")
    got = [(r.payment_method, r.order_count, r.share_pct, r.avg_fraud_score) for r in reports.payment_breakdown(orders).collect()]
    assert got == [("x", 2, 66.7, 0.1), ("y", 1, 33.3, None)]


def test_session_gaps(spark):
    def at(s):
        return (dt.datetime(2026, 4, 13, 14, 30) + dt.timedelta(seconds=s)).isoformat() + "+00:00"
    data = [("e1", "s1", None, at(0)), ("e2", "s1", "c", at(1799)), ("e3", "s1", "c", at(1799 + 1800)), ("e4", "s1", "c", at(1799 + 1800 + 1801)),
            ("e5", "s2", "d", at(5))]
    frame = clicks(spark, data).withColumn("timestamp", F.to_timestamp("timestamp"))
    got = sorted((r.session_id, r.event_count, r.customer_id, r.expires_at - int(r.last_seen.replace(tzinfo=dt.timezone.utc).timestamp()))
                 for r in sessions.sessionize(frame).collect())
    assert got == [("s1", 1, "c", 1800), ("s1", 3, "anonymous", 1800), ("s2", 1, "d", 1800)]


def test_ten_clicks_over_three_sessions(spark, rows):
    data = [(f"e{i}", f"sess-{i % 3}", None, "2026-04-13T14:30:00+00:00") for i in range(10)]
    frame = clicks(spark, data).withColumn("timestamp", F.to_timestamp("timestamp"))
    assert rows(sessions.sessionize(frame), "session_id", "event_count") == [("sess-0", 4), ("sess-1", 3), ("sess-2", 3)]


def test_stock(spark, rows):
    at = "2026-04-13T14:30:0"
    events = spark.createDataFrame(
        [(f"i{i}", f"P{s}", None if s == 4 else "toys", s, -1, "w", at + "0Z") for i, s in enumerate([95, 7, 2, 0, 10, 11, 3, 4])],
        "event_id string, product_id string, category string, current_stock int, delta int, warehouse_id string, timestamp string")
    got = rows(inventory.stock_alerts(events), "current_stock", "severity", "category")
    assert got == sorted([(7, "WARNING", "toys"), (2, "CRITICAL", "toys"), (0, "CRITICAL", "toys"), (10, "WARNING", "toys"),
                          (3, "CRITICAL", "toys"), (4, "WARNING", "unknown")], key=repr)
    subject = inventory.stock_alerts(events).filter("current_stock = 2").first().subject
    assert subject == "Low Inventory [CRITICAL] — toys / P2"


def test_stock_merge_keeps_category_and_replaces_warehouse(spark, rows):
    events = spark.createDataFrame(
        [("1", "p", "first", 9, "w1", "2026-01-01"), ("2", "p", "second", 5, "w2", "2026-01-02"), ("3", "q", None, 1, None, "2026-01-01")],
        "event_id string, product_id string, category string, current_stock int, warehouse_id string, timestamp string")
    latest = inventory.latest_stock(events)
    assert rows(latest) == [("p", "first", 5, "2026-01-02", "w2"), ("q", "unknown", 1, "2026-01-01", "unknown")]
    products = spark.createDataFrame([("p", "toys", 9.5, 0), ("r", "auto", 1.0, 7)], "product_id string, category string, unit_price double, stock_level int")
    assert rows(inventory.apply_stock(products, latest)) == [
        ("p", "toys", 9.5, 5, "2026-01-02", "w2"), ("q", "unknown", None, 1, "2026-01-01", "unknown"), ("r", "auto", 1.0, 7, None, None)]


def test_alarms(spark):
    base = dt.datetime(2024, 1, 1)
    def metric(minute, value, name="m"):
        return (name, base + dt.timedelta(minutes=minute), value)
    schema = "metric string, ts timestamp_ntz, value double"
    errors = spark.createDataFrame([metric(0, 2.0), metric(4, 2.0), metric(5, 2.0), metric(9, 3.0)], schema)
    assert [r.window_start for r in alarms.alarms(errors, ERROR_ALARM).collect()] == [base + dt.timedelta(minutes=5)]
    backlog = spark.createDataFrame(
        [metric(m, 1001.0) for m in (0, 1, 3, 4, 5, 6)] + [metric(2, 1000.0)] + [metric(m, 1001.0, "gap") for m in (0, 1, 3)], schema)
    got = sorted((r.metric, r.window_start.minute) for r in alarms.alarms(backlog, BACKLOG_ALARM).collect())
    assert got == [("m", 5), ("m", 6)]


def test_numbers_do_not_depend_on_partitioning(spark):
    df = spark.range(20000).select((F.col("id") % 977 / 100.0).alias("x"))
    want = df.agg(exact_sum(F.col("x")).alias("s"), exact_avg(F.col("x")).alias("a")).first()
    for parts in (1, 3, 7):
        assert df.repartition(parts).agg(exact_sum(F.col("x")).alias("s"), exact_avg(F.col("x")).alias("a")).first() == want
    assert df.limit(1).select(round_half_up(F.lit(2.675)), round_half_up(F.lit(0.125), 2), round_half_up(F.lit(2.5), 0)).first()[1:] == (0.13, 3.0)


def test_text_and_maps(spark):
    one = spark.range(1)
    got = one.select(
        text.title_label(F.lit("home_décor big-size")),
        text.category_key(F.lit("  Home Decor ")),
        text.category_matches(F.lit("Toys_big"), F.lit("toys")),
        text.category_matches(F.lit(None).cast("string"), F.lit("toys")),
        text.whole_number(F.lit(2.5)),
        lookups.payment_method(F.lit("crypto")),
        lookups.payment_method(F.lit(None).cast("string")),
        lookups.order_status(F.lit("invoiced")),
        lookups.order_status(F.lit("whatever")),
    ).first()
    assert tuple(got)[1:] == ("home_decor", True, False, "2", "credit_card", "credit_card", "pending", "confirmed")
    assert got[0].startswith("Home D") and got[0].endswith(" Big-Size")


def test_halves_go_away_from_zero_and_nan_is_null(spark, rows):
    from marketlake.functions.numeric import round_half_up, units

    df = spark.createDataFrame([(-2.675,), (2.675,), (-1.5,), (1.5,), (-0.001,), (float("nan"),), (None,)], "x double")
    got = [tuple(r) for r in df.select(round_half_up(F.col("x")), round_half_up(F.col("x"), 0), units(F.col("x"))).collect()]
    assert got == [(-2.68, -3.0, -26750), (2.68, 3.0, 26750), (-1.5, -2.0, -15000), (1.5, 2.0, 15000), (0.0, 0.0, -10), (None,) * 3, (None,) * 3]


def test_copies_and_stock_are_ordered_by_time_not_text(spark, rows):
    from marketlake.operators.inventory import latest_stock

    stamps = [("a", "2024-01-01T00:00:00.500000Z", 9), ("a", "2024-01-01T00:00:00Z", 1), ("b", "2024-01-01T02:00:00+02:00", 1), ("b", "2024-01-01T01:00:00+00:00", 9), ("b", "soon", 5), ("b", None, 6)]
    events = spark.createDataFrame(
        [(p, t, f"e{i}", n, "w", "c", "n") for i, (p, t, n) in enumerate(stamps)],
        "product_id string, timestamp string, event_id string, current_stock int, warehouse_id string, category string, product_name string",
    )
    assert rows(latest_stock(events), "product_id", "stock_level") == [("a", 9), ("b", 9)]
