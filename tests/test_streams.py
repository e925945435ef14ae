"""Streams give what the batch operators give, whatever the file split."""

import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.config import AlarmRule, VelocityRules
from marketlake.operators import alarms, clean, fraud, inventory, sessions
from marketlake.sources import messages
from marketlake.streaming import clicks as click_jobs
from marketlake.streaming.alarms import AlarmJob
from marketlake.streaming import sinks
from marketlake.streaming.inventory import StockJob, stock_stream
from marketlake.streaming.orders import REQUIRED, OrderJob
from marketlake.streaming.sinks import run_now
from marketlake.streaming.velocity_state import StateDecisionJob

BASE = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def iso(seconds):
    return (BASE + dt.timedelta(seconds=seconds)).isoformat()


def put(folder, groups):
    folder.mkdir(parents=True, exist_ok=True)
    for i, group in enumerate(groups):
        path = folder / f"{i:03d}.json"
        path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in group) + "\n")
        stamp = 1_700_000_000 + i * 10
        os.utime(path, (stamp, stamp))


def split(records, n):
    size = -(-len(records) // n)
    return [records[i : i + size] for i in range(0, len(records), size)]


def orders(n=60):
    rng = random.Random(2)
    out = []
    for i in range(n):
        out.append({
            "order_id": f"o{i:03d}", "customer_id": rng.choice(["hot", "hot", "c1", "c2", "c3"]), "customer_tier": rng.choice(["bronze", "gold"]),
            "items": [{"product_id": "p", "category": "toys", "quantity": 1, "unit_price": 1.0, "freight": 1.0}] * rng.randrange(1, 6),
            "total": round(rng.random() * 900, 2), "payment_method": rng.choice(["crypto", "credit_card"]), "status": rng.choice(["confirmed", "pending"]),
            "created_at": iso(i * 900), "is_suspicious": rng.random() < 0.4,
        })
    return out


def run_orders(spark, tmp_path, groups, files=1):
    put(tmp_path / "in", groups)
    job = OrderJob(spark, str(tmp_path / "job"))
    run_now(job.start(messages.message_stream(spark, str(tmp_path / "in"), files)))
    return job


def batch_orders(spark, records):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "body string")
    events = messages.good(messages.parse(df, schemas.ORDER_EVENT, REQUIRED))
    return fraud.score_orders(events).withColumn("created_at", F.to_timestamp("created_at"))


def test_order_stream_equals_batch_in_any_split(spark, tmp_path, rows):
    records = orders()
    scored = batch_orders(spark, records)
    want_log = rows(scored, "order_id", "fraud_score", "fraud_flags", "is_fraud")
    decided = fraud.decide(scored.filter("is_fraud"), scored, VelocityRules())
    columns = ("order_id", "orders_in_window", "spend_in_window", "fraud_decision", "combined_fraud_score", "all_fraud_flags")
    want = rows(decided, *columns)
    for n in (1, 4):
        job = run_orders(spark, tmp_path / str(n), split(records, n))
        assert rows(job.order_log(), "order_id", "fraud_score", "fraud_flags", "is_fraud") == want_log
        assert rows(job.decisions(), *columns) == want
        assert rows(job.alerts(), "order_id") == rows(scored.filter("is_fraud"), "order_id")
        assert rows(job.events(), "order_id", "status") == rows(scored, "order_id", "status")
        assert job.orders().count() == len(records)


def test_copies_bad_records_and_replays(spark, tmp_path, rows):
    records = orders(12)
    no_total = {k: v for k, v in records[0].items() if k != "total"}
    bad_time = {**records[0], "order_id": "late", "created_at": "sometime"}
    job = run_orders(spark, tmp_path, [records + records[:3], [*records[3:6], "{broken", no_total, bad_time]])
    assert job.order_log().count() == 12
    problems = sorted(r.problem for r in spark.read.parquet(str(tmp_path / "job/quarantine")).collect())
    assert problems == ["missing total", "unreadable", "unreadable created_at"]
    # the same batch written again leaves the same rows
    before = rows(job.decisions(), "order_id", "fraud_decision")
    stored = job.order_log().filter("batch_id = 0").drop("batch_id", "log_day", "processed_at")
    replay = spark.createDataFrame(stored.collect(), stored.schema)
    job.on_batch(replay, 0)
    assert job.order_log().count() == 12
    assert rows(job.decisions(), "order_id", "fraud_decision") == before


def click(i, session, at, customer=None):
    return {"event_id": f"e{i:03d}", "session_id": session, "customer_id": customer, "action": "view", "timestamp": iso(at), "duration_ms": 5}


def clicks(n=80):
    rng = random.Random(4)
    at, out = 0, []
    for i in range(n):
        at += rng.choice([10, 300, 1799, 1800, 1801])
        out.append(click(i, rng.choice(["hot", "hot", "s1", "s2"]), at, rng.choice([None, "c"])))
    return out


def run_clicks(spark, tmp_path, groups):
    put(tmp_path / "in", groups)
    job = click_jobs.ClickJob(spark, str(tmp_path / "job"))
    run_now(job.start(messages.message_stream(spark, str(tmp_path / "in"), 1)))
    return job


def test_sessions_equal_batch_in_any_split_and_order(spark, tmp_path, rows):
    records = clicks()
    frame = spark.createDataFrame([(json.dumps(r),) for r in records], "body string")
    typed = click_jobs.click_stream(frame).withColumn("timestamp", F.to_timestamp("timestamp"))
    columns = ("session_id", "first_seen", "last_seen", "event_count", "expires_at", "customer_id")
    want = rows(sessions.sessionize(typed), *columns)
    shuffled = random.Random(3).sample(records, len(records))
    for name, groups in {"one": [records], "five": split(records, 5), "mixed": split(shuffled, 4)}.items():
        assert rows(run_clicks(spark, tmp_path / name, groups).sessions(), *columns) == want


def test_no_click_vanishes(spark, tmp_path, rows):
    far, old, none = click(3, "far", 75 * 365 * 86400), click(4, "old", -99 * 86400), click(5, "none", 0)
    del none["timestamp"]
    bad = {**click(6, "s", 0), "timestamp": "garbage"}
    job = run_clicks(spark, tmp_path, [[click(1, "s", 0), far], [click(2, "s", 5), bad], [old, none, "{broken"]])
    assert rows(job.sessions(), "session_id", "event_count") == [("far", 1), ("none", 1), ("old", 1), ("s", 2)]
    assert rows(job.quarantine(), "problem") == [("unreadable timestamp",), ("unreadable",)]
    enriched = spark.read.schema("event_id string").json(str(tmp_path / "job/clicks"))
    assert rows(enriched, "event_id") == [(f"e{i:03d}",) for i in (1, 2, 3, 4, 5)]


def test_no_order_vanishes_and_times_do_not_matter(spark, tmp_path, rows):
    records = orders(8)
    records[2]["created_at"] = iso(-5 * 86400)
    records[3]["created_at"] = "2099-01-01T00:00:00+00:00"
    job = run_orders(spark, tmp_path, [[r] for r in records] + [["{broken"]])
    assert rows(job.order_log(), "order_id") == [(r["order_id"],) for r in records]
    assert spark.read.parquet(str(tmp_path / "job/quarantine")).count() == 1


def test_decisions_do_not_depend_on_the_order_of_arrival(spark, tmp_path, rows):
    records = orders(40)
    scored = batch_orders(spark, records)
    columns = ("order_id", "orders_in_window", "spend_in_window", "fraud_decision", "combined_fraud_score", "all_fraud_flags")
    want = rows(fraud.decide(scored.filter("is_fraud"), scored, VelocityRules()), *columns)
    shuffled = random.Random(5).sample(records, len(records))
    job = run_orders(spark, tmp_path, split(shuffled, 4))
    assert rows(job.decisions(), *columns) == want


def test_state_decisions_equal_the_logs(spark, tmp_path, rows):
    """Any split, any order of arrival, values of the state cut small, and a restart from the checkpoint."""
    records = orders(60)
    scored = batch_orders(spark, records)
    columns = ("order_id", "orders_in_window", "spend_in_window", "fraud_decision", "combined_fraud_score", "all_fraud_flags")
    want = rows(fraud.decide(scored.filter("is_fraud"), scored, VelocityRules()), *columns)
    shuffled = random.Random(6).sample(records, len(records))
    for name, groups, part in (("one", [shuffled], 1000), ("four", split(shuffled, 4), 2)):
        put(tmp_path / name, groups)
        job = StateDecisionJob(spark, str(tmp_path / f"job-{name}"), part=part)
        job.start(messages.message_stream(spark, str(tmp_path / name), 1)).awaitTermination()
        assert rows(job.decisions(), *columns) == want

    # some files, then a new query on the same checkpoint with the rest; copies of earlier orders change nothing
    groups = split(shuffled, 3)
    put(tmp_path / "late", groups[:1])
    job = StateDecisionJob(spark, str(tmp_path / "job-late"))
    job.start(messages.message_stream(spark, str(tmp_path / "late"), 1)).awaitTermination()
    first = rows(job.decisions(), *columns)
    put(tmp_path / "late", [groups[0], groups[1] + groups[0][:5], groups[2]])
    again = StateDecisionJob(spark, str(tmp_path / "job-late"))
    again.start(messages.message_stream(spark, str(tmp_path / "late"), 1)).awaitTermination()
    assert rows(again.decisions(), *columns) == want != first


def test_a_batch_lists_only_the_days_in_reach(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    for i in range(12):
        day = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i))], "x int, d date")
        sinks.write_parts(day, path, i, F.col("d"))
    assert sinks.parts_of(spark, path, 7) == [dt.date(2024, 1, 8)]
    near = sinks.read_parts(spark, path, "x int, log_day date, batch_id int", [dt.date(2024, 1, d) for d in (7, 8, 31)])
    assert rows(near, "x") == [(6,), (7,)] and len(near.inputFiles()) == 2


def test_enriched_clicks_go_to_hourly_folders(spark, tmp_path, rows):
    records = clicks(20)
    put(tmp_path / "in", split(records, 2) + [["no json"]])
    bodies = messages.message_stream(spark, str(tmp_path / "in"), 1)
    click_jobs.start_enriched(click_jobs.click_stream(bodies), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    back = spark.read.schema("event_id string, hour_of_day int, day_of_week string, year int, month int, day int, hour int").json(str(tmp_path / "out"))
    frame = click_jobs.click_stream(spark.createDataFrame([(json.dumps(r),) for r in records], "body string"))
    want = clean.enrich_clicks(frame)
    assert rows(back, "event_id", "hour_of_day", "day_of_week") == rows(want, "event_id", "hour_of_day", "day_of_week")
    assert back.filter("year > 2000 and month between 1 and 12 and hour between 0 and 23").count() == 20


def test_unique_clicks(spark, tmp_path):
    records = clicks(30)
    put(tmp_path / "in", [records, records[10:], records[:5]])
    stream = click_jobs.unique_clicks(click_jobs.click_stream(messages.message_stream(spark, str(tmp_path / "in"), 1)))
    sinks.start_files(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 30


def test_stock_stream_equals_batch(spark, tmp_path, rows):
    rng = random.Random(6)
    records = [{"event_id": f"i{i:03d}", "product_id": rng.choice(["hot", "hot", "p1", "p2"]), "category": rng.choice([None, "toys", "auto"]),
                "current_stock": rng.randrange(0, 20), "delta": -1, "warehouse_id": rng.choice(["w1", "w2"]), "timestamp": iso(i)} for i in range(40)]
    put(tmp_path / "in", [*split(records, 4), ["no json", {**records[0], "timestamp": "garbage"}]])
    job = StockJob(spark, str(tmp_path / "job"))
    run_now(job.start(messages.message_stream(spark, str(tmp_path / "in"), 1)))
    batch = stock_stream(spark.createDataFrame([(json.dumps(r),) for r in records], "body string"))
    assert rows(job.stock()) == rows(inventory.latest_stock(batch))
    assert rows(job.alerts()) == rows(inventory.stock_alerts(batch))
    assert rows(job.quarantine(), "problem") == [("unreadable timestamp",), ("unreadable",)]


def test_alarm_stream_equals_batch(spark, tmp_path, rows):
    rng = random.Random(8)
    data = [("m", BASE.replace(tzinfo=None) + dt.timedelta(seconds=i * 20), float(rng.choice([900, 1100, 1200]))) for i in range(120)]
    data = [d for d in data if d[1].minute != 17]
    schema = "metric string, ts timestamp_ntz, value double"
    rule = AlarmRule("backlog", 60, "max", "gt", 1150.0, 2)
    for part in split(rng.sample(data, len(data)), 3):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    job = AlarmJob(spark, str(tmp_path / "job"), rule)
    job.start(stream).awaitTermination()
    want = alarms.alarms(spark.createDataFrame(data, schema), rule).select("metric", F.col("window_start").cast("timestamp"), "stat")
    got = job.alarms().select("metric", "window_start", "stat")
    assert rows(got) == rows(want) and got.count() > 0
    assert set(rows(job.raised().select("metric", "window_start", "stat"))) >= set(rows(got))
