"""Versions of a stream's state: the same rows as one fold of everything, with a constant number of folders."""

import datetime as dt
import random
from pathlib import Path

from pyspark.sql import functions as F

from marketlake.operators import sessions
from marketlake.sources import messages
from marketlake.streaming.clicks import ClickJob
from marketlake.streaming.inventory import StockJob
from marketlake.streaming.orders import OrderJob
from marketlake.streaming.sinks import run_now
from marketlake.streaming.snapshots import Snapshot, bucket_of
from test_streams import batch_orders, click, clicks, orders, put, split

SCHEMA = "k string, n bigint, bucket int"


def counts(spark, path, every=4):
    def fold(rows):
        return rows.groupBy("k").agg(F.sum("n").alias("n")).withColumn("bucket", bucket_of("k", 4))

    return Snapshot(spark, str(path), SCHEMA, "bucket", fold, every)


def batch(spark, keys):
    df = spark.createDataFrame([(k, 1) for k in keys], "k string, n bigint")
    return df.groupBy("k").agg(F.sum("n").alias("n")).withColumn("bucket", bucket_of("k", 4)).coalesce(1)


def folders(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).glob("*/bucket=*"))


def test_fifty_batches_leave_a_constant_number_of_folders(spark, tmp_path, rows):
    rng = random.Random(1)
    state, want, most = counts(spark, tmp_path), {}, 0
    early = None
    for i in range(50):
        keys = [f"k{rng.randrange(6)}" for _ in range(3)]
        for k in keys:
            want[k] = want.get(k, 0) + 1
        state.add(batch(spark, keys), i)
        if i in (7, 49):
            state.add(batch(spark, keys), i)  # a batch that is run again
        if i == 20:
            early, then = state.read(), dict(want)
        if i == 24:  # one fold later the frame still has its files and its version
            assert dict(rows(early, "k", "n")) == then
        most = max(most, len(folders(tmp_path)))
    assert dict(rows(state.read(), "k", "n")) == want
    # two versions of each bucket, and the batches after the version before the newest
    assert most <= 2 * 4 + 4 * (2 * 4 + 1) and len(list(Path(tmp_path).glob("*"))) <= 4 + 2 * 4 + 1
    assert len(state.read().inputFiles()) <= 4 + 4 * 5


def test_only_touched_parts_are_written_and_asked_parts_read(spark, tmp_path, rows):
    state = counts(spark, tmp_path, every=2)
    for i in range(2):
        state.add(batch(spark, [f"k{n}" for n in range(8)]), i)
    for i in range(2, 6):
        state.add(batch(spark, ["k0"]), i)
    bucket = spark.range(1).select(bucket_of(F.lit("k0"), 4)).first()[0]
    newest = max(int(f.split("/")[0][5:]) for f in folders(tmp_path) if f.startswith("upto"))
    assert [f for f in folders(tmp_path) if f.startswith(f"upto={newest}/")] == [f"upto={newest}/bucket={bucket}"]
    assert dict(rows(state.read(), "k", "n")) == {"k0": 6, **{f"k{n}": 2 for n in range(1, 8)}}
    one = state.read([bucket])
    assert dict(rows(one, "k", "n"))["k0"] == 6 and all(f"bucket={bucket}" in f for f in one.inputFiles())


def test_unfinished_folders_do_not_count(spark, tmp_path, rows):
    state = counts(spark, tmp_path, every=2)
    for i in range(3):
        state.add(batch(spark, ["a"]), i)
    (tmp_path / "upto=1" / "_SUCCESS").unlink()  # a fold that was cut off before it ended
    assert dict(rows(state.read(), "k", "n")) == {"a": 3}
    state.add(batch(spark, ["a"]), 3)
    assert dict(rows(state.read(), "k", "n")) == {"a": 4}
    assert counts(spark, tmp_path / "none").read().count() == 0


def test_old_folders_expire(spark, tmp_path, rows):
    state = counts(spark, tmp_path, every=1)
    for i in range(3):
        state.add(batch(spark, ["a"]), i)
    assert state.expire(dt.datetime(2020, 1, 1)) == 0
    assert state.expire(dt.datetime(2200, 1, 1)) > 0
    assert dict(rows(state.read(), "k", "n")) == {"a": 1}  # the batch after the versions


def test_jobs_that_fold_give_what_the_batch_gives(spark, tmp_path, rows):
    records = random.Random(3).sample(clicks(), 80)
    put(tmp_path / "clicks", split(records, 6))
    job = ClickJob(spark, str(tmp_path / "click-job"), buckets=3, every=2)
    run_now(job.start(messages.message_stream(spark, str(tmp_path / "clicks"), 1)))
    frame = spark.createDataFrame([(c["event_id"], c["session_id"], c["customer_id"], c["timestamp"]) for c in records],
                                  "event_id string, session_id string, customer_id string, timestamp string")
    want = sessions.sessionize(frame)
    assert list((tmp_path / "click-job/session_slots").glob("upto=*"))
    assert rows(job.sessions()) == rows(want)
    assert rows(job.session("hot")) == rows(want.filter("session_id = 'hot'"))
    limit = rows(want, "expires_at")[len(rows(want)) // 2][0]
    assert rows(job.sessions(limit)) == rows(want.filter(F.col("expires_at") > limit))

    records = random.Random(5).sample(orders(36), 36)
    put(tmp_path / "orders", split(records, 6))
    job = OrderJob(spark, str(tmp_path / "order-job"), buckets=3, every=2)
    plain = OrderJob(spark, str(tmp_path / "plain-job"))
    for j in (job, plain):
        run_now(j.start(messages.message_stream(spark, str(tmp_path / "orders"), 1)))
    assert list((tmp_path / "order-job/order_log").glob("upto=*"))
    columns = ("order_id", "orders_in_window", "spend_in_window", "fraud_decision")
    assert rows(job.decisions(), *columns) == rows(plain.decisions(), *columns)
    assert rows(job.order_log(), "order_id", "ts") == rows(plain.order_log(), "order_id", "ts")
    day = dt.date(2024, 1, 1)
    mine = job.customer_orders("hot", day, day)
    want = batch_orders(spark, records).filter((F.col("customer_id") == "hot") & (F.to_date("created_at") == F.lit(day)))
    assert rows(mine, "order_id") == rows(want, "order_id") and len(rows(mine)) > 0
    now = dt.datetime.now(dt.timezone.utc)
    assert job.orders(now).count() == 36 and job.orders(now + dt.timedelta(days=91)).count() == 0
    assert job.expire(now) == 0 and job.expire(now + dt.timedelta(days=91)) > 0


def test_expired_sessions_leave_the_state_as_a_whole(spark, tmp_path, rows):
    old = [click(i, "old", i * 1000) for i in range(3)]
    frame = spark.createDataFrame([(c["event_id"], c["session_id"], None, c["timestamp"]) for c in old],
                                  "event_id string, session_id string, customer_id string, timestamp string")
    slots = sessions.session_slots(frame)
    end = rows(sessions.merge_slots(slots), "expires_at")[0][0]
    assert rows(sessions.live_slots(slots, F.lit(end - 1))) == rows(slots)
    assert sessions.live_slots(slots, F.lit(end)).count() == 0
    fresh = {**click(9, "new", 0), "timestamp": dt.datetime.now(dt.timezone.utc).isoformat()}
    put(tmp_path / "in", [old, [fresh]])
    job = ClickJob(spark, str(tmp_path / "job"), keep_s=3600, every=1)
    run_now(job.start(messages.message_stream(spark, str(tmp_path / "in"), 1)))
    assert rows(job.sessions(), "session_id") == [("new",)]


def test_stock_folds_touch_few_buckets(spark, tmp_path, rows):
    def change(i, product):
        return {"event_id": f"i{i:03d}", "product_id": product, "category": "toys", "current_stock": i, "delta": -1,
                "warehouse_id": "w", "timestamp": (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)).isoformat() + "+00:00"}

    put(tmp_path / "in", [[change(i, f"p{i}") for i in range(20)], [change(30, "p1")], [change(31, "p1")], [change(32, "p2")]])
    job = StockJob(spark, str(tmp_path / "job"), buckets=8, every=1)
    run_now(job.start(messages.message_stream(spark, str(tmp_path / "in"), 1)))
    got = dict(rows(job.stock(), "product_id", "stock_level"))
    assert got == {**{f"p{i}": i for i in range(20)}, "p1": 31, "p2": 32}
    assert len(list((tmp_path / "job/changes/upto=2").glob("bucket=*"))) == 1
