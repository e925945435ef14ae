"""A micro-batch with state writes its parts from few tasks, not a file from each task for each part."""

from pathlib import Path

from marketlake.config import VelocityRules
from marketlake.sources import messages
from marketlake.streaming.orders import OrderJob
from marketlake.streaming.sinks import run_now
from marketlake.streaming.velocity_state import StateDecisionJob
from test_streams import iso, orders, put


def spread_orders(n=120, days=4):
    return [{**o, "created_at": iso(i % days * 86_400 + i)} for i, o in enumerate(orders(n))]


def files_by_part(folder):
    return {p.name: len(list(p.glob("*.parquet"))) for p in Path(folder).glob("batch=0/*=*")}


def test_order_log_has_one_small_file_for_each_day(spark, tmp_path, rows):
    records = spread_orders()
    put(tmp_path / "in", [records])
    job = OrderJob(spark, str(tmp_path / "job"))
    run_now(job.start(messages.message_stream(spark, str(tmp_path / "in"))))
    assert files_by_part(tmp_path / "job/order_log") == {f"log_day=2024-01-0{k}": 1 for k in range(1, 5)}
    assert rows(job.order_log(), "order_id") == sorted((r["order_id"],) for r in records)
    assert not list((tmp_path / "job").glob("*/_staged"))


def test_state_decisions_have_one_small_file_for_each_bucket(spark, tmp_path):
    put(tmp_path / "in", [spread_orders()])
    job = StateDecisionJob(spark, str(tmp_path / "job"), VelocityRules(max_spend=500.0), buckets=4)
    job.start(messages.message_stream(spark, str(tmp_path / "in"))).awaitTermination()
    found = files_by_part(tmp_path / "job/fraud_decisions")
    assert len(found) == 4 and set(found.values()) == {1}
