"""Files: the whole lake job, daily overwrite, views, CSV."""

import datetime as dt
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.plans import batch_job
from marketlake.session import shared_folder
from marketlake.sources import csv_tables, lake, messages


def order(oid, total, at, status="confirmed", customer="c1", state="SP"):
    return {
        "order_id": oid, "customer_id": customer, "status": status, "total": str(total), "fraud_score": "0.55", "created_at": at,
        "shipping_address": {"city": "x", "state": state, "country": "BR"},
        "items": [{"product_id": "p1", "category": "toys", "quantity": 2, "unit_price": 5.0, "freight": 1.5}],
    }


def click(eid, at, customer="c1"):
    return {"event_id": eid, "session_id": "s", "customer_id": customer, "action": "view", "timestamp": at, "duration_ms": 1000}


def put(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))


def test_job_end_to_end(spark, tmp_path):
    root = lake.Lake(str(tmp_path))
    put(tmp_path / "raw/orders/2024", "a.json", [order("o1", 10, "2024-01-01T10:00:00Z"), order("o2", 20, "2024-01-02T10:00:00Z", "failed")])
    put(tmp_path / "raw/orders/2024/deep", "b.json", [order("o1", 10, "2024-01-01T10:00:00Z"), order("o3", 5, "2024-01-02T11:00:00Z", state=None)])
    put(tmp_path / "raw/clickstream", "c.json", [click("e1", "2024-01-01T00:00:00Z"), click("e1", "2024-01-01T00:00:00Z"), click("e2", "2024-01-02T00:00:00Z", None)])
    assert batch_job.run(spark, root) == {
        "clickstream": 2, "orders": 3, "daily_kpis": 2, "customer_clv": 1, "product_interactions": 1, "state_revenue": 1}
    names = lake.register_views(spark, root)
    assert {"processed_orders", "processed_clickstream", "curated_daily_kpis", "curated_customer_clv", "curated_state_revenue", "order_items"} <= set(names)
    row = spark.sql(
        "SELECT item.product_id, count(DISTINCT order_id) AS n, sum(item.quantity * item.unit_price) AS revenue, avg(item.freight_value) AS freight "
        "FROM processed_orders LATERAL VIEW explode(items) t AS item WHERE status = 'confirmed' AND order_date >= DATE '2024-01-01' GROUP BY 1"
    ).first()
    assert tuple(row) == ("p1", 2, 20.0, 1.5)
    assert spark.sql("SELECT sum(freight_value) FROM order_items").first()[0] == 4.5
    assert spark.table("curated_daily_kpis").agg(F.sum("total_orders")).first()[0] == 3
    # running again changes nothing
    assert batch_job.run(spark, root)["orders"] == 3
    assert spark.read.parquet(root.processed("orders")).count() == 3


def test_empty_raw_zone_is_skipped(spark, tmp_path):
    for name in ("orders", "clickstream"):
        (tmp_path / "raw" / name).mkdir(parents=True)
    assert batch_job.run(spark, lake.Lake(str(tmp_path))) == {"clickstream": 0, "orders": 0}


def test_only_written_days_are_replaced(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 2))], "k string, day date")
    assert lake.write_by_day(df, path, "day") == 2
    assert lake.write_by_day(spark.createDataFrame([("c", dt.date(2024, 1, 2))], df.schema), path, "day") == 1
    assert rows(spark.read.parquet(path), "k") == [("a",), ("c",)]


def test_partition_filter_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 2))], "k string, day date")
    lake.write_by_day(df, path, "day")
    plan = spark.read.parquet(path).filter(F.col("day") >= F.date_sub(F.lit("2024-01-02").cast("date"), 0))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_csv_tables(spark, tmp_path):
    texts = {
        "orders": "extra,order_id,customer_id,order_status\nx,o1,c1,delivered\n",
        "order_items": "order_id,product_id,price,freight_value\no1,p1,10.5,1\no1,p2,bad,2\n",
        "payments": "order_id,payment_sequential,payment_type,payment_value\no1,1,boleto,10\n",
        "customers": "customer_id,customer_unique_id,customer_city,customer_state\nc1,u1,\"sao, paulo\",SP\n",
        "products": "product_id,product_category_name\np1,\n",
        "sellers": "seller_id\ns1\n",
        "translations": "product_category_name,product_category_name_english\nbrinquedos,toys\n",
    }
    for name, body in texts.items():
        (tmp_path / f"shop_{name}.csv").write_text(body)
    got = csv_tables.read_csv_tables(spark, str(tmp_path), "shop_{table}.csv")
    assert set(got) == set(schemas.CSV_TABLES)
    assert [tuple(r) for r in got["order_items"].orderBy("product_id").collect()] == [("o1", "p1", 10.5, 1.0), ("o1", "p2", None, 2.0)]
    assert got["orders"].columns == ["order_id", "customer_id", "order_status"]
    assert got["customers"].first().customer_city == "sao, paulo"
    assert got["products"].first().product_category_name is None


def test_bad_messages_are_set_apart(spark):
    good = {"product_id": "p", "current_stock": 3}
    bodies = [json.dumps(good), "{oops", json.dumps({"product_id": "p", "current_stock": "many"}), json.dumps({"product_id": "p"}), None, "[]", ""]
    df = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "message_id string, body string")
    parsed = messages.parse(df, schemas.INVENTORY_EVENT, ["product_id", "current_stock"])
    assert messages.good(parsed).count() == 1
    problems = {r.message_id: r.problem for r in messages.bad(parsed).collect()}
    assert set(problems) == {"1", "2", "3", "4", "5", "6"}
    assert problems["3"] == "missing current_stock" and problems["1"] == problems["2"] == "unreadable"


def test_alert_envelope_and_bare_body(spark):
    alert = json.dumps({"order_id": "o", "customer_id": "c", "total": 5.5, "fraud_flags": ["x"]})
    df = spark.createDataFrame([(json.dumps({"Message": alert}),), (alert,)], "body string")
    got = messages.good(messages.parse_alerts(df)).collect()
    assert len(got) == 2 and {(r.order_id, r.total, tuple(r.fraud_flags)) for r in got} == {("o", 5.5, ("x",))}


class FakeSession:
    """A session as far as the shared folder is concerned."""

    def __init__(self, master, settings):
        self.conf = settings
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{id(self)}")


def test_shared_folder_comes_from_the_session():
    assert shared_folder(FakeSession("yarn", {"spark.checkpoint.dir": "hdfs://x/work/"})) == "hdfs://x/work"
    with pytest.raises(ValueError):
        shared_folder(FakeSession("yarn", {}))
    alone = FakeSession("local[2]", {})
    assert shared_folder(alone) == shared_folder(alone)
