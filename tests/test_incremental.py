"""The lake by runs against the whole job over the same raw files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from marketlake.operators.partials import PARTS
from marketlake.plans import batch_job
from marketlake.plans.incremental import KPIS, LakeRuns
from marketlake.sources import lake as zones


def order(rng, oid, day):
    at = rng.choice([f"2024-01-{day:02d}T{rng.randrange(24):02d}:00:00Z"] * 9 + [None])
    return {
        "order_id": oid, "customer_id": rng.choice(["c1", "c2", "c3", "c4", None]), "status": rng.choice(["confirmed", "confirmed", "failed"]),
        "total": rng.choice(["10.25", "99.9", "1500", "bad"]), "fraud_score": rng.choice(["0.1", "0.7", None]), "created_at": at,
        "shipping_address": {"city": "x", "state": rng.choice(["SP", "RJ", None]), "country": "BR"},
        "items": [{"product_id": rng.choice("pq"), "category": "toys", "quantity": rng.choice([1, 2, None]), "unit_price": 5.5, "freight": 1.0}
                  for _ in range(rng.randrange(3))],
    }


def put(path, records):
    path.mkdir(parents=True)
    (path / "a.json").write_text("\n".join(json.dumps(r) for r in records))


def content(df):
    names = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def whole(spark, tmp_path, raws):
    """Each table by the whole job over the raw folders given."""
    lake = zones.Lake(str(tmp_path))
    for i, raw in enumerate(raws):
        (tmp_path / "raw/orders").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"raw/orders/{i}.json").write_text((raw / "a.json").read_text())
    (tmp_path / "raw/clickstream").mkdir(parents=True)
    batch_job.run(spark, lake)
    return {n: content(zones.read_parquet(spark, lake.curated(n))) for n in (KPIS, *PARTS)}


def test_every_run_equals_the_whole_job(spark, tmp_path):
    """Late orders, copies that move an order to an earlier day or take its status away, null days and keys."""
    rng = random.Random(5)
    job = LakeRuns(spark, zones.Lake(str(tmp_path / "lake")), buckets=3, every=2)
    raws = []
    for run in range(4):
        days = [1, 2, 3] if run == 0 else [rng.randrange(1, 6), 6 + run]
        new = [order(rng, f"o{run}-{i}", rng.choice(days)) for i in range(12)]
        copies = [order(rng, f"o{rng.randrange(run)}-{rng.randrange(12)}", rng.choice(days)) for _ in range(5)] if run else []
        raws.append(tmp_path / f"new{run}")
        put(raws[-1], new + copies + new[:2])
        assert job.update(str(raws[-1]), run)
        want = whole(spark, tmp_path / f"whole{run}", raws)
        for name in (KPIS, *PARTS):
            assert content(job.table(name)) == want[name], (run, name)
    assert job.update(str(raws[-1]), 3) == []
    assert job.publish() == {n: len(rows) for n, rows in want.items()}


def plain(oid, day, customer="c1", status="confirmed", hour=10):
    return order(random.Random(1), oid, day) | {
        "created_at": f"2024-01-{day:02d}T{hour:02d}:00:00Z", "customer_id": customer, "status": status, "total": "20"}


def test_only_touched_days_are_written(spark, tmp_path):
    job = LakeRuns(spark, zones.Lake(str(tmp_path / "lake")), buckets=8)
    put(tmp_path / "a", [plain(f"o{d}", d, f"c{d}") for d in range(1, 9)])
    job.update(str(tmp_path / "a"), 0)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "lake/processed").rglob("*.parquet")}
    put(tmp_path / "b", [plain("late", 3, "c3")])
    assert [str(d) for d in job.update(str(tmp_path / "b"), 1)] == ["2024-01-03"]
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "lake/processed").rglob("*.parquet")}
    assert {f.parent.name for f in set(before.items()) ^ set(after.items()) for f in [f[0]]} == {"order_date=2024-01-03"}
    for name in (KPIS, *PARTS):
        made = spark.read.parquet(str(tmp_path / f"lake/partials/{name}/run=1")).select("order_date").distinct().collect()
        assert [str(r[0]) for r in made] in (["2024-01-03"], [])
        if name in PARTS:
            assert len(list((tmp_path / f"lake/state/{name}/batch=1").glob("bucket=*"))) <= 1
    assert {r.customer_id: r.order_count for r in job.table("customer_clv").collect()}["c3"] == 2


def test_a_lost_first_order_is_found_again(spark, tmp_path):
    """An earlier copy takes a customer's only order of a day to another day and another state of payment."""
    job = LakeRuns(spark, zones.Lake(str(tmp_path / "lake")), buckets=2)
    put(tmp_path / "a", [plain("x", 2), plain("y", 5), plain("z", 7)])
    job.update(str(tmp_path / "a"), 0)
    put(tmp_path / "b", [plain("x", 1, status="failed"), plain("z", 6, "c2")])
    assert len(job.update(str(tmp_path / "b"), 1)) == 4
    got = {r.customer_id: (r.order_count, r.first_order.day, r.last_order.day, r.active_days) for r in job.table("customer_clv").collect()}
    assert got == {"c1": (1, 5, 5, 1), "c2": (1, 6, 6, 1)}
    assert sorted(str(r.order_date) for r in job.table(KPIS).collect()) == ["2024-01-01", "2024-01-05", "2024-01-06"]


@pytest.mark.parametrize("at", ["ingest", "fold", "note"])
def test_a_broken_run_is_started_again(spark, tmp_path, monkeypatch, at):
    job = LakeRuns(spark, zones.Lake(str(tmp_path / "lake")), buckets=2)
    raws = [tmp_path / "a", tmp_path / "b"]
    put(raws[0], [plain("x", 2), plain("y", 5), plain("w", 5, "c2")])
    put(raws[1], [plain("x", 1), plain("v", 5, "c2"), plain("u", 9)])
    job.update(str(raws[0]), 0)

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if at == "ingest":
            m.setattr(zones, "write_by_day", broken)
        elif at == "fold":
            real, calls = LakeRuns._fold, []

            def second_breaks(self, name, *rest):
                calls.append(name)
                return broken() if len(calls) == 2 else real(self, name, *rest)

            m.setattr(LakeRuns, "_fold", second_breaks)
        else:
            m.setattr(job.done, "add", broken)
        with pytest.raises(RuntimeError):
            job.update(str(raws[1]), 1)
    assert job.update(str(raws[1]), 1)
    want = whole(spark, tmp_path / "whole", raws)
    for name in (KPIS, *PARTS):
        assert content(job.table(name)) == want[name], name


def test_empty_run(spark, tmp_path):
    job = LakeRuns(spark, zones.Lake(str(tmp_path / "lake")))
    put(tmp_path / "a", [])
    assert job.update(str(tmp_path / "a"), 0) == []
    assert job.table(KPIS).count() == 0 and job.table("customer_clv").count() == 0


def test_a_run_that_breaks_off_while_days_are_moved(spark, tmp_path, monkeypatch):
    job = LakeRuns(spark, zones.Lake(str(tmp_path / "lake")), buckets=2)
    raws = [tmp_path / "a", tmp_path / "b"]
    put(raws[0], [plain("x", 2), plain("y", 5)])
    put(raws[1], [plain("x", 1), plain("v", 5, "c2"), plain("u", 9)])
    job.update(str(raws[0]), 0)
    real = LakeRuns._replace

    def half(self, staged, into, gone):
        kept = tmp_path / "kept"
        (tmp_path / "lake/staging/orders/run=1/rows/order_date=2024-01-09").rename(kept)
        real(self, staged, into, [])
        kept.rename(tmp_path / "lake/staging/orders/run=1/rows/order_date=2024-01-09")
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(LakeRuns, "_replace", half)
        with pytest.raises(RuntimeError):
            job.update(str(raws[1]), 1)
    assert len(job.update(str(raws[1]), 1)) == 4
    want = whole(spark, tmp_path / "whole", raws)
    for name in (KPIS, *PARTS):
        assert content(job.table(name)) == want[name], name


def test_deltas_and_states_are_shuffled_once(spark):
    """Rows come out of their sums dealt by bucket, and no rebalance follows."""
    part = PARTS["product_interactions"]
    keys = spark.range(10).select(F.lit("c").alias("customer_id"), F.col("id").cast("string").alias("product_id"))
    rows = keys.select("*", *[F.lit(1).cast("bigint").alias(c) for c in part.added], F.lit(0).alias("bucket"), F.lit(1).alias("_split"))
    for out in (part.delta(rows, rows, 1, "bucket", "_split"), part.fold(rows, "bucket", "_split")):
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
