"""The raw zone's files are compressed, and finding the days of new orders moves ids and times only."""

import gzip
from pathlib import Path

from pyspark.sql import functions as F

from marketlake import schemas
from marketlake.operators import clean
from marketlake.operators.velocity import MOST_BITS, may_be_among
from marketlake.plans import lake_reports
from marketlake.sources import lake as zones

TIMES = ["2024-01-01T23:30:00-03:00", "2024-01-02T02:30:00Z", "2024-01-05T00:00:00Z", "sometime", None]


def test_messages_are_the_same_in_short_compressed_files(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(zones, "FILE_ROWS", 7)
    bodies = spark.range(50).select(F.concat(F.lit("m"), "id").alias("body"), (F.col("id") % 2).alias("run")).coalesce(2)
    zones.write_ndjson(bodies, str(tmp_path / "by"), "run")
    zones.write_ndjson(bodies.select("body"), str(tmp_path / "all"))
    for folder, want in (("by/run=0", range(0, 50, 2)), ("by/run=1", range(1, 50, 2)), ("all", range(50))):
        files = list((tmp_path / folder).glob("*.gz"))
        assert all(len(gzip.open(f).readlines()) <= 7 for f in files)
        assert rows(spark.read.text(str(tmp_path / folder)), "value") == sorted((f"m{k}",) for k in want)


def test_order_days_are_those_of_the_cleaned_orders(spark, rows):
    some = [(f"o{k % 9}", "1.5" if k % 7 else "bad", TIMES[k % 5]) for k in range(60)] + [(None, "1", TIMES[0]), ("x", None, TIMES[0])]
    raw = spark.createDataFrame(some, "order_id string, total string, created_at string")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.RAW_ORDER.fields if f.name not in raw.columns]
    raw = raw.select("*", *empty)
    assert rows(clean.order_days(raw), "order_id", "order_date") == rows(clean.clean_orders(raw), "order_id", "order_date")


def test_runs_have_compressed_messages_and_no_copy_of_them(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(zones, "stored", lambda df, name: made.append(name) or df)
    body = F.format_string('{"created_at": "2024-01-%02dT00:00:00Z"}', (F.col("id") + 1).cast("int")).alias("body")
    days = spark.range(30)
    created = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp_ntz")
    monkeypatch.setattr(lake_reports, "order_bodies", lambda *a: days.select(body))
    monkeypatch.setattr(lake_reports.t, "orders", lambda *a: days.select(created.alias("created_at")))
    lake_reports._raw_orders_by_run(spark, "unused", str(tmp_path / "raw"))
    assert not made and not list(Path(tmp_path).rglob("*.txt"))
    found = [spark.read.text(str(tmp_path / f"raw/run={k}")).count() for k in range(lake_reports.RUNS)]
    assert found == [10, 10, 11]  # the 15th, of the second run, comes again in the third


def test_orders_without_a_copy_are_not_shuffled(spark, tmp_path, rows):
    """The same orders as by the plain way; only those of two ids travel."""
    some = [(f"o{k}", str(k), TIMES[k % 5], "confirmed") for k in range(400)]
    some += [("o3", "7", TIMES[0], "failed"), ("o3", "8", TIMES[0], "failed"), ("o9", "1", TIMES[2], "failed"), (None, "1", TIMES[0], "x")]
    spark.createDataFrame(some, "order_id string, total string, created_at string, status string").write.json(str(tmp_path / "raw"))
    raw = zones.read_ndjson(spark, str(tmp_path / "raw"), schemas.RAW_ORDER)
    plain, few = clean.clean_orders(raw, F.lit(0)), clean.clean_orders(raw, F.lit(0), few_copies=True)
    assert few.columns == plain.columns and rows(few) == rows(plain) and few.count() == 400
    marked = may_be_among(raw, spark.createDataFrame([("o3",), ("o9",)], "order_id string"), ("order_id",), MOST_BITS, "copied")
    assert 4 <= marked.filter("copied").count() < 40 and marked.count() == raw.count()
