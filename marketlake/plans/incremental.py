"""The lake job by runs: each takes a folder of new raw orders and puts right only the days these change.

A run cleans its raw files together with the stored orders of the days it touches (days of new rows, and days that
hold an earlier copy of one), overwrites those days, makes their partials anew and folds the differences into the
keyed tables. The result equals the whole job over all raw files so far, whatever comes late.

Runs are numbered upwards. Every step writes to the run's own folders and reads only what earlier runs have finished,
and the run is noted as done last; so a run that broke off is simply started again, and a finished one does nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake import schemas
from marketlake.functions.numeric import finite
from marketlake.operators import clean, curated
from marketlake.operators.partials import DAY, PARTS
from marketlake.operators.velocity import MOST_BITS, seen
from marketlake.sources import lake as zones
from marketlake.streaming.sinks import matching
from marketlake.streaming.snapshots import Snapshot, bucket_of

KPIS = "daily_kpis"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
MONTH = "month"
BUCKET, SPLIT = "bucket", "_split"
#: Groups of keys that a state's rows are dealt in, at least one for each bucket.
GROUPS = 256
Day = dt.date | None


def _folder_name(day: Day) -> str:
    return NO_DAY if day is None else day.isoformat()


def _day_of(folder: str) -> Day:
    name = folder.split("=", 1)[1]
    return None if name == NO_DAY else dt.date.fromisoformat(name)


def _month(day: str) -> str:
    return day if day == NO_DAY else day[:7]


def on_days(days: Iterable[Day]) -> Column:
    """Rows of some days, with literals so that other days are not listed or read."""
    dated = [d for d in days if d is not None]
    found = F.col(DAY).isin(*dated) if dated else F.lit(False)
    return found | F.col(DAY).isNull() if None in set(days) else found


class LakeRuns:
    """The curated zone of a lake as state that follows its runs.

    `buckets` cuts each keyed table's state (fixed once the first run has written); `every` is the number of deltas
    that are folded at once.
    """

    def __init__(self, spark: SparkSession, lake: zones.Lake, buckets: int = 64, every: int = 16):
        self.spark = spark
        self.lake = lake
        self.buckets = buckets
        self.every = every
        self.done = Snapshot(
            spark, f"{lake.root}/runs", "day string, run bigint, part int", "part", every=every,
            fold=lambda rows: rows.groupBy("day", "part").agg(F.max("run").alias("run")),
        )

    def update(self, raw: str, run: int) -> list[Day]:
        """Take a folder of new raw orders into all tables; returns the days that were made anew."""
        if self._finished(run):
            return []
        days = self._ingest(raw, run)
        if days:
            self.curate(self._processed(days), list(days), run)
        return list(days)

    def curate(self, orders: DataFrame, days: list[Day], run: int) -> None:
        """Make the curated tables follow some days that have changed; `orders` are all processed orders of these days."""
        if self._finished(run):
            return
        latest = self._latest()
        self._drop_superseded(latest)
        self._write_partials(KPIS, curated.daily_kpis(orders), run)
        for name in PARTS:
            self._fold(name, orders, days, run, latest)
        noted = self.spark.createDataFrame([(_folder_name(d), run, 0) for d in days], self.done.schema)
        self.done.add(noted, run)
        self._delete(self._staged(run))

    def table(self, name: str) -> DataFrame:
        """A curated table as of the last finished run."""
        if name == KPIS:
            return self._partials(KPIS, self._latest())
        return PARTS[name].table(self._state(name).read())

    def publish(self) -> dict[str, int]:
        """Write the tables to the curated zone, where the SQL views read them; returns the rows of each."""
        return {n: zones.write_table(self.table(n), self.lake.curated(n)) for n in (KPIS, *PARTS)}

    # ---- raw to processed ----

    def _ingest(self, raw: str, run: int) -> dict[Day, bool]:
        """Clean new raw orders into the processed zone; returns the days touched and if they have rows.

        The merged days are staged first, by day, and their folders are moved when all are written: a run that breaks
        off while days are replaced goes on with those that are left.
        """
        staged, path = self._staged(run), self.lake.processed("orders")
        if not self._exists(f"{staged}/days/_SUCCESS"):
            self._delete(staged)
            new = zones.read_ndjson(self.spark, raw, schemas.RAW_ORDER)
            new = new.withColumns({c: finite(F.col(c).try_cast("double")) for c in ("total", "fraud_score")})
            merged, touched = new, []
            if self._exists(path):
                stored = zones.read_parquet(self.spark, path)
                fresh = zones.stored(clean.order_days(new), f"run-{run}-ids")
                near = seen(stored.select("order_id", DAY), fresh, ("order_id",), MOST_BITS)
                copies = near.join(fresh.select("order_id"), "order_id", "left_semi").select(DAY)
                touched = [r[0] for r in fresh.select(DAY).union(copies).distinct().collect()]
                merged = new.unionByName(stored.filter(on_days(touched)).select(*new.columns))
            zones.write_by_day(clean.clean_orders(merged, few_copies=True), f"{staged}/rows", DAY)
            full = [_day_of(s.getPath().getName()) for s in matching(self.spark, f"{staged}/rows/{DAY}=*")]
            rows = [(d, d in full) for d in {*full, *touched}]
            self.spark.createDataFrame(rows, f"{DAY} date, full boolean").coalesce(1).write.mode("overwrite").parquet(f"{staged}/days")
        days = {r[DAY]: r["full"] for r in zones.read_parquet(self.spark, f"{staged}/days").collect()}
        self._replace(f"{staged}/rows", path, [f"{DAY}={_folder_name(d)}" for d, full in days.items() if not full])
        return days

    def _processed(self, days: dict[Day, bool]) -> DataFrame:
        """All processed orders of some days."""
        path, schema = self.lake.processed("orders"), self._order_schema()
        folders = [f"{path}/{DAY}={_folder_name(day)}" for day, full in days.items() if full]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", path).parquet(*folders)

    def _order_schema(self) -> T.StructType:
        """The columns of processed orders, from their plan over no orders."""
        return clean.clean_orders(self.spark.createDataFrame([], schemas.RAW_ORDER)).schema

    def _staged(self, run: int) -> str:
        return f"{self.lake.root}/staging/orders/run={run}"

    # ---- processed to curated ----

    def _fold(self, name: str, orders: DataFrame, days: list[Day], run: int, latest: dict[str, int]) -> None:
        part = PARTS[name]
        self._write_partials(name, part.by_day(orders), run)
        changed = {_folder_name(d) for d in days}
        old = self._partials(name, {d: r for d, r in latest.items() if d in changed})
        now = latest | {d: run for d in changed}
        new = self._partials(name, {d: run for d in changed})
        key = F.concat_ws("\u0001", *part.keys)
        dealt = {BUCKET: bucket_of(key, self.buckets), SPLIT: self._split(key)}
        delta = part.delta(old.withColumns(dealt), new.withColumns(dealt), run, BUCKET, SPLIT)
        if part.span is not None:
            delta = zones.stored(delta, f"run-{run}-{name}")
            if not delta.filter("full").isEmpty():
                delta = part.respan(delta, self._partials(name, now))
        self._state(name).add(delta, run, gathered=part.span is None)

    def _split(self, key: Column) -> Column:
        """A key's group within its bucket: a bucket's rows may be many, and few buckets meet in a task."""
        return F.pmod(F.xxhash64(key, F.lit(SPLIT)), F.lit(max(1, GROUPS // self.buckets))).cast("int")

    def _state(self, name: str) -> Snapshot:
        part = PARTS[name]
        keys = ", ".join(f"{k} string" for k in part.keys)
        sums = ", ".join(f"{c} bigint" for c in part.added)
        ends = "" if part.span is None else ", first timestamp, last timestamp, full boolean, epoch bigint"
        split = self._split(F.concat_ws("\u0001", *part.keys))
        fold: Callable[[DataFrame], DataFrame] = lambda rows: part.fold(rows.withColumn(SPLIT, split), BUCKET, SPLIT)
        return Snapshot(
            self.spark, f"{self.lake.root}/state/{name}", f"{keys}, {sums}{ends}, {BUCKET} int", BUCKET, fold, self.every, gathered=True
        )

    def _write_partials(self, name: str, rows: DataFrame, run: int) -> None:
        """A run's partials, in folders by month: days alone would be too many small files."""
        dated = rows.withColumn(MONTH, F.date_format(DAY, "yyyy-MM")).hint("rebalance", F.col(MONTH))
        dated.write.mode("overwrite").partitionBy(MONTH).parquet(self._run_folder(name, run))

    def _run_folder(self, name: str, run: int | str) -> str:
        return f"{self.lake.root}/partials/{name}/run={run}"

    def _partials(self, name: str, runs: dict[str, int]) -> DataFrame:
        """The partials of some days, each from the run that made it last."""
        schema = self._partial_schema(name)
        wanted = {(run, _month(day)) for day, run in runs.items()}
        found = [folder for folder, run, month in self._partial_folders(name) if (run, month) in wanted]
        if not found:
            return self.spark.createDataFrame([], schema)
        typed = T.StructType([*schema.fields, T.StructField("run", T.LongType())])
        rows = self.spark.read.schema(typed).option("basePath", f"{self.lake.root}/partials/{name}").parquet(*found)
        # one row a day, so its size is bounded by the calendar
        current = self.spark.createDataFrame(list(runs.items()), "_day string, run bigint")
        day = F.coalesce(F.col(DAY).cast("string"), F.lit(NO_DAY))
        return rows.withColumn("_day", day).join(F.broadcast(current), ["_day", "run"], "left_semi").select(*schema.names)

    def _partial_folders(self, name: str) -> list[tuple[str, int, str]]:
        """(folder, run, month) of what is stored."""
        paths = [status.getPath() for status in matching(self.spark, f"{self._run_folder(name, '*')}/{MONTH}=*")]
        return [(p.toString(), int(p.getParent().getName().split("=")[1]), p.getName().split("=", 1)[1]) for p in paths]

    def _partial_schema(self, name: str):
        """The columns of a table's partials, from its plan over no orders."""
        orders = self.spark.createDataFrame([], self._order_schema())
        return (curated.daily_kpis(orders) if name == KPIS else PARTS[name].by_day(orders)).schema

    def _latest(self) -> dict[str, int]:
        """For each day the last finished run that made it; one entry a day."""
        return {r["day"]: r["run"] for r in self.done.read().collect()}

    def _finished(self, run: int) -> bool:
        return any(r >= run for r in self._latest().values())

    def _drop_superseded(self, latest: dict[str, int]) -> None:
        """Delete months of partials that later finished runs have replaced as a whole; nothing reads them any more."""
        last = max(latest.values(), default=-1)
        live = {(run, _month(day)) for day, run in latest.items()}
        for name in (KPIS, *PARTS):
            for folder, run, month in self._partial_folders(name):
                if run <= last and (run, month) not in live:
                    self._delete(folder)

    def _exists(self, path: str) -> bool:
        return bool(matching(self.spark, path))

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _replace(self, staged: str, into: str, gone: list[str]) -> None:
        """Move the folders that are staged over those of the same name, and delete those that are gone."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        target = hadoop(into)
        files = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = {p.getName(): p for p in (s.getPath() for s in matching(self.spark, f"{staged}/{DAY}=*"))}
        for s in matching(self.spark, f"{into}/{DAY}=*"):
            old = s.getPath()
            if (name := old.getName()) in names or name in gone:
                files.delete(old, True)
        files.mkdirs(target)
        for name, source in names.items():
            if not files.rename(source, hadoop(target, name)):
                raise OSError(f"{name} could not be moved to {into}")
