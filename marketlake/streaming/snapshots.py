"""State folded from the batches of a stream: versions by part, so that reading never grows with the number of batches.

Below one folder every batch owns `batch=<id>/<part>=...`. After some batches the ones that are certainly committed
are folded into a version `upto=<id>/<part>=...`, which holds only the parts those batches touched; untouched parts
stay where the last version that has them left them. A part is a day, or a hash bucket of a key. A reader takes of each
part its newest version, and the batches after the newest version.

A folder counts only when its writer has left the marker file of a finished job, which comes last: that is the switch
to a new version, and a half-written folder is overwritten by the next try. Folders are deleted one version late, so
a frame that was read before a switch still has its files during the next one. Batches run again are not counted
twice: a folded batch is older than the newest version and no longer read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlake.streaming.sinks import STAGED, matching, rebalancing

BATCH, VERSION, MARKER = "batch", "upto", "_SUCCESS"


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Snapshot:
    """A folder of batches and versions.

    `schema` names the columns, the part's among them. `fold` reduces rows of old versions and batches to the state's
    rows; it must keep the columns and give the same from any cut of the rows, and rows it meets together share a part.
    `every` is the number of open batches that are folded at once, so at most `every` and one are read beside the versions.
    `gathered` says that `fold` leaves few parts in a task, so its rows are written without another shuffle.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str | StructType, part: str,
        fold: Callable[[DataFrame], DataFrame] = lambda rows: rows, every: int = 16,
        gathered: bool = False,
    ):
        self.spark = spark
        self.path = path
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        self.part = part
        self.fold = fold
        self.every = every
        self.gathered = gathered

    def add(self, rows: DataFrame, batch_id: int, gathered: bool = False) -> None:
        """Write a batch, over an earlier try of the same one, and fold the batches before it if they are enough.

        `gathered` rows have few parts in a task.
        """
        staged = f"{self.path}/{STAGED}"
        picked = rows.select(*self.schema.names)
        self._write(picked if gathered else rebalancing(self.spark, picked, staged), f"{self.path}/{BATCH}={batch_id}", gathered)
        self._delete(staged)
        before = [b for b in self._open() if b < batch_id]
        if len(before) >= self.every:
            self.fold_batches(before)

    def fold_batches(self, batches: list[int]) -> None:
        """Fold open batches: only the parts they touch are read and written."""
        touched = {part for b in batches for part in self._parts(f"{BATCH}={b}")}
        self._write(self.fold(self._rows(touched, batches)), f"{self.path}/{VERSION}={max(batches)}", self.gathered)
        self._clean()

    def read(self, parts: Iterable[object] | None = None) -> DataFrame:
        """The state's rows, of all parts or of some; other parts are neither listed nor read."""
        wanted = None if parts is None else {str(p) for p in parts}
        return self.fold(self._rows(wanted, self._open()))

    def batch(self, batch_id: int) -> DataFrame:
        """The rows of one batch that is not yet folded, as they were written."""
        return self._load([f"{self.path}/{BATCH}={batch_id}"])

    def batch_parts(self, batch_id: int) -> list[str]:
        """The parts that a batch has written, from folder names alone."""
        return sorted(self._parts(f"{BATCH}={batch_id}"))

    def expire(self, before: dt.datetime) -> int:
        """Delete the folders of versions finished before a time: all their rows are older. Returns the folders deleted.

        A part that was folded again since is in a younger version; what is old there goes by the reader's own test.
        """
        limit = before.timestamp() * 1000
        newest = max(self._ids(VERSION), default=None)
        gone = 0
        for version, finished in self._ids(VERSION).items():
            if finished < limit:
                for folder in self._parts(f"{VERSION}={version}").values():
                    gone += self._delete(folder)
                if version != newest:  # the newest marker tells which batches are folded
                    self._delete(f"{self.path}/{VERSION}={version}")
        return gone

    def _write(self, rows: DataFrame, folder: str, gathered: bool) -> None:
        picked = rows.select(*self.schema.names)
        picked = picked if gathered else picked.hint("rebalance", self.part)
        picked.write.mode("overwrite").partitionBy(self.part).parquet(folder)

    def _ids(self, kind: str) -> dict[int, int]:
        """Finished batches or versions, with the time of their marker."""
        found = matching(self.spark, f"{self.path}/{kind}=*/{MARKER}")
        return {int(s.getPath().getParent().getName().split("=")[1]): s.getModificationTime() for s in found}

    def _open(self) -> list[int]:
        # versions first: a batch that a version met here has folded is not looked for
        newest = max(self._ids(VERSION), default=-1)
        return sorted(b for b in self._ids(BATCH) if b > newest)

    def _parts(self, folder: str) -> dict[str, str]:
        found = [str(s.getPath().toString()) for s in matching(self.spark, f"{self.path}/{folder}/{self.part}=*")]
        return {path.rsplit("=", 1)[1]: path for path in found}

    def _state(self, upto: int | None = None) -> dict[str, int]:
        """For each part the newest version that has it, of all versions or of those up to one."""
        done = self._ids(VERSION)
        newest: dict[str, int] = {}
        for s in matching(self.spark, f"{self.path}/{VERSION}=*/{self.part}=*"):
            part, version = s.getPath().getName().split("=", 1)[1], int(s.getPath().getParent().getName().split("=")[1])
            if version in done and (upto is None or version <= upto):
                newest[part] = max(version, newest.get(part, -1))
        return newest

    def _rows(self, parts: set[str] | None, batches: list[int]) -> DataFrame:
        """Rows of some parts (all: None): their newest version before the first open batch's fold, and the batches."""
        last = min(batches) - 1 if batches else None
        old = [
            f"{self.path}/{VERSION}={version}/{self.part}={part}"
            for part, version in self._state(last).items() if parts is None or part in parts
        ]
        new = [
            folder for b in batches
            for part, folder in self._parts(f"{BATCH}={b}").items() if parts is None or part in parts
        ]
        return self._load(old).unionByName(self._load(new))

    def _load(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        found = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)
        return found.select(*self.schema.names)

    def _clean(self) -> None:
        """Delete what neither of the last two versions reads."""
        versions = sorted(self._ids(VERSION))
        if len(versions) < 2:
            return
        kept = versions[-2]
        live = self._state(kept)
        for version in versions[:-2]:
            parts = self._parts(f"{VERSION}={version}")
            stale = [folder for part, folder in parts.items() if live.get(part) != version]
            if len(stale) == len(parts):
                self._delete(f"{self.path}/{VERSION}={version}")
            else:
                for folder in stale:
                    self._delete(folder)
        for s in matching(self.spark, f"{self.path}/{BATCH}=*"):
            if int(s.getPath().getName().split("=")[1]) <= kept:
                self._delete(s.getPath().toString())

    def _delete(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
