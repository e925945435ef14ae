"""Whitened embeddings: principal components of all different vectors, to double precision.

1. Each entry c becomes the integer floor(64 c) + 1,000,000. The different integer vectors are the fit list,
   written once; number and sums are exact integers, added up by dimension.
2. The covariance is added up in the tasks from centred vectors, one d x d matrix each, and then row by row of the
   matrix, so that no task and not the driver ever holds more than such a matrix.
3. Its eigenvectors are found in single precision and corrected by Ogita-Aishima steps, matrix products in extended
   precision that roughly square the error each. Where eigenvalues lie closer than what a step can tell apart, the
   step only makes their vectors orthonormal, and a sub-solve of the small matrix of that cluster, shifted by its
   mean eigenvalue, turns them.
4. A pass over the fit list measures the whitened covariance, a last one over all rows gives the result.

Rows whose vector is null, empty or holds null or non-finite entries are dropped, and rows of another length than
most of the different vectors (ties: the longer one). Entries beyond +-2**50 count as that. A deviation that a long
cannot hold is null. A component without variance (at most 1e-13 of the whole) has whitened 0 and is not measured.
Repeated rows and ids are kept, a null id stays null. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import small_batches, stored

SCALE, SHIFT = 64.0, 1_000_000
#: Vectors that a task turns to doubles at once.
ROWS = 4_096
MOST = 2.0**56
COMPONENTS = 16
#: Share of the whole variance under which a component has none.
NOTHING = 1e-13
ROUNDS = 20
#: Differences of eigenvalues, in parts of the largest entry, that count as none: below what a double shows.
ALIKE = 1e-16
_HALF = 24


# --- eigenvectors -------------------------------------------------------------------------------


def _clusters(values: np.ndarray, close: np.ndarray) -> list[np.ndarray]:
    """Groups of two or more eigenvalues that are chained by `close`."""
    order = np.argsort(-values, kind="stable")
    joined = close[order[:-1], order[1:]]
    cuts = np.flatnonzero(~joined) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Single precision first, then Ogita-Aishima steps in extended precision until they change nothing that a double
    can show.
    """
    size = np.abs(a).max() if a.size else 0.0
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    matrix = a.astype(np.longdouble) / np.longdouble(size)
    x = np.linalg.eigh(matrix.astype(np.float32))[1].astype(np.longdouble)
    one = np.eye(len(a), dtype=np.longdouble)
    whole = np.sqrt((matrix * matrix).sum())
    values, before = np.zeros(len(a), np.longdouble), np.inf
    for _ in range(ROUNDS):
        r = one - x.T @ x
        s = x.T @ (matrix @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        # what this step can tell apart; norms by the sum of squares, which are no smaller
        told = max(2 * (np.sqrt((off * off).sum()) + whole * np.sqrt((r * r).sum())), ALIKE)
        gap = values[None, :] - values[:, None]
        close = np.abs(gap) <= told
        step = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gap))
        x = x + x @ step
        moved = np.abs(step).max()
        np.fill_diagonal(close, False)
        for c in _clusters(values, close):
            own = x[:, c]
            middle = values[c].mean()
            small = own.T @ (matrix @ own - middle * own)
            scale = np.abs(small).max()
            if scale > ALIKE:
                turn = np.linalg.eigh(((small + small.T) / (2 * scale)).astype(np.float64))[1].astype(np.longdouble)
                # a turn of double precision is orthonormal to that only; one Newton step mends it
                turn = turn + turn @ (np.eye(len(c), dtype=np.longdouble) - turn.T @ turn) / 2
                x[:, c] = own @ turn
                moved = np.inf
        if moved < np.finfo(np.float64).eps / 8 or np.inf > moved >= before:
            break
        before = moved
    for _ in range(2):
        x = x + x @ (one - x.T @ x) / 2
    values = (x * (matrix @ x)).sum(0)
    order = np.argsort(-values, kind="stable")
    return (values[order] * size).astype(np.float64), x[:, order].astype(np.float64)


# --- vectors in tasks ---------------------------------------------------------------------------


def _integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer vectors of the usable rows, for each length."""
    length = np.asarray(pc.fill_null(pc.list_value_length(column), 0)).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    start = np.cumsum(length) - length
    for d in np.unique(length[length > 0]):
        rows = np.flatnonzero(length == d)
        values = flat[start[rows][:, None] + np.arange(d)]
        usable = np.isfinite(values).all(axis=1)
        whole = np.clip(np.floor(SCALE * values[usable]), -MOST, MOST)
        yield rows[usable], whole.astype(np.int64) + SHIFT


def _different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, x in _integers(batch["v"]):
            if len(x):
                yield pa.record_batch([pa.array([row.tobytes() for row in x], pa.binary())], ["x"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Vectors of the fit list as matrices of some rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            some = batch["x"].slice(start, ROWS).to_pylist()
            if some:
                yield np.frombuffer(b"".join(some), np.int64).reshape(len(some), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each dimension: number, and sums of the high and low halves of its entries, which stay exact."""
    n, high, low = 0, 0, 0
    for x in _parts(batches):
        n, high, low = n + len(x), high + (x >> _HALF).sum(axis=0), low + (x & (1 << _HALF) - 1).sum(axis=0)
    if n:
        d = len(high)
        yield pa.record_batch([pa.array(np.arange(d)), pa.array(np.full(d, n)), pa.array(high), pa.array(low)], ["i", "n", "high", "low"])


class Centre:
    """Number and sums of the fit list; what vectors differ from their mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums

    def centred(self, x: np.ndarray, exact: bool = False) -> tuple[np.ndarray, list[int | None]]:
        """x - S / n, unrounded but for the last place; with `exact` also the sums of (n x - S)**2."""
        # n x - S fits a long for all but absurd entries
        if self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0) < 2**63:
            d = self.n * x - np.array(self.sums, np.int64)
        else:
            d = self.n * x.astype(object) - np.array(self.sums, object)
        real = d.astype(np.float64)
        out: list[int | None] = []
        if exact:
            guess = (real * real).sum(axis=1)
            whole = (d * d).sum(axis=1) if d.dtype != object else None
            for k, about in enumerate(guess):
                total = int(whole[k]) if whole is not None and about < 9e18 else sum(int(v) ** 2 for v in d[k])
                out.append(total if total < 2**63 else None)
        return real / self.n, out


def _rows_of(matrix: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.arange(len(matrix))), pa.array(list(matrix), pa.list_(pa.float64()))], ["i", "row"])


def _products(centre: Centre, project: np.ndarray | None):
    """Sums of centred vectors' outer products, of the vectors themselves or of their projections, row by row."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x in _parts(batches):
            c = centre.centred(x)[0]
            c = c if project is None else c @ project
            total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            yield _rows_of(total)

    return multiply


def _added(group: pa.Table) -> pa.Table:
    rows = group["row"].combine_chunks()
    return pa.table([group["i"][:1], pa.array([rows.flatten().to_numpy().reshape(len(rows), -1).sum(axis=0)], pa.list_(pa.float64()))], names=["i", "row"])


def _covariance(fit: DataFrame, centre: Centre, project: np.ndarray | None = None) -> np.ndarray:
    rows = fit.mapInArrow(_products(centre, project), "i long, row array<double>").groupBy("i").applyInArrow(_added, "i long, row array<double>")
    return np.array([r.row for r in sorted(rows.collect(), key=lambda r: r.i)]) / centre.n


def _projected(centre: Centre, project: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _integers(batch["v"]):
                if x.shape[1] != len(project):
                    continue
                for start in range(0, len(x), ROWS):
                    c, far = centre.centred(x[start : start + ROWS], exact=True)
                    ids = batch["vec_id"].take(pa.array(rows[start : start + ROWS]))
                    yield pa.record_batch([ids, pa.array(far, pa.int64()), pa.array(list(c @ project), pa.list_(pa.float64()))], ["vec_id", "deviation", "w"])

    return run


# --- operator -----------------------------------------------------------------------------------


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of each usable row and component."""
    small_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(column).alias("v"))
    kind = rows.schema["vec_id"].dataType
    fit = stored(rows.select("v").mapInArrow(_different, "x binary").distinct(), "whitening-fit")
    lengths = fit.groupBy(F.length("x").alias("bytes")).count().orderBy(F.desc("count"), F.desc("bytes")).head(1)
    if not lengths:
        empty = rows.limit(0).select("vec_id", F.lit(0).alias("component"), *(F.lit(0).cast("long").alias(c) for c in ("n", "deviation")))
        return empty.select("*", *(F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")))
    fit = fit.where(F.length("x") == lengths[0].bytes)
    sums = fit.mapInArrow(_sums, "i long, n long, high long, low long").groupBy("i")
    # decimals, as the sum of very many sums may pass a long
    sums = sums.agg(F.sum("n").alias("n"), *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low"))).orderBy("i").collect()
    centre = Centre(sums[0].n, [(int(r.high) << _HALF) + int(r.low) for r in sums])
    covariance = _covariance(fit, centre)
    values, axes = eigenvectors((covariance + covariance.T) / 2)
    k = min(components, len(values))
    trace = float(np.trace(covariance))
    held = values[:k] > NOTHING * trace
    project = axes[:, :k] * np.where(held, 1 / np.sqrt(np.where(held, values[:k], 1)), 0.0)
    error = float(np.abs(_covariance(fit, centre, project) - np.diag(held.astype(float))).max())
    explained = F.array(*(F.lit(float(v / trace) if trace else 0.0) for v in values[:k]))
    schema = T.StructType([T.StructField("vec_id", kind), T.StructField("deviation", T.LongType()), T.StructField("w", T.ArrayType(T.DoubleType()))])
    projected = rows.mapInArrow(_projected(centre, project), schema)
    # a vector becomes its components behind Python: only its numbers travel
    out = projected.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(centre.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
