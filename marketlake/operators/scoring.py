"""Exact top-k of user-item scores by blocks of the item table, with bounds by norm.

The score table has users x items cells and is never built. Users stay where they are: a task holds some, by a hash,
with each user's k best so far. Items are cut in blocks by falling norm and pass by the tasks, block after block; each
task is sent every item once, so what is shuffled grows with the items times the tasks. A block is multiplied with
numpy by a few hundred users at a time. No score of a user in a block exceeds the user's norm times the block's
greatest, so a user who has k items is not multiplied with a block whose bound does not reach the k-th score so far, and
of a block's scores only those that reach it are kept and sorted. How much is saved depends on the norms: nothing of
the products if all are alike, most of them if few items stand out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.vectors import norm
from marketlake.sources.lake import stored

_ROWS_AT_ONCE = 64
#: Users in a task, if there are tasks for all cores.
FEWEST = 256
#: Scores that a task keeps, over all its users: 20 bytes each, and as much again before they are cut.
MOST_KEPT = 6_000_000
#: Candidates that are cut at once without need, so that bounds fall soon.
CUT_SOON = 500_000
#: What rounding may add to a score beyond the product of the norms.
_SLACK = 1 + 1e-9
#: Copies of a product's metadata: a popular product stands in many users' lists.
SALTS = 16


class _Best:
    """The k best of each of some users, as far as the items have come by; equal scores by the smaller product."""

    def __init__(self, k: int, ids: pa.Array, factors: np.ndarray, most: np.ndarray | None):
        coded = ids.dictionary_encode(null_encoding="encode")
        # rows of one id have one list
        self.ids, self.own = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.k, self.factors, self.norms = k, factors, np.sqrt((factors * factors).sum(axis=1))
        self.most = np.full(len(self.ids), k)
        if most is not None:
            self.most[self.own] = most
        self.bar = np.full(len(self.ids), -np.inf)
        self.user, self.score, self.at = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pool: list[pa.Array] = []
        self.pairs = 0

    def meet(self, products: pa.Array, factors: np.ndarray, bounded: bool, seen: dict[int, np.ndarray] | None) -> None:
        """One block of items; seen: for users by number the places in the block to leave out."""
        matrix, n = factors.T.copy(), len(products)
        hi = np.sqrt((factors * factors).sum(axis=1).max()) if bounded and n else np.inf
        # not below: a norm or bound that is no number leaves nobody out
        active = np.flatnonzero(~(self.norms * hi * _SLACK < self.bar[self.own]))
        self.pairs += len(active)
        if not n or not len(active):
            return
        first = sum(map(len, self.pool))
        self.pool.append(products)
        rank = None
        product, reaches = np.empty((_ROWS_AT_ONCE, n)), np.empty((_ROWS_AT_ONCE, n), bool)
        for start in range(0, len(active), _ROWS_AT_ONCE):
            rows = active[start : start + _ROWS_AT_ONCE]
            own = self.own[rows]
            scores = np.matmul(self.factors[rows], matrix, out=product[: len(rows)])
            for row in () if seen is None else [row for row, user in enumerate(own) if user in seen]:
                scores[row, seen[own[row]]] = -np.inf
            bar = self.bar[own]
            if n > 4 * self.k and np.isneginf(bar).any():
                # the k-th greatest of the greatest of many stretches: at least k scores reach it
                wide = n // (4 * self.k)
                tops = scores[:, : n // wide * wide].reshape(len(rows), -1, wide).max(axis=2)
                bar = np.fmax(bar, np.partition(tops, tops.shape[1] - self.k, axis=1)[:, tops.shape[1] - self.k])
            # what is left out is the least number, so it never reaches the least number above it
            found = np.greater_equal(scores, np.fmax(bar, -np.finfo(float).max)[:, None], out=reaches[: len(rows)])
            row, column = np.divmod(np.flatnonzero(found.ravel()), n)
            kept = own[row], scores[row, column], column
            if len(row) > 4 * self.k * len(rows):  # many equal scores
                rank = _ranks(products) if rank is None else rank
                some = _first(self.k, kept[0], kept[1], rank[column])[0]
                kept = tuple(x[some] for x in kept)
            self.new.append((kept[0], kept[1], kept[2] + first))
        waiting = sum(len(x[0]) for x in self.new)
        if waiting >= min(max(len(self.user) // 2, CUT_SOON), MOST_KEPT) or waiting + len(self.user) <= 2 * CUT_SOON:
            self.cut()

    def cut(self) -> None:
        """Keep each user's k best."""
        if not self.new:
            return
        user, score, at = (np.concatenate([old, *new]) for old, new in zip((self.user, self.score, self.at), zip(*self.new, strict=True), strict=True))
        self.new, pool = [], pa.chunked_array(self.pool).combine_chunks()
        order, place = _first(self.k, user, score, _ranks(pool)[at])
        self.user, self.score, self.at = user[order], score[order], at[order]
        full = place == self.k - 1
        self.bar[self.user[full]] = self.score[full]
        used = np.zeros(len(pool), bool)
        used[self.at] = True
        self.pool, self.at = [pool.filter(pa.array(used))], (np.cumsum(used) - 1)[self.at]

    def rows(self) -> Iterator[pa.RecordBatch]:
        """(customer_id, product, score, rank, pairs), by user and rank."""
        self.cut()
        place = np.arange(len(self.user)) - np.searchsorted(self.user, self.user)
        some = np.flatnonzero(place < self.most[self.user])
        pool = self.pool[0] if self.pool else None
        for start in range(0, len(some), 100_000):
            part = some[start : start + 100_000]
            pairs = pa.array([self.pairs if not start else 0, *[0] * (len(part) - 1)], pa.int64())
            columns = [self.ids.take(pa.array(self.user[part])), pool.take(pa.array(self.at[part])), pa.array(self.score[part])]
            columns += [pa.array((place[part] + 1).astype(np.int32)), pairs]
            yield pa.record_batch(columns, ["customer_id", "product", "score", "rank", "pairs"])


def _ranks(products: pa.Array) -> np.ndarray:
    return pc.rank(products.field("product_id"), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()


def _first(k: int, user: np.ndarray, score: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of each user's k best rows, by user, score and rank, and their place with the user."""
    order = np.argsort(-score, kind="stable")
    order = order[np.argsort(user[order], kind="stable")]
    user, sorted_score = user[order], score[order]
    begins = np.flatnonzero(np.diff(user, prepend=-1))
    # equal scores of a user are few; only these are put in the order of their products
    same = (np.diff(user, prepend=-1) == 0) & (np.diff(sorted_score, prepend=np.nan) == 0)
    if same.any():
        some = np.flatnonzero(same | np.append(same[1:], False))
        order[some] = order[some][np.lexsort((rank[order[some]], -sorted_score[some], user[some]))]
    place = np.arange(len(user)) - np.repeat(begins, np.diff(begins, append=len(user)))
    few = place < k
    return order[few], place[few]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as rows."""
    lists = column.combine_chunks()
    if lists.null_count:
        raise ValueError("a row of the model has no factors")
    return np.asarray(lists.flatten(), np.float64).reshape(len(lists), -1)


_USER, _SEEN, _ITEM = range(3)


def _ranked(k: int, bounded: bool, with_most: bool) -> Callable:
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, seen = None, None
        for kind, table in _runs(batches):
            if kind == _USER:
                ids = table["customer_id"].combine_chunks()
                best = _Best(k, ids, _matrix(table["factors"]), table["most"].to_numpy() if with_most else None)
            elif best is None:
                break
            elif kind == _SEEN:
                seen = table
            else:
                products = table["product"].combine_chunks()
                masks = None if seen is None or seen["ib"][0] != table["ib"][0] else _masks(best, products, seen)
                best.meet(products, _matrix(table["factors"]), bounded, masks)
                seen = None
        if best is not None:
            yield from best.rows()

    return rank


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The users, and for each block the seen lists and the items, which come one after the other."""
    held, key = [], None
    for batch in batches:
        keys = batch["ib"].to_numpy().astype(np.int64) * 3 + batch["kind"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi == lo:
                continue
            if held and keys[lo] != key:
                yield key % 3, pa.Table.from_batches(held)
                held = []
            key = int(keys[lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield key % 3, pa.Table.from_batches(held)


def _masks(best: _Best, products: pa.Array, seen: pa.Table) -> dict[int, np.ndarray]:
    """Places in a block of the products that each user has seen."""
    lists = seen["seen"].combine_chunks()
    users = pc.index_in(seen["customer_id"].combine_chunks(), value_set=best.ids)
    place = pc.index_in(lists.flatten(), value_set=products.field("product_id"))
    ends = np.cumsum(pc.list_value_length(lists).to_numpy())
    user, at = np.repeat(pc.fill_null(users, -1).to_numpy(), np.diff(ends, prepend=0)), pc.fill_null(place, -1).to_numpy()
    some = (user >= 0) & (at >= 0)
    user, at = user[some], at[some]
    order = np.argsort(user, kind="stable")
    names, cuts = np.unique(user[order], return_index=True)
    return dict(zip(names.tolist(), np.split(at[order], cuts[1:]), strict=True)) if len(names) else {}


def _salted(column: str, by: str) -> tuple:
    """A salt column for rows, and for the other side all its values."""
    return F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int").alias(column), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(column)


def _seen_lists(seen: DataFrame, blocks: DataFrame) -> DataFrame:
    """(customer_id, ib, seen): each user's seen items by item block; a popular item is a hot key, so it is salted."""
    salt, every = _salted("_salt", "customer_id")
    placed = blocks.select("product_id", "ib", every)
    pairs = seen.select("customer_id", "product_id", salt).distinct().join(placed, ["product_id", "_salt"])
    return stored(pairs.groupBy("customer_id", "ib").agg(F.collect_list("product_id").alias("seen")), "seen-lists")


def top_scores(
    users: DataFrame,
    items: DataFrame,
    k: int,
    seen: DataFrame | None = None,
    metadata: DataFrame | None = None,
    user_block: int = 4096,
    item_block: int = 16384,
    report: dict[str, int] | None = None,
) -> DataFrame:
    """Each user's k best items by dot product, with rank; ties go to the smaller product_id.

    `users` is (customer_id, factors), `items` (product_id, factors). With a column `most` in `users` only the ranks up
    to it are returned. `metadata` has one row per product_id; it is joined to the k best alone, so blocks and
    candidates carry ids and scores only. That join is salted by user, as a popular product is a hot key there.
    With `seen` (customer_id, product_id) those pairs are left out before the cut, inside each
    block, so heavy buyers still get k items. Seen lists are per (user, item block) and hence
    no longer than a block. A task holds `user_block` users or as many as keep `MOST_KEPT` scores, if these are more;
    `report` gets the number of (user, item block) pairs that were multiplied, and of all.
    """
    with_most = "most" in users.columns
    everyone = stored(users.select("customer_id", "factors", *(["most"] if with_most else [])), "score-users")
    n_users, n_items = everyone.count(), items.count()
    cores = users.sparkSession.sparkContext.defaultParallelism
    n_blocks = max(1, -(-n_items // item_block))
    carried = [c for c in items.columns if c != "factors"]
    ranged = items.select(*carried, "factors")
    if n_blocks > 1:
        # ties in norm are cut by id
        ranged = ranged.repartitionByRange(n_blocks, F.desc(norm(F.col("factors"))), "product_id")
        blocks = stored(ranged.withColumn("ib", F.spark_partition_id()), "score-items")
    else:
        blocks = ranged.withColumn("ib", F.lit(0))

    # At least one task per core, as long as a task keeps a few hundred users.
    parts = max(1, -(-n_users // max(user_block, MOST_KEPT // k)), min(cores, n_users // FEWEST))
    kinds = {frame.schema["factors"].dataType.elementType.simpleString() for frame in (users, items)}
    factors = F.col("factors").cast(f"array<{kinds.pop() if len(kinds) == 1 else 'double'}>").alias("factors")
    place = F.pmod(F.xxhash64("customer_id"), F.lit(parts)).cast("int").alias("part")
    kind = lambda number: F.lit(number).alias("kind")
    rows = everyone.select(place, F.lit(-1).alias("ib"), kind(_USER), "customer_id", factors, *(["most"] if with_most else []))
    passing = blocks.select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "ib", kind(_ITEM), factors, F.struct(*carried).alias("product")
    )
    rows = rows.unionByName(passing, allowMissingColumns=True)
    if seen is not None:
        lists = _seen_lists(seen, blocks).select(place, "ib", kind(_SEEN), "customer_id", "seen")
        rows = rows.unionByName(lists, allowMissingColumns=True)
    dealt = rows.repartitionById(parts, F.col("part")).sortWithinPartitions("ib", "kind")
    schema = T.StructType(
        [
            T.StructField("customer_id", users.schema["customer_id"].dataType), T.StructField("product", passing.schema["product"].dataType),
            T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType()), T.StructField("pairs", T.LongType()),
        ]
    )
    found = dealt.mapInArrow(_ranked(k, n_blocks > 1, with_most), schema)
    if report is not None:
        found = stored(found, "score-top")
        report.update(multiplied=found.agg(F.sum("pairs")).first()[0] or 0, pairs=n_users * n_blocks)
    top = found.select("customer_id", "product.*", "score", "rank")
    if metadata is None:
        return top
    more = [c for c in metadata.columns if c != "product_id"]
    salt, every = _salted("_salt", "customer_id")
    salted = top.select("*", salt)
    # Only the model's products are copied, and merged: the estimate that would choose a broadcast knows nothing of the copies.
    known = metadata.join(items.select("product_id"), "product_id", "left_semi").select("product_id", *more, every).hint("merge")
    return salted.join(known, ["product_id", "_salt"], "left").select("customer_id", *carried, *more, "score", "rank")


def popular_items(items: DataFrame, k: int) -> DataFrame:
    """The k items of the greatest factor norm; the norm is the score."""
    return (
        items.withColumn("score", norm(F.col("factors")))
        .drop("factors")
        .orderBy(F.desc("score"), "product_id")
        .limit(k)
    )
