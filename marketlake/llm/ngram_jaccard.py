"""Near-duplicate documents: all pairs of shingle sets with Jaccard >= 0.8, as connected components.

T-occurrence search with DivideSkip. A set of n shingles can only be linked to one with which it shares
T = ceil(0.8 n) of them. Of its inverted lists the T - 1 longest are never merged: only the n - T + 1
shortest are, and what occurs in none of them cannot reach T. The others are probed by binary search.

1. Rows with the same set (128-bit hash) become one node; the rest works on different sets only.
2. Blocks of sets send their shingles to buckets of the hash range (sorted and compressed); a bucket finds
   how many sets hold each shingle and returns those that at least two hold. Shingles that occur once form
   empty lists, so a set with fewer than T shared shingles is finished here.
3. The lists of a set that are short (rarest first, by corpus counts) are its prefix. Sets that meet in a
   prefix list are joined to the least of that list: these star edges have the same components as all
   pairs, and no list is ever gathered.
4. Each component of such candidates is searched on its own. One that is larger than a block is cut in
   blocks: each links its sets among themselves and to the component's first set; only sets that miss this
   core are then searched against the other blocks.

Buckets and parts come as runs of sorted rows, of which a task holds one run as numpy arrays, never an Arrow
group. Shingles are compared by 48 bits of a 64-bit hash. A null or blank text has an empty set and is linked
with nothing. Rows are told apart by doc_id and text, so rows that share a doc_id, or have none, are judged each
by its own text. component_id is the least doc_id of the linked rows, null if none of them has one; a row that is
linked with nothing keeps its own. Other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import bytes_of, chunks, components, release, stored, texts
from marketlake.llm.words import mixed, shingles, word_bounds, word_hashes

BITS = np.uint64(48)
LOW = np.uint64(2**48 - 1)
#: Shingles of a bucket, and of a block of a large component.
BUCKET = 500_000
BLOCK = 1_000_000
#: Sets that leave a task at once.
SETS = 10_000
#: Text bytes that a task turns to arrays at once.
STEP = 2_500_000


def needed(n):
    """Least overlap of a set of n shingles with any set it is linked to."""
    return (80 * n + 99) // 100


def _sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (48 bits, ascending in each document) of all documents, and the size of each set."""
    n = len(offsets) - 1
    start, end, doc = word_bounds(data, offsets)
    hashes, of = shingles(word_hashes(data, start, end), doc, n)
    packed = of.astype(np.uint64) << BITS | hashes >> np.uint64(16)
    packed.sort()
    if len(packed):
        packed = packed[np.concatenate([[True], packed[1:] != packed[:-1]])]
    return packed & LOW, np.bincount((packed >> BITS).astype(np.int64), minlength=n)


def _signatures(tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each set, independent of order: sums of its shingles' hashes."""
    starts, full = np.cumsum(counts) - counts, counts > 0
    sums = np.zeros((2, len(counts)), np.uint64)
    if full.any():
        sums[0, full] = np.add.reduceat(mixed(tokens + np.uint64(1)), starts[full])
        sums[1, full] = np.add.reduceat(mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)), starts[full])
    return sums


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id, text as bytes and its hash; with doc_id it tells rows apart."""
    return texts(docs, F.xxhash64("text").alias("text_hash"))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, STEP):
        tokens, counts = _sets(*bytes_of(part["text"]))
        sums = _signatures(tokens, counts)
        kept = [part[c].combine_chunks() for c in ("doc_id", "text_hash")]
        yield pa.record_batch([*kept, pa.array(counts), *(pa.array(s.view(np.int64)) for s in sums)], [*SIGNED])


#: Columns of a row's signature.
SIGNED = {"doc_id": "long", "text_hash": "long", "n_shingles": "long", "h1": "long", "h2": "long"}


def _packed(values: np.ndarray) -> bytes:
    """Bytes of like weight side by side, compressed."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(1).compress(planes.tobytes())


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).reshape(-1)


#: Of a bundle: shingles, each one's place among the sets, and number and size of each set.
BUNDLE = (np.uint64, np.uint32, np.int64, np.int64)


def _bundle(tokens: np.ndarray, nodes: np.ndarray, sizes: np.ndarray) -> bytes:
    """Shingles, ascending, with the set that holds each and that set's size; sizes go once a set."""
    held, first, local = np.unique(nodes, return_index=True, return_inverse=True)
    parts = [
        _packed(np.diff(tokens, prepend=np.uint64(0))), _packed(local.astype(np.uint32)),
        _packed(held.astype(np.int64)), _packed(sizes[first].astype(np.int64)),
    ]
    return struct.pack("<4q", *map(len, parts)) + b"".join(parts)


def _unbundled(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles, sets and sizes of bundles, end to end."""
    out: list[list[np.ndarray]] = [[], [], []]
    for raw in rows:
        at, found = 32, []
        for length, kind in zip(struct.unpack_from("<4q", raw), BUNDLE, strict=True):
            found.append(_unpacked(raw[at : at + length], kind))
            at += length
        for held, new in zip(out, (np.cumsum(found[0], dtype=np.uint64), found[2][found[1]], found[3][found[1]]), strict=True):
            held.append(new)
    return tuple(np.concatenate(x) for x in out)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Bundles of each key, from rows (key, payload) sorted by key."""
    key, held = None, []
    for batch in batches:
        for k, raw in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
            if k != key and held:
                yield key, held
                held = []
            key = k
            held.append(raw)
    if held:
        yield key, held


def _dealt(buckets: int):
    """Rows chosen for their sets -> (bucket, its shingles with the sets that hold them)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for part in chunks(batches, STEP):
            tokens, counts = _sets(*bytes_of(part["text"]))
            nodes = np.asarray(part["node"].combine_chunks()).astype(np.int64)
            # repeated rows stand for one set: the first of them in the task goes on
            chosen = _signatures(tokens, counts)[0].view(np.int64) == np.asarray(part["h1"].combine_chunks())
            for k in np.flatnonzero(chosen):
                chosen[k] = nodes[k] not in sent
                sent.add(int(nodes[k]))
            tokens, counts = tokens[np.repeat(chosen, counts)], np.where(chosen, counts, 0)
            doc = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
            packed = tokens << np.uint64(16) | doc
            packed.sort()
            tokens, doc = packed >> np.uint64(16), (packed & np.uint64(0xFFFF)).astype(np.int64)
            edges = np.searchsorted(tokens, np.array([(k << 48) // buckets for k in range(buckets)] + [1 << 48], np.uint64))
            full = np.flatnonzero(np.diff(edges))
            rows = [_bundle(tokens[(own := slice(edges[k], edges[k + 1]))], nodes[doc[own]], counts[doc[own]]) for k in full]
            if len(full):
                yield pa.record_batch([pa.array(full.astype(np.int32)), pa.array(rows, pa.binary())], ["bucket", "payload"])
        release()

    return deal


def _shared(parts: int):
    """Buckets -> for each part of the sets their shingles that others hold too, with the holders' number."""

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches):
            token, node, size = _unbundled(rows)
            order = np.lexsort((node, token))
            token, node, size = token[order], node[order], size[order]
            new = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])])
            token, node, size = token[new], node[new], size[new]
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            many = np.diff(np.append(first, len(token)))
            many = np.repeat(many, many)
            keep = np.flatnonzero(many > 1)
            token = token[keep] << np.uint64(16) | np.minimum(many[keep], 65535).astype(np.uint64)
            node, size = node[keep], size[keep]
            part = (mixed(node.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[order], np.arange(parts + 1))
            full = np.flatnonzero(np.diff(cut))
            out = [_bundle(token[(own := order[cut[k] : cut[k + 1]])], node[own], size[own]) for k in full]
            if len(full):
                yield pa.record_batch([pa.array(full.astype(np.int32)), pa.array(out, pa.binary())], ["part", "payload"])
        release()

    return share


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts -> sets with enough shared shingles, these ascending, and the rarest that are merged."""
    for _, rows in _runs(batches):
        token, doc, size = _unbundled(rows)
        order = np.lexsort((token, doc))
        token, doc, size = token[order], doc[order], size[order]
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        held = np.diff(np.append(first, len(doc)))
        n = size[first]
        take = n - needed(n) + 1 - (n - held)
        wanted = np.flatnonzero(take > 0)
        for k in range(0, len(wanted), SETS):
            chosen = wanted[k : k + SETS]
            tokens, prefix = [], []
            for i in chosen:
                own = token[first[i] : first[i] + held[i]]
                plain, count = own >> np.uint64(16), own & np.uint64(0xFFFF)
                tokens.append(plain.tobytes())
                prefix.append(plain[np.lexsort((plain, count))[: take[i]]].astype(np.int64))
            yield pa.record_batch(
                [pa.array(doc[first[chosen]]), pa.array(n[chosen]), pa.array(tokens, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))],
                ["doc_id", "n", "tokens", "prefix"],
            )
    release()


class Index:
    """Inverted lists of some sets, searched with DivideSkip."""

    def __init__(self, sizes: np.ndarray, sets: list[np.ndarray]):
        self.sizes, self.n = sizes, len(sets)
        token = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        of = np.repeat(np.arange(self.n), [len(s) for s in sets])
        order = np.argsort(token, kind="stable")
        self.tokens, self.docs = token[order], of[order]

    def search(self, size: int, own: np.ndarray, wanted) -> np.ndarray:
        """The indexed sets linked to a set of `size` shingles, of which `own` are held by any other.

        wanted(found) tells which of some sets need an answer.
        """
        lo, hi = np.searchsorted(self.tokens, own), np.searchsorted(self.tokens, own, side="right")
        length = hi - lo
        order = np.argsort(length, kind="stable")
        least = needed(size)
        short = order[: max(0, size - least + 1 - (size - len(own)))]
        short, long = short[length[short] > 0], order[len(short) :]
        if not len(short):
            return short
        at = np.repeat(lo[short] - (np.cumsum(length[short]) - length[short]), length[short]) + np.arange(length[short].sum())
        found, count = np.unique(self.docs[at], return_counts=True)
        new = wanted(found)
        found, count = found[new], count[new]
        both = self.sizes[found] + size
        # 100 * o >= 80 * (both - o), so o >= 80 * both / 180
        goal = (80 * both + 179) // 180
        alive = count + len(long) >= goal
        found, goal, have = found[alive], goal[alive], count[alive]
        if not len(found):
            return found
        for k in long:
            docs = self.docs[lo[k] : hi[k]]
            if len(docs):
                place = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                have = have + (docs[place] == found)
        return found[have >= goal]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task (component, block, turn); yields the links found, fewest that tell the components.

    Members (role 0) of turn -1 are linked among themselves; sets of role 1 are searched against the members.
    """

    def linked(rows: list[tuple]) -> list[tuple[int, int]]:
        rows.sort(key=lambda r: (r[0], r[1]))
        docs = [r[1] for r in rows]
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        members = [i for i, r in enumerate(rows) if r[0] == 0]
        queries = [i for i, r in enumerate(rows) if r[0] == 1] or members
        index = Index(np.array([rows[i][2] for i in members]), [sets[i] for i in members])
        root, own, out = np.arange(len(rows)), {i: [i] for i in range(len(rows))}, []
        at = np.array(members, np.int64)
        for q in queries:
            for m in at[index.search(rows[q][2], sets[q], lambda found, q=q: root[at[found]] != root[q])]:
                a, b = int(root[m]), int(root[q])
                if a != b:
                    out.append((docs[q], docs[m]))
                    # the smaller group takes the other's name
                    a, b = (a, b) if len(own[a]) <= len(own[b]) else (b, a)
                    root[own[a]] = b
                    own[b] += own.pop(a)
        return out

    held, key = [], None
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("component", "block", "turn", "role", "doc_id", "n", "tokens")]
        found = []
        for row in zip(*columns, strict=True):
            if row[:3] != key and held:
                found += linked(held)
                held = []
            key = row[:3]
            held.append(row[3:])
        if found:
            yield pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])
    release()
    if held and (found := linked(held)):
        yield pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])


def _searched(rows: DataFrame, parts: int) -> DataFrame:
    tasks = rows.select("component", "block", "turn", "role", "doc_id", "n", "tokens").repartition(parts, "component", "block", "turn")
    return tasks.sortWithinPartitions("component", "block", "turn").mapInArrow(_links, "a long, b long")


def set_links(sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join all linked sets of the candidates' components; sets: doc_id, n, tokens, prefix."""
    lists = sets.select("doc_id", F.explode("prefix").alias("token"))
    least = lists.groupBy("token").agg(F.min("doc_id").alias("b"), F.count("*").alias("k")).where("k > 1")
    stars = lists.join(least, "token").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b").distinct()
    of = components(stars, "candidates")
    sets = sets.drop("prefix")
    joined = stored(sets.join(of.withColumnRenamed("node", "doc_id"), "doc_id"), "candidate-sets")
    sizes = stored(
        joined.groupBy("component").agg(F.sum("n").alias("weight")).withColumn("blocks", F.ceil(F.col("weight") / block).cast("int")),
        "component-sizes",
    )
    held = joined.join(sizes, "component")
    total = sizes.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    parts = max(8, total // block + 1)
    members = held.withColumns(
        {"block": F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"), "turn": F.lit(-1), "role": F.lit(0)}
    )
    # the first set of a large component also stands in each of its other blocks
    firsts = (
        members.where("blocks > 1 and doc_id = component")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .where("other <> block").withColumn("block", F.col("other")).drop("other")
    )
    links = stored(_searched(members.unionByName(firsts), parts), "block-links")
    if not sizes.where("blocks > 1").head(1):
        return links
    core = components(links, "core").where("node <> component").select(F.col("node").alias("doc_id"), F.col("component").alias("root"))
    large = members.where("blocks > 1")
    stray = large.join(core, "doc_id", "left").where("coalesce(root, doc_id) <> component").drop("root")
    turns = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("blocks")).cast("int")
    stray = stored(stray.withColumn("turn", turns), "stray")
    asked = (
        stray.withColumn("own", F.col("block")).withColumn("role", F.lit(1))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("block <> own").drop("own")
    )
    tasks = asked.select("component", "block", "turn").distinct()
    met = large.drop("turn").join(tasks, ["component", "block"])
    return links.union(_searched(asked.unionByName(met), parts))


def _labelled(docs: DataFrame, bucket: int, block: int) -> DataFrame:
    """Each row's signature with `own`, the first row of its set, and `best`, that of its component; null if it has no words."""
    rows = stored(_documents(docs).mapInArrow(_signed, ", ".join(f"{k} {v}" for k, v in SIGNED.items())), "signed")
    # rows with an id come before those without
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash"))
    full = rows.where("n_shingles > 0").groupBy("h1", "h2", "n_shingles").agg(first.alias("own"))
    sets = stored(full.withColumn("node", F.monotonically_increasing_id()), "sets")
    total = sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket))
    tasks = max(8, buckets)
    all_rows, firsts = _documents(docs).alias("d"), sets.select("own", "node", "h1").alias("s")
    same = F.col("d.doc_id").eqNullSafe(F.col("s.own.doc_id")) & (F.col("d.text_hash") == F.col("s.own.text_hash"))
    chosen = all_rows.join(firsts, same).select("d.text", "s.node", "s.h1")
    dealt = chosen.mapInArrow(_dealt(buckets), "bucket int, payload binary").repartition(tasks, "bucket").sortWithinPartitions("bucket")
    shared = dealt.mapInArrow(_shared(buckets), "part int, payload binary").repartition(tasks, "part").sortWithinPartitions("part")
    near = stored(shared.mapInArrow(_prefixes, "doc_id long, n long, tokens binary, prefix array<long>"), "near-sets")
    linked = sets.join(components(set_links(near, block), "near"), "node")
    best = linked.groupBy("component").agg(F.min("own").alias("best"))
    linked = linked.join(best, "component").select("node", "best")
    of = sets.join(linked, "node", "left").select("h1", "h2", "n_shingles", "own", F.coalesce("best", "own").alias("best"))
    return rows.join(of, ["h1", "h2", "n_shingles"], "left")


def near_duplicates(docs: DataFrame, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable by links) and set_id (least with its set) of each row."""
    labelled = _labelled(docs, bucket, block)
    return labelled.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("component_id"),
        F.when(F.col("own").isNull(), F.col("doc_id")).otherwise(F.col("own.doc_id")).alias("set_id"),
    )


def keep_first(docs: DataFrame, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """`docs` with one row of each component: the judged one of least doc_id, or of least text hash if none has an id.

    Rows without words stay.
    """
    rows = _labelled(docs, bucket, block).where("n_shingles > 0")
    first = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_hash") == F.col("best.text_hash"))
    judged = stored(rows.groupBy("doc_id", "text_hash").agg(F.first(first).alias("stays"), F.count("*").alias("copies")), "near-judged")
    name = "text_hash"
    while name in docs.columns:
        name += "_"

    def met(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col(f"d.{name}") == F.col("k.text_hash"))
        return rows.alias("d").join(keys.alias("k"), same, how)

    left = met(docs.withColumn(name, F.xxhash64("text")), judged.where("not stays"), "left_anti")
    again = judged.where("stays and copies > 1")
    if again.head(1):
        # of rows that are equal in id and text, one stays
        left = met(left, again, "left_anti").union(met(left, again, "left_semi").dropDuplicates(["doc_id", name]))
    return left.select(*docs.columns)
