"""Exact substring deduplication: every byte of a 400-byte string that also starts elsewhere goes.

Suffix arrays by induced sorting, sharded so that equal strings always meet:

1. Each 400-byte window of a text has an anchor: the leftmost of its 48-byte substrings with the least
   hash. The anchor depends on the window's bytes alone, so equal windows have equal anchors at equal
   offsets, and the windows of one anchor occurrence start in one range (sliding minima, content-defined).
2. Anchors that occur once hold no repeated window and are done. Of the others, occurrences with the same
   bytes around them (all their windows) are one context with a count, so a group of exact copies is one
   row before any text is moved.
3. Contexts go to shards by anchor. A shard joins its contexts to one string, builds its suffix array by
   induced sorting (classify suffixes, sort leftmost-smaller substrings, name and sort them recursively,
   induce the rest in linear passes), and the permuted common prefixes. A run of neighbours with common
   prefixes >= 400 that starts at two or more windows (contexts counted) is a repeated string.
4. Ranges of repeated starts return to the occurrences and are united to spans per document.

Anchors with very many different contexts (a passage of 48 to 399 bytes in many documents) would make one
shard too large: their windows do not reach a shard but are counted by 64-bit hash under the anchor, by Spark
over all of them.

A null text is empty; so is a text shorter than 400 bytes in that nothing of it can go. Rows are told apart by
doc_id and text. Rows equal in both repeat each other; they are worked on once, with their number, and each gets
its own result row. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import bytes_of, chunks, release, stored, texts
from marketlake.llm.words import BYTE, mixed, powers

WINDOW = 400
SEED = 48
#: Text bytes that a task turns to arrays at once; bytes of a shard.
STEP = 2_000_000
SHARD = 1_000_000
#: Contexts of an anchor from which on they are thinned first.
MANY = 2_000
#: Parts of a hot anchor.
SALTS = 16
_ROLL = 0xD1342543DE82EF95
_LETTER = np.random.default_rng(77).integers(1, 2**63, 4097, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64(23)
_NONE = np.uint64(2**64 - 1)


def _rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of the `width` bytes from each place on (the last places have none)."""
    have, span, out, reach = BYTE[data], 1, None, 0
    while True:
        if width & span:
            if out is None:
                out, reach = have, span
            else:
                out = out[: len(have) - reach] if len(have) > reach else out[:0]
                tail = have[reach : reach + len(out)]
                out = out[: len(tail)] * np.uint64(pow(_ROLL, span, 2**64)) + tail
                reach += span
        if reach == width or len(have) <= span:
            break
        have = have[:-span] * np.uint64(pow(_ROLL, span, 2**64)) + have[span:]
        span *= 2
    if reach < width:
        return np.zeros(0, np.uint64)
    return mixed(out[: max(0, len(data) - width + 1)])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Sliding minimum over `width` items."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def _anchors(data: np.ndarray, offsets: np.ndarray, window: int, seed: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each anchor occurrence: document, place, first and last start of its windows, all in `data`."""
    inside = np.zeros(len(data), bool)  # starts whose window ends in the same document
    ends = np.maximum(offsets[1:] - window + 1, offsets[:-1])
    marks = np.zeros(len(data) + 1, np.int8)
    np.add.at(marks, offsets[:-1], 1)
    np.add.at(marks, ends, -1)
    inside = np.cumsum(marks[:-1], dtype=np.int8) > 0
    for at in range(0, max(0, len(data) - window + 1), STEP):
        stop = min(at + STEP, len(data) - window + 1)
        hashes = _rolling(data[at : stop + window - 1], seed)
        # the hash above, the place below: the least is the leftmost of the least hashes
        keyed = hashes >> _PLACE << _PLACE | np.arange(len(hashes), dtype=np.uint64)
        least = np.where(inside[at:stop], _least(keyed, window - seed + 1), _NONE)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.append(first[1:], len(least)) - 1
        real = least[first] != _NONE
        first, last = first[real], last[real]
        place = (least[first] & (np.uint64(1) << _PLACE) - np.uint64(1)).astype(np.int64)
        doc = np.searchsorted(offsets, first + at, side="right") - 1
        yield doc, place + at, first + at, last + at, hashes[place]


def _spans_hash(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(_ROLL, len(data)), out=sums[1:])
    inverse = pow(_ROLL, -1, 2**64)
    return mixed((sums[stop] - sums[start]) * powers(inverse, len(data) + 1)[start] + (stop - start).astype(np.uint64))


def _occurrences(window: int, seed: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, STEP):
            data, offsets = bytes_of(part["text"])
            ids, own, copies = (np.asarray(part[c].combine_chunks()) for c in ("doc_id", "own", "copies"))
            for doc, place, start, end, anchor in _anchors(data, offsets, window, seed):
                if not len(doc):
                    continue
                lo, hi = start[0], end[-1] + window
                # the anchor's offset belongs to the context: equal bytes give equal windows then
                context = _spans_hash(data[lo:hi], start - lo, end - lo + window) + mixed((place - start).astype(np.uint64))
                columns = [ids[doc], own[doc], copies[doc], start - offsets[doc], (end - start).astype(np.int32)]
                columns += [anchor.view(np.int64), context.view(np.int64)]
                yield pa.record_batch([pa.array(c) for c in columns], ["doc_id", "own", "copies", "start", "more", "anchor", "context"])

    return find


# --- suffix array -------------------------------------------------------------------------------


def _bucketed(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return values[np.argsort(keys, kind="stable")]


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, letters: int) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order; bucket by bucket, each in array steps.

    Larger-type suffixes are induced upwards from the front of their buckets, then smaller-type ones downwards
    from the back.
    """
    n = len(text)
    size = np.bincount(text, minlength=letters)
    ends = np.cumsum(size)
    begins = ends - size
    order = np.full(n, -1, np.int32)
    large_count = np.bincount(text[~small], minlength=letters)
    seed_letter = text[seeds]
    seed_edges = np.searchsorted(seed_letter, np.arange(letters + 1))
    head = begins.copy()

    def push_up(sources: np.ndarray) -> None:
        before = sources - 1
        before = before[before >= 0]
        before = before[~small[before]]
        if not len(before):
            return
        letter = text[before]
        by = np.argsort(letter, kind="stable")
        before, letter = before[by], letter[by]
        first = np.flatnonzero(np.concatenate([[True], letter[1:] != letter[:-1]]))
        count = np.diff(np.append(first, len(letter)))
        order[np.repeat(head[letter[first]] - first, count) + np.arange(len(letter))] = before
        head[letter[first]] += count

    push_up(np.array([n]))  # the end of the text counts as the least suffix of all
    for c in range(letters):
        if not size[c]:
            continue
        done = begins[c]
        while done < head[c]:
            upto = head[c]
            push_up(order[done:upto].astype(np.int64))
            done = upto
        if seed_edges[c] < seed_edges[c + 1]:
            push_up(seeds[seed_edges[c] : seed_edges[c + 1]])
    tail = ends.copy()

    def push_down(sources: np.ndarray) -> None:
        before = sources - 1
        before = before[before >= 0]
        before = before[small[before]]
        if not len(before):
            return
        letter = text[before]
        by = np.argsort(letter, kind="stable")
        before, letter = before[by], letter[by]
        first = np.flatnonzero(np.concatenate([[True], letter[1:] != letter[:-1]]))
        count = np.diff(np.append(first, len(letter)))
        order[np.repeat(tail[letter[first]] - 1 + first, count) - np.arange(len(letter))] = before
        tail[letter[first]] -= count

    for c in range(letters - 1, -1, -1):
        if not size[c]:
            continue
        done = ends[c]
        while done > tail[c]:
            downto = tail[c]
            push_down(order[downto:done][::-1].astype(np.int64))
            done = downto
        large = order[begins[c] : begins[c] + large_count[c]]
        push_down(large[::-1].astype(np.int64))
    return order


def _doubled(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string with many letters, by doubling the ranks of those not yet told apart."""
    n = len(names)
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    span = 1
    while True:
        ranked = rank[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        if new.all() or span >= n:
            return order
        group = np.cumsum(new) - 1
        open_ = np.flatnonzero(~(new & np.append(new[1:], True)))
        items = order[open_]
        after = np.where(items + span < n, rank[np.minimum(items + span, n - 1)] + 1, 0)
        by = np.lexsort((after, group[open_]))
        items, after, of = items[by], after[by], group[open_][by]
        order[open_] = items
        split = np.concatenate([[True], (of[1:] != of[:-1]) | (after[1:] != after[:-1])])
        # the rank of a group is the place of its first member: it stays as groups are cut
        place = open_[np.maximum.accumulate(np.where(split, np.arange(len(split)), 0))]
        first_place = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = first_place
        rank[items] = place
        span *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of a byte (or small-letter) string in order, by induced sorting."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    text = text.astype(np.int64) if text.dtype.itemsize > 2 else text
    letters = int(text.max()) + 1
    if n < 64 or letters > 4096:
        return _doubled(np.asarray(text, np.int64)).astype(np.int32)
    # smaller type: less than the next suffix; equal letters take the type of what follows them
    differs = text[:-1] != text[1:]
    follow = np.append(np.where(differs, np.arange(n - 1), n), n)
    follow = np.minimum.accumulate(follow[::-1])[::-1][:n]
    small = np.zeros(n, bool)
    known = follow < n
    at = follow[known]
    small[known] = text[at] < text[at + 1]
    leftmost = np.zeros(n, bool)
    leftmost[1:] = small[1:] & ~small[:-1]
    places = np.flatnonzero(leftmost)
    if not len(places):
        return _induce(text, small, places, letters)
    # sort the substrings between leftmost places by one induction, then name them
    guess = _induce(text, small, _bucketed(places, text[places]), letters)
    ordered = guess[leftmost[guess]].astype(np.int64)
    stops = np.append(places[1:], n - 1)
    length = np.zeros(n, np.int64)
    length[places] = stops - places + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTER[text] * powers(_ROLL, n), out=sums[1:])
    stop = ordered + length[ordered]
    value = (sums[stop] - sums[ordered]) * powers(pow(_ROLL, -1, 2**64), n + 1)[ordered]
    final = ordered == places[-1]  # reaches the end of the text: equal to no other
    new = np.ones(len(ordered), bool)
    new[1:] = (value[1:] != value[:-1]) | (length[ordered][1:] != length[ordered][:-1]) | final[1:] | final[:-1]
    name = np.zeros(n, np.int64)
    name[ordered] = np.cumsum(new) - 1
    if new.all():
        return _induce(text, small, ordered, letters)
    reduced = suffix_array(name[places])
    return _induce(text, small, places[reduced], letters)


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, by place in the text (permuted form).

    A place whose letter before equals that before its predecessor continues the previous place's match: its
    value is one less. Only the other places are compared, eight letters a step.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    value = np.zeros(n, np.int64)
    heads = np.ones(n, bool)
    heads[1:] = (before[1:] < 1) | (text[:-1] != text[before[1:] - 1]) | (before[:-1] < 0)
    at = np.flatnonzero(heads & (before >= 0))
    have = np.zeros(len(at), np.int64)
    short = np.append(text, np.zeros(16, text.dtype)).astype(np.uint8)  # equal letters have equal low bytes
    words = np.zeros(n + 8, np.uint64)
    for k in range(8):
        words |= short[k : k + n + 8].astype(np.uint64) << np.uint64(8 * k)
    live = np.arange(len(at))
    while len(live):
        p, q = at[live] + have[live], before[at[live]] + have[live]
        same = np.maximum(p, q) + 8 <= n
        same[same] = words[p[same]] == words[q[same]]
        live = live[same]
        have[live] += 8
    live = np.arange(len(at))
    for _ in range(8):
        p, q = at[live] + have[live], before[at[live]] + have[live]
        same = np.maximum(p, q) < n
        same[same] = text[p[same]] == text[q[same]]
        live = live[same]
        have[live] += 1
    value[at] = have
    head_of = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    return np.where(heads, value, np.maximum(value[head_of] - (np.arange(n) - head_of), 0))


def repeated_starts(texts: list[bytes], ranges: np.ndarray, weights: np.ndarray, window: int) -> list[np.ndarray]:
    """Of each text the starts 0 .. range whose `window` bytes occur at two or more such starts of all texts.

    A text with weight w stands for w equal ones.
    """
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum(sizes + 1) - sizes
    joined = np.frombuffer(b"\0" + b"\0".join(texts), np.uint8).astype(np.uint16) + 1
    joined[begins - 1] = 0
    order = suffix_array(joined)
    prefix = common_prefixes(joined, order)[order]
    weight = np.zeros(len(joined), np.int64)
    at = np.repeat(begins - (np.cumsum(ranges + 1) - (ranges + 1)), ranges + 1) + np.arange((ranges + 1).sum())
    weight[at] = np.repeat(weights, ranges + 1)
    group = np.cumsum(prefix < window)
    many = np.bincount(group, weights=weight[order])[group] >= 2
    hit = np.zeros(len(joined), bool)
    hit[order[many]] = True
    return [np.flatnonzero(hit[b : b + r + 1]) for b, r in zip(begins, ranges, strict=True)]


# --- on Spark -----------------------------------------------------------------------------------


def _runs(starts: np.ndarray) -> bytes:
    """Ascending numbers as packed (first, last) pairs of runs."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return np.stack([starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)]], 1).astype(np.int32).tobytes()


def _cut_out(window: int):
    """Documents with the contexts to take from them -> context bytes, or hashes of its windows if it is thinned."""

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()))

    def packed(out: list[tuple]) -> pa.RecordBatch:
        names = ["anchor", "context", "weight", "more", "piece", "hashes"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            for text, wanted in zip(batch["text"], batch["wanted"], strict=True):
                text = text.as_buffer()
                for x in wanted.as_py():
                    size = x["more"] + window
                    piece, hashes = memoryview(text)[x["start"] : x["start"] + size].tobytes(), None
                    if x["hot"]:
                        at = np.arange(x["more"] + 1)
                        hashes = _spans_hash(np.frombuffer(piece, np.uint8), at, at + window).view(np.int64)
                        piece = None
                    out.append((x["anchor"], x["context"], x["weight"], x["more"], piece, hashes))
                    held += size * (8 if x["hot"] else 1)
                    if held > STEP or len(out) >= 5000:
                        yield packed(out)
                        out, held = [], 0
        if out:
            yield packed(out)
        release()

    return cut


def _shard(window: int):
    def search(group: pa.Table) -> pa.Table:
        # rows equal in id and text bring the same contexts: one of each is enough, its weight counts them all
        pairs = np.stack([np.asarray(group[c].combine_chunks()) for c in ("anchor", "context")])
        group = group.take(pa.array(np.unique(pairs, axis=1, return_index=True)[1]))
        pieces = [x.as_buffer().to_pybytes() for x in group["piece"]]
        more, weight = (np.asarray(group[c].combine_chunks()).astype(np.int64) for c in ("more", "weight"))
        found = repeated_starts(pieces, more, weight, window)
        release()
        keep = np.array([len(f) > 0 for f in found])
        runs = pa.array([_runs(f) for f in found if len(f)], pa.binary())
        return pa.table([group["anchor"].filter(pa.array(keep)), group["context"].filter(pa.array(keep)), runs], names=["anchor", "context", "runs"])

    return search


def _hot_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = [_runs(np.unique(np.array(x, np.int64))) for x in batch["places"].to_pylist()]
        yield pa.record_batch([batch["anchor"], batch["context"], pa.array(runs, pa.binary())], ["anchor", "context", "runs"])


def _kept(window: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, shas, sizes = [], [], [], []
            for text, found in zip(batch["text"], batch["found"].to_pylist(), strict=True):
                text = text.as_buffer()
                sizes.append(text.size)
                digest = hashlib.sha256()
                done = gone = many = 0
                if found:
                    pairs = np.concatenate([np.frombuffer(x["runs"], np.int32).reshape(-1, 2).astype(np.int64) + x["start"] for x in found])
                    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                    ends = np.maximum.accumulate(pairs[:, 1]) + window
                    new = np.flatnonzero(np.append(True, pairs[1:, 0] > ends[:-1]))
                    for lo, hi in zip(pairs[new, 0].tolist(), ends[np.append(new[1:], len(ends)) - 1].tolist(), strict=True):
                        digest.update(memoryview(text)[done:lo])
                        done, gone, many = hi, gone + hi - lo, many + 1
                digest.update(memoryview(text)[done:])
                removed.append(gone)
                spans.append(many)
                shas.append(digest.hexdigest())
            columns = [batch["doc_id"], *(pa.array(c, pa.int64()) for c in (sizes, removed, spans)), pa.array(shas)]
            yield pa.record_batch(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return keep


def _different(rows: DataFrame) -> DataFrame:
    """doc_id, own, text and number of rows (copies) of each different row.

    Only rows that repeat are grouped with their texts; partial sums leave one of them a task.
    """
    key = ["doc_id", "own"]
    repeated = stored(rows.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1"), "repeated-rows")
    every = rows.select(*key, "text")
    if not repeated.head(1):
        return every.withColumn("copies", F.lit(1).cast("long"))
    once = every.join(repeated, key, "left_anti").withColumn("copies", F.lit(1).cast("long"))
    return once.unionByName(every.join(repeated.select(*key), key, "left_semi").groupBy(*key).agg(F.first("text").alias("text"), F.count("*").alias("copies")))


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, shard: int = SHARD, many: int = MANY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of `docs` (doc_id, text)."""
    # a row is known by its id and text: rows equal in both have the same result
    rows = texts(docs).withColumn("own", F.xxhash64("text")).withColumn("no_id", F.col("doc_id").isNull())
    rows = rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(0).cast("long"))).withColumn("own", F.col("own") + F.col("no_id").cast("long"))
    different_rows = _different(rows)
    found = different_rows.mapInArrow(
        _occurrences(window, seed), "doc_id long, own long, copies long, start long, more int, anchor long, context long"
    )
    found = stored(found, "anchors")
    often = found.groupBy("anchor").agg(F.sum("copies").alias("total")).where("total > 1").select("anchor")
    # salted: an anchor of a large group of copies is cut in several tasks
    often = often.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(SALTS)).cast("int"))
    found = stored(salted.join(often, ["anchor", "salt"]).drop("salt"), "repeated")
    contexts = found.groupBy("anchor", "context").agg(
        F.sum("copies").alias("weight"), F.min(F.struct("doc_id", "own", "start", "more")).alias("at")
    )
    contexts = stored(contexts, "contexts")
    large = contexts.groupBy("anchor").agg(F.count("*").alias("different")).where(F.col("different") > many)
    large = stored(large, "large-anchors")
    picked = contexts.join(large, "anchor", "left").select(
        F.col("at.doc_id").alias("doc_id"),
        F.col("at.own").alias("own"),
        F.struct("anchor", "context", "weight", F.col("at.start").alias("start"), F.col("at.more").alias("more"), F.col("different").isNotNull().alias("hot")).alias("w"),
    )
    wanted = picked.groupBy("doc_id", "own").agg(F.collect_list("w").alias("wanted"))
    source = different_rows.select("doc_id", "own", "text").join(wanted, ["doc_id", "own"]).select("text", "wanted")
    pieces = source.mapInArrow(_cut_out(window), "anchor long, context long, weight long, more int, piece binary, hashes array<long>")
    thinned = bool(large.head(1))
    if thinned:
        pieces = stored(pieces, "pieces")
    total = contexts.agg(F.coalesce(F.sum(F.col("at.more") + window), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard))
    cold = pieces.where("piece is not null")
    cold = cold.select("anchor", "context", "weight", "more", "piece", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard"))
    runs = cold.repartition(max(8, shards), "shard").groupBy("shard").applyInArrow(_shard(window), "anchor long, context long, runs binary")
    if thinned:
        hot = pieces.where("piece is null").dropDuplicates(["anchor", "context"])
        hot = hot.select("anchor", "context", "weight", F.posexplode("hashes").alias("place", "hash"))
        often = hot.groupBy("anchor", "hash").agg(F.sum("weight").alias("k")).where("k > 1").select("anchor", "hash")
        places = hot.join(often, ["anchor", "hash"]).groupBy("anchor", "context").agg(F.collect_list("place").alias("places"))
        runs = runs.union(places.mapInArrow(_hot_runs, "anchor long, context long, runs binary"))
    runs = stored(runs, "runs")
    spans = found.join(runs, ["anchor", "context"]).groupBy("doc_id", "own").agg(F.collect_list(F.struct("start", "runs")).alias("found"))
    whole = rows.join(spans, ["doc_id", "own"], "left")
    whole = whole.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "text", "found")
    return whole.mapInArrow(_kept(window), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
