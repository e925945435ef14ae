"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman alignment scores them.

1. Word 4-grams of a test item are its seeds (an item with fewer words gives its whole sequence, looked for
   at its own width). Every gram of an item is one, however often it occurs: an edited copy keeps whichever
   grams its edits leave, and beside a full copy those are the more frequent ones.
2. Each seed hit in a document fixes a diagonal. Around the diagonals of an item (its length and a margin on
   both sides, overlapping ranges united) a local alignment of words scores match 2, mismatch -1, gap -1, so
   edited and reordered copies still score high. A range with too few words of the item to reach the score
   with all of them matched is not aligned.
3. A document is contaminated by an item if the best alignment reaches `least` of the item's score with itself.

Documents stay where they are: items travel, in blocks of a fixed size in bytes, one pass over the documents
for each block. Words are runs of non-space, A-Z lower-cased. Items and documents that are null or blank take
no part. Equal items are reported each; repeated documents give repeated rows. Columns other than doc_id, text
and item_id, text are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import bytes_of, chunks, stored, texts
from marketlake.llm.words import shingles, word_bounds, word_hashes

GRAM = 4
#: Share of an item's own score from which on a passage counts as its copy.
LEAST = 0.5
MATCH, OTHER, GAP = 2, -1, -1
#: Bytes of items that travel at once.
BLOCK = 4_000_000
STEP = 1_500_000


@dataclass(frozen=True)
class Items:
    """Words of the items of one block, and their grams: hash, item and place, by hash."""

    ids: np.ndarray
    words: list[np.ndarray]
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray

    @property
    def hashes(self) -> np.ndarray:
        return np.unique(self.grams)

    @property
    def widths(self) -> list[int]:
        """Gram widths to look for in documents."""
        return sorted({min(len(w), GRAM) for w in self.words} - {0})


def _grams(word: np.ndarray, doc: np.ndarray, n: int, width: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and place (in words of all texts) of each gram."""
    hashes, of = shingles(word, doc, n, width)
    begins = np.searchsorted(doc, np.arange(n))
    full = len(word) - width + 1
    own = np.flatnonzero(doc[: max(0, full)] == doc[width - 1 :]) if full > 0 else np.zeros(0, np.int64)
    return hashes, of, np.concatenate([own, begins[of[len(own) :]]])


def items_of(rows: list[tuple[int, str]]) -> Items:
    rows = sorted(rows)
    data, offsets = bytes_of(pa.array([t.encode() for _, t in rows], pa.binary()))
    start, end, doc = word_bounds(data, offsets)
    word = word_hashes(data, start, end)
    begins = np.searchsorted(doc, np.arange(len(rows) + 1))
    hashes, of, place = _grams(word, doc, len(rows))
    place = place - begins[of]
    order = np.argsort(hashes, kind="stable")
    return Items(np.array([i for i, _ in rows], np.int64), np.split(word, begins[1:-1]), hashes[order], of[order], place[order])


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local score of the item's words against the passage's, and where it ends in the passage."""
    span = np.arange(len(passage) + 1) * -GAP
    row = np.zeros(len(passage) + 1, np.int64)
    best, at = 0, 0
    for word in item:
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(passage == word, MATCH, OTHER), row[1:] + GAP)
        np.maximum(new, 0, out=new)
        # gaps in the item: the best earlier cell of the row less its distance
        row = np.maximum(new, np.maximum.accumulate(new + span) - span)
        k = int(row.argmax())
        if row[k] > best:
            best, at = int(row[k]), k
    return best, at


def _hits(part: pa.Table, hashes: np.ndarray, widths: list[int]):
    """Words of the texts and their documents; hash, document and place of the grams that are looked for."""
    data, offsets = bytes_of(part["text"])
    start, end, doc = word_bounds(data, offsets)
    word = word_hashes(data, start, end)
    found = []
    for width in widths:
        gram, of, place = _grams(word, doc, part.num_rows, width)
        at = np.minimum(np.searchsorted(hashes, gram), len(hashes) - 1)
        hit = np.flatnonzero(hashes[at] == gram)
        found.append((gram[hit], of[hit], place[hit]))
    return word, doc, *map(np.concatenate, zip(*found, strict=True))


def _aligned(items: Items, least: float):
    hashes, widths = items.hashes, items.widths

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, STEP):
            word, doc, gram, of, place = _hits(part, hashes, widths)
            begins = np.searchsorted(doc, np.arange(part.num_rows + 1))
            lo, hi = np.searchsorted(items.grams, gram), np.searchsorted(items.grams, gram, side="right")
            times = hi - lo
            rows = np.repeat(np.arange(len(gram)), times)
            g = np.repeat(lo - (np.cumsum(times) - times), times) + np.arange(times.sum())
            of, item, diagonal = of[rows], items.item[g], place[rows] - items.place[g]
            length = np.array([len(w) for w in items.words])[item] if len(item) else item
            margin = length // 4 + 4
            first, last = diagonal - margin, diagonal + length + margin
            order = np.lexsort((first, item, of))
            of, item, first, last = of[order], item[order], first[order], last[order]
            # an item's ranges have one length, so the one before ends last
            new = np.ones(len(order), bool)
            new[1:] = (of[1:] != of[:-1]) | (item[1:] != item[:-1]) | (first[1:] > last[:-1])
            at = np.flatnonzero(new)
            of, item, first, last = of[at], item[at], first[at], last[np.append(at[1:], len(order))[: len(at)] - 1]
            first, last = np.maximum(first, begins[of]), np.minimum(last, begins[of + 1])
            ids = np.asarray(part["doc_id"].combine_chunks())
            valid = np.asarray(part["doc_id"].combine_chunks().is_valid())
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            for d, i, begin, stop in zip(of.tolist(), item.tolist(), first.tolist(), last.tolist(), strict=True):
                own, passage = items.words[i], word[begin:stop]
                # no alignment scores more than all words of the passage that the item has
                if MATCH * np.isin(passage, own).sum() < least * MATCH * len(own):
                    continue
                score, end = align(own, passage)
                if score >= least * MATCH * len(own) and score > best.get((d, i), (0,))[0]:
                    best[d, i] = (score, begin - begins[d], begin - begins[d] + end)
            if best:
                keys = list(best)
                columns = [
                    pa.array([int(ids[d]) if valid[d] else None for d, _ in keys], pa.int64()),
                    pa.array([int(items.ids[i]) for _, i in keys], pa.int64()),
                    pa.array([best[key][0] / (MATCH * len(items.words[key[1]])) for key in keys], pa.float64()),
                    pa.array([int(best[key][1]) for key in keys], pa.int64()),
                    pa.array([int(best[key][2]) for key in keys], pa.int64()),
                ]
                yield pa.record_batch(columns, ["doc_id", "item_id", "score", "from_word", "to_word"])

    return look


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """doc_id, item_id, score (share of the item's own), and the words of the document the alignment lies in."""
    spark = docs.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * size // block))
    schema = "doc_id long, item_id long, score double, from_word long, to_word long"
    out = spark.createDataFrame([], schema)
    source = texts(docs)
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        known = items_of([tuple(r) for r in rows])
        if not len(known.grams):
            continue
        out = out.union(source.mapInArrow(_aligned(known, least), schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """`docs` without contaminated documents; rows without doc_id stay."""
    found = stored(contaminated(docs, benchmark, least).select("doc_id").where("doc_id is not null").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
