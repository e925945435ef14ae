"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Each text gives a vector of transformed statistics (sizes, shares of character kinds, repetition of words,
word pairs and lines). Of each class the mean and the covariance are summed by Spark over all labelled rows
outside the held-out fold; the covariance is shrunk towards the pooled one and then towards a multiple of the
identity. A text's score is the probability of label 1 from the difference of the classes' log densities:
Mahalanobis distances by the cached Cholesky factors, log determinants, and log priors.

Labels are learned only from rows with crc32(doc_id as text) mod 5 <> 0; labels, lang, source and doc_id never
enter a score. A null text counts as empty and has a score like any other. Rows with several labels count once
for each; rows without label are scored only. If a class has no labelled row, every score is the share of
label 1 among labels (1 without labels). Empty tables give no rows. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import bytes_of, chunks, stored, texts
from marketlake.llm.words import mixed, word_bounds, word_hashes

NAMES = (
    "bytes", "word_bytes", "upper", "digit", "mark", "odd", "pipe", "high", "line_words",
    "new_words", "same_next", "new_pairs", "new_lines", "odd_end",
)
#: A text is rejected below this score.
LEAST = 0.3
POOLED = 0.1
IDENTITY = 0.01
STEP = 1_500_000

_KIND = np.zeros(256, np.uint8)
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[[ord(c) for c in ".,;:'\"?-()"]] = 3
_KIND[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{}~"]] = 4
_KIND[ord("|")] = 5
_KIND[128:] = 6
_KIND[ord("\n")] = 7


def held_out(doc_id: str = "doc_id") -> Column:
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def _different(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """How many different values each document has."""
    keyed = np.sort(doc.astype(np.uint64) << np.uint64(48) | values >> np.uint64(16))
    first = np.concatenate([[True], keyed[1:] != keyed[:-1]]) if len(keyed) else np.zeros(0, bool)
    return np.bincount((keyed[first] >> np.uint64(48)).astype(np.int64), minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of NAMES for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    full = np.flatnonzero(size)
    kinds = _KIND[data]
    share = np.zeros((8, n))
    if len(full):
        for k in range(1, 8):
            share[k, full] = np.add.reduceat(kinds == k, offsets[:-1][full], dtype=np.int64)
    start, end, doc = word_bounds(data, offsets)
    word = word_hashes(data, start, end)
    words = np.bincount(doc, minlength=n).astype(float)
    some = np.maximum(words, 1)
    same_doc = doc[1:] == doc[:-1]
    again = np.bincount(doc[1:][same_doc & (word[1:] == word[:-1])], minlength=n)
    pair = mixed(word[:-1] * np.uint64(3) + word[1:])[same_doc]
    pairs = np.bincount(doc[1:][same_doc], minlength=n)
    ends = np.isin(kinds[end - 1], (4, 5)) if len(end) else np.zeros(0, bool)
    # lines by the sum of their words' hashes
    breaks = np.concatenate([[0], np.cumsum(kinds == 7)])[start] if len(start) else np.zeros(0, np.int64)
    new_line = np.concatenate([[True], (breaks[1:] != breaks[:-1]) | ~same_doc]) if len(start) else np.zeros(0, bool)
    at = np.flatnonzero(new_line)
    line = mixed(np.add.reduceat(word, at)) if len(at) else np.zeros(0, np.uint64)
    lines = np.bincount(doc[at], minlength=n)
    weight = np.maximum(size, 1)
    part = lambda x, of: np.log(0.002 + x / of)
    long = np.log1p(words)
    return np.stack(
        [
            np.log1p(size),
            np.log1p(size / some),
            part(share[1], weight),
            part(share[2], weight),
            part(share[3], weight),
            part(share[4], weight),
            part(share[5], weight),
            part(share[6], weight),
            np.log1p(words / np.maximum(lines, 1)),
            np.log1p(_different(word, doc, n)) / np.maximum(long, 1),
            part(again, some),
            part(np.maximum(pairs, 1) - np.minimum(_different(pair, doc[1:][same_doc], n), pairs), np.maximum(pairs, 1)),
            part(np.maximum(lines, 1) - _different(line, doc[at], n), np.maximum(lines, 1)),
            part(np.bincount(doc[ends], minlength=n), some),
        ],
        1,
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, STEP):
        rows = statistics(*bytes_of(part["text"]))
        values = pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), pa.array(rows.ravel()))
        yield pa.record_batch([part["doc_id"].combine_chunks(), values], ["doc_id", "x"])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the vector x of each row."""
    return texts(docs).mapInArrow(_measured, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Model:
    """Means, inverse Cholesky factors and constants of the classes 0 and 1; `share` is used if one is missing."""

    means: np.ndarray | None
    factors: np.ndarray | None
    constants: np.ndarray | None
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        density = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return np.round(1 / (1 + np.exp(np.clip(density[0] - density[1], -60, 60))), 9)


def fit(rows: DataFrame, labels: DataFrame) -> Model:
    """rows: doc_id, x. Sums of each class come to the driver: a fixed number of values, whatever the corpus."""
    known = labels.where("quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("label"))
    learn = rows.join(known, "doc_id").where(~held_out())
    d = len(NAMES)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = np.asarray(batch["x"].flatten()).reshape(-1, d)
            label = np.asarray(batch["label"])
            for k in (0, 1):
                own = x[label == k]
                total[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        yield pa.record_batch(
            [pa.array(np.repeat([0, 1], total.shape[1]), pa.int32()), pa.array(np.tile(np.arange(total.shape[1]), 2), pa.int32()), pa.array(total.ravel())],
            ["label", "place", "value"],
        )

    sums = learn.select("x", "label").mapInArrow(summed, "label int, place int, value double")
    total = np.zeros((2, 1 + d + d * d))
    for r in sums.groupBy("label", "place").agg(F.sum("value").alias("value")).collect():
        total[r.label, r.place] = r.value
    count = total[:, 0]
    if count.min() < 2:
        return Model(None, None, None, float(count[1] / count.sum()) if count.sum() else 1.0)
    means = total[:, 1 : d + 1] / count[:, None]
    scatter = total[:, d + 1 :].reshape(2, d, d) - count[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(0) / count.sum()
    factors, constants = [], []
    for k in (0, 1):
        own = (1 - POOLED) * scatter[k] / count[k] + POOLED * pooled
        own = (1 - IDENTITY) * own + IDENTITY * (np.trace(own) / d + 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(own)
        factors.append(np.linalg.inv(factor))
        constants.append(np.log(count[k] / count.sum()) - np.log(np.diag(factor)).sum())
    return Model(means, np.stack(factors), np.array(constants), 0.0)


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of each row of doc_id, x."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch["x"].flatten()).reshape(-1, len(NAMES))
            yield pa.record_batch([batch["doc_id"], pa.array(model.score(x))], ["doc_id", "score"])

    return rows.mapInArrow(score, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `docs`."""
    rows = stored(measured(docs), "statistics")
    out = scored(rows, fit(rows, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """`docs` without the rows that the classifier rejects; each row is judged by its own text."""
    model = fit(measured(docs), labels)
    columns = docs.columns
    place = columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, STEP):
            text = part.column(place).combine_chunks()
            data, offsets = bytes_of(text.fill_null("").cast(pa.large_binary()))
            good = model.score(statistics(data, offsets)) >= least
            yield from part.filter(pa.array(good)).combine_chunks().to_batches()

    return docs.mapInArrow(keep, docs.schema)
