"""Words one edit apart, and the more frequent form that a spelling variant belongs to.

Letters fall into groups, and a word is the vector of how often each group occurs in it. One inserted letter adds one
to one count, a deleted one takes one away, a replaced one does both or, within a group, neither. So words near to
each other have vectors within a surplus and a deficit of one each.

The words are arranged by length and successive counts: a trie whose upper levels (length and the first counts) are
spread over the cluster by their values. A word is looked up in every upper node within its budget, and goes on there
with what is left of it. In each node the lower levels are searched depth first, for many words at once: at each
level a word follows the child of its own count, that of one more if it has a surplus left, and that of one less if
it has a deficit left. What reaches a leaf is verified by its letters: equal heads and tails leave just one edit.

Each pair is looked for from one side only: from the longer word, and between words of one length from the one that
spends the deficit before the surplus, or from the lesser one where the vectors are equal. Nodes with many words
looked up are cut by these; the words that lie in a node are those of one length and equal first counts.

Words are counted in the tasks and then summed, so no word is hot. Each word's near words are summed likewise, and
roots are found by doubling: a word takes its form's root so far, until none changes.

A null or empty text has no words, a null doc_id stands as an empty text before the colon. Repeated rows count each.
Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import bytes_of, chunks, release, small_batches, stored

LEAST_LETTERS, LEAST_TIMES = 5, 3
#: A form is so many times as frequent as its variant, at least.
TIMES = 2
#: One of so many pairs of document and word loses a letter.
DAMAGED = 97
#: The most frequent letters of Latin script, each a group of its own; the others fall into four groups.
ALONE = "eaionsrtldum"
GROUPS = len(ALONE) + 4
#: Groups whose counts, with the length, name an upper node.
UPPER = 5
#: Different words that a task counts before it passes them on.
HELD = 200_000
STEP = 4_000_000
#: Words looked up in a node at once, and places of the search that are held at once.
LOOKED_UP = 50_000
FRONT = 200_000
#: Letters up to which words are compared as rows of a matrix.
WIDE = 48
#: What a word has spent: nothing, the deficit, both; and towards a shorter word, which takes a deficit alone: it, or nothing yet.
NONE, DEFICIT, BOTH, ALL, NOT_YET = range(5)
_RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")


# --- words --------------------------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of texts, damaged where the rule says so, and how often they occur."""
    total: Counter[bytes] = Counter()

    def batch() -> pa.RecordBatch:
        long_ones = [(w, n) for w, n in total.items() if len(w) >= LEAST_LETTERS and len(w) - w.count(b"\xc3") >= LEAST_LETTERS]
        words, times = zip(*long_ones, strict=True) if long_ones else ((), ())
        return pa.record_batch([pa.array(words, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())], ["word", "n"])

    for part in chunks(batches, STEP):
        data, offsets = bytes_of(part["text"])
        raw = data.tobytes().lower()
        ends = offsets.tolist()
        for k, doc_id in enumerate(part["id"].to_pylist()):
            head = zlib.crc32(f"{doc_id}:".encode())
            for word, n in Counter(_RUN.findall(raw, ends[k], ends[k + 1])).items():
                h = zlib.crc32(word, head)
                if h % DAMAGED == 0:
                    letters = word.decode()
                    at = h % len(letters)
                    word = (letters[:at] + letters[at + 1 :]).encode()
                total[word] += n
        if len(total) > HELD:
            yield batch()
            total.clear()
    if total:
        yield batch()
    total.clear()
    release()


def words(docs: DataFrame) -> DataFrame:
    """word, n: the words that are long and frequent enough."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counted = rows.mapInArrow(_counted, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TIMES)


# --- vectors ------------------------------------------------------------------------------------


def _groups() -> np.ndarray:
    group = len(ALONE) + np.arange(256) % (GROUPS - len(ALONE))
    for k, letter in enumerate(ALONE):
        group[ord(letter)] = k
    return group


_GROUP = _groups()


class Letters:
    """Words as bytes of Latin-1, end to end, with their count vectors."""

    def __init__(self, some: list[str]):
        raw = [w.encode("latin-1") for w in some]
        self.size = np.array([len(w) for w in raw], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        n = len(raw)
        of = np.repeat(np.arange(n), self.size)
        self.vectors = np.bincount(of * GROUPS + _GROUP[self.data], minlength=n * GROUPS).reshape(n, GROUPS) if n else np.zeros((0, GROUPS), np.int64)

    def padded(self, rows: np.ndarray, width: int, from_end: bool) -> np.ndarray:
        """Letters of some words as rows of a matrix, from their first or their last letter on; 0 beyond."""
        size = np.minimum(self.size[rows], width)
        within = np.arange(width)
        start = self.begin[rows] + self.size[rows] - 1 if from_end else self.begin[rows]
        at = start[:, None] + (-within if from_end else within)
        inside = within < size[:, None]
        return np.where(inside, self.data[np.where(inside, at, 0)], 0)


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one inserted, deleted or replaced letter lies between them."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    least = min(len(a), len(b))
    head = next((k for k in range(least) if a[k] != b[k]), least)
    tail = next((k for k in range(least) if a[-1 - k] != b[-1 - k]), least)
    return head + tail >= max(len(a), len(b)) - 1


def _near(a: Letters, i: np.ndarray, b: Letters, j: np.ndarray) -> np.ndarray:
    """For pairs of different words, not longer by more than one, whether they are one edit apart."""
    longer, shorter = np.maximum(a.size[i], b.size[j]), np.minimum(a.size[i], b.size[j])
    out = np.zeros(len(i), bool)
    small = np.flatnonzero(longer <= WIDE)
    for k in np.split(small, range(LOOKED_UP, len(small), LOOKED_UP)):
        if not len(k):
            continue
        width, equal = int(longer[k].max()), []
        for from_end in (False, True):
            same = a.padded(i[k], width, from_end) == b.padded(j[k], width, from_end)
            # letters in common until the first that differs; padding does not count
            equal.append(np.minimum(np.where(same.all(axis=1), width, np.argmin(same, axis=1)), shorter[k]))
        out[k] = equal[0] + equal[1] >= longer[k] - 1
    for k in np.flatnonzero(longer > WIDE):
        left = a.data[a.begin[i[k]] : a.begin[i[k]] + a.size[i[k]]].tobytes()
        out[k] = one_edit(left, b.data[b.begin[j[k]] : b.begin[j[k]] + b.size[j[k]]].tobytes())
    return out


# --- trie ---------------------------------------------------------------------------------------


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word in its own upper node (role 0), and looked up in the nodes within its budget (role 1)."""
    for batch in batches:
        some = batch["word"].to_pylist()
        letters = Letters(some)
        upper, size = letters.vectors[:, :UPPER], letters.size
        out: list[tuple] = []

        def add(rows: np.ndarray, role: int, less: int | None, more: int | None, shorter: int, size=size, upper=upper, out=out) -> None:
            node = np.column_stack([size[rows] - shorter, upper[rows]])
            if less is not None:
                node[:, 1 + less] -= 1
            if more is not None:
                node[:, 1 + more] += 1
            out.append((rows, role, node, less is not None, more is not None))

        every = np.arange(len(some))
        add(every, 0, None, None, 0)
        for shorter in (0, 1):
            add(every, 1, None, None, shorter)
            for less in range(UPPER):
                rows = np.flatnonzero(upper[:, less] > 0)
                add(rows, 1, less, None, shorter)
                if not shorter:
                    for more in range(less + 1, UPPER):
                        add(rows, 1, less, more, 0)
        for rows, role, node, less, more in out:
            if len(rows):
                n = len(rows)
                names = pa.array([",".join(map(str, x)) for x in node.tolist()])
                flags = [pa.array(np.full(n, x)) for x in (role, int(less), int(more))]
                yield pa.record_batch([names, *flags, batch["word"].take(pa.array(rows)), batch["n"].take(pa.array(rows))], ["node", "role", "less", "more", "word", "n"])


class Trie:
    """The lower levels of a node: counts of the other groups, one after another."""

    def __init__(self, vectors: np.ndarray):
        order = np.lexsort(vectors.T[::-1]) if len(vectors) else np.zeros(0, np.int64)
        vectors = vectors[order]
        self.levels: list[np.ndarray] = []
        parent = np.zeros(len(order), np.int64)
        for k in range(vectors.shape[1]):
            # a child is named by its parent and its count
            keys, parent = np.unique(parent << 32 | vectors[:, k], return_inverse=True)
            self.levels.append(keys)
        self.words, self.leaf_begin = order, np.searchsorted(parent, np.arange(len(self.levels[-1]) + 1))

    def search(self, vectors: np.ndarray, budget: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words looked up, leaves reached, and what was spent till there; budget: what was spent before.

        A surplus comes after a deficit only, as the other order is found from the other word.
        """
        stack = [(0, np.arange(len(vectors)), np.zeros(len(vectors), np.int64), budget)]
        while stack:
            level, who, at, spent = stack.pop()
            if level == len(self.levels):
                yield who, at, spent
                continue
            keys = self.levels[level]
            count = vectors[who, level]
            found = []
            for change, before, after in ((0, None, None), (-1, NONE, DEFICIT), (-1, NOT_YET, ALL), (1, DEFICIT, BOTH)):
                rows = np.arange(len(who)) if before is None else np.flatnonzero((spent == before) & (count + change >= 0))
                if len(rows) and len(keys):
                    key = at[rows] << 32 | count[rows] + change
                    place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    hit = keys[place] == key
                    paid = spent[rows[hit]] if after is None else np.full(int(hit.sum()), after)
                    found.append((who[rows[hit]], place[hit], paid))
            if found:
                who, at, spent = (np.concatenate(x) for x in zip(*found, strict=True))
                for k in range(0, len(who), FRONT):
                    if len(who[k : k + FRONT]):
                        stack.append((level + 1, who[k : k + FRONT], at[k : k + FRONT], spent[k : k + FRONT]))


def _searched(group: pa.Table) -> pa.Table:
    """One node: pairs of near words, each with its number of occurrences."""
    role, word = np.asarray(group["role"].combine_chunks()), group["word"].combine_chunks()
    n = np.asarray(group["n"].combine_chunks())
    here, asked = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
    held = [(np.zeros(0, np.int64),) * 2]
    if len(here) and len(asked):
        index = Letters(word.take(pa.array(here)).to_pylist())
        trie = Trie(index.vectors[:, UPPER:])
        less, more = (np.asarray(group[c].combine_chunks()) for c in ("less", "more"))
        for rows in np.split(asked, range(LOOKED_UP, len(asked), LOOKED_UP)):
            some = Letters(word.take(pa.array(rows)).to_pylist())
            shorter = some.size > index.size[0]
            spent = np.where(shorter, np.where(less[rows] == 1, ALL, NOT_YET), less[rows] + more[rows])
            for who, leaf, end in trie.search(some.vectors[:, UPPER:], spent):
                # equal vectors, a deficit with its surplus, or a deficit alone in a shorter word
                done = (end == NONE) | (end == BOTH) | (end == ALL)
                who, leaf, end = who[done], leaf[done], end[done]
                size = trie.leaf_begin[leaf + 1] - trie.leaf_begin[leaf]
                for lo, hi in _slices(size):
                    many = size[lo:hi]
                    i = np.repeat(who[lo:hi], many)
                    within = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                    j = trie.words[np.repeat(trie.leaf_begin[leaf[lo:hi]], many) + within]
                    keep = _near(some, i, index, j)
                    i, j, kind = i[keep], j[keep], np.repeat(end[lo:hi], many)[keep]
                    left, right = rows[i], here[j]
                    # of two words with one vector the pair is found from both sides
                    if (kind == NONE).any():
                        first = np.array([a < b for a, b in zip(word.take(pa.array(left)).to_pylist(), word.take(pa.array(right)).to_pylist(), strict=True)], bool)
                        left, right = left[(kind != NONE) | first], right[(kind != NONE) | first]
                    held.append((left, right))
    left, right = (np.concatenate(x) for x in zip(*held, strict=True))
    release()
    a, b = pa.array(left), pa.array(right)
    return pa.table([word.take(a), pa.array(n[left]), word.take(b), pa.array(n[right])], names=["a", "a_n", "b", "b_n"])


def _slices(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of leaves with about FRONT words together."""
    ends, lo = np.cumsum(size), 0
    while lo < len(size):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + FRONT, side="right")))
        yield lo, hi
        lo = hi


PAIRS = "a string, a_n long, b string, b_n long"


def near_pairs(counted: DataFrame, most: int = LOOKED_UP) -> DataFrame:
    """a, a_n, b, b_n: each pair of words one edit apart, once; counted: word, n.

    most: words looked up in a task; nodes with more are cut by these.
    """
    placed = counted.mapInArrow(_placed, "node string, role long, less long, more long, word string, n long")
    cuts = placed.where("role = 1").groupBy("node").agg(F.ceil(F.count("*") / most).cast("int").alias("cuts"))
    cut = placed.join(cuts.where("cuts > 1"), "node", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    whole = F.when(F.col("role") == 0, F.sequence(F.lit(0), F.col("cuts") - 1))
    dealt = cut.withColumn("salt", F.explode(whole.otherwise(F.array(F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int")))))
    return dealt.select("node", "salt", "role", "less", "more", "word", "n").groupBy("node", "salt").applyInArrow(_searched, PAIRS)


def roots(forms: DataFrame) -> DataFrame:
    """word, root: forms (word, form or null) followed to the last."""
    now = stored(forms.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next")).where("root <> next")
        new = stored(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        now = new.select("word", "root")
        if not new.where("moved").head(1):
            return now


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word; see the module."""
    counted = stored(words(docs), "spelling-words")
    pairs = stored(near_pairs(counted), "spelling-pairs")
    sides = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = sides.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best")
    )
    joined = counted.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    found = F.col("form_n") >= TIMES * F.col("n")
    forms = stored(
        joined.select(
            "word", F.when(found, F.col("best.form")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(found, F.col("form_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    return forms.join(roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
