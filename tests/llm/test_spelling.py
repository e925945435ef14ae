"""Spelling variants against all pairs of words by plain edit distance."""

import random
import re
import zlib
from collections import Counter

import pytest

from marketlake.llm import spelling_variants
from marketlake.llm.common import table
from marketlake.llm.spelling_variants import near_pairs, one_edit, variants

DOCS = "doc_id long, text string, word string, n int, node string"


def _words(docs):
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def _edits(w, letters):
    for k in range(len(w) + 1):
        for c in letters:
            yield w[:k] + c + w[k:]
            if k < len(w):
                yield w[:k] + c + w[k + 1 :]
        if k < len(w):
            yield w[:k] + w[k + 1 :]


def _plain(docs):
    words = _words(docs)
    letters = sorted(set("".join(words)))
    out = []
    near = {w: {x for x in _edits(w, letters) if x in words and x != w} for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def _docs(seed, n=120):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéÀ×") for _ in range(rng.randrange(4, 9))) for _ in range(25)]
    base += ["l" * 60 + "".join(rng.choice("ab") for _ in range(3)) for _ in range(5)] + ["straße", "mañana", "Colour", "color", "colours"]
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(0, 60)):
            w = rng.choice(base)
            if rng.random() < 0.5:
                k = rng.randrange(len(w) + 1)
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abé") + w[k:], w[:k] + "a" + w[k + 1 :]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        out.append((i, rng.choice([" ", "\n", ", ", "ł"]).join(words)))
    return out


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain(spark, rows, seed):
    docs = _docs(seed) + [(None, None), (None, "colour colour colour"), (None, "colour colour colour"), (7, ""), (8, "a1b2 ÷÷÷÷÷ ÷÷÷÷÷ ÷÷÷÷÷")]
    docs += [(900 + k, " ".join(w for w, n in zip(["zzwwwx", "zzwwyx", "zzvwyx", "zzvvyx", "zzvvyy"], [3, 6, 12, 24, 50], strict=True) if k < n)) for k in range(50)]
    df = spark.createDataFrame([(*d, "x", 1, "y") for d in docs], DOCS)
    want = _plain(docs)
    assert len({w[2] for w in want}) < len(want) and any(w[1] and w[1] != w[2] for w in want)
    assert rows(variants(df), *COLUMNS) == want


def test_table(spark, tables, rows):
    docs = table(spark, tables, "documents")
    assert rows(variants(docs), *COLUMNS) == _plain([(r.doc_id, r.text) for r in docs.collect()])


def test_nodes_cut_by_words_looked_up(spark, monkeypatch):
    """Small cuts of nodes, fronts and matrices lose no pair and find none twice."""
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(5, 9))) for _ in range(250)})
    counted = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = sorted(tuple(sorted((r.a, r.b))) for r in near_pairs(counted, most=7).collect())
    assert got == sorted((a, b) for a in words for b in words if a < b and one_edit(a.encode(), b.encode()))


def test_front_is_cut(monkeypatch):
    import numpy as np

    monkeypatch.setattr(spelling_variants, "FRONT", 3)
    rng = np.random.default_rng(0)
    vectors = rng.integers(0, 2, (60, 6))
    found = set()
    for who, leaf, spent in (trie := spelling_variants.Trie(vectors)).search(vectors, np.zeros(60, np.int64)):
        for w, at, s in zip(who, leaf, spent, strict=True):
            found |= {(int(w), int(x), int(s)) for x in trie.words[trie.leaf_begin[at] : trie.leaf_begin[at + 1]]}
    want = set()
    for a in range(60):
        for b in range(60):
            d = vectors[b] - vectors[a]
            less, more = np.flatnonzero(d == -1), np.flatnonzero(d == 1)
            if not np.abs(d).any():
                want.add((a, b, 0))
            elif np.abs(d).sum() == 1 and len(less):
                want.add((a, b, 1))
            elif len(less) == len(more) == 1 and less[0] < more[0]:
                want.add((a, b, 2))
    assert found == want


def test_one_edit():
    assert one_edit(b"aab", b"ab") and one_edit(b"ab", b"bb") and one_edit(b"a", b"")
    assert not one_edit(b"ab", b"ab") and not one_edit(b"ab", b"ba") and not one_edit(b"abc", b"a")


def test_empty_and_long(spark):
    assert variants(spark.createDataFrame([], DOCS)).columns == list(COLUMNS)
    assert variants(spark.createDataFrame([], DOCS)).count() == 0
    long_run = "ab" * 200_000
    got = variants(spark.createDataFrame([(k, long_run + (" " + long_run + "c") * (k % 2)) for k in range(12)], "doc_id long, text string")).collect()
    assert sorted((len(r.word), r.n, r.n_near) for r in got) == sorted((len(w), n, m) for w, n, m in [(long_run, 12, 1), (long_run + "c", 6, 1)])
