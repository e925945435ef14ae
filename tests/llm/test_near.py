"""n-gram Jaccard join and suffix-array dedup against plain versions."""

import random

import brute
import numpy as np
import pytest

from marketlake.llm import ngram_jaccard, suffix_dedup
from marketlake.llm.common import components, table

DOCS = "doc_id long, text string, component string"


def _random_docs(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        if i and rng.random() < 0.6:
            base = list(out[rng.randrange(len(out))])
            for _ in range(rng.randrange(0, 4)):
                if base:
                    base[rng.randrange(len(base))] = rng.choice(words)
            out.append(base)
        else:
            out.append([rng.choice(words) for _ in range(rng.choice([0, 1, 3, 4, 5, 30, 80, 200]))])
    return [(i * 7, " ".join(w).upper() if i % 9 == 0 else "\t".join(w)) for i, w in enumerate(out)]


@pytest.mark.parametrize("block", [1_000_000, 300])
def test_links_equal_all_pairs(spark, rows, block):
    """Small blocks cut every group: links across blocks must not be lost."""
    docs = _random_docs(3) + [(9001, None), (9002, ""), (9003, " \n"), (9004, "one two"), (9005, "ONE  two")]
    df = spark.createDataFrame([(*d, "x") for d in docs], DOCS)
    got = ngram_jaccard.near_duplicates(df, bucket=500, block=block)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.near_components(docs), key=repr)


def test_repeated_rows_and_empty_table(spark, rows):
    df = spark.createDataFrame([(1, "a b c d e f", ""), (1, "a b c d e f", ""), (2, "A b c d e f", ""), (None, "a b c d e f", "")], DOCS)
    got = ngram_jaccard.near_duplicates(df)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 2, 1)], key=repr)
    assert ngram_jaccard.near_duplicates(df.limit(0)).count() == 0


def test_rows_that_share_an_id_or_have_none(spark, rows):
    """Rows are told apart by id and text: none is lost, and unlike ones are not linked."""
    texts = ["a b c d e f", "g h i j k l", "m n o p q r", "s t u v w x"]
    df = spark.createDataFrame([(None, texts[0], ""), (None, texts[1], ""), (1, texts[2], ""), (1, texts[3], ""), (1, "", ""), (1, "", "")], DOCS)
    got = ngram_jaccard.near_duplicates(df)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted([(None, 2, None)] * 2 + [(1, 2, 1)] * 2 + [(1, 0, 1)] * 2, key=repr)
    assert rows(ngram_jaccard.keep_first(df)) == rows(df)
    linked = df.union(spark.createDataFrame([(0, texts[1], ""), (5, texts[2], ""), (None, texts[3], "")], DOCS))
    got = ngram_jaccard.near_duplicates(linked)
    want = [(None, 2, None), (None, 2, 0), (0, 2, 0), (1, 2, 1), (5, 2, 1), (1, 2, 1), (None, 2, 1), (1, 0, 1), (1, 0, 1)]
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(want, key=repr)
    kept = [(None, texts[0], ""), (0, texts[1], ""), (1, texts[2], ""), (1, texts[3], ""), (1, "", ""), (1, "", "")]
    assert rows(ngram_jaccard.keep_first(linked)) == sorted(kept, key=repr)


def test_keep_first_edges(spark, rows):
    """Repeated rows leave one, also without an id; clashing columns and empty tables pass."""
    kind = "doc_id long, text string, text_hash string, node int, best string"
    some = [(None, "a b c d e f", "x", 1, "y")] * 30 + [(3, "q r s t u v w", "x", 1, "y")] * 2 + [(4, None, None, None, None)] * 2
    df = spark.createDataFrame(some, kind)
    assert rows(ngram_jaccard.keep_first(df)) == sorted([some[0], some[30], some[32], some[32]], key=repr)
    assert ngram_jaccard.keep_first(df).columns == df.columns
    assert ngram_jaccard.keep_first(df.limit(0)).count() == 0


def test_one_line_in_all_documents(spark, rows):
    """A line that all texts share links none of them."""
    rng = random.Random(9)
    line = " ".join(f"l{k}" for k in range(25))
    docs = [(i, f"{line} {' '.join(rng.choice('abcdefgh') * 3 + str(rng.random()) for _ in range(rng.randrange(12, 60)))}") for i in range(200)]
    df = spark.createDataFrame([(*d, "") for d in docs], DOCS)
    got = ngram_jaccard.near_duplicates(df, bucket=500, block=300)
    assert rows(got, "doc_id", "component_id") == sorted([(i, i) for i, _ in docs], key=repr)


def test_one_large_group_of_near_copies(spark, rows):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randrange(1, 6)):
            copy[rng.randrange(len(copy))] = f"x{rng.random()}"
        docs.append((i, " ".join(copy)))
    df = spark.createDataFrame([(*d, "") for d in docs], DOCS)
    got = ngram_jaccard.near_duplicates(df, bucket=2000, block=2500)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute.near_components(docs), key=repr)


def test_components(spark, rows):
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101)], "a long, b long")
    assert rows(components(chain, "t")) == sorted([(i, 0) for i in range(41)] + [(100, 100), (101, 100), (102, 100)], key=repr)


@pytest.mark.parametrize("letters", [1, 2, 4, 26])
def test_suffix_array_and_prefixes(letters):
    rng = np.random.default_rng(letters)
    text = rng.integers(97, 97 + letters, 900).astype(np.uint8)
    text[500:700] = text[100:300]
    order = suffix_dedup.suffix_array(text.astype(np.uint16))
    assert list(order) == brute.suffix_order(text)
    prefix = suffix_dedup.common_prefixes(text.astype(np.uint16), order)
    raw = bytes(text)
    for r in range(1, len(raw)):
        i, j, k = order[r], order[r - 1], 0
        while max(i, j) + k < len(raw) and raw[i + k] == raw[j + k]:
            k += 1
        assert prefix[i] == k


@pytest.mark.parametrize("many", [2000, 1])
def test_repeats_equal_brute_force(spark, rows, tables, many):
    docs = [(r.doc_id, r.text) for r in table(spark, tables, "documents").select("doc_id", "text").collect()][:80]
    long = "é" * 500
    docs += [(5000, long), (5001, None), (5002, ""), (5003, docs[0][1]), (5003, docs[0][1]), (None, docs[1][1]), (5004, "ab" * 900)]
    df = spark.createDataFrame([(*d, "x") for d in docs], DOCS)
    got = suffix_dedup.remove_repeats(df, shard=20_000, many=many)
    assert rows(got) == brute.repeats_removed(docs, 400)
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_many_equal_rows_are_worked_on_once(spark, rows):
    """Rows equal in id and text, with and without an id, beside others that share part of the text."""
    rng = random.Random(12)
    text = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    other = "".join(rng.choice("abcdefgh ") for _ in range(900)) + text[300:900]
    docs = [(None, text)] * 6 + [(1, text)] * 3 + [(2, other)] * 2 + [(3, other[:800])] + [(None, None)] * 2 + [(0, text)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame([(*d, "") for d in docs], DOCS))
    assert rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeats_removed(docs, 400)
    many = spark.range(5000).selectExpr("cast(null as long) AS doc_id", f"'{text}' AS text", "'' AS component")
    done = suffix_dedup.remove_repeats(many).groupBy("n_removed").count().collect()
    assert [(r.n_removed, r["count"]) for r in done] == [(2000, 5000)]
