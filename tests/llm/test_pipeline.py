"""PII, quality, decontamination, packing and the whole pipeline."""

import hashlib
import itertools
import random
import re

import pytest

import corpus_pipeline
from marketlake.llm import decontamination, packing, pii, quality
from marketlake.llm.common import table

DOCS = "doc_id long, text string, bucket string, score string"


def _luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _plain_spans(text):
    """The base patterns, applied by finditer."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_equal_plain_patterns(tables, spark):
    rng = random.Random(2)
    made = ["".join(rng.choice("ab.@-+0123456789 4()é") for _ in range(rng.randrange(120))) for _ in range(4000)]
    made += [r.text for r in table(spark, tables, "documents").select("text").collect()]
    made += ["x@y", "a@b@c.d", "a@b.c@d.e", "@a.b", "1.2.3.4.5.6.7.8", "0.0.0.0000255", "4111 1111-1111 1111", "+1 (323) 555-9830", ""]
    for text in made:
        assert pii.base_spans(text) == _plain_spans(text), text


def test_pii_query(spark, rows):
    text = "é bank account DE89370400440532013000, ssn 123-45-6789, 123-45-6788 no words around it at all, so it is left alone by the rule"
    df = spark.createDataFrame([(1, text, "", ""), (2, None, "", ""), (2, "", "", ""), (None, "a@b.cd", "", "")], DOCS)
    got = {(r.doc_id, r.n_email): r for r in pii.find(df).collect()}
    assert got[1, 0].spans.split(",")[0].startswith("iban:15:37") and "ssn:43:54" in got[1, 0].spans
    empty = hashlib.sha256(b"").hexdigest()
    assert got[2, 0].spans == "" and got[2, 0].base_sha256 == empty == got[1, 0].base_sha256
    assert got[None, 1].base_sha256 == hashlib.sha256(b"email:0:6").hexdigest()
    red = {(r.doc_id, r.text) for r in pii.redact(df).collect()}
    assert (None, "<EMAIL>") in red and (2, None) in red and (2, "") in red
    assert pii.find(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF", ["DE89 3704 0044 0532 0130 00"]),
        ("iban GB82WEST12345698765432 2024", ["GB82WEST12345698765432"]),
        ("IBAN DE89370400440532013000 IBAN GB82WEST12345698765432", ["DE89370400440532013000", "GB82WEST12345698765432"]),
        ("DE89370400440532013000 GB82 WEST 1234 5698 7654 32", ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"]),
        ("AB12 CDEF GHIJ DE89 3704 0044 0532 0130 00 Bank", ["DE89 3704 0044 0532 0130 00"]),
        ("NO93 8601 1117 947 KONTO 12 UND NOCH MEHR WORTE 2024", ["NO93 8601 1117 947"]),
        ("DE88370400440532013000 BIC COBADEFF AND MORE", []),
        ("DE89370400440532013000X", []),
    ],
)
def test_ibans_before_capitals_and_digits(text, want):
    found = [text[s:e] for kind, s, e, _ in pii.all_spans(text, 0.6) if kind == "iban"]
    assert found == want
    assert not any(w in pii.redacted(text, pii.all_spans(text, 0.6)) for w in want)


def test_quality_on_the_held_out_fold(spark, tables):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_quality_edges(spark):
    df = spark.createDataFrame([(1, None, "", ""), (1, "", "", ""), (None, "x " * 50_000, "", ""), (3, "good text", "", "")], DOCS)
    labels = spark.createDataFrame([(1, 1), (3, None), (None, 0)], "doc_id long, quality int")
    assert sorted(r.predicted for r in quality.classify(df, labels).collect()) == [1, 1, 1, 1]
    assert quality.keep_good(df, labels.limit(0)).count() == 4
    assert quality.classify(df.limit(0), labels).count() == 0


def test_alignment_equals_plain_smith_waterman():
    import numpy as np

    rng = random.Random(4)
    for _ in range(100):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        h, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
        for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
        assert decontamination.align(np.array(a), np.array(b))[0] == best


def test_copies_are_found_and_others_left(spark, rows):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    items = [[rng.choice(words) for _ in range(30)] for _ in range(5)] + [["two", "words"]]
    edited = list(items[1])
    for k in (3, 11, 19, 27):
        edited[k] = "EDIT"
    noise = lambda n: [rng.choice(words) for _ in range(n)]
    docs = [noise(200) + items[0] + noise(50), noise(20) + edited, noise(400), [*noise(9), "Two", "WORDS", *noise(9)], items[2][:6] + noise(80), []]
    frame = [(i, " ".join(d).upper() if i == 0 else "\n".join(d), "", "") for i, d in enumerate(docs)]
    df = spark.createDataFrame([*frame, (6, None, "", ""), (0, frame[0][1], "", ""), (None, frame[0][1], "", "")], DOCS)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(None, "x y z q"), (9, None), (10, " ")], "item_id long, text string")
    want = sorted([(0, 0), (0, 0), (None, 0), (1, 1), (3, 5)], key=repr)
    for block in (4_000_000, 600):
        assert rows(decontamination.contaminated(df, bench, block=block), "doc_id", "item_id") == want
    assert rows(decontamination.clean(df, bench), "doc_id") == sorted([(2,), (4,), (5,), (6,), (None,)], key=repr)
    assert decontamination.contaminated(df, bench.limit(0)).count() == 0


def test_edited_copy_beside_a_full_copy(spark, rows):
    """The grams an edited copy keeps are the frequent ones of the item; they are seeds all the same."""
    rng = random.Random(11)
    item = [f"w{i}" for i in range(60)]
    every = lambda n: [f"e{k}" if k % n == n - 1 else w for k, w in enumerate(item)]
    noise = lambda: [f"n{rng.randrange(500)}" for _ in range(40)]
    copies = [item, every(7), every(6), every(5)]
    for n in range(2, 5):
        docs = [(i, " ".join([*noise(), *c, *noise()]), "", "") for i, c in enumerate([item, every(n + 3), noise()])]
        df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
        assert rows(decontamination.contaminated(df, bench), "doc_id") == [(0,), (1,)]
    docs = [(i, " ".join([*noise(), *c, *noise()]), "", "") for i, c in enumerate(copies)]
    found = {r.doc_id: r.score for r in decontamination.contaminated(spark.createDataFrame(docs, DOCS), bench).collect()}
    assert found == pytest.approx({0: 1.0, 1: 96 / 120, 2: 90 / 120, 3: 85 / 120}, abs=0.02)


@pytest.mark.parametrize("seed", range(40))
def test_bounds_are_optimal(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 40), rng.randrange(1, 9)))
    counts, most = [rng.randrange(1, 9) for _ in lengths], rng.randrange(1, 6)
    cost = lambda bounds: sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts, strict=True))
    best = min(cost((*s, lengths[-1])) for m in range(min(most, len(lengths))) for s in itertools.combinations(lengths[:-1], m))
    got = packing.best_bounds(lengths, counts, most)
    assert len(got) <= most and got[-1] == lengths[-1] and cost(got) == best


def test_batches_hold_the_budget(spark):
    rng = random.Random(8)
    docs = [(i, " ".join(["a"] * rng.choice([0, 1, 5, 5, 5, 40, 90])), "", "") for i in range(300)] + [(7, None, "", ""), (7, None, "", ""), (None, "a " * 9000, "", "")]
    got = packing.pack(spark.createDataFrame(docs, DOCS), buckets=3, budget=200).collect()
    assert len(got) == len(docs) and len({(r.bucket, r.batch, r.slot) for r in got}) == len(docs)
    for _, group in itertools.groupby(sorted(got, key=lambda r: (r.bucket, r.batch)), key=lambda r: (r.bucket, r.batch)):
        group = list(group)
        assert all(r.n_tokens <= r.bound for r in group)
        assert len(group) == 1 or sum(r.bound for r in group) <= 200 or group[0].bound == 0
        assert sorted(r.slot for r in group) == list(range(len(group)))
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


def test_pipeline_stages(spark, tables):
    docs = table(spark, tables, "documents")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables)
        assert out.columns == docs.columns
        docs = corpus_pipeline.stored(out, "test")
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4]
    texts = [r.text for r in docs.collect()]
    assert not any(_plain_spans(t) for t in texts)
    assert corpus_pipeline.run(spark, tables).count() == sizes[4]
