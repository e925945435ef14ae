"""HTML text, URL filters, fingerprints and language-model scores against plain versions."""

import hashlib
import random
import re
import time
import zlib
from datetime import datetime

import brute
import pytest

from marketlake.llm import fingerprints, html_text, lm_scoring, pii, url_filters

DOCS = "doc_id long, text string, row long, word string"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header class="top"><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies on this site and you can read all of it in the policy if you want to.</div>
<article><h1>Head &amp; title</h1><p><b>First  paragraph of the text<br>goes&nbsp;on in the same block and it is long enough to be one.<br>
<p>Short.</p><div class="ad">Buy this now, it is the best of all the things that you can have.</div><p>Of.</p>
<section class="comments"><p>I think that this is the best article that I have read in a very long time.</p></section>
<p>Last &lt;block&gt; &am</p></article><aside>More of it</aside><footer>&copy; site</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == (
        "Head & title\n\nFirst paragraph of the text goes on in the same block and it is long enough to be one.\n\nShort.\n\nOf.\n\nLast <block> &am"
    )
    plain = "<body><div><a href=1>one link and another and so on and on and on and on and more of the same</a></div>" + "<div>The text of it is here, and it is what the page is all about, as you can see in it.</div><div>End.</div>"
    assert html_text.main_text(plain) == "The text of it is here, and it is what the page is all about, as you can see in it.\n\nEnd."
    for broken in (None, "", " ", "<", "<div", "<p", "<!--", "<script>x", "<article><p>x<a href='", "&#xZZ;"):
        html_text.main_text(broken)
    assert html_text.main_text("<article>" + "<p>" + "word " * 50_000 + "</article>").count("word") == 50_000


LINE = "This is the text of the page and it is what all of it is about, as you can see in it."
ASIDE = "This is one of the things beside the text, and it is as long as a block of it would be."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<body><div class='content-sidebar-wrap'><main><p>{LINE}</main><div class='sidebar'><p>{ASIDE}</div></div>", LINE),
        (f"<body><div class='has-sidebar'><article><p>{LINE}</article></div>", LINE),
        (f"<body><div class='elementor-widget elementor-widget-container'><article><p>{LINE}</article></div>", LINE),
        (f"<body><div class='post-header-area'><article><p>{LINE}</article></div>", LINE),
        (f"<body><div class='sidebar'><article><p>{LINE}</article></div>", LINE),
        (f"<body><div class='has-sidebar'><div><p>{LINE}</div></div>", LINE),
        (f"<body><article><p>{LINE}</article><div class='comment-list'><article><p>{ASIDE}</article></div>", LINE),
        (f"<body><article><p>{LINE}</article><div class='sidebar'><article><p>{ASIDE}</article></div>", LINE),
        (f"<body><aside><article><p>{ASIDE}</article></aside><p>{LINE}", LINE),
        (f"<body><article><p>{LINE}<div class='cookie-notice'><p>{ASIDE}</div></article>", LINE),
        (f"<html><head><title>T</title><body><p>{LINE}</body></html>", LINE),
        (f"<html><head><title>T</title><meta charset=a><p>{LINE}", LINE),
        (f"<head><noscript><p>{ASIDE}</noscript></head><body><p>{LINE}", LINE),
    ],
)
def test_wrappers_and_open_heads(page, want):
    assert html_text.main_text(page) == want


def test_extract_rows(spark, rows):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", None, "x"), (None, None, "", "x")], "page_id long, url string, html string, text string")
    assert sorted(r[3] for r in rows(html_text.extract(df))) == [0, 0, len(html_text.main_text(PAGE))]
    assert html_text.extract(df).count() == 3 and html_text.extract(df.limit(0)).count() == 0


def test_url_filters_equal_plain_rules(spark):
    rng = random.Random(1)
    hosts = ["a.b.example.com", "b.example.com", "example.com", "x.org", "example.com.evil.net"]
    at = lambda: datetime(2024, 1, rng.randrange(1, 6), rng.randrange(24))
    changes = [(rng.choice(["block", "allow"]), *rng.choice([("host", rng.choice(hosts)), ("domain", rng.choice(hosts)), ("path", f"{rng.choice(hosts)}/en")]), at(), rng.choice(["add", "add", "remove"])) for _ in range(60)]
    changes += [("block", "host", None, at(), "add"), ("block", "host", "x.org", None, "add"), ("block", "host", "x.org", at(), "odd")]
    captures = [(i, f"HTTPS://user@www.{rng.choice(hosts).upper()}:80/{rng.choice(['en', 'de'])}/p", at()) for i in range(150)]
    captures += [(1000, None, at()), (1001, "", at()), (1002, "http://x.org", None), captures[0], (None, *captures[1][1:])]

    def plain(url, when):
        if not url or when is None:
            return ("unlisted", None, 0)
        rest = url.split("://", 1)[1] if "://" in url else url
        name, _, path = rest.partition("/")
        name = name.rpartition("@")[2].split(":")[0].lower().removeprefix("www.")
        active = []
        for key in {c[:3] for c in changes if c[2] and c[3] and c[4] in ("add", "remove")}:
            past = [(c[3], c[4]) for c in changes if c[:3] == key and c[3] and c[4] in ("add", "remove") and c[3] <= when]
            kind, pattern = key[1:]
            fits = {"host": name == pattern, "domain": name == pattern or name.endswith("." + pattern), "path": f"{name}/{path.split('/')[0]}" == pattern}[kind]
            if past and max(past)[1] == "add" and fits:
                active.append(({"path": 3, "host": 2, "domain": 1}[kind], len(pattern), key[0] == "allow", pattern))
        if not active:
            return ("unlisted", None, 0)
        best = max(active)
        return ("allow" if best[2] else "block", best[3], len(active))

    frame = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp_ntz")
    listed = spark.createDataFrame(changes, "list string, kind string, pattern string, at timestamp_ntz, action string")
    got = sorted((tuple(r) for r in url_filters.judge(frame, listed).collect()), key=repr)
    assert got == sorted(((*c, *plain(*c[1:])) for c in captures), key=repr)
    assert url_filters.judge(frame.limit(0), listed).count() == 0
    assert {r.decision for r in url_filters.judge(frame, listed.limit(0)).collect()} == {"unlisted"}


@pytest.mark.parametrize("n", [1, 3, 40])
def test_edited_texts_and_likeness(spark, n):
    rng = random.Random(n)
    docs = [(i * 13, " ".join(rng.choice(["é", "bc", "def", "gh\n"]) + str(rng.randrange(50)) for _ in range(rng.choice([0, 1, 2, 9, 300])))) for i in range(n)]
    docs += [(5, None), (6, ""), (6, "")] if n == 40 else []
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS)
    got = sorted((tuple(r) for r in fingerprints.fingerprints(df).collect()), key=lambda r: (r[0], r[1]))
    order = sorted((d, t or "") for d, t in docs)
    assert len(got) == len(order)
    for (d, text), (_, after), r in zip(order, order[1:] + order[:1], got, strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r[:3] == (d, len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r[5] <= 1 and 0 <= r[6] <= 1
        if n == 1:
            assert r[6] == 1.0


def test_shared_passages_share_anchors(spark):
    rng = random.Random(3)
    make = lambda m: " ".join(f"w{rng.randrange(5000)}" for _ in range(m))
    passage = make(300)
    df = spark.createDataFrame([(0, make(40) + " " + passage), (1, passage + " " + make(70)), (2, make(300)), (3, "a b c")], "doc_id long, text string")
    marks = {r.doc_id: set(r.marks) for r in fingerprints.with_anchors(df, "text", "places", "marks").collect()}
    assert len(marks[0] & marks[1]) > 50 and not marks[0] & marks[2] and len(marks[3]) == 1


def test_no_python_in_fingerprints(spark, tables):
    from marketlake.llm.common import table

    plan = fingerprints.fingerprints(table(spark, tables, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("bucket", [24_000_000, 1_800])
def test_base_scores_equal_plain_counts(spark, bucket):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice(["The", "cat", "É", "sat", f"w{rng.randrange(300)}"]) for _ in range(rng.randrange(60)))) for i in range(120)]
    docs += [(500, None), (501, "x " * 20_000), (502, "y" * 30_000), (3, docs[3][1]), (None, "the null"), (None, "the null"), (7, "other text")]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS)
    got = sorted(([*r] for r in lm_scoring.scores(df, bucket=bucket).collect()), key=lambda r: repr((r[:5], round(r[5], 4))))
    want = sorted(brute.base_scores(docs), key=lambda r: repr(([*r[:5]], round(r[5], 4))))
    for a, b in zip(got, want, strict=True):
        assert tuple(a[:5]) == b[:5] and a[5] == pytest.approx(b[5]) and a[6] < 0
    assert lm_scoring.scores(df.limit(0)).count() == 0


def test_model_is_a_distribution_and_learns(spark):
    """The chances of all next bytes add up to 1, and frequent spellings are likely."""
    import numpy as np

    mixer = lm_scoring.Mixer()
    letters = np.frombuffer(b"the cat sat the end then " * 50, np.uint8)
    s = lm_scoring.Spelling(letters)
    mixer.learn(s.letters, s.place, s.contexts, np.ones(len(s.letters)))
    every = np.concatenate([np.frombuffer(b"th", np.uint8), np.zeros(1, np.uint8)])
    chance = 0.0
    for b in range(256):
        every[2] = b
        probe = lm_scoring.Spelling(letters[:0])
        probe.letters, probe.place = every, np.arange(3)
        base = lm_scoring.Spelling(np.frombuffer(b"the ", np.uint8))
        probe.contexts = base.contexts[:, :3]
        chance += 10 ** mixer.cost(probe.letters, probe.place, probe.contexts)[2]
    assert chance == pytest.approx(1)
    spelled = lm_scoring.Spelling(np.frombuffer(b"the xqz ", np.uint8)).spelled(mixer)
    assert spelled[0] > spelled[1] + 1


def test_mixer_learns_in_small_steps():
    """Few letters are enough to move all weights, and predictions are not held within 0.25 .. 0.75."""
    import numpy as np

    text = np.frombuffer(b"the cat sat on that mat then ran home " * 60, np.uint8)
    s, mixer = lm_scoring.Spelling(text), lm_scoring.Mixer()
    mixer.learn(s.letters, s.place, s.contexts, np.ones(len(s.letters)))
    assert (mixer.weights != lm_scoring.Mixer().weights).any(axis=2).all()
    seen = lm_scoring.Spelling(text).spelled(mixer)[:9]
    # one word of nine is log10(1 / 9) = -0.95
    assert seen.mean() > -1.3
    plain = lm_scoring.Mixer()
    for k in range(len(s.letters)):
        plain.learn(s.letters[k : k + 1], s.place[k : k + 1], s.contexts[:, k : k + 1], np.ones(1))
    assert seen.mean() == pytest.approx(lm_scoring.Spelling(text).spelled(plain)[:9].mean(), abs=0.1)


def test_turns_hold_all_occurrences():
    import numpy as np

    counts = np.array([0, 1, 2, 7, 1000])
    word, times = lm_scoring.turns(counts, np.arange(5, dtype=np.uint64))
    assert np.bincount(word, times, 5).tolist() == counts.tolist()
    assert times[word == 3].tolist() == [1, 1, 2, 3]


def test_cost_without_a_words_own_counts():
    """Leaving a word out gives what the tables give that never counted it once."""
    import numpy as np

    s = lm_scoring.Spelling(np.frombuffer(b"the aaaaaa that banana ", np.uint8))
    for left in range(4):
        every, less = lm_scoring.Mixer(), lm_scoring.Mixer()
        times = np.full(len(s.letters), 3.0)
        every.learn(s.letters, s.place, s.contexts, times)
        less.learn(s.letters, s.place, s.contexts, np.where(s.word == left, 2.0, 3.0))
        less.weights, less.map, less.seen = every.weights, every.map, every.seen
        got = every.cost(s.letters, s.place, s.contexts, s.word)[s.word == left]
        assert got == pytest.approx(less.cost(s.letters, s.place, s.contexts)[s.word == left], abs=1e-4)


def test_last_gate_hears_all_words(spark):
    """Every training word has its part in the likelihood by which the gate is chosen."""
    import numpy as np
    import pyarrow as pa

    words = [f"w{k}" for k in range(40)]
    letters = np.frombuffer("".join(w + " " for w in words).encode(), np.uint8)

    def gates(counts):
        payload = lm_scoring._packed((letters, np.array(counts)), lm_scoring.WORD_KINDS)
        group = pa.table([pa.array([1]), pa.array([0], pa.int32()), pa.array([payload], pa.binary())], names=["chunk", "bucket", "words"])
        return lm_scoring._answered(lm_scoring.Mixer().packed(), 1000.0)(group)["gates"][0].as_py()

    base = gates([2] * 40)
    assert all(gates([2 + (j == k) for j in range(40)]) != base for k in range(40))


def test_long_runs_take_linear_time():
    """A megabyte of digits, dots or phone-like text, and many spans, in seconds."""
    begun = time.monotonic()
    for text in ("7" * 1_000_000, "1." * 500_000, "+1 " * 300_000, "1-" * 500_000, "A1" * 500_000, "a@" * 300_000):
        pii.all_spans(text, 0.6)
    many = "tel 415-555-0100, ip 10.0.0.1; " * 20_000
    assert len(pii.all_spans(many, 0.6)) == 40_000
    assert time.monotonic() - begun < 30


def test_ip_matches_equal_the_plain_pattern():
    plain = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("0123..  a") for _ in range(rng.randrange(30)))
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in plain.finditer(text)]


def _reading(texts, order=None):
    """Spelling and tokens of texts, and a mixer that has read them; `order` reorders the tokens."""
    import numpy as np
    import pyarrow as pa

    words = lm_scoring.Words(pa.table({"text": pa.array([t.encode() for t in texts], pa.binary())}))
    n = len(words.hashes)
    spelling = lm_scoring.Spelling(words.letters(0, n))
    tokens = np.insert(words.of, np.searchsorted(words.doc, np.arange(len(texts)), side="right"), n)
    mixer = lm_scoring.Mixer()
    mixer.read(spelling, tokens if order is None else tokens[order])
    return spelling, tokens, mixer


def test_model_reads_texts_in_their_order():
    """Each step of the text is predicted from what stands before it, ends too; equal words of a step change nothing."""
    import numpy as np

    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", "Cat", "sat", f"w{rng.randrange(400)}"]) for _ in range(rng.randrange(200))) for _ in range(40)]
    spelling, tokens, mixer = _reading(texts)
    plain, sizes, k = lm_scoring.Mixer(), np.diff(np.append(spelling.begins, len(spelling.letters))), 0
    while k < len(tokens):
        most, rows = max(lm_scoring.ONLINE, plain.letters // lm_scoring.SHARE), []
        while k < len(tokens) and (not rows or len(rows) + sizes[tokens[k]] <= most):
            rows += range(spelling.begins[tokens[k]], spelling.begins[tokens[k]] + sizes[tokens[k]])
            k += 1
        rate = lm_scoring.RATE * min(1, lm_scoring.STEADY / len(rows))
        plain._step_by(spelling.letters[rows], spelling.place[rows], spelling.contexts[:, rows], np.ones(len(rows)), rate)
        plain.letters += len(rows)
    assert mixer.letters == plain.letters == sum(len(t.split()) + sum(map(len, t.split())) for t in texts) + len(texts)
    assert np.allclose(mixer.weights, plain.weights, atol=1e-4) and np.allclose(mixer.counts[3], plain.counts[3])
    assert mixer.map.sum() == pytest.approx(plain.map.sum())
    _, _, back = _reading(texts, np.arange(len(tokens))[::-1])
    assert np.allclose(mixer.counts[3], back.counts[3]) and abs(mixer.weights - back.weights).max() > 1e-4
    assert spelling.spelled(mixer)[-1] > -4  # ends are learned


def test_order_of_words_reaches_the_scores(spark):
    """The same words in another order within the texts train another model; the base stays."""
    rng = random.Random(2)
    texts = [[rng.choice(["the", "cat", "sat", f"w{rng.randrange(300)}"]) for _ in range(60)] for _ in range(60)]
    make = lambda words: spark.createDataFrame([(i, " ".join(w), 1, "x") for i, w in enumerate(words)], DOCS)
    one, two = (
        {r.doc_id: r for r in lm_scoring.scores(make(words)).collect()} for words in (texts, [sorted(w) for w in texts])
    )
    assert all(one[i].base_score == pytest.approx(two[i].base_score) for i in one)
    assert max(abs(one[i].score - two[i].score) for i in one) > 1e-3


def test_the_word_before_reaches_the_scores(spark):
    """Equal words, each behind another one: behind its own fixed word it is likelier than in the wrong company."""
    rng = random.Random(8)
    make = lambda pairs: " ".join(w for a, b in pairs for w in (f"left{a}", f"right{b}"))
    texts = [make([(k, k) for k in (rng.randrange(8) for _ in range(80))]) for _ in range(120)]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 != 2][:120]
    order = [rng.randrange(8) for _ in range(60)]
    texts += [make([(k, k) for k in order]), make([(k, (k + 3) % 8) for k in order])]
    rows = spark.createDataFrame([(i, x, 1, "x") for i, x in zip([*ids, *held], texts, strict=True)], DOCS)
    got = {r.doc_id: r for r in lm_scoring.scores(rows).collect()}
    usual, odd = (got[i] for i in held)
    assert usual.n_tokens == odd.n_tokens == 121 and usual.base_score == pytest.approx(odd.base_score, rel=0.05)
    assert usual.score > odd.score + 20


def test_pairs_learn_and_lose_their_own_count():
    """A pair read once is likelier than without its own count; chances of all next bytes behind a word add up to 1."""
    import numpy as np
    import pyarrow as pa

    texts = ["the cat sat the cat ran", "a dog sat a dog ran"] * 20 + ["the zebra"]
    words = lm_scoring.Words(pa.table({"text": pa.array([t.encode() for t in texts], pa.binary())}))
    model, n = lm_scoring.Model(), len(words.hashes)
    model.read(words, len(texts))
    model = lm_scoring.Model.summed(iter([model.packed()]))
    letters = words.letters(0, n)
    spelling, names, said = lm_scoring.Spelling(letters), lm_scoring._names(letters), letters.tobytes().decode().split()
    word = {w: k for k, w in enumerate(said)}
    ask = np.array(sorted([word["cat"], word["cat"], word["zebra"], n]))
    at = lambda w, before: (model.pairs.spelled(model.mixer, spelling, np.array([word[w]]), names[[word[before]]]))
    assert at("cat", "the")[0] > at("cat", "dog")[0] + 0.5
    every, less = model.pairs.spelled(model.mixer, spelling, ask, names[[word["the"], word["dog"], word["the"], word["ran"]]])
    assert every.shape == less.shape == (4,) and (less <= every + 1e-6).all()
    assert at("zebra", "the")[1] < at("zebra", "the")[0] - 1
    one = lm_scoring.Spelling(np.zeros(0, np.uint8))
    chance = 0.0
    for b in range(256):
        one.letters, one.place, one.begins = np.array([b], np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64)
        chance += 10 ** model.pairs.spelled(model.mixer, one, np.zeros(1, np.int64), names[[word["the"]]])[0][0]
    assert chance == pytest.approx(1, abs=1e-4)
