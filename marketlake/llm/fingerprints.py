"""Document fingerprints from closed syncmers, in DataFrame functions only.

Of the runs of K words of a text those are anchors whose least-hashed inner run of S words stands at the
start or the end. Whether a run is chosen depends on its own words alone, so a shared passage has the same
anchors in every text, at shifted places. About 2 / (K - S + 1) of the runs are chosen. A text with fewer
than K words, but one at least, has its whole word sequence as its only anchor. A fingerprint lists
place:hash of the anchors; the likeness of two is the Jaccard index of their different hashes (two
fingerprints without anchors have likeness 1, one without and one with 0).

The edited text of a document is its first half followed by as much of the next document's beginning, by
ascending doc_id; the last is followed by the first. Ids are cut in even ranges of about `ROWS` documents,
each range and a copy of the next range's first row meet in one window group, so texts are shuffled once.
If ids lie very unevenly, a range gets more rows and its window sorts on disk.

A null text is empty. Rows of the same doc_id follow each other by the hash of their text; a null doc_id comes
first. Columns other than doc_id and text are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import stored

K = 9
S = 2
ROWS = 2_000


def _shifted(values: str, by: int) -> Column:
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def _cut(values: str, by: int) -> Column:
    return F.slice(values, F.lit(1), F.greatest(F.size(values) - by, F.lit(0)))


def with_anchors(df: DataFrame, text: str, places: str, marks: str, k: int = K, s: int = S) -> DataFrame:
    """`df` with two arrays: word places of the anchors of `text`, and their 32-bit hashes."""
    keep = df.columns
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    df = df.select(*keep, words.alias("_words"))
    df = df.select(*keep, "_words", F.transform("_words", lambda w: F.xxhash64(w)).alias("_inner"))
    for _ in range(s - 1):
        df = df.select(*keep, "_words", F.zip_with(_cut("_inner", 1), _shifted("_inner", 1), lambda a, b: F.xxhash64(a, b)).alias("_inner"))
    # sliding minimum over the k - s + 1 inner runs, by doubling
    wide, span = k - s + 1, 1
    df = df.select(*keep, "_words", "_inner", F.col("_inner").alias("_least"))
    while span < wide:
        step = min(span, wide - span)
        df = df.select(*keep, "_words", "_inner", F.zip_with(_cut("_least", step), _shifted("_least", step), lambda a, b: F.least(a, b)).alias("_least"))
        span += step
    n = F.size("_words")
    ends = F.arrays_zip(_cut("_inner", wide - 1).alias("a"), _shifted("_inner", wide - 1).alias("b"), F.col("_least").alias("m"))
    df = df.select(*keep, "_words", F.transform(ends, lambda e: (e["a"] == e["m"]) | (e["b"] == e["m"])).alias("_closed"))
    chosen = F.filter(
        F.transform("_closed", lambda c, i: F.when(c, i)), lambda i: i.isNotNull()
    )
    found = F.when(n >= k, chosen).when(n > 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    df = df.select(*keep, "_words", found.alias(places))
    hashes = F.transform(places, lambda i: F.hash(F.slice("_words", i + 1, F.lit(k))))
    return df.select(*keep, places, hashes.alias(marks))


def listed(places: str, marks: str) -> Column:
    return F.array_join(F.zip_with(places, marks, lambda p, m: F.concat_ws(":", p.cast("string"), F.lower(F.hex(m.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))))), ",")


def likeness(a: str, b: str) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def with_next(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """doc_id, text, places, marks and the next row's text and marks (next_text, next_marks)."""
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("own", F.xxhash64("text"))
    span = docs.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")).first()
    lo, hi = span.lo or 0, span.hi or 0
    width = max(1, -(-(hi - lo + 1) // max(1, span.n // rows)))
    block = F.floor((F.coalesce("doc_id", F.lit(lo)) - F.lit(lo)) / F.lit(width)).cast("long")
    source = source.withColumn("block", block)
    # one row for each range: its first document, to be copied to the range before
    first = source.groupBy("block").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "own")).alias("first"))
    around = Window.orderBy("block")
    ahead = first.select(
        F.coalesce(F.lag("block").over(around), F.max("block").over(Window.partitionBy())).alias("to"),
        F.col("block"), F.col("first.doc_id").alias("first_id"), F.col("first.own").alias("first_own"),
    )
    # Written first, so that its size is known when the join is planned: texts need not move to meet a few ids.
    copies = source.join(stored(ahead, "fingerprint-ranges"), "block").where("doc_id <=> first_id and own = first_own")
    copies = copies.select("doc_id", "text", "own", F.col("to").alias("block"), F.lit(True).alias("copy"))
    every = with_anchors(source.withColumn("copy", F.lit(False)).unionByName(copies), "text", "places", "marks")
    order = Window.partitionBy("block").orderBy("copy", F.col("doc_id").asc_nulls_first(), "own")
    return (
        every.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_marks", F.lead("marks").over(order))
        .where("not copy")
        .select("doc_id", "text", "places", "marks", "next_text", "next_marks")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    df = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))
    df = df.select("doc_id", "n_chars", edited.alias("edited"), listed("places", "marks").alias("fingerprint"), "marks", likeness("marks", "next_marks").alias("near_next"))
    df = df.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    df = with_anchors(df, "edited", "edited_places", "edited_marks")
    return df.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint",
        listed("edited_places", "edited_marks").alias("edited_fingerprint"),
        likeness("marks", "edited_marks").alias("near_edited"), "near_next",
    )
