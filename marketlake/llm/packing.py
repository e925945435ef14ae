"""Packing by length: buckets whose bounds minimise padding, and token-budget batches inside each.

A text of n tokens goes to the bucket with the least bound >= n and is padded to that bound. The bounds are
the optimum over the global histogram of lengths (dynamic programming over all ways to cut it in at most
`buckets` runs). Lengths up to 4096 are told apart exactly; longer ones by three digits, so the histogram that
reaches the driver has a bounded number of rows whatever the corpus. A batch of a bucket holds
budget // bound texts (one at least: a text longer than the budget has a batch of its own, marked by
`over_budget`). No text is cut, dropped or split.

Places in a bucket are counted from salted groups and their running totals, so a bucket that holds most texts
is never in one task. A null or blank text has 0 tokens and is placed like any other. Repeated rows are placed
each. Empty tables give no rows. Only doc_id and the length column are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import stored

BUCKETS = 16
BUDGET = 32_768
EXACT = 4096
#: Rows of a salted group.
GROUP = 50_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _class(n: Column) -> Column:
    """The length itself up to EXACT, else the length rounded up to three digits."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.greatest(n, F.lit(1)).cast("double"))) - 2).cast("long")
    return F.when(n <= EXACT, n).otherwise(F.ceil(n / unit).cast("long") * unit)


def best_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` runs of the ascending lengths with the least total padding.

    With P and S the running sums of counts and of counts x length, a run i..j costs
    lengths[j] * (P[j] - P[i]) - (S[j] - S[i]): for a fixed j the choices of i are lines in lengths[j] with
    falling slopes, so the best ones form a hull that is walked once.
    """
    n = len(lengths)
    if not n:
        return []
    many, total = [0], [0]
    for length, count in zip(lengths, counts, strict=True):
        many.append(many[-1] + count)
        total.append(total[-1] + count * length)
    cost = [0] + [None] * n
    back = []
    for _ in range(min(buckets, n)):
        hull: list[tuple[int, int, int]] = []
        new, came, at = [None] * (n + 1), [0] * (n + 1), 0
        for j in range(1, n + 1):
            i = j - 1
            if cost[i] is not None:
                slope, start = -many[i], cost[i] + total[i]
                while len(hull) > 1:
                    (m1, b1, _), (m2, b2, _) = hull[-2], hull[-1]
                    if (start - b1) * (m1 - m2) > (b2 - b1) * (m1 - slope):
                        break
                    hull.pop()
                hull.append((slope, start, i))
            if not hull:
                continue
            x = lengths[j - 1]
            at = min(at, len(hull) - 1)
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            new[j] = hull[at][0] * x + hull[at][1] + x * many[j] - total[j]
            came[j] = hull[at][2]
        back.append(came)
        if cost[n] is not None and new[n] is not None and new[n] >= cost[n]:
            back.pop()
            break
        cost = [None, *new[1:]]
    bounds, j = [], n
    for came in reversed(back):
        bounds.append(lengths[j - 1])
        j = came[j]
    return bounds[::-1]


def pack(docs: DataFrame, length: Column | None = None, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, n_tokens, bucket, bound, batch (within its bucket), slot (within its batch), over_budget."""
    sized = stored(docs.select("doc_id", (word_count() if length is None else length).cast("long").alias("n_tokens")), "lengths")
    histogram = sized.groupBy(_class(F.col("n_tokens")).alias("k")).agg(F.max("n_tokens").alias("most"), F.count("*").alias("rows"))
    rows = sorted((r.most, r.rows) for r in histogram.collect())
    if not rows:
        rows = [(0, 0)]
    bounds = best_bounds([r[0] for r in rows], [r[1] for r in rows], buckets)
    salts = max(1, sum(r[1] for r in rows) // GROUP)
    of = F.array(*(F.lit(b).cast("long") for b in bounds))
    placed = sized.withColumn("bucket", F.size(F.filter(of, lambda b: b < F.col("n_tokens"))))
    placed = placed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    counts = placed.groupBy("bucket", "salt").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("bucket").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", "salt", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy("bucket", "salt").orderBy("n_tokens", "doc_id")
    index = F.row_number().over(own) - 1 + F.col("offset")
    per = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bound"), F.lit(1)))).cast("long")
    return (
        placed.join(offsets, ["bucket", "salt"])
        .withColumn("bound", F.element_at(of, F.col("bucket") + 1))
        .withColumn("place", index.cast("long"))
        .select(
            "doc_id", "n_tokens", "bucket", "bound",
            F.floor(F.col("place") / per).cast("long").alias("batch"),
            F.pmod("place", per).cast("long").alias("slot"),
            (F.col("bound") > budget).alias("over_budget"),
        )
    )
