"""URL filters with history: each capture is judged by the list entries that were active when it was fetched.

Dated changes of a list (add or remove a pattern) become validity intervals: from an add to the next change of
the same list and pattern. A pattern is a host, a domain (the host or anything below it) or a host with the
first step of the path. A capture asks for its host, the domains above it and its path pattern. Intervals are
cut by day and met by equal (pattern, day), so a host with most captures is spread over days and can be split
by adaptive joins, and an as-of test within the day decides. Of the active entries the most specific wins
(path, host, the longest domain); among equals `allow` beats `block`.

URLs are compared without scheme, user, port, case of the host and a leading www. A null or empty url has no
pattern and is `unlisted`, as is a capture without time. Changes without date, pattern or known action are
ignored; of changes at the same instant the removal comes last. Repeated captures give repeated rows; empty
tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host(url: str = "url") -> Column:
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(found), r"^www\.", "")


def first_step(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*/([^/?#]+)", 1)


def intervals(changes: DataFrame) -> DataFrame:
    """changes: list, kind (host, domain, path), pattern, at, action (add, remove) -> list, kind, pattern, since, until."""
    known = changes.where("at is not null and pattern is not null and action in ('add', 'remove')")
    known = known.groupBy("list", "kind", "pattern", "at").agg(F.max("action").alias("action"))
    order = Window.partitionBy("list", "kind", "pattern").orderBy("at")
    return known.withColumn("until", F.lead("at").over(order)).where("action = 'add'").select("list", "kind", "pattern", F.col("at").alias("since"), "until")


def judge(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """captures: page_id, url, fetched_at. Adds decision (block, allow, unlisted), the winning pattern, n_active."""
    valid = intervals(changes)
    reach = captures.agg(F.min("fetched_at").alias("lo"), F.max("fetched_at").alias("hi")).first()
    keyed = captures.select("page_id", "url", "fetched_at").withColumn("_host", host()).withColumn("_step", first_step())
    labels = F.split("_host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(labels) - 1, F.lit(0))),
        lambda k: F.struct(F.lit("domain").alias("kind"), F.concat_ws(".", F.slice(labels, k + 1, F.size(labels))).alias("pattern")),
    )
    asked = F.concat(
        F.array(
            F.struct(F.lit("host").alias("kind"), F.col("_host").alias("pattern")),
            F.struct(F.lit("path").alias("kind"), F.concat_ws("/", "_host", "_step").alias("pattern")),
        ),
        domains,
    )
    questions = keyed.where("_host <> '' and fetched_at is not null").select(
        "page_id", "url", "fetched_at", F.to_date("fetched_at").alias("day"), F.explode(asked).alias("q")
    ).select("page_id", "url", "fetched_at", "day", "q.*")
    if reach.lo is None:
        valid = valid.where("false")
        days = F.array(F.lit(None).cast("date"))
    else:
        start = F.greatest(F.to_date("since"), F.lit(reach.lo).cast("date"))
        stop = F.least(F.to_date(F.coalesce("until", F.lit(reach.hi))), F.lit(reach.hi).cast("date"))
        valid = valid.withColumns({"_from": start, "_to": stop}).where("_from <= _to")
        days = F.sequence("_from", "_to")
    daily = valid.select("list", "kind", "pattern", "since", "until", F.explode(days).alias("day"))
    met = questions.join(daily, ["kind", "pattern", "day"]).where("since <= fetched_at and (until is null or fetched_at < until)")
    rank = F.struct(
        F.when(F.col("kind") == "path", 3).when(F.col("kind") == "host", 2).otherwise(1).alias("level"),
        F.length("pattern").alias("size"), (F.col("list") == "allow").alias("allow"), "pattern",
    )
    # captures equal in all values share one answer and each get it
    best = met.groupBy("page_id", "url", "fetched_at").agg(
        F.max(rank).alias("best"), F.countDistinct("list", "kind", "pattern").alias("n_active")
    )
    joined = captures.select("page_id", "url", "fetched_at").alias("c").join(
        best.alias("b"), F.expr("c.page_id <=> b.page_id and c.url <=> b.url and c.fetched_at <=> b.fetched_at"), "left"
    )
    return joined.select(
        "c.page_id", "c.url", "c.fetched_at",
        F.when(F.col("best").isNull(), "unlisted").when(F.col("best.allow"), "allow").otherwise("block").alias("decision"),
        F.col("best.pattern").alias("pattern"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
    )
