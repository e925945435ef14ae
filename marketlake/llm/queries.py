"""The registered queries of this folder and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from marketlake.llm import decontamination, fingerprints, html_text, lm_scoring, packing, pii, quality, spelling_variants, token_counts, url_filters, whitening
from marketlake.llm.common import table
from marketlake.llm.ngram_jaccard import near_duplicates
from marketlake.llm.suffix_dedup import remove_repeats


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Captures are the pages, fetched at a second of one month that follows from page_id; every event
    changes a list at its time, an add for three of the five event types, else a removal, by the page whose number
    (ids are 0 to n - 1) follows from event_id.
    """
    pages = table(spark, folder, "pages").select("page_id", "url")
    fetched = "timestampadd(SECOND, cast(pmod(page_id * 7919, 2592000) as int), timestamp_ntz'2024-01-01 00:00:00')"
    captures = pages.withColumn("fetched_at", F.expr(fetched))
    events = table(spark, folder, "events").select("event_id", "ts", "event_type")
    number = F.pmod(F.col("event_id") * 7919, F.lit(max(pages.count(), 1)))
    dated = events.withColumn("page_id", number).join(pages, "page_id")
    name = url_filters.host()
    kind = F.element_at(F.array(F.lit("host"), F.lit("domain"), F.lit("path")), (F.col("page_id") % 3 + 1).cast("int"))
    changes = dated.select(
        F.when(F.col("page_id") % 5 == 0, "allow").otherwise("block").alias("list"),
        kind.alias("kind"),
        F.when(F.col("page_id") % 3 == 0, name)
        .when(F.col("page_id") % 3 == 1, F.regexp_replace(name, r"^[^.]*\.", ""))
        .otherwise(F.concat_ws("/", name, url_filters.first_step())).alias("pattern"),
        F.col("ts").alias("at"),
        F.when(F.col("event_type").isin("signup", "purchase", "error"), "add").otherwise("remove").alias("action"),
    )
    return url_filters.judge(captures, changes)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.scores(table(spark, folder, "documents"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.variants(table(spark, folder, "documents"))


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer)


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_pii": op3_pii,
    "op4_html_text": op4_html_text,
    "op5_quality": op5_quality,
    "op6_url_filters": op6_url_filters,
    "op7_decontamination": op7_decontamination,
    "op8_fingerprints": op8_fingerprints,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_packing": op10_packing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_counts": op12_token_counts,
    "op13_whitening": op13_whitening,
    "pipeline": corpus_pipeline.run,
}

#: Queries without a twin here are tested against plain versions in tests/llm.
ORACLE: dict[str, str] = {
    "op6_url_filters": r"""
        WITH named AS (
            SELECT page_id, url,
                regexp_replace(lower(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.', '') AS host,
                regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*/([^/?#]+)', 1) AS step,
                TIMESTAMP '2024-01-01' + to_seconds((page_id * 7919) % 2592000) AS fetched_at
            FROM pages
        ),
        changes AS (
            SELECT CASE WHEN page_id % 5 = 0 THEN 'allow' ELSE 'block' END AS list,
                CASE page_id % 3 WHEN 0 THEN 'host' WHEN 1 THEN 'domain' ELSE 'path' END AS kind,
                CASE page_id % 3 WHEN 0 THEN host WHEN 1 THEN regexp_replace(host, '^[^.]*\.', '') ELSE concat_ws('/', host, step) END AS pattern,
                ts AS changed,
                max(CASE WHEN event_type IN ('signup', 'purchase', 'error') THEN 'add' ELSE 'remove' END) AS action
            FROM events JOIN named ON (event_id * 7919) % (SELECT count(*) FROM pages) = page_id WHERE ts IS NOT NULL GROUP BY 1, 2, 3, 4
        ),
        valid AS (
            SELECT *, lead(changed) OVER (PARTITION BY list, kind, pattern ORDER BY changed) AS until FROM changes
        ),
        met AS (
            SELECT n.page_id, v.list, v.kind, v.pattern,
                CASE v.kind WHEN 'path' THEN 3 WHEN 'host' THEN 2 ELSE 1 END AS level
            FROM named n JOIN valid v ON v.action = 'add' AND v.changed <= n.fetched_at AND (v.until IS NULL OR n.fetched_at < v.until)
                AND n.host <> '' AND CASE v.kind WHEN 'host' THEN n.host = v.pattern
                    WHEN 'domain' THEN n.host = v.pattern OR ends_with(n.host, '.' || v.pattern)
                    ELSE concat_ws('/', n.host, n.step) = v.pattern END
        ),
        best AS (
            SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY level DESC, length(pattern) DESC, list, pattern DESC) AS place,
                count(*) OVER (PARTITION BY page_id) AS n_active
            FROM met
        )
        SELECT n.page_id, n.url, n.fetched_at, coalesce(b.list, 'unlisted') AS decision, b.pattern, coalesce(b.n_active, 0) AS n_active
        FROM named n LEFT JOIN best b ON b.page_id = n.page_id AND b.place = 1
    """,
}
