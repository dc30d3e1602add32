"""Lanes of documents, pages and assets made from the tables, as DataFrames and as SQL.

Texts, pages, digests, languages, sources, labels and vectors are the tables' own; what a parser, a renderer or a
vision model would add (states, kinds, severities) is derived from them and from ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.operators.ingest import asset_verdicts
from loomwork.plans.base import PAGES, Tables, big, pages

CATEGORIES = ("violence", "hate", "sexual", "self-harm", "none", "minor", "other")

DOCS_SQL = """lane_docs AS (
  SELECT d.doc_id, d.lang, d.source, d.text, CASE WHEN d.doc_id % 29 = 0 THEN NULL WHEN d.doc_id % 23 = 0 THEN 'error' ELSE 'ok' END AS status,
    'doc-' || d.doc_id || '.pdf' AS document_name, d.lang AS case_key, CASE WHEN d.doc_id % 31 <> 0 THEN d.source END AS dataset_key,
    CASE WHEN d.doc_id % 7 = 0 THEN 'scan' END AS source_kind, sha256(coalesce(d.text, '')) AS filehash, CAST(greatest(1, ceil(length(coalesce(d.text, '')) / 2000.0)) AS BIGINT) AS page_count
  FROM documents d)"""

PAGES_SQL = f"""{PAGES},
lane_pages AS (
  SELECT p.doc_id, p.lang, p.source, p.page_number, p.content, sha256(p.content) AS content_sha, CASE WHEN trim(p.content) = '' OR (p.doc_id + p.page_number) % 43 = 0 THEN 'blank' ELSE 'text' END AS page_kind,
    regexp_matches(p.content, '[0-9]') AS has_visual_content, CASE WHEN l.toxic = 1 THEN 'review' WHEN l.toxic = 0 THEN 'ok' END AS flag, p.page_number % 5 = 0 AS content_filtered, l.toxic, l.quality
  FROM pages_of p LEFT JOIN labels l USING (doc_id))"""

ASSETS_SQL = f"""{PAGES_SQL},
lane_assets AS (
  SELECT doc_id, source, page_number, CASE WHEN page_number % 2 = 1 THEN 'page' ELSE 'artifact' END AS kind, page_number AS image_index,
    'img/' || doc_id || '-' || page_number || CASE WHEN lang = 'en' THEN '.png' WHEN lang = 'fr' THEN '.JPG' ELSE '.bin' END AS path, content_sha, has_visual_content,
    CASE WHEN (doc_id + page_number) % 3 <> 0 THEN 'emb/' || doc_id END AS embedding_ref, toxic IS NOT NULL OR quality IS NOT NULL AS judged, coalesce(toxic, 0) = 1 AS toxic,
    coalesce(toxic, 0) = 1 AND page_number % 9 = 0 AS minor, coalesce(toxic, 0) = 1 AND quality = 0 AS explicit,
    ['violence','hate','sexual','self-harm','none','minor','other'][CAST((doc_id + page_number) % 7 AS INTEGER) + 1] AS cat,
    CASE WHEN toxic IS NOT NULL THEN CAST(length(content) % 8 AS BIGINT) ELSE 0 END AS severity,
    page_number % 11 = 0 AS refused, CASE WHEN doc_id % 37 = 0 THEN 'content_filter' WHEN doc_id % 41 = 0 THEN 'timeout' END AS error_code
  FROM lane_pages),
told AS (
  SELECT *, refused OR coalesce(error_code, '') = 'content_filter' AS filtered, judged AND error_code IS NULL AS vetted,
    list_distinct(list_filter([CASE WHEN toxic THEN cat END, CASE WHEN severity >= 4 THEN 'hate' END], lambda x: x IS NOT NULL)) AS every FROM lane_assets),
split AS (
  SELECT *, list_sort(list_filter(every, lambda x: x = 'minor')) AS report, list_sort(list_filter(every, lambda x: x IN ('hate', 'self-harm', 'sexual', 'violence'))) AS hold FROM told),
held AS (
  SELECT *, minor OR len(report) > 0 AS csam,
    list_filter(list_concat([CASE WHEN filtered THEN 'content_filter' END, CASE WHEN explicit THEN 'explicit' END], list_concat(list_transform(hold, lambda c: 'category:' || c), [CASE WHEN severity >= 4 THEN 'cs:hate=' || severity END])), lambda x: x IS NOT NULL) AS held FROM split),
judged AS (
  SELECT *, len(held) = 0 AND has_visual_content AND NOT vetted AS unvetted, csam OR len(held) > 0 OR (has_visual_content AND NOT vetted) AS withhold,
    CASE WHEN csam THEN 'csam' WHEN filtered THEN 'content_filter' WHEN explicit THEN 'sexual' WHEN len(hold) > 0 THEN replace(hold[1], '-', '_') WHEN len(held) = 0 AND has_visual_content AND NOT vetted THEN 'unvetted' END AS tier,
    array_to_string(CASE WHEN csam THEN list_concat(CASE WHEN minor THEN ['minor_indicator'] ELSE CAST([] AS VARCHAR[]) END, list_transform(report, lambda c: 'category:' || c))
      WHEN len(held) = 0 AND has_visual_content AND NOT vetted THEN ['unvetted_verdict'] ELSE held END, ',') AS reasons
  FROM held)"""

STATUS_SQL = f"""{DOCS_SQL}, {ASSETS_SQL},
by_doc AS (SELECT doc_id, bool_or(csam) AS csam, CAST(count_if(withhold) AS BIGINT) AS n_withheld FROM judged GROUP BY doc_id),
loads AS (
  SELECT d.*, coalesce(b.n_withheld, 0) AS n_withheld, coalesce(b.n_withheld, 0) > 0 AS source_withheld,
    CASE WHEN status IS NULL THEN 'no_sidecar' WHEN status <> 'ok' THEN 'skip_status' WHEN dataset_key IS NULL OR case_key IS NULL THEN 'error' WHEN b.csam THEN 'skip_csam' ELSE 'ready' END AS load_status
  FROM lane_docs d LEFT JOIN by_doc b USING (doc_id))"""


def docs_lane(t: Tables) -> DataFrame:
    d = F.col("doc_id")
    text = F.coalesce("text", F.lit(""))
    return t.documents.select(
        "doc_id", "lang", "source", F.when(d % 29 == 0, None).when(d % 23 == 0, "error").otherwise("ok").alias("status"), F.concat(F.lit("doc-"), d, F.lit(".pdf")).alias("document_name"),
        F.col("lang").alias("case_key"), F.when(d % 31 != 0, F.col("source")).alias("dataset_key"), F.when(d % 7 == 0, "scan").alias("source_kind"),
        F.sha2(text, 256).alias("filehash"), big(F.greatest(F.lit(1), F.ceil(F.length(text) / 2000))).alias("page_count"),
    )


def pages_lane(t: Tables) -> DataFrame:
    """doc_id, lang, source, page_number, content_sha, n_chars, page_class, page_kind, has_visual_content, flag, content_filtered, toxic, quality; content where it is asked for.

    What is needed of a page's text is computed before the join with the labels.
    """
    p = F.col("page_number")
    content = F.col("content")
    kind = F.when((F.trim("content") == "") | ((F.col("doc_id") + p) % 43 == 0), "blank").otherwise("text")
    made = pages(t, "lang", "source").select(
        "doc_id", "lang", "source", "page_number", F.sha2(content, 256).alias("content_sha"), F.length(content).alias("n_chars"), kind.alias("page_kind"), (F.trim("content") == "").alias("empty"),
        F.regexp_like(content, F.lit("[0-9]")).alias("has_visual_content"), (p % 5 == 0).alias("content_filtered"),
    )
    judged = t.labels.select(F.col("doc_id").alias("_id"), "toxic", "quality")
    return made.join(judged, F.col("doc_id") == F.col("_id"), "left").drop("_id").withColumn("flag", F.when(F.col("toxic") == 1, "review").when(F.col("toxic") == 0, "ok"))


def assets_lane(t: Tables) -> DataFrame:
    """One asset for each page, in the shape of ingest.ASSET."""
    d, p = F.col("doc_id"), F.col("page_number")
    toxic, judged = F.coalesce("toxic", F.lit(0)) == 1, F.col("toxic").isNotNull() | F.col("quality").isNotNull()
    suffix = F.when(F.col("lang") == "en", ".png").when(F.col("lang") == "fr", ".JPG").otherwise(".bin")
    cat = F.element_at(F.array(*map(F.lit, CATEGORIES)), ((d + p) % 7 + 1).cast("int"))
    empty: Column = F.array().cast("array<string>")
    safety = F.struct(
        F.when(toxic, "review").otherwise("ok").alias("flag"), F.when(toxic, F.array(cat)).otherwise(empty).alias("categories"), (toxic & (p % 9 == 0)).alias("minor_indicator"),
        F.coalesce(toxic & (F.col("quality") == 0), F.lit(False)).alias("explicit"),
    )
    mark = lambda name, level: F.struct(F.lit(name).alias("category"), level.cast("string").alias("severity"))
    return pages_lane(t).select(
        "doc_id", "source", F.when(p % 2 == 1, "page").otherwise("artifact").alias("kind"), "page_number", p.alias("image_index"), F.concat(F.lit("img/"), d, F.lit("-"), p, suffix).alias("path"),
        "content_sha", "has_visual_content", F.when((d + p) % 3 != 0, F.concat(F.lit("emb/"), d)).alias("embedding_ref"), F.when(judged, safety).alias("safety"),
        F.when(F.col("toxic").isNotNull(), F.array(mark("Hate", F.col("n_chars") % 8), mark("violence", F.lit("n/a")))).alias("severities"),
        (p % 11 == 0).alias("content_filtered"), F.when(d % 37 == 0, "content_filter").when(d % 41 == 0, "timeout").alias("error_code"),
    )


def judged_lane(t: Tables) -> DataFrame:
    return asset_verdicts(assets_lane(t))
