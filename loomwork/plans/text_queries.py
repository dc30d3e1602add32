"""Page lane: splitting, quality, routing, stamps, cost, identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.config import Embed, Summarise
from loomwork.functions import cost as C
from loomwork.functions import text as T
from loomwork.operators import routing as R
from loomwork.plans.base import PAGES, QUALITY, WHOLE, Tables, big, judged, pages, query


@query(f"WITH {WHOLE}, {QUALITY} SELECT doc_id, CAST(n_chars AS BIGINT) AS n_chars, CAST(n_alpha AS BIGINT) AS n_alpha, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(n_wordlike AS BIGINT) AS n_wordlike, CAST(token_chars AS BIGINT) AS token_chars, passed FROM gated")
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Tables(spark, sf_dir).documents.select("doc_id", T.quality(F.coalesce("text", F.lit(""))).alias("q"))
    return rows.select("doc_id", "q.*", T.quality_gate(F.col("q")).alias("passed"))


@query(f"WITH {PAGES}, {QUALITY} SELECT lang, count(*) AS n_pages, CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS BIGINT) AS n_passed, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM gated GROUP BY lang")
def quality_gate_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages(Tables(spark, sf_dir), "lang").select("lang", T.quality(F.col("content")).alias("q"))
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n_pages"), F.count_if(T.quality_gate(F.col("q"))).alias("n_passed"), F.sum("q.n_chars").alias("n_chars"))


@query(f"WITH {PAGES} SELECT doc_id, CAST(page_number AS BIGINT) AS page_number, CAST(length(content) AS BIGINT) AS n_chars, sha256(content) AS content_sha FROM pages_of")
def page_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(Tables(spark, sf_dir)).select("doc_id", "page_number", T.chars(F.col("content")).alias("n_chars"), F.sha2("content", 256).alias("content_sha"))


# Signals that a parser would give are derived from ids: images, image cover, ink, bars and runs of redaction.
SIGNALS_SQL = """signals AS (
  SELECT *, (doc_id + page_number) % 3 AS images, ((doc_id * 7 + page_number * 13) % 100) / 100.0::DOUBLE AS coverage,
         ((doc_id * 11 + page_number) % 500) / 100000.0::DOUBLE AS ink, ((doc_id + 31 * page_number) % 200) / 200.0::DOUBLE AS dark,
         (doc_id + page_number) % 17 AS run_mod, ((doc_id * 3 + page_number) % 10) / 10.0::DOUBLE AS bars FROM gated),
told AS (
  SELECT *, CASE WHEN run_mod = 0 THEN 2 ELSE 0 END AS runs,
         CASE WHEN n_chars < 40 AND ink < 0.0008 THEN 'blank' WHEN n_chars < 40 THEN 'low_text' WHEN NOT passed THEN 'quality_fail'
              WHEN images > 0 AND coverage >= 0.05 AND coverage < 0.8 THEN 'has_figures' ELSE 'text_sufficient' END AS reason FROM signals)"""


def _signals(t: Tables) -> DataFrame:
    d, p = F.col("doc_id"), F.col("page_number")
    rows = pages(t, "lang", "source").select("*", T.quality(F.col("content")).alias("q"))
    rows = rows.select(
        "*", T.quality_gate(F.col("q")).alias("passed"), ((d + p) % 3).alias("images"), ((d * 7 + p * 13) % 100 / 100.0).alias("coverage"),
        ((d * 11 + p) % 500 / 100000.0).alias("ink"), ((d + p * 31) % 200 / 200.0).alias("dark"), F.when((d + p) % 17 == 0, 2).otherwise(0).alias("runs"), ((d * 3 + p) % 10 / 10.0).alias("bars"),
    )
    c = F.col
    figures = (c("images") > 0) & (c("coverage") >= 0.05) & (c("coverage") < 0.8)
    return rows.withColumn("reason", R.vision_reason(F.lit(False), c("q.n_chars"), c("ink"), F.lit(0.0), c("passed"), figures))


@query(
    f"""WITH {PAGES}, {QUALITY}, {SIGNALS_SQL}
SELECT doc_id, CAST(page_number AS BIGINT) AS page_number,
  CASE WHEN length(trim(content)) >= 50 AND images = 0 THEN 'ocr_backing_scan' WHEN length(trim(content)) >= 50 THEN 'mixed_content'
       WHEN images > 1 THEN 'embedded_subimage' ELSE 'full_page_visual' END AS page_class,
  CASE WHEN reason = 'blank' OR ink < 0.0008 OR dark > 1.0 - 0.0008 THEN 'blank'
       WHEN runs > 0 AND length(regexp_replace(replace(content, '[REDACTED]', ' '), '\\s+', '', 'g')) < 40 AND bars >= 0.6 THEN 'redacted'
       WHEN coverage >= 0.8 AND n_chars < 40 THEN 'image'
       WHEN n_chars >= 40 AND images >= 1 AND coverage >= 0.05 AND coverage < 0.8 THEN 'mixed'
       WHEN n_chars >= 40 THEN 'text' ELSE 'image' END AS page_kind
FROM told""".replace("\\\\", "\\")
)
def page_class_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    kind = R.page_kind(c("reason"), c("ink"), c("dark"), c("runs"), T.visible_chars(c("content")), c("bars"), c("coverage"), c("q.n_chars"), c("images"))
    return _signals(Tables(spark, sf_dir)).select("doc_id", "page_number", R.page_class(c("content"), c("images")).alias("page_class"), kind.alias("page_kind"))


@query(
    f"""WITH {PAGES}, {QUALITY}, judged AS (
  SELECT g.*, coalesce(l.toxic, 0) = 1 AS redacted, passed AND coalesce(l.quality, 1) = 1 AS gate FROM gated g LEFT JOIN labels l USING (doc_id)),
reasons AS (SELECT *, CASE WHEN redacted THEN 'redaction_suspected' WHEN n_chars < 40 THEN 'low_text' WHEN NOT gate THEN 'quality_fail' ELSE 'text_sufficient' END AS reason FROM judged)
SELECT lang, reason, reason NOT IN ('blank', 'text_sufficient') AS needs_vision, count(*) AS n_pages FROM reasons GROUP BY ALL"""
)
def needs_vision_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    told = pages(t, "lang").select("doc_id", "lang", T.quality(F.col("content")).alias("q"))
    rows = told.join(t.labels.select("doc_id", "quality", "toxic"), "doc_id", "left")
    gate = T.quality_gate(F.col("q")) & (F.coalesce("quality", F.lit(1)) == 1)
    none = F.lit(None).cast("double")
    reason = R.vision_reason(F.coalesce("toxic", F.lit(0)) == 1, F.col("q.n_chars"), none, none, gate, F.lit(False))
    rows = rows.select("lang", reason.alias("reason"))
    return rows.groupBy("lang", "reason", R.needs_vision(F.col("reason")).alias("needs_vision")).agg(F.count(F.lit(1)).alias("n_pages"))


@query(
    f"""WITH {PAGES}, {QUALITY}, {SIGNALS_SQL},
counted AS (SELECT doc_id, count(*) AS n_pages, sum(CASE WHEN reason IN ('blank', 'text_sufficient') THEN 1 ELSE 0 END) AS n_sufficient FROM told GROUP BY doc_id)
SELECT doc_id, n_pages, CAST(n_sufficient AS BIGINT) AS n_sufficient,
  CASE WHEN n_sufficient * 10 >= n_pages * 9 THEN 'text_primary' WHEN n_sufficient * 10 <= n_pages THEN 'vision_primary' ELSE 'mixed' END AS routing FROM counted"""
)
def doc_routing_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _signals(Tables(spark, sf_dir)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"), F.count_if(~R.needs_vision(F.col("reason"))).alias("n_sufficient"))
    return rows.select("*", R.document_routing(F.col("n_sufficient"), F.col("n_pages")).alias("routing"))


@query(
    f"""WITH {PAGES}, {QUALITY}, {SIGNALS_SQL}
SELECT count(DISTINCT doc_id) AS n_docs, count(*) AS n_pages, CAST(sum(n_chars) AS BIGINT) AS n_chars, CAST(sum(CASE WHEN reason IN ('blank', 'text_sufficient') THEN 0 ELSE 1 END) AS BIGINT) AS n_vision,
  CAST(sum(CASE WHEN reason = 'blank' THEN 1 ELSE 0 END) AS BIGINT) AS n_blank, CAST(sum(runs) AS BIGINT) AS n_runs, CAST(sum(images) AS BIGINT) AS n_images FROM told"""
)
def run_manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Documents are counted by their first pages: no distinct, one pass of partial sums.
    return _signals(Tables(spark, sf_dir)).agg(
        F.count_if(F.col("page_number") == 1).alias("n_docs"), F.count(F.lit(1)).alias("n_pages"), F.sum("q.n_chars").alias("n_chars"), F.count_if(R.needs_vision(F.col("reason"))).alias("n_vision"),
        F.count_if(F.col("reason") == "blank").alias("n_blank"), F.sum("runs").alias("n_runs"), F.sum("images").alias("n_images"),
    )


@query(r"SELECT doc_id, CAST(length(regexp_replace(replace(replace(coalesce(text, ''), ' the ', '[REDACTED]'), '[REDACTED]', ' '), '\s+', '', 'g')) AS BIGINT) AS visible FROM documents")
def visible_chars_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    covered = F.replace(F.coalesce("text", F.lit("")), F.lit(" the "), F.lit("[REDACTED]"))
    return Tables(spark, sf_dir).documents.select("doc_id", T.visible_chars(covered).alias("visible"))


@query(r"SELECT doc_id, nullif(regexp_extract('see ' || upper(source) || lpad(CAST(doc_id AS VARCHAR), 3 + CAST(doc_id % 5 AS INTEGER), '0') || ' and ABC_' || lpad(CAST(doc_id AS VARCHAR), 7, '0') || ' ' || coalesce(text, ''), '\b[A-Z]{2,8}[-_]?\d{6,}\b'), '') AS stamp FROM documents")
def bates_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id").cast("string")
    text = F.concat(F.lit("see "), F.upper("source"), F.lpad(d, (F.col("doc_id") % 5 + 3).cast("int"), F.lit("0")), F.lit(" and ABC_"), F.lpad(d, 7, "0"), F.lit(" "), F.coalesce("text", F.lit("")))
    return Tables(spark, sf_dir).documents.select("doc_id", T.bates_stamp(text).alias("stamp"))


@query("SELECT doc_id, sha256(substring(text, 1, 24000)) AS kept_sha, length(text) > 24000 AS truncated, length(text) > 24000 OR coalesce(quality, 1) = 0 AS low_confidence FROM documents LEFT JOIN labels USING (doc_id)")
def truncate_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = T.truncated(F.col("text"), Summarise.max_chars)
    rows = judged(Tables(spark, sf_dir), F.sha2(cut["text"], 256).alias("kept_sha"), cut["truncated"].alias("truncated"))
    return rows.select("doc_id", "kept_sha", "truncated", (F.col("truncated") | (F.coalesce("quality", F.lit(1)) == 0)).alias("low_confidence"))


@query(
    f"""WITH {PAGES}, tokens AS (SELECT lang, least(length(content), 24000) // 4 AS prompt, (least(length(content), 24000) // 4) // 3 AS cached FROM pages_of)
SELECT lang, count(*) AS n_pages, CAST(sum(prompt) AS BIGINT) AS prompt_tokens, CAST(sum(cached) AS BIGINT) AS cached_tokens,
  CAST(sum((prompt - cached) * 100 + cached * 25 + 160 * 400) AS BIGINT) AS cost_nano FROM tokens GROUP BY lang"""
)
def token_cost_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = C.dry_run_tokens(F.length("content"))
    rows = pages(Tables(spark, sf_dir), "lang").select("lang", prompt.alias("prompt"), big(F.floor(prompt / 3)).alias("cached"))
    nano = C.usage_cost_nano(F.col("prompt"), F.lit(Summarise.dry_run_out), F.col("cached"))
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n_pages"), F.sum("prompt").alias("prompt_tokens"), F.sum("cached").alias("cached_tokens"), F.sum(nano).alias("cost_nano"))


SHA_SQL = "sha256('text-embedding-3-small' || chr(10) || 'doc ' || source || chr(10) || coalesce(text, ''))"


@query(f"SELECT doc_id, {SHA_SQL} AS content_sha, substring({SHA_SQL}, 1, 2) AS shard, CAST(length('doc ' || source || ' ' || coalesce(text, '')) AS BIGINT) AS input_chars, CAST(greatest(1, length(coalesce(text, '')) // 4) AS BIGINT) AS tokens FROM documents")
def content_sha(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix, text = F.concat(F.lit("doc "), "source"), F.coalesce("text", F.lit(""))
    sha = T.content_sha(F.lit(Embed.model), prefix, text)
    return Tables(spark, sf_dir).documents.select("doc_id", sha.alias("content_sha"), T.shard(sha).alias("shard"), T.chars(T.embed_input(prefix, text)).alias("input_chars"), C.embed_tokens(text).alias("tokens"))
