"""Dedup, membership, vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.config import Embed
from loomwork.functions import text as T
from loomwork.operators import dedup as D
from loomwork.plans.base import Tables, big, query
from loomwork.sources.package import vector_literal


def sha_of(text: str = "text") -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


@query("SELECT content_sha, doc_id, source FROM (SELECT sha256(coalesce(text, '')) AS content_sha, doc_id, source, row_number() OVER (PARTITION BY sha256(coalesce(text, '')) ORDER BY doc_id, source) AS r FROM documents) WHERE r = 1")
def global_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Tables(spark, sf_dir).documents.select(sha_of().alias("content_sha"), "doc_id", "source")
    return D.first_seen(rows, "content_sha", ["doc_id", "source"])


@query("SELECT sha256(coalesce(text, '')) AS content_sha, lang, min(doc_id) AS first_place, count(*) AS n_places FROM documents GROUP BY ALL")
def dedup_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Tables(spark, sf_dir).documents.select(sha_of().alias("content_sha"), "lang", "doc_id")
    return D.occurrences(rows, ["content_sha", "lang"], F.col("doc_id"))


@query("SELECT source, count(*) AS n_children, count(DISTINCT sha256(coalesce(text, ''))) AS n_unique, 1.0::DOUBLE - CAST(count(DISTINCT sha256(coalesce(text, ''))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS dedup_ratio FROM documents GROUP BY source")
def dedup_ratio_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Counted once by (source, sha) with partial sums, then by source: a hot source never sends its shas to one task.
    by = Tables(spark, sf_dir).documents.groupBy("source", sha_of().alias("sha")).agg(F.count(F.lit(1)).alias("n"))
    out = by.groupBy("source").agg(F.sum("n").alias("n_children"), F.count(F.lit(1)).alias("n_unique"))
    return out.select("*", (F.lit(1.0) - F.col("n_unique").cast("double") / F.col("n_children").cast("double")).alias("dedup_ratio"))


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return t.documents.select("doc_id", "source").join(t.labels.select("doc_id"), "doc_id", "left_anti")


STORE_SQL = "store AS (SELECT sha256(CAST(vec_id AS VARCHAR)) AS content_sha, vec_id, embedding, label FROM embeddings)"


def _store(t: Tables) -> DataFrame:
    return t.embeddings.select(F.sha2(F.col("vec_id").cast("string"), 256).alias("content_sha"), "vec_id", "embedding", "label")


@query(
    f"""WITH {STORE_SQL}, child AS (SELECT source, sha256(CAST(doc_id AS VARCHAR)) AS content_sha FROM documents)
SELECT source, count(*) AS n_children, CAST(sum(CASE WHEN EXISTS (SELECT 1 FROM store s WHERE s.content_sha = c.content_sha) THEN 1 ELSE 0 END) AS BIGINT) AS n_embedded FROM child c GROUP BY source"""
)
def store_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    seen = _store(t).select("content_sha").distinct().withColumn("seen", F.lit(True))
    child = t.documents.select("source", F.sha2(F.col("doc_id").cast("string"), 256).alias("content_sha"))
    return child.join(seen, "content_sha", "left").groupBy("source").agg(F.count(F.lit(1)).alias("n_children"), F.count_if("seen").alias("n_embedded"))


@query(
    f"""WITH {STORE_SQL}, log AS (SELECT content_sha, vec_id, 0 AS seq, CAST(embedding[1] AS DOUBLE) AS head FROM store UNION ALL SELECT content_sha, vec_id, 1, CAST(embedding[2] AS DOUBLE) FROM store WHERE vec_id % 3 = 0)
SELECT substring(content_sha, 1, 2) AS shard, content_sha, vec_id, arg_max(head, seq) AS head FROM log GROUP BY ALL"""
)
def vector_lookup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _store(Tables(spark, sf_dir))
    head = lambda i: F.col("embedding")[i].cast("double").alias("head")
    log = s.select("content_sha", "vec_id", F.lit(0).alias("seq"), head(0)).union(s.where("vec_id % 3 = 0").select("content_sha", "vec_id", F.lit(1).alias("seq"), head(1)))
    last = D.last_written(log, ["content_sha", "vec_id"], "seq")
    return last.select(T.shard(F.col("content_sha")).alias("shard"), "content_sha", "vec_id", "head")


@query(f"WITH {STORE_SQL} SELECT substring(content_sha, 1, 2) AS shard, count(*) AS n_vectors, CAST(sum(len(embedding)) AS BIGINT) AS n_floats FROM store GROUP BY 1")
def vector_shard_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _store(Tables(spark, sf_dir))
    return s.groupBy(T.shard(F.col("content_sha")).alias("shard")).agg(F.count(F.lit(1)).alias("n_vectors"), F.sum(F.size("embedding")).alias("n_floats"))


@query(f"WITH {STORE_SQL} SELECT content_sha, CAST(len(embedding) AS BIGINT) AS dims, 'other' AS target, true AS same FROM store")
def vector_literal_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as [v,v,...] texts, routed by their dimension; float texts differ between engines, so the texts are read again and held against the vectors."""
    s = _store(Tables(spark, sf_dir))
    read = F.transform(F.from_json(vector_literal(F.col("embedding")), "array<double>"), lambda v: v.cast("float"))
    dims = big(F.size("embedding"))
    return s.select("content_sha", dims.alias("dims"), F.when(dims == Embed.dims, "embedding").when(dims == 3072, "embedding_large").otherwise("other").alias("target"), (read == F.col("embedding")).alias("same"))


@query(f"WITH {STORE_SQL}, child AS (SELECT doc_id, sha256(CAST(doc_id AS VARCHAR)) AS content_sha FROM documents) SELECT doc_id, content_sha FROM child c WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.content_sha = c.content_sha)")
def missing_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    child = t.documents.select("doc_id", F.sha2(F.col("doc_id").cast("string"), 256).alias("content_sha"))
    return child.join(_store(t).select("content_sha"), "content_sha", "left_anti").select("doc_id", "content_sha")


@query(
    f"""WITH {STORE_SQL}, child AS (SELECT doc_id, sha256(CAST(doc_id AS VARCHAR)) AS content_sha, length(coalesce(text, '')) AS n FROM documents),
uniq AS (SELECT content_sha, min(n) AS n FROM child GROUP BY 1),
flagged AS (SELECT u.*, EXISTS (SELECT 1 FROM store s WHERE s.content_sha = u.content_sha) AS cached FROM uniq u)
SELECT (SELECT count(*) FROM child) AS n_seen, count(*) AS n_unique, CAST(sum(CASE WHEN cached THEN 1 ELSE 0 END) AS BIGINT) AS n_cached, CAST(sum(CASE WHEN cached THEN 0 ELSE 1 END) AS BIGINT) AS n_to_embed,
  CAST(sum(CASE WHEN cached THEN 0 ELSE greatest(1, n // 4) END) AS BIGINT) AS tokens, CAST(sum(CASE WHEN cached THEN 0 ELSE greatest(1, n // 4) END) * 20 AS BIGINT) AS cost_nano FROM flagged"""
)
def embed_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    child = t.documents.select(F.sha2(F.col("doc_id").cast("string"), 256).alias("content_sha"), F.greatest(F.lit(1), F.floor(F.length(F.coalesce("text", F.lit(""))) / 4)).alias("tokens"))
    one = child.groupBy("content_sha").agg(F.min("tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
    seen = _store(t).select("content_sha", F.lit(True).alias("cached")).distinct()
    left = one.join(seen, "content_sha", "left").withColumn("cached", F.coalesce("cached", F.lit(False)))
    todo = F.when(~F.col("cached"), F.col("tokens")).otherwise(0)
    return left.agg(
        F.sum("n").alias("n_seen"), F.count(F.lit(1)).alias("n_unique"), F.count_if("cached").alias("n_cached"), F.count_if(~F.col("cached")).alias("n_to_embed"), F.sum(todo).alias("tokens"), (F.sum(todo) * 20).alias("cost_nano")
    )


@query("SELECT b.item_id, sha256(b.text) AS content_sha, count(d.doc_id) AS n_documents FROM benchmark b LEFT JOIN documents d ON sha256(d.text) = sha256(b.text) GROUP BY ALL")
def held_out_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose whole text is a held-out item."""
    t = Tables(spark, sf_dir)
    by = t.documents.groupBy(sha_of().alias("content_sha")).agg(F.count("doc_id").alias("n"))
    return t.benchmark.select("item_id", sha_of().alias("content_sha")).join(by, "content_sha", "left").select("item_id", "content_sha", F.coalesce("n", F.lit(0)).alias("n_documents"))
