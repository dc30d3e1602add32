"""Safety verdicts and fusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.operators import routing as R
from loomwork.operators import safety as S
from loomwork.plans.base import PAGES, Tables, big, judged, pages, query

# What a vision model would say is derived from ids and labels; the ladder is what is under test.
CATEGORIES = ("violence", "hate", "sexual", "self-harm", "none", "minor", "other")
VERDICT_SQL = """asset AS (
  SELECT d.doc_id, d.source, d.lang, l.toxic, l.quality,
    ['violence','hate','sexual','self-harm','none','minor','other'][CAST(d.doc_id % 7 AS INTEGER) + 1] AS cat,
    CASE WHEN l.doc_id IS NULL THEN NULL ELSE CAST((d.doc_id % 7) AS BIGINT) END AS sev,
    coalesce(l.toxic, 0) = 1 AS flagged, d.doc_id % 11 = 0 AS filtered, d.doc_id % 13 = 0 AND coalesce(l.toxic, 0) = 1 AS explicit, l.doc_id IS NOT NULL AS vetted, d.doc_id % 3 <> 0 AS visual
  FROM documents d LEFT JOIN labels l USING (doc_id)),
named AS (
  SELECT *, list_filter(list_distinct([CASE WHEN flagged THEN cat END, CASE WHEN sev >= 4 THEN cat END]), lambda x: x IS NOT NULL) AS every FROM asset),
split AS (
  SELECT *, list_sort(list_filter(every, lambda x: x IN ('csam','csam_suspected','minor'))) AS report,
    list_sort(list_filter(every, lambda x: x IN ('hate','self-harm','self_harm','selfharm','sexual','violence'))) AS hold FROM named),
held AS (
  SELECT *, len(report) > 0 AS csam,
    list_concat(list_concat(CASE WHEN filtered THEN ['content_filter'] ELSE CAST([] AS VARCHAR[]) END, CASE WHEN explicit THEN ['explicit'] ELSE CAST([] AS VARCHAR[]) END), list_transform(hold, lambda c: 'category:' || c)) AS reasons_held FROM split),
verdicts AS (
  SELECT *, CASE WHEN csam THEN array_to_string(list_transform(report, lambda c: 'category:' || c), ',')
                 WHEN len(reasons_held) = 0 AND visual AND NOT vetted THEN 'unvetted_verdict' ELSE array_to_string(reasons_held, ',') END AS reasons,
    CASE WHEN csam THEN 'csam' WHEN filtered THEN 'content_filter' WHEN explicit THEN 'sexual' WHEN len(hold) > 0 THEN replace(hold[1], '-', '_')
         WHEN len(reasons_held) = 0 AND visual AND NOT vetted THEN 'unvetted' END AS tier FROM held)"""


def _verdicts(t: Tables, unvetted: bool = True) -> DataFrame:
    d = F.col("doc_id")
    rows = judged(t)
    toxic, vetted = F.coalesce("toxic", F.lit(0)) == 1, F.col("toxic").isNotNull() | F.col("quality").isNotNull()
    cat = F.element_at(F.array(*map(F.lit, CATEGORIES)), (d % 7 + 1).cast("int"))
    severity = F.when(vetted, d % 7)
    empty: Column = F.array().cast("array<string>")
    severe = S.over_threshold(F.array(F.struct(cat.alias("category"), severity.cast("string").alias("severity"))))
    v = S.verdict(d % 11 == 0, (d % 13 == 0) & toxic, F.lit(False), F.when(toxic, F.array(cat)).otherwise(empty), severe, d % 3 != 0, vetted, unvetted)
    return rows.select("doc_id", "source", "lang", "toxic", "quality", v.alias("v"))


@query(f"WITH {VERDICT_SQL} SELECT doc_id, csam, reasons <> '' AS withhold, reasons, tier FROM verdicts")
def safety_verdict_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(Tables(spark, sf_dir)).select("doc_id", "v.csam", "v.withhold", F.array_join("v.reasons", ",").alias("reasons"), "v.tier")


@query(f"WITH {VERDICT_SQL} SELECT source, coalesce(tier, 'clean') AS tier, count(*) AS n FROM verdicts GROUP BY ALL")
def withheld_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(Tables(spark, sf_dir)).groupBy("source", F.coalesce("v.tier", F.lit("clean")).alias("tier")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {VERDICT_SQL} SELECT tier = 'unvetted' AS failsafe, vetted, count(*) AS n FROM verdicts WHERE tier IS NULL OR tier = 'unvetted' GROUP BY ALL")
def withhold_unvetted_failsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _verdicts(Tables(spark, sf_dir)).where("v.tier IS NULL OR v.tier = 'unvetted'")
    vetted = F.col("toxic").isNotNull() | F.col("quality").isNotNull()
    return rows.groupBy((F.col("v.tier") == "unvetted").alias("failsafe"), vetted.alias("vetted")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {PAGES}, p AS (SELECT p.source, p.doc_id, coalesce(l.toxic, 0) = 1 AND page_number % 2 = 1 AS review, page_number % 5 = 0 AS filtered FROM pages_of p LEFT JOIN labels l USING (doc_id)), d AS (SELECT source, doc_id, bool_or(review) AS review, bool_or(filtered) AS filtered FROM p GROUP BY ALL) SELECT source, count(*) AS n_docs, CAST(sum(CASE WHEN review THEN 1 ELSE 0 END) AS BIGINT) AS n_review, CAST(sum(CASE WHEN filtered THEN 1 ELSE 0 END) AS BIGINT) AS n_filtered FROM d GROUP BY source")
def doc_safety_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    rows = pages(t, "source").select("doc_id", "source", "page_number").join(t.labels.select("doc_id", "toxic"), "doc_id", "left")
    review = (F.coalesce("toxic", F.lit(0)) == 1) & (F.col("page_number") % 2 == 1)
    docs = rows.groupBy("source", "doc_id").agg(F.bool_or(review).alias("review"), F.bool_or(F.col("page_number") % 5 == 0).alias("filtered"))
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("review").alias("n_review"), F.count_if("filtered").alias("n_filtered"))


@query(f"WITH {PAGES} SELECT p.doc_id, count(*) AS n_review, string_agg(CAST(page_number AS VARCHAR), ',' ORDER BY page_number) AS page_list FROM pages_of p JOIN labels l USING (doc_id) WHERE l.toxic = 1 GROUP BY p.doc_id")
def text_safety_pages_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    rows = pages(t).select("doc_id", "page_number").join(t.labels.where("toxic = 1").select("doc_id"), "doc_id")
    listed = F.array_join(F.transform(F.sort_array(F.collect_list("page_number")), lambda p: p.cast("string")), ",")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_review"), listed.alias("page_list"))


FINDINGS_SQL = """found AS (
  SELECT d.doc_id, CASE WHEN d.doc_id % 2 = 0 THEN 'page_image' ELSE 'artifact_image' END AS modality,
    CAST(CASE WHEN d.doc_id % 4 = 0 THEN d.doc_id % 7 ELSE 0 END AS BIGINT) AS hate, CAST(CASE WHEN d.doc_id % 4 = 1 THEN d.doc_id % 7 ELSE 0 END AS BIGINT) AS sexual,
    CAST(CASE WHEN d.doc_id % 4 = 2 THEN d.doc_id % 7 ELSE 0 END AS BIGINT) AS violence, CAST(CASE WHEN d.doc_id % 4 = 3 THEN d.doc_id % 7 ELSE 0 END AS BIGINT) AS self_harm, d.doc_id % 101 = 0 AS csam_suspected
  FROM documents d JOIN labels l USING (doc_id)
  UNION ALL SELECT l.doc_id, 'page_text', 0, 0, 0, 0, false FROM labels l JOIN documents USING (doc_id) WHERE l.toxic = 1)"""


def _findings(t: Tables) -> DataFrame:
    """One row for each scanned unit; severities stand in columns by category."""
    d = F.col("doc_id")
    both = t.documents.select("doc_id").join(t.labels.select("doc_id", "toxic"), "doc_id")
    column = lambda k, name: F.when(d % 4 == k, d % 7).otherwise(0).cast("bigint").alias(name)
    image = both.select("doc_id", F.when(d % 2 == 0, "page_image").otherwise("artifact_image").alias("modality"), column(0, "hate"), column(1, "sexual"), column(2, "violence"), column(3, "self_harm"), (d % 101 == 0).alias("csam_suspected"))
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("hate", "sexual", "violence", "self_harm")]
    return image.union(both.where("toxic = 1").select("doc_id", F.lit("page_text").alias("modality"), *zero, F.lit(False).alias("csam_suspected")))


@query(f"WITH {FINDINGS_SQL} SELECT * FROM found WHERE modality = 'page_text' OR hate + sexual + violence + self_harm > 0 OR csam_suspected")
def findings_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _findings(Tables(spark, sf_dir)).where("modality = 'page_text' OR hate + sexual + violence + self_harm > 0 OR csam_suspected")


@query(f"WITH {FINDINGS_SQL} SELECT doc_id, max(hate) AS hate, max(sexual) AS sexual, max(violence) AS violence, max(self_harm) AS self_harm, bool_or(csam_suspected) AS csam_suspected FROM found GROUP BY doc_id")
def finding_rollup_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.rollup_findings(_findings(Tables(spark, sf_dir)), "doc_id")


@query("SELECT user_id, max(CASE WHEN event_type = 'click' THEN sev END) AS click, max(CASE WHEN event_type = 'view' THEN sev END) AS view, CAST(max(sev) AS BIGINT) AS most FROM (SELECT user_id, event_type, CAST(floor(value) AS BIGINT) % 8 AS sev FROM events) GROUP BY user_id")
def severity_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Tables(spark, sf_dir).events.select("user_id", "event_type", (big(F.floor("value")) % 8).alias("sev"))
    of = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("sev"))).alias(kind)
    return rows.groupBy("user_id").agg(of("click"), of("view"), F.max("sev").alias("most"))


ROUTE_SQL = """routed AS (
  SELECT d.doc_id, d.source, coalesce(l.quality, 0) = 1 AS has_text, e.vec_id IS NOT NULL AND e.label % 2 = 0 AS has_vision
  FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN embeddings e ON e.vec_id = d.doc_id),
routes AS (SELECT *, CASE WHEN has_vision AND has_text THEN 'fused' WHEN has_vision THEN 'image_only' WHEN has_text THEN 'promoted' ELSE 'no_content' END AS route FROM routed)"""


@query(f"WITH {ROUTE_SQL} SELECT source, route, count(*) AS n FROM routes GROUP BY ALL")
def fusion_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    rows = judged(t).join(t.embeddings.select(F.col("vec_id").alias("doc_id"), "label"), "doc_id", "left")
    vision = F.coalesce(F.col("label") % 2 == 0, F.lit(False))
    route = R.fusion_route(vision, F.coalesce("quality", F.lit(0)) == 1)
    return rows.groupBy("source", route.alias("route")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {PAGES}, items AS (
  SELECT doc_id, page_number, 0 AS lane, '[page ' || page_number || ' — text summary]' || chr(10) || sha256(trim(content)) AS item FROM pages_of WHERE trim(content) <> ''
  UNION ALL SELECT doc_id, CASE WHEN quality = 1 THEN 1 END, 1, '[' || CASE WHEN quality = 1 THEN 'page 1' ELSE 'page (unknown)' END || ' — image]' || chr(10) || 'label ' || toxic FROM labels)
SELECT doc_id, count(*) AS n_items, CAST(sum(1 - lane) AS BIGINT) AS n_text, CAST(sum(lane) AS BIGINT) AS n_vision, sha256(string_agg(item, chr(10) ORDER BY page_number NULLS LAST, lane, item)) AS items_sha FROM items GROUP BY doc_id"""
)
def fusion_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page summaries and captions of each document in page order, missing pages last.  The digest of a whole page stands for its summary, so no text is shuffled."""
    t = Tables(spark, sf_dir)
    head = F.sha2(F.trim("content"), 256)
    label = lambda p, what: F.concat(F.lit("["), p, F.lit(f" — {what}]\n"))
    text = pages(t).where(F.trim("content") != "").select("doc_id", F.col("page_number").alias("page"), F.lit(0).alias("lane"), F.concat(label(F.concat(F.lit("page "), F.col("page_number").cast("string")), "text summary"), head).alias("item"))
    known = F.coalesce(F.col("quality") == 1, F.lit(False))
    image = t.labels.select("doc_id", F.when(known, F.lit(1).cast("bigint")).alias("page"), F.lit(1).alias("lane"), F.concat(label(F.when(known, "page 1").otherwise("page (unknown)"), "image"), F.lit("label "), F.col("toxic").cast("string")).alias("item"))
    order = F.struct(F.coalesce("page", F.lit(2**62)).alias("page"), "lane", "item")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(order)), lambda x: x["item"]), "\n")
    return text.union(image).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_items"), F.sum(1 - big("lane")).alias("n_text"), F.sum(big("lane")).alias("n_vision"), F.sha2(joined, 256).alias("items_sha"))


@query(
    """WITH n AS (SELECT source, count(*) AS items, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY source),
a AS (SELECT *, CASE WHEN chars > 24000 AND items > 1 THEN (items + 39) // 40 ELSE items END AS l1, chars > 24000 AND items > 1 AS f1 FROM n),
b AS (SELECT *, CASE WHEN f1 AND l1 * 600 > 24000 AND l1 > 1 THEN (l1 + 39) // 40 ELSE l1 END AS l2, f1 AND l1 * 600 > 24000 AND l1 > 1 AS f2 FROM a)
SELECT source, items, CAST(1 + CAST(f1 AS INTEGER) + CAST(f2 AS INTEGER) AS BIGINT) AS depth, CAST(1 + CASE WHEN f1 THEN l1 ELSE 0 END + CASE WHEN f2 THEN l2 ELSE 0 END AS BIGINT) AS calls FROM b"""
)
def hierarchical_reduce_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth and calls of a tree reduce: batches of 40 while the text is over 24,000 characters, two levels at most, then one; a summary counts as 600 characters."""
    rows = Tables(spark, sf_dir).documents.groupBy("source").agg(F.count(F.lit(1)).alias("items"), F.sum(F.length("text")).alias("chars"))
    up = lambda n: big(F.ceil(n / 40))
    rows = rows.withColumn("f1", (F.col("chars") > 24000) & (F.col("items") > 1)).withColumn("l1", F.when(F.col("f1"), up(F.col("items"))).otherwise(F.col("items")))
    rows = rows.withColumn("f2", F.col("f1") & (F.col("l1") * 600 > 24000) & (F.col("l1") > 1)).withColumn("l2", F.when(F.col("f2"), up(F.col("l1"))).otherwise(F.col("l1")))
    depth = F.lit(1) + F.col("f1").cast("bigint") + F.col("f2").cast("bigint")
    calls = F.lit(1) + F.when(F.col("f1"), F.col("l1")).otherwise(0) + F.when(F.col("f2"), F.col("l2")).otherwise(0)
    return rows.select("source", "items", big(depth).alias("depth"), big(calls).alias("calls"))
