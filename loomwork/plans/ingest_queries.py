"""Load records of documents and media: states, rows of the target tables, findings, blobs, vectors, plans, events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import text as T
from loomwork.operators import ingest as I
from loomwork.plans.base import Tables, big, query
from loomwork.plans.lanes import ASSETS_SQL, DOCS_SQL, PAGES_SQL, STATUS_SQL, docs_lane, judged_lane, pages_lane


def _loads(t: Tables) -> DataFrame:
    return I.document_status(docs_lane(t), judged_lane(t))


@query(f"WITH {ASSETS_SQL} SELECT doc_id, page_number, kind, csam, withhold, reasons, tier FROM judged")
def ingest_asset_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is withheld of each document's assets, why, and under which tier."""
    return judged_lane(Tables(spark, sf_dir)).select("doc_id", "page_number", "kind", "v.csam", "v.withhold", F.array_join("v.reasons", ",").alias("reasons"), "v.tier")


@query(f"WITH {STATUS_SQL} SELECT doc_id, load_status, n_withheld, source_withheld FROM loads")
def ingest_document_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loads(Tables(spark, sf_dir)).select("doc_id", "load_status", "n_withheld", "source_withheld")


@query(
    f"""WITH {STATUS_SQL} SELECT doc_id, case_key, dataset_key, document_name, coalesce(source_kind, 'pdf') AS source_kind, 'application/pdf' AS content_type, filehash, page_count, CASE WHEN doc_id % 2 = 0 THEN lang || ' text' END AS title, 'upload' AS source
FROM loads WHERE load_status = 'ready'"""
)
def ingest_document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the documents table, for documents that are ready."""
    docs = _loads(Tables(spark, sf_dir)).withColumn("content_type", F.lit("application/pdf")).withColumn("title", F.when(F.col("doc_id") % 2 == 0, F.concat("lang", F.lit(" text"))))
    return I.document_rows(docs)


@query(
    f"""WITH {STATUS_SQL}, w AS (SELECT DISTINCT doc_id, page_number FROM judged WHERE withhold)
SELECT p.doc_id, p.page_number, CASE WHEN (p.doc_id + p.page_number) % 3 = 0 THEN 'mixed_content' END AS page_class, sha256(nullif(p.content, '')) AS ocr_sha, p.flag AS summary, CASE WHEN w.doc_id IS NULL THEN 'none' ELSE 'withheld' END AS review_status
FROM lane_pages p JOIN loads d ON d.doc_id = p.doc_id AND d.load_status = 'ready' LEFT JOIN w ON w.doc_id = p.doc_id AND w.page_number = p.page_number"""
)
def ingest_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the pages table with their review status; a page class that isn't known is null.  Texts are told by their digest, so none is shuffled."""
    t = Tables(spark, sf_dir)
    kind = F.when((F.col("doc_id") + F.col("page_number")) % 3 == 0, "mixed_content").otherwise("unheard_of")
    rows = pages_lane(t).select("doc_id", "page_number", kind.alias("page_class"), F.when(~F.col("empty") | (F.col("n_chars") > 0), F.col("content_sha")).alias("content"), F.col("flag").alias("summary"))
    return I.page_rows(I.ready_only(rows, _loads(t)), judged_lane(t)).withColumnRenamed("ocr_text", "ocr_sha")


@query(
    f"""WITH {ASSETS_SQL}
SELECT doc_id, 'page_text' AS modality, 'page:' || page_number AS locator, CAST(0 AS BIGINT) AS hate, CAST(0 AS BIGINT) AS sexual, CAST(0 AS BIGINT) AS violence, CAST(0 AS BIGINT) AS self_harm, false AS csam_suspected FROM lane_pages WHERE flag = 'review' OR content_filtered
UNION ALL SELECT doc_id, CASE WHEN kind = 'page' THEN 'page_image' ELSE 'artifact_image' END, CASE WHEN kind = 'page' THEN 'page:' || page_number ELSE 'artifact:' || page_number || ':' || image_index END, severity, 0, 0, 0, minor
FROM judged WHERE severity > 0 OR minor OR explicit"""
)
def ingest_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the findings table: pages under review or refused, assets with a severity or a report signal."""
    t = Tables(spark, sf_dir)
    return I.findings(pages_lane(t), judged_lane(t)).select("doc_id", "modality", "locator", *(big(c).alias(c) for c in ("hate", "sexual", "violence", "self_harm")), "csam_suspected")


@query(
    f"""WITH {ASSETS_SQL}, named AS (SELECT *, 'a5e9b1c200005000800000000000' || '0001' AS ns FROM judged),
hashed AS (SELECT *, sha1(unhex(ns) || encode(content_sha)) AS h FROM named)
SELECT doc_id, 'source.pdf' AS artifact, 'upload' AS action, CAST(doc_id AS VARCHAR) AS source_path, 'application/pdf' AS content_type FROM documents
UNION ALL SELECT doc_id, CASE WHEN kind = 'page' THEN 'ocr/page-' || page_number || '.png'
    ELSE 'artifacts/' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr(h, 17, 1))::INTEGER % 4 AS INTEGER) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) || '/image.png' END,
  CASE WHEN withhold THEN 'placeholder_redacted' ELSE 'upload' END, CASE WHEN NOT withhold THEN path END,
  CASE WHEN NOT withhold THEN CASE lower(regexp_extract(path, '[.][^.]+$')) WHEN '.png' THEN 'image/png' WHEN '.jpg' THEN 'image/jpeg' ELSE 'application/octet-stream' END END FROM hashed
UNION ALL SELECT doc_id, 'ocr/page-' || page_number || '.png', 'placeholder_blank', NULL, NULL FROM lane_pages WHERE page_kind = 'blank' OR (trim(content) = '' AND NOT has_visual_content)"""
)
def ingest_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is copied for each document, and where a placeholder stands."""
    t = Tables(spark, sf_dir)
    rows = pages_lane(t).withColumn("content", F.when(F.col("empty"), "").otherwise("x"))
    return I.blobs(docs_lane(t).select("doc_id"), rows, judged_lane(t))


@query(
    f"""WITH {ASSETS_SQL} SELECT j.doc_id, j.content_sha, j.page_number, CAST(len(e.embedding) AS BIGINT) AS dims, e.embedding[1]::DOUBLE AS first_value FROM judged j JOIN embeddings e ON j.embedding_ref = 'emb/' || e.vec_id
WHERE NOT withhold AND has_visual_content"""
)
def ingest_image_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of the assets that are kept and show something."""
    t = Tables(spark, sf_dir)
    vectors = t.embeddings.select(F.concat(F.lit("emb/"), "vec_id").alias("embedding_ref"), F.struct(F.size("embedding").alias("dims"), F.get("embedding", F.lit(0)).alias("first_value")).alias("vector"))
    rows = I.image_vectors(judged_lane(t), vectors)
    return rows.select("doc_id", "content_sha", "page_number", big("vector.dims").alias("dims"), F.col("vector.first_value").cast("double").alias("first_value"))


PLAN_SQL = f"""{STATUS_SQL},
seen AS (SELECT DISTINCT content_sha FROM lane_pages WHERE doc_id % 3 <> 0),
shas AS (SELECT p.doc_id, CAST(count(*) AS BIGINT) AS n_children, CAST(count_if(s.content_sha IS NULL) AS BIGINT) AS n_missing FROM (SELECT DISTINCT doc_id, content_sha FROM lane_pages WHERE doc_id % 5 <> 0) p LEFT JOIN seen s USING (content_sha) GROUP BY p.doc_id),
blank AS (SELECT doc_id, CAST(count_if(page_kind = 'blank' OR (trim(content) = '' AND NOT has_visual_content)) AS BIGINT) AS n_blank FROM lane_pages GROUP BY doc_id),
images AS (SELECT j.doc_id, count(*) AS n_images FROM judged j JOIN embeddings e ON j.embedding_ref = 'emb/' || e.vec_id WHERE NOT withhold AND has_visual_content GROUP BY j.doc_id),
plans AS (
  SELECT d.doc_id, d.load_status, d.n_withheld, CASE WHEN ready THEN coalesce(n_images, 0) ELSE 0 END AS n_images, CASE WHEN ready THEN coalesce(n_blank, 0) ELSE 0 END AS n_blank, CASE WHEN ready THEN coalesce(n_children, 0) ELSE 0 END AS n_children, CASE WHEN ready THEN coalesce(n_missing, 0) ELSE 0 END AS n_missing
  FROM (SELECT *, load_status = 'ready' AS ready FROM loads) d LEFT JOIN shas USING (doc_id) LEFT JOIN blank USING (doc_id) LEFT JOIN images USING (doc_id))"""


def _plans(t: Tables) -> DataFrame:
    rows = pages_lane(t)
    chunks = rows.where("doc_id % 5 <> 0").select("doc_id", F.col("page_number").alias("place"), "content_sha")
    store = rows.where("doc_id % 3 <> 0").select("content_sha")
    vectors = t.embeddings.select(F.concat(F.lit("emb/"), "vec_id").alias("embedding_ref"), F.lit(1).alias("vector"))
    judged = judged_lane(t)
    return I.plan(I.document_status(docs_lane(t), judged), rows.withColumn("content", F.when(F.col("empty"), "").otherwise("x")), judged, chunks, store, vectors)


@query(f"WITH {PLAN_SQL} SELECT * FROM plans")
def ingest_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of what a load of each document would write; a document without chunks counts none."""
    return _plans(Tables(spark, sf_dir))


@query(f"""WITH {PLAN_SQL} SELECT '{{"doc_id":' || doc_id || ',"load_status":"' || load_status || '","n_withheld":' || n_withheld || ',"n_images":' || n_images || ',"n_blank":' || n_blank || ',"n_children":' || n_children || ',"n_missing":' || n_missing || '}}' AS value FROM plans""")
def ingest_plan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan as JSON lines."""
    return I.plan_json(_plans(Tables(spark, sf_dir)))


@query(f"WITH {PLAN_SQL} SELECT load_status, count(*) AS n_docs, CAST(sum(n_withheld) AS BIGINT) AS n_withheld, CAST(sum(n_images) AS BIGINT) AS n_images, CAST(sum(n_blank) AS BIGINT) AS n_blank, CAST(sum(n_children) AS BIGINT) AS n_children, CAST(sum(n_missing) AS BIGINT) AS n_missing FROM plans GROUP BY load_status")
def ingest_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ("n_withheld", "n_images", "n_blank", "n_children", "n_missing")
    return _plans(Tables(spark, sf_dir)).groupBy("load_status").agg(F.count(F.lit(1)).alias("n_docs"), *(F.sum(c).alias(c) for c in counts))


UUID_SQL = "substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr({h}, 17, 1))::INTEGER % 4 AS INTEGER) + 1, 1) || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"


@query(
    f"""WITH {STATUS_SQL}, b AS (SELECT *, 't1/' || case_key || '/' || dataset_key || '/' || document_name AS base FROM loads WHERE load_status = 'ready'),
h AS (SELECT *, sha1(unhex('b7c4d2e000005000800000000000' || '00a8') || encode('ingest/' || base)) AS i, sha1(unhex('b7c4d2e000005000800000000000' || '00a8') || encode('corr/' || base)) AS c FROM b)
SELECT 't1' AS tenant_id, case_key, dataset_key, document_name, filehash AS document_id, {UUID_SQL.format(h="i")} AS ingestion_id, coalesce(source_kind, 'pdf') AS source_kind, 'application/pdf' AS content_type, 'upload' AS source, {UUID_SQL.format(h="c")} AS correlation_id, CAST(NULL AS VARCHAR) AS ingested_by FROM h"""
)
def ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed events of the documents that are ready; their ids are the same in every run."""
    docs = _loads(Tables(spark, sf_dir)).where("load_status = 'ready'").withColumn("document_id", F.col("filehash")).withColumn("content_type", F.lit("application/pdf"))
    return I.events(docs, "t1")


@query(
    f"""WITH {DOCS_SQL}, e AS (
  SELECT d.doc_id, list_filter(['document.content_type=application/pdf', 'document.title=' || CASE WHEN d.doc_id % 2 = 0 THEN d.lang || ' text' END, 'generator.tool=loomwork', CASE WHEN d.doc_id % 3 = 0 THEN 'generator.tool_version=1' END,
    'source.bytes=' || strlen(d.text), 'source.filename=' || d.document_name, 'source.pdf_producer=' || p.url, 'source.sha256=' || d.filehash], lambda x: x IS NOT NULL) AS x FROM lane_docs d LEFT JOIN pages p ON p.page_id = d.doc_id)
SELECT doc_id, array_to_string(list_sort(x), chr(10)) AS entries FROM e"""
)
def metadata_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitelisted, non-null entries in groups; empty groups are left out.  Shown as sorted lines, as maps have no order."""
    t = Tables(spark, sf_dir)
    size = t.documents.select(F.col("doc_id").alias("_id"), F.octet_length("text").alias("bytes"))
    docs = docs_lane(t).join(size, F.col("doc_id") == F.col("_id")).join(t.pages.select(F.col("page_id").alias("_page"), "url"), F.col("doc_id") == F.col("_page"), "left")
    none = F.lit(None).cast("string")
    bag = I.metadata_bag(
        {"source": {"sha256": F.col("filehash"), "bytes": F.col("bytes"), "pdf_producer": F.col("url"), "filename": F.col("document_name"), "secret": F.lit("not listed")},
         "document": {"title": F.when(F.col("doc_id") % 2 == 0, F.concat("lang", F.lit(" text"))), "content_type": F.lit("application/pdf"), "bates_begin": none},
         "generator": {"tool": F.lit("loomwork"), "tool_version": F.when(F.col("doc_id") % 3 == 0, "1")}}
    )
    return docs.select("doc_id", I.bag_lines(bag).alias("entries"))


@query(
    f"""WITH {PAGES_SQL}, words AS (SELECT doc_id, page_number, flag, regexp_extract_all(content, '[A-Za-z]{{9,}}') AS w FROM lane_pages),
points AS (SELECT doc_id, list(x ORDER BY page_number, k) AS p FROM (SELECT doc_id, page_number, unnest(w) AS x, unnest(range(len(w))) AS k FROM words) GROUP BY doc_id),
topics AS (SELECT doc_id, list_sort(list(DISTINCT lower(x))) AS t FROM (SELECT doc_id, unnest(w) AS x FROM words) GROUP BY doc_id),
finals AS (SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN 'summary of ' || doc_id END AS summary_text, CASE WHEN doc_id % 4 = 0 THEN 'no_content' WHEN doc_id % 4 = 1 THEN 'fused' ELSE 'promoted' END AS src FROM documents)
SELECT f.doc_id, f.summary_text, f.src AS source, CAST(len(coalesce(p.p[:50], [])) AS BIGINT) AS n_points, sha256(array_to_string(coalesce(p.p[:50], []), '|')) AS points_sha, array_to_string(coalesce(t.t[:30], []), '|') AS topics
FROM finals f LEFT JOIN points p USING (doc_id) LEFT JOIN topics t USING (doc_id) WHERE f.summary_text IS NOT NULL OR len(coalesce(p.p, [])) > 0"""
)
def ingest_asset_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's summary with the first 50 key points in page order and its first 30 topics (the limits are the feature); long words of whole pages stand for a model's key points."""
    from loomwork.plans.base import pages

    t = Tables(spark, sf_dir)
    words = F.regexp_extract_all("content", F.lit("[A-Za-z]{9,}"), F.lit(0))
    rows = pages(t).select("doc_id", "page_number", words.alias("key_points"), F.array().cast("array<struct<name:string,type:string>>").alias("entities"), F.transform(words, F.lower).alias("topics"))
    d = F.col("doc_id")
    finals = t.documents.select("doc_id", F.concat(F.lit("summary of "), d).alias("text"), F.when(d % 4 == 0, "no_content").when(d % 4 == 1, "fused").otherwise("promoted").alias("source"), F.lit(None).cast("boolean").alias("no_content"))
    made = I.asset_context(rows, finals)
    points = F.coalesce("key_points", F.array().cast("array<string>"))
    return made.select("doc_id", "summary_text", "source", big(F.size(points)).alias("n_points"), F.sha2(F.array_join(points, "|"), 256).alias("points_sha"), F.array_join(F.coalesce("topics", F.array().cast("array<string>")), "|").alias("topics"))


# -- media ---------------------------------------------------------------------------------------------

MEDIA_SQL = """media AS (
  SELECT doc_id, lang, source, 'DataSet-' || (doc_id % 9) || '/VOL' || (doc_id % 4) || '/m' || doc_id || CASE lang WHEN 'en' THEN '.mp4' WHEN 'fr' THEN '.WAV' WHEN 'de' THEN '.jpg' ELSE '.mkv' END AS asset,
    CASE lang WHEN 'fr' THEN 'audio' WHEN 'de' THEN 'image' ELSE 'video' END AS kind, CAST(n_chars / 10.0 AS DOUBLE) AS seconds, doc_id % 6 AS six FROM documents)"""


def media_lane(t: Tables) -> DataFrame:
    d = F.col("doc_id")
    suffix = F.when(F.col("lang") == "en", ".mp4").when(F.col("lang") == "fr", ".WAV").when(F.col("lang") == "de", ".jpg").otherwise(".mkv")
    asset = F.concat(F.lit("DataSet-"), d % 9, F.lit("/VOL"), d % 4, F.lit("/m"), d, suffix)
    return t.documents.select("doc_id", "lang", "source", asset.alias("asset"), I.ids.source_kind(asset).alias("kind"), (F.col("n_chars") / 10.0).cast("double").alias("seconds"), (d % 6).alias("six"))


@query(
    f"""WITH {MEDIA_SQL} SELECT asset, CASE WHEN six = 0 THEN 'chunk-' || doc_id ELSE regexp_replace(regexp_extract(asset, '[^/]+$'), '[.][^.]*$', '') END AS document_name,
  CASE WHEN six = 0 THEN lang ELSE 'VOL' || (doc_id % 4) END AS case_key, CASE WHEN six = 0 THEN source ELSE 'DataSet-' || (doc_id % 9) END AS dataset_key FROM media"""
)
def media_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of media documents: those of a whole chunk block, which the digests were made with, else those of the path."""
    rows = media_lane(Tables(spark, sf_dir))
    own = lambda c, whole: F.when(F.col("six") == 0, c).when(F.col("six") == 1, whole)
    block = F.struct(own(F.concat(F.lit("chunk-"), "doc_id"), F.lit("half")).alias("document_name"), own(F.col("lang"), F.lit(None)).alias("case_key"), own(F.col("source"), F.lit("half")).alias("dataset_key"))
    return rows.select("asset", I.media_identifiers(F.col("asset"), block).alias("i")).select("asset", "i.*")


@query(
    f"""WITH {MEDIA_SQL} SELECT asset, kind AS source_kind, CASE WHEN six <> 2 THEN seconds END AS duration_seconds, CASE WHEN kind = 'video' THEN 'h264' END AS video_codec, CASE WHEN six % 2 = 0 THEN 'aac' END AS audio_codec FROM media WHERE kind IN ('audio', 'video')"""
)
def media_metadata_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows of audio and video only."""
    c = F.col
    rows = media_lane(Tables(spark, sf_dir)).withColumn("metadata", F.struct(F.when(c("six") != 2, c("seconds")).alias("duration_seconds"), F.when(c("kind") == "video", "h264").alias("video_codec"), F.when(c("six") % 2 == 0, "aac").alias("audio_codec")))
    return I.media_metadata_rows(rows)


@query(
    f"""WITH {MEDIA_SQL}, o AS (SELECT *, unnest(range(0, six)) AS frame_index FROM media), s AS (SELECT *, (doc_id + frame_index) % 8 AS sev, CASE WHEN (doc_id + frame_index) % 8 >= 4 THEN 'block' WHEN (doc_id + frame_index) % 8 >= 2 THEN 'review' ELSE 'ok' END AS flag FROM o)
SELECT asset, CASE WHEN frame_index % 4 = 3 THEN 'artifact_image' ELSE 'keyframe' END AS modality, CASE WHEN frame_index % 4 = 3 THEN 'artifact:' ELSE 'frame:' END || frame_index AS locator,
  CASE WHEN frame_index % 2 = 0 THEN sev ELSE 0 END AS hate, CAST(0 AS BIGINT) AS sexual, CASE WHEN frame_index % 2 = 1 THEN sev ELSE 0 END AS violence, CAST(0 AS BIGINT) AS self_harm, doc_id % 50 = 0 AS csam_suspected FROM s WHERE flag IN ('block', 'review')"""
)
def media_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of keyframes and pictures that are blocked or under review."""
    d, i = F.col("doc_id"), F.col("frame_index")
    rows = media_lane(Tables(spark, sf_dir)).where("six > 0").select("doc_id", "asset", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("six") - 1)).alias("frame_index"))
    sev = (d + i) % 8
    rows = rows.select(
        "asset", "frame_index", F.when(i % 4 == 3, "picture").when(i % 4 == 1, "keyframe").alias("artifact_kind"), F.when(sev >= 4, "block").when(sev >= 2, "review").otherwise("ok").alias("flag"),
        F.array(F.struct(F.when(i % 2 == 0, "Hate").otherwise("Violence").alias("category"), sev.cast("string").alias("severity")), F.struct(F.lit("odd").alias("category"), F.lit("9").alias("severity"))).alias("severities"), (d % 50 == 0).alias("minor_indicator"),
    )
    found = I.media_findings(rows)
    return found.select("asset", "modality", "locator", *(big(c).alias(c) for c in ("hate", "sexual", "violence", "self_harm")), "csam_suspected")


@query(
    f"""WITH {MEDIA_SQL}, c AS (SELECT asset, CASE WHEN six <> 1 THEN 'caption ' || doc_id END AS caption, CASE six WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'described ' || lang END AS description, CASE WHEN six <> 1 THEN 'photo' END AS content_class, six FROM media WHERE six <> 4)
SELECT asset, nullif(array_to_string(list_filter([nullif(caption, ''), nullif(description, '')], lambda x: x IS NOT NULL), chr(10) || chr(10)), '') AS summary_text, content_class, CASE WHEN six <> 1 THEN true END AS has_visual_content FROM c"""
)
def media_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caption and description of media; assets without either and without a class have no row."""
    d, six = F.col("doc_id"), F.col("six")
    rows = media_lane(Tables(spark, sf_dir)).select(
        "asset", F.when(~six.isin(1, 4), F.concat(F.lit("caption "), d)).alias("caption"), F.when(six == 2, "").when(~six.isin(3, 4), F.concat(F.lit("described "), "lang")).alias("description"),
        F.when(~six.isin(1, 4), "photo").alias("content_class"), F.when(~six.isin(1, 4), True).alias("has_visual_content"),
    )
    return I.media_context(rows)


@query(
    f"""WITH {MEDIA_SQL}, s AS (SELECT asset, kind, doc_id % 50 = 0 AS minor, six = 2 OR six = 3 AS redacted, doc_id % 13 = 0 AS explicit, CASE six WHEN 3 THEN 'block' WHEN 2 THEN 'review' ELSE 'ok' END AS flag, CASE WHEN six = 5 THEN 2 ELSE 0 END AS n_block FROM media),
b AS (SELECT *, CASE WHEN kind = 'image' THEN redacted OR flag = 'block' OR explicit ELSE flag = 'block' OR n_block > 0 END AS blocked FROM s)
SELECT asset, minor AS csam, minor OR (kind = 'image' AND blocked) AS withhold, minor OR blocked AS source_withheld, CASE WHEN minor THEN 'csam' WHEN blocked AND kind = 'image' THEN 'blocked_image' WHEN blocked THEN 'blocked_keyframe' END AS tier FROM b"""
)
def media_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is withheld of media: all of an image that is blocked, only the source of a recording with a blocked frame."""
    six = F.col("six")
    rows = media_lane(Tables(spark, sf_dir)).select(
        "asset", "kind", (F.col("doc_id") % 50 == 0).alias("minor"), six.isin(2, 3).alias("redacted"), (F.col("doc_id") % 13 == 0).alias("explicit"), F.when(six == 3, "block").when(six == 2, "review").otherwise("ok").alias("flag"), F.when(six == 5, 2).otherwise(0).alias("n_block")
    )
    return rows.select("asset", I.media_verdict(F.col("kind"), F.col("minor"), F.col("redacted"), F.col("explicit"), F.col("flag"), F.col("n_block")).alias("v")).select("asset", "v.*")


@query(
    f"""WITH {DOCS_SQL}, {MEDIA_SQL}, both_tracks AS (SELECT document_name AS rel, 'pdf' AS track, status, CAST(NULL AS DOUBLE) AS seconds FROM lane_docs UNION ALL SELECT asset, kind, NULL, seconds FROM media)
SELECT track, count(*) AS n, CAST(coalesce(count_if(status = 'ok'), 0) AS BIGINT) AS n_ok, min(rel) AS first_rel, max(rel) AS last_rel, CAST(count(seconds) AS BIGINT) AS n_timed FROM both_tracks GROUP BY track"""
)
def ingest_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of both tracks, documents and media, by track."""
    t = Tables(spark, sf_dir)
    rows = I.both_tracks(docs_lane(t).select(F.col("document_name").alias("rel"), "status"), media_lane(t).select(F.col("asset").alias("rel"), F.col("kind").alias("track"), "seconds"))
    return rows.groupBy("track").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "ok").alias("n_ok"), F.min("rel").alias("first_rel"), F.max("rel").alias("last_rel"), F.count("seconds").alias("n_timed"))


@query(f"WITH {PAGES_SQL} SELECT doc_id, page_number, sha256('## Transcription' || chr(10) || chr(10) || content) AS page_sha FROM lane_pages WHERE page_kind = 'text'")
def page_markdown_sha(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each text page's markdown."""
    from loomwork.plans.base import pages

    blank = (F.trim("content") == "") | ((F.col("doc_id") + F.col("page_number")) % 43 == 0)
    return pages(Tables(spark, sf_dir)).where(~blank).select("doc_id", "page_number", F.sha2(T.page_markdown(F.col("content")), 256).alias("page_sha"))
