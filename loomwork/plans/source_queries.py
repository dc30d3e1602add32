"""Discovery, sidecars, lanes, stores and packages over listings made from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomwork.functions import ids
from loomwork.functions import text as T
from loomwork.operators import dedup as U
from loomwork.plans.base import Tables, big, query
from loomwork.plans.lanes import PAGES_SQL, assets_lane, docs_lane, pages_lane
from loomwork.sources import discovery as D
from loomwork.sources import lanes as L
from loomwork.sources.package import write_package
from loomwork.sources.store import VectorStore
from loomwork.storage import Scratch

# A listing as a directory walk gives it: files below language folders, some in folders that hold outputs.
FILES_SQL = """files AS (
  SELECT doc_id, n_chars AS length, 'file:/c/' || lang || CASE doc_id % 8 WHEN 0 THEN '/' || doc_id || '.pdf' WHEN 1 THEN '/' || doc_id || '.pdf' WHEN 2 THEN '/' || (doc_id - 1) || '/extra.pdf' WHEN 3 THEN '/pages/' || doc_id || '.pdf'
    WHEN 4 THEN '/Artifacts/' || doc_id || '.pdf' WHEN 5 THEN '/' || doc_id || '.PDF' WHEN 6 THEN '/sub/' || doc_id || '.pdf' ELSE '/' || doc_id || '.txt' END AS path FROM documents)"""


def files_lane(t: Tables) -> DataFrame:
    """path, length, doc_id."""
    d = F.col("doc_id")
    name = (
        F.when(d % 8 <= 1, F.concat(d, F.lit(".pdf"))).when(d % 8 == 2, F.concat(d - 1, F.lit("/extra.pdf"))).when(d % 8 == 3, F.concat(F.lit("pages/"), d, F.lit(".pdf")))
        .when(d % 8 == 4, F.concat(F.lit("Artifacts/"), d, F.lit(".pdf"))).when(d % 8 == 5, F.concat(d, F.lit(".PDF"))).when(d % 8 == 6, F.concat(F.lit("sub/"), d, F.lit(".pdf"))).otherwise(F.concat(d, F.lit(".txt")))
    )
    return t.documents.select("doc_id", F.col("n_chars").alias("length"), F.concat(F.lit("file:/c/"), "lang", F.lit("/"), name).alias("path"))


@query(
    f"""WITH {FILES_SQL}, stems AS (SELECT regexp_replace(path, '[.][pP][dD][fF]$', '') AS stem FROM files WHERE lower(path) LIKE '%.pdf')
SELECT path FROM files f WHERE lower(path) LIKE '%.pdf' AND NOT regexp_matches(lower(path), '/(images|pages|artifacts|[.]embeddings)/') AND NOT EXISTS (SELECT 1 FROM stems s WHERE starts_with(f.path, s.stem || '/'))"""
)
def pdf_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents below a root: output folders, and folders beside a document of their name, are left out."""
    files = files_lane(Tables(spark, sf_dir)).where(F.lower("path").endswith(".pdf"))
    return D.pruned(files, "file:/c").select("path")


@query(f"WITH {FILES_SQL} SELECT path, length FROM files WHERE lower(path) LIKE '%.pdf'")
def pdf_walk_unpruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files_lane(Tables(spark, sf_dir)).where(F.lower("path").endswith(".pdf")).select("path", "length")


MEDIA_FILES_SQL = """media_files AS (
  SELECT 'file:/m/DataSet-' || (doc_id % 9) || CASE doc_id % 7 WHEN 0 THEN '/IMAGES' WHEN 1 THEN '/x.media' WHEN 2 THEN '/Review' ELSE '/VOL' || (doc_id % 3) END || '/f' || doc_id || ['.m4a', '.MP4', '.jpeg', '.pdf', '.opus', '.vob', '.heif', '.txt', ''][CAST(doc_id % 9 AS INTEGER) + 1] AS path FROM documents)"""


def _media_files(t: Tables) -> DataFrame:
    d = F.col("doc_id")
    folder = F.when(d % 7 == 0, "/IMAGES").when(d % 7 == 1, "/x.media").when(d % 7 == 2, "/Review").otherwise(F.concat(F.lit("/VOL"), d % 3))
    suffix = F.element_at(F.array(*map(F.lit, (".m4a", ".MP4", ".jpeg", ".pdf", ".opus", ".vob", ".heif", ".txt", ""))), (d % 9 + 1).cast("int"))
    return t.documents.select(F.concat(F.lit("file:/m/DataSet-"), d % 9, folder, F.lit("/f"), d, suffix).alias("path"))


@query(
    f"""WITH {MEDIA_FILES_SQL}, k AS (SELECT path, CASE WHEN lower(path) SIMILAR TO '.*[.](m4a|opus)' THEN 'audio' WHEN lower(path) SIMILAR TO '.*[.](mp4|vob)' THEN 'video' WHEN lower(path) SIMILAR TO '.*[.](jpeg|heif)' THEN 'image' END AS kind FROM media_files)
SELECT path, kind FROM k WHERE kind IS NOT NULL AND NOT regexp_matches(lower(path), '/(images|review|[^/]*[.]media)/')"""
)
def media_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audio, video and image files with their kind, without outputs and folders that hold no originals."""
    return D.media_of(_media_files(Tables(spark, sf_dir)), "file:/m").select("path", "kind")


@query(f"WITH {MEDIA_FILES_SQL} SELECT nullif(regexp_extract(path, 'DataSet-[0-9]+'), '') AS dataset, count(*) AS n_files FROM media_files GROUP BY 1")
def dataset_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.datasets(_media_files(Tables(spark, sf_dir)))


@query("WITH p AS (SELECT CASE WHEN doc_id % 5 = 0 THEN 'VOL' || (doc_id % 3) || '/IMAGES' WHEN doc_id % 5 = 1 THEN 'DATA' END AS dir FROM documents) SELECT DISTINCT dir FROM p WHERE dir LIKE 'VOL%'")
def image_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of page images of a dataset without IMAGES at its root."""
    d = F.col("doc_id")
    rel = F.when(d % 5 == 0, F.concat(F.lit("VOL"), d % 3, F.lit("/IMAGES/"))).when(d % 5 == 1, F.lit("DATA/")).otherwise(F.lit("x/IMAGES/"))
    return D.image_dirs(Tables(spark, sf_dir).documents.select(F.concat(F.lit("file:/d/"), rel, d, F.lit(".pdf")).alias("path")), "file:/d")


@query(
    f"""WITH {FILES_SQL}, sides AS (SELECT regexp_replace(path, '[.][^.]*$', '') || '.json' AS sidecar, length % 97 AS sidecar_length FROM files WHERE doc_id % 3 = 0 AND lower(path) LIKE '%.pdf')
SELECT path AS pdf, regexp_replace(path, '[.][^.]*$', '') || '.json' AS sidecar, s.sidecar IS NOT NULL AS has_sidecar, s.sidecar_length FROM files f LEFT JOIN sides s ON s.sidecar = regexp_replace(f.path, '[.][^.]*$', '') || '.json' WHERE lower(path) LIKE '%.pdf'"""
)
def sidecar_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's sidecar and its length, from one listing; nothing is opened."""
    files = files_lane(Tables(spark, sf_dir))
    sides = files.where("doc_id % 3 = 0").where(F.lower("path").endswith(".pdf")).select(F.concat(F.regexp_replace("path", r"\.[^.]*$", ""), F.lit(".json")).alias("path"), (F.col("length") % 97).alias("length"))
    every = files.select("path", "length").union(sides).withColumn("modified", F.lit(None).cast("timestamp"))
    return D.sidecars(every).select("pdf", "sidecar", F.col("exists").alias("has_sidecar"), "sidecar_length")


@query(f"WITH {FILES_SQL} SELECT regexp_replace(path, '/[^/]*$', '') AS directory, count(*) AS n_files, CAST(sum(length) AS BIGINT) AS bytes FROM files WHERE path LIKE '%/pages/%' GROUP BY 1")
def purge_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.purge_plan(files_lane(Tables(spark, sf_dir)))


@query(
    """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'missing' WHEN doc_id % 7 = 1 THEN 'parse_error' ELSE 'ok' END AS parse_status,
  CASE WHEN doc_id % 7 = 0 THEN 'no_sidecar' WHEN doc_id % 7 = 1 THEN 'bad_sidecar' WHEN doc_id % 5 = 0 THEN 'no_stage2' WHEN doc_id % 3 = 0 THEN 'skipped_done' ELSE 'run' END AS action,
  CASE WHEN doc_id % 7 = 0 THEN 'no_sidecar' WHEN doc_id % 7 = 1 THEN 'bad_sidecar' WHEN doc_id % 5 = 0 THEN 'no_stage2' ELSE 'run' END AS forced FROM documents"""
)
def sidecar_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stage does with sidecars that are missing, broken, without the block it needs, or done."""
    d = F.col("doc_id")
    docs = Tables(spark, sf_dir).documents.select("doc_id", F.concat(F.lit("file:///c/"), d, F.lit(".json")).alias("path"))
    records = docs.where("doc_id % 7 <> 0").select(
        F.concat(F.lit("file:/c/"), d, F.lit(".json")).alias("path"), F.timestamp_seconds(F.lit(0)).alias("modified"), F.when(d % 7 == 1, "{").alias(L.CORRUPT), (d % 5 != 0).alias("stage2"), F.when(d % 3 == 0, True).alias("done")
    )
    rows = L.tolerant(docs, records)
    gate = lambda force: L.gate(F.col("parse_status"), {"no_stage2": F.col("stage2")}, F.col("done"), force)
    return rows.select("doc_id", "parse_status", gate(False).alias("action"), gate(True).alias("forced"))


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id % 3 = 0 OR (doc_id % 3 = 1 AND n_chars % 2 = 0)")
def resume_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose path and digest aren't those that were recorded."""
    t = Tables(spark, sf_dir)
    now = t.documents.select("doc_id", "n_chars", F.sha2("text", 256).alias("sha"))
    recorded = now.where("doc_id % 3 <> 0").select("doc_id", F.when((F.col("doc_id") % 3 == 1) & (F.col("n_chars") % 2 == 0), F.lit("other")).otherwise(F.col("sha")).alias("sha"))
    return L.resume(now, recorded, ["doc_id", "sha"]).select("doc_id", "n_chars")


@query(
    f"""WITH {PAGES_SQL} SELECT lang AS case_key, source AS dataset_key, 'doc-' || doc_id || '.pdf' AS document_name, count(*) AS n_blobs, sha256(string_agg('img/' || doc_id || '-' || page_number || '=' || content_sha, '|' ORDER BY 'img/' || doc_id || '-' || page_number, content_sha)) AS blobs_sha
FROM lane_pages GROUP BY ALL, doc_id""".replace("GROUP BY ALL, doc_id", "GROUP BY doc_id, lang, source")
)
def blob_manifest_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows grouped by document, in order of their paths."""
    rows = pages_lane(Tables(spark, sf_dir)).select(
        F.col("lang").alias("case_key"), F.col("source").alias("dataset_key"), F.concat(F.lit("doc-"), "doc_id", F.lit(".pdf")).alias("document_name"), F.concat(F.lit("img/"), "doc_id", F.lit("-"), "page_number").alias("path"), "content_sha"
    )
    made = L.grouped_manifest(rows)
    listed = F.array_join(F.transform("blobs", lambda b: F.concat(b["path"], F.lit("="), b["content_sha"])), "|")
    return made.select("case_key", "dataset_key", "document_name", big(F.size("blobs")).alias("n_blobs"), F.sha2(listed, 256).alias("blobs_sha"))


@query(
    f"""WITH {PAGES_SQL}, f AS (SELECT doc_id, content_sha, min(page_number) AS first_page FROM lane_pages GROUP BY ALL)
SELECT doc_id, count(*) AS n_shas, sha256(string_agg(content_sha, ',' ORDER BY first_page)) AS shas_sha FROM f GROUP BY doc_id"""
)
def child_shas_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of a document's children in order, each once, where it stands first; a document's pages are its parents here."""
    child = F.array(F.struct("content_sha"))
    parents = pages_lane(Tables(spark, sf_dir)).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page_number", child.alias("children")))).alias("parents"))
    shas = parents.select("doc_id", L.ordered_shas(F.col("parents")).alias("s"))
    return shas.select("doc_id", big(F.size("s")).alias("n_shas"), F.sha2(F.array_join("s", ","), 256).alias("shas_sha"))


@query(
    """SELECT event_id, CAST(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), -1) AS INTEGER) AS page_number, CAST(coalesce(TRY_CAST(json_extract_string(props, '$.missing') AS INTEGER), -1) AS INTEGER) AS timestamp_ms, CAST(-1 AS INTEGER) AS frame_index FROM events"""
)
def occurrence_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences with -1 for a place that isn't a whole number."""
    place = lambda k: F.get_json_object("props", f"$.{k}")
    return L.occurrence_rows(Tables(spark, sf_dir).events.select("event_id", place("k").alias("page_number"), place("missing").alias("timestamp_ms"), F.col("event_type").alias("frame_index")))


@query(
    f"""WITH {PAGES_SQL}, low AS (SELECT doc_id, page_number FROM lane_pages WHERE quality = 0) SELECT doc_id, 'page' AS kind, page_number, 'low_quality_text' AS route_reason FROM low WHERE page_number % 2 = 0"""
)
def escalated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New page assets for pages of low quality that have none; assets stand for odd pages here."""
    t = Tables(spark, sf_dir)
    rows = pages_lane(t).select("doc_id", "page_number", F.when(F.col("quality") == 0, F.array(F.lit("low_quality_text"))).otherwise(F.array(F.lit("rotated"))).alias("flags"))
    return L.escalated(rows, assets_lane(t).where("kind = 'page'"))


@query(
    f"""WITH {PAGES_SQL}, low AS (SELECT doc_id, count(*) AS n FROM lane_pages WHERE quality = 0 AND page_number % 2 = 0 GROUP BY doc_id) SELECT count(*) AS documents_scanned, CAST(count(l.n) AS BIGINT) AS documents_escalated, CAST(coalesce(sum(l.n), 0) AS BIGINT) AS pages_escalated FROM documents d LEFT JOIN low l USING (doc_id)"""
)
def escalation_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages of an escalation run."""
    return L.escalation_manifest(Tables(spark, sf_dir).documents.select("doc_id"), escalated_pages(spark, sf_dir))


@query("WITH b AS (SELECT doc_id, 'stage' || (3 + doc_id % 3) AS stage, CASE WHEN doc_id % 11 <> 0 THEN 'v' || (doc_id % 2) END AS version FROM documents) SELECT doc_id, stage, version FROM b WHERE version IS NULL OR version <> CASE stage WHEN 'stage3' THEN 'v0' ELSE 'v1' END")
def stale_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks made with other upstream versions than the present ones."""
    d = F.col("doc_id")
    blocks = Tables(spark, sf_dir).documents.select("doc_id", F.concat(F.lit("stage"), d % 3 + 3).alias("stage"), F.when(d % 11 != 0, F.concat(F.lit("v"), d % 2)).alias("version"))
    now = spark.createDataFrame([("stage3", "v0"), ("stage4", "v1"), ("stage5", "v1")], "stage string, version string")
    return L.stale(blocks, now, "doc_id")


@query("SELECT doc_id, 'stage3' AS stage, 'model_error' AS error_code, substring(text, 1, 300) AS error_message FROM documents WHERE doc_id % 17 = 0")
def error_lane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error rows; messages are cut at 300 characters (the limit is the lane's own)."""
    return L.error_rows(Tables(spark, sf_dir).documents.where("doc_id % 17 = 0"), "doc_id", "model_error", F.col("text"), "stage3")


@query(
    """WITH u AS (SELECT page_id, url || ['.png', '.JPEG', '.webp', '.pdf', '.mp3', ''][CAST(page_id % 6 AS INTEGER) + 1] AS path FROM pages)
SELECT page_id, regexp_extract(path, '[^/]+$') AS file_name, CASE page_id % 6 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/webp' WHEN 3 THEN 'application/pdf' ELSE 'application/octet-stream' END AS mime,
  CASE WHEN page_id % 6 <= 2 THEN 'image' WHEN page_id % 6 = 4 THEN 'audio' END AS kind FROM u"""
)
def file_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.element_at(F.array(*map(F.lit, (".png", ".JPEG", ".webp", ".pdf", ".mp3", ""))), (F.col("page_id") % 6 + 1).cast("int"))
    rows = Tables(spark, sf_dir).pages.select("page_id", F.concat("url", suffix).alias("path"))
    return rows.select("page_id", ids.file_name(F.col("path")).alias("file_name"), ids.mime(F.col("path")).alias("mime"), ids.source_kind(F.col("path")).alias("kind"))


@query(
    """WITH u AS (SELECT doc_id, source, text, '6ba7b8109dad11d180b4' || '00c04fd430c8' AS ns FROM documents), h AS (SELECT doc_id, sha1(unhex(ns) || encode(source || '/' || text)) AS h FROM u)
SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr(h, 17, 1))::INTEGER % 4 AS INTEGER) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id FROM h"""
)
def deterministic_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version-5 uuids of names."""
    return Tables(spark, sf_dir).documents.select("doc_id", ids.document_uuid(F.col("source"), F.col("text")).alias("id"))


@query("SELECT 'emb/' || vec_id AS embedding_ref, 'image-vectors' AS model, 'v' || (vec_id % 2) AS version, CAST(len(embedding) AS BIGINT) AS dim, embedding[1]::DOUBLE AS first_value FROM embeddings")
def image_vector_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image vectors written in two runs and read again with what they were made by."""
    rows = Tables(spark, sf_dir).embeddings.select("vec_id", F.concat(F.lit("emb/"), "vec_id").alias("embedding_ref"), F.col("embedding").alias("vector"))
    out = f"{Scratch(spark, 'image-vectors').root}/vectors"
    for k in (0, 1):
        L.write_image_vectors(rows.where(F.col("vec_id") % 2 == k), out, "image-vectors", f"v{k}")
    found = spark.read.schema("embedding_ref string, embedding_model string, model_version string, dim int, vector array<float>").parquet(out)
    return found.select("embedding_ref", F.col("embedding_model").alias("model"), F.col("model_version").alias("version"), big("dim").alias("dim"), F.get("vector", F.lit(0)).cast("double").alias("first_value"))


@query("SELECT doc_id, lang, n_chars, filehash FROM (SELECT doc_id, lang, n_chars, sha256(text) AS filehash FROM documents)")
def plan_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan written as JSON lines and read again with its schema."""
    rows = Tables(spark, sf_dir).documents.select("doc_id", "lang", "n_chars", F.sha2("text", 256).alias("filehash"))
    out = f"{Scratch(spark, 'plan').root}/plan"
    rows.write.json(out)
    return L.read_jsonl(spark, out, StructType.fromDDL("doc_id bigint, lang string, n_chars bigint, filehash string"))


@query("SELECT sha256(CAST(vec_id AS VARCHAR)) AS content_sha, CAST(len(embedding) AS BIGINT) AS dims, CASE WHEN vec_id % 3 = 0 THEN -embedding[1] ELSE embedding[1] END::DOUBLE AS first_value FROM embeddings")
def store_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors appended in two runs and read again; of a digest in both, the later vector counts."""
    t = Tables(spark, sf_dir)
    rows = t.embeddings.select("vec_id", F.sha2(F.col("vec_id").cast("string"), 256).alias("content_sha"), F.col("embedding").alias("vector"))
    store = VectorStore(spark, f"{Scratch(spark, 'store').root}/vectors", "test", int(rows.select(F.max(F.size("vector"))).first()[0] or 0))
    store.append(rows.select("content_sha", "vector"), 1)
    store.append(rows.where("vec_id % 3 = 0").select("content_sha", F.transform("vector", lambda x: -x).alias("vector")), 2)
    return store.latest().select("content_sha", big(F.size("vector")).alias("dims"), F.get("vector", F.lit(0)).cast("double").alias("first_value"))


@query(
    f"""WITH {PAGES_SQL} SELECT (SELECT count(*) FROM documents) AS plan, (SELECT count(*) FROM lane_pages) AS blobs, (SELECT count(DISTINCT content_sha) FROM lane_pages) AS text_vectors, (SELECT count(*) FROM embeddings) AS image_vectors"""
)
def package_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a load package that was written and read again; a digest that several documents share is written once."""
    t = Tables(spark, sf_dir)
    rows = pages_lane(t)
    out = f"{Scratch(spark, 'package-out').root}/package"
    text = rows.select("content_sha", F.array(F.col("n_chars").cast("float")).alias("vector"))
    image = t.embeddings.select(F.sha2(F.col("vec_id").cast("string"), 256).alias("content_sha"), F.col("embedding").alias("vector"))
    write_package(out, docs_lane(t).select("doc_id", "status"), text, image, rows.select("doc_id", "page_number", "content_sha"))
    return spark.read.schema("plan bigint, blobs bigint, text_vectors bigint, image_vectors bigint").json(f"{out}/counts")


@query(
    f"""WITH {PAGES_SQL}, c AS (SELECT doc_id, count(*) AS n FROM lane_pages WHERE doc_id % 4 <> 0 GROUP BY doc_id) SELECT d.doc_id, coalesce(c.n, 0) AS n_chunks, CASE WHEN d.doc_id % 8 = 1 THEN 'given/' || d.doc_id ELSE 'derived/doc-' || d.doc_id || '.chunks.json' END AS chunks_path FROM documents d LEFT JOIN c USING (doc_id)"""
)
def chunk_loader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's chunks by the path that its plan gives or else the derived one; an empty list for a document without."""
    t = Tables(spark, sf_dir)
    d = F.col("doc_id")
    chunks = pages_lane(t).where("doc_id % 4 <> 0").groupBy("doc_id").agg(F.collect_list("content_sha").alias("chunks"))
    plans = t.documents.select("doc_id", F.when(d % 8 == 1, F.concat(F.lit("given/"), d)).alias("chunks_path"), F.concat(F.lit("derived/doc-"), d, F.lit(".pdf")).alias("document"))
    rows = L.with_chunks(plans, chunks, "doc_id", "array<string>")
    return rows.select("doc_id", big(F.size("chunks")).alias("n_chunks"), "chunks_path")


@query(
    "WITH s AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) SELECT user_id, event_type, event_id, value FROM s WHERE r = 1"
)
def last_written_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last record of each key."""
    rows = Tables(spark, sf_dir).events.select("user_id", "event_type", "event_id", "value", F.struct("ts", "event_id").alias("seq"))
    return U.last_written(rows, ["user_id", "event_type"], "seq").select("user_id", "event_type", "event_id", "value")


@query(f"WITH {PAGES_SQL} SELECT substr(content_sha, 1, 2) AS shard, count(*) AS n, count(DISTINCT content_sha) AS n_shas FROM lane_pages GROUP BY 1")
def store_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = pages_lane(Tables(spark, sf_dir)).groupBy(T.shard(F.col("content_sha")).alias("shard"), "content_sha").agg(F.count(F.lit(1)).alias("n"))
    return by.groupBy("shard").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_shas"))
