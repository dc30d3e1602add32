"""Load records: one DataFrame for each target table, keyed by document, from the lanes of documents, pages, assets and chunks.

Lanes: docs (doc_id, status, document_name, case_key, dataset_key, source_kind, ...), pages (doc_id, page_number,
page_class, page_kind, content, has_visual_content, summary, flag, content_filtered), assets (ASSET columns), children
(doc_id, place, content_sha) and the store's keys (content_sha).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.config import Ingest
from loomwork.functions import ids
from loomwork.operators import safety as S

ASSET = (
    "doc_id string, kind string, page_number int, image_index int, path string, content_sha string, has_visual_content boolean, embedding_ref string, "
    "safety struct<flag:string,categories:array<string>,minor_indicator:boolean,explicit:boolean>, severities array<struct<category:string,severity:string>>, content_filtered boolean, error_code string"
)


# Classes of pages that the target knows.
PAGE_CLASSES = ("ocr_backing_scan", "mixed_content", "embedded_subimage", "full_page_visual")
# Entries of the metadata bag.
BAG = {
    "source": ("sha256", "bytes", "pdf_producer", "pdf_metadata", "filename"),
    "document": ("bates_begin", "bates_end", "title", "content_type"),
    "generator": ("tool", "tool_version", "pymupdf_version", "reconstruction", "generated_at_utc", "config"),
}
MEDIA_BAG = {"source": ("sha256", "bytes", "content_type", "filename"), "media": None, "caption": ("caption", "description", "content_class"), "generator": ("tool", "tool_version", "generated_at_utc")}


def document_rows(docs: DataFrame, default_kind: str = "pdf") -> DataFrame:
    """Rows of the documents table, of documents that are ready; docs: the lane with load_status, filehash, page_count, content_type, title."""
    kind = F.coalesce("source_kind", F.lit(default_kind)).alias("source_kind")
    return docs.where("load_status = 'ready'").select("doc_id", "case_key", "dataset_key", "document_name", kind, "content_type", "filehash", "page_count", "title", F.lit("upload").alias("source"))


def events(docs: DataFrame, tenant: str, user: str | None = None, default_kind: str = "pdf") -> DataFrame:
    """An event for each document: names, ids that are the same in every run, kind and type."""
    made = ids.event_ids(F.lit(tenant), F.col("case_key"), F.col("dataset_key"), F.col("document_name"))
    rows = docs.withColumn("_ids", made)
    return rows.select(
        F.lit(tenant).alias("tenant_id"), "case_key", "dataset_key", "document_name", "document_id", "_ids.ingestion_id", F.coalesce("source_kind", F.lit(default_kind)).alias("source_kind"), "content_type",
        F.lit("upload").alias("source"), "_ids.correlation_id", F.lit(user).cast("string").alias("ingested_by"),
    )


def metadata_bag(groups: dict[str, dict[str, Column]], listed: dict[str, tuple[str, ...] | None] = BAG) -> Column:
    """map of maps: the listed entries that aren't null, by group; groups without any are left out.  A group that lists None takes all entries."""

    def entries(name: str) -> Column:
        kept = [(k, v) for k, v in groups.get(name, {}).items() if listed[name] is None or k in listed[name]]
        if not kept:
            return F.create_map().cast("map<string,string>")
        return F.map_filter(F.create_map(*[x for k, v in kept for x in (F.lit(k), v.cast("string"))]), lambda _, v: v.isNotNull())

    return F.map_filter(F.create_map(*[x for name in listed for x in (F.lit(name), entries(name))]), lambda _, v: F.size(v) > 0)


def bag_lines(bag: Column) -> Column:
    """`group.key=value` lines of a bag, sorted."""
    lines = F.transform(F.map_entries(bag), lambda g: F.transform(F.map_entries(g["value"]), lambda e: F.concat(g["key"], F.lit("."), e["key"], F.lit("="), e["value"])))
    return F.array_join(F.array_sort(F.flatten(lines)), "\n")


def media_identifiers(asset: Column, block: Column) -> Column:
    """Names (document_name, case_key, dataset_key) of a chunk block if it has all three, else those of the path."""
    names = ("document_name", "case_key", "dataset_key")
    whole = F.lit(True)
    for n in names:
        whole &= F.coalesce(block[n], F.lit("")) != ""
    derived = {"document_name": ids.stem(asset), "case_key": ids.case_key(asset), "dataset_key": ids.dataset_key(asset)}
    return F.struct(*(F.when(whole, block[n]).otherwise(derived[n]).alias(n) for n in names))


def media_metadata_rows(media: DataFrame) -> DataFrame:
    """Rows of the media table, of audio and video only; media: asset, kind, metadata (struct)."""
    return media.where(F.col("kind").isin("audio", "video")).select("asset", F.col("kind").alias("source_kind"), "metadata.*")


def media_findings(frames: DataFrame) -> DataFrame:
    """Findings of frames (asset, frame_index, artifact_kind, flag, severities, minor_indicator) that are blocked or under review."""
    is_frame = F.coalesce("artifact_kind", F.lit("keyframe")) == "keyframe"
    locator = F.when(is_frame, F.concat(F.lit("frame:"), "frame_index")).otherwise(F.concat(F.lit("artifact:"), F.coalesce("frame_index", F.lit(0))))
    minor = F.coalesce("minor_indicator", F.lit(False)).alias("csam_suspected")
    return frames.where(F.col("flag").isin("block", "review")).select("asset", F.when(is_frame, "keyframe").otherwise("artifact_image").alias("modality"), locator.alias("locator"), *map(severity, SEVERITIES), minor)


def media_context(captions: DataFrame) -> DataFrame:
    """Caption and description in one text, with the class; nothing for an asset without any of them.  captions: asset, caption, description, content_class, has_visual_content."""
    part = lambda c: F.nullif(F.col(c), F.lit(""))
    text = F.nullif(F.concat_ws("\n\n", part("caption"), part("description")), F.lit(""))
    return captions.select("asset", text.alias("summary_text"), "content_class", "has_visual_content").where("summary_text IS NOT NULL OR content_class IS NOT NULL OR has_visual_content IS NOT NULL")


def media_verdict(kind: Column, minor: Column, redacted: Column, explicit: Column, flag: Column, n_block: Column) -> Column:
    """Struct (csam, withhold, source_withheld, tier): an image is withheld whole, of a recording with a blocked frame only the source."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    image = kind == "image"
    blocked = F.when(image, yes(redacted) | yes(flag == "block") | yes(explicit)).otherwise(yes(flag == "block") | (F.coalesce(n_block, F.lit(0)) > 0))
    tier = F.when(yes(minor), "csam").when(blocked, F.when(image, "blocked_image").otherwise("blocked_keyframe"))
    return F.struct(yes(minor).alias("csam"), (yes(minor) | (image & blocked)).alias("withhold"), (yes(minor) | blocked).alias("source_withheld"), tier.alias("tier"))


def both_tracks(documents: DataFrame, media: DataFrame) -> DataFrame:
    """Records of documents (track pdf), then of media, in one frame; columns that one track lacks are null."""
    return documents.withColumn("track", F.lit("pdf")).unionByName(media, allowMissingColumns=True)


SEVERITIES = ("hate", "sexual", "violence", "self_harm")


def severity(column: str) -> Column:
    """The largest severity among the categories of a column; 0 for none, and for those that aren't numbers."""
    names = [k for k, v in S.COLUMNS.items() if v == column]
    hits = F.transform(F.filter(F.coalesce("severities", F.array().cast("array<struct<category:string,severity:string>>")), lambda c: F.lower(c["category"]).isin(*names)), lambda c: F.coalesce(c["severity"].try_cast("int"), F.lit(0)))
    return F.coalesce(F.array_max(hits), F.lit(0)).alias(column)


def asset_verdicts(assets: DataFrame, cfg: Ingest = Ingest()) -> DataFrame:
    """Assets with v: csam, withhold, reasons, tier."""
    c = F.col
    flagged = F.transform(F.coalesce(c("safety.categories"), F.array().cast("array<string>")), F.lower)
    filtered = F.coalesce(c("content_filtered"), F.lit(False)) | (F.coalesce(c("error_code"), F.lit("")) == "content_filter")
    vetted = c("safety.flag").isNotNull() & c("error_code").isNull()
    return assets.withColumn("v", S.verdict(filtered, c("safety.explicit"), c("safety.minor_indicator"), flagged, S.over_threshold(c("severities"), cfg.severity), c("has_visual_content"), vetted, cfg.withhold_unvetted, S.severity_marks(c("severities"), cfg.severity)))


def document_status(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """docs with load_status: no_sidecar, error, skip_status, skip_csam, ready; n_withheld; source_withheld."""
    by = judged.groupBy("doc_id").agg(F.bool_or("v.csam").alias("csam"), F.count_if("v.withhold").alias("n_withheld"))
    rows = docs.join(by, "doc_id", "left").withColumn("n_withheld", F.coalesce("n_withheld", F.lit(0)))
    unnamed = F.col("document_name").isNull() | F.col("case_key").isNull() | F.col("dataset_key").isNull()
    status = F.when(F.col("status").isNull(), "no_sidecar").when(F.col("status") != "ok", "skip_status").when(unnamed, "error").when(F.coalesce("csam", F.lit(False)), "skip_csam").otherwise("ready")
    return rows.withColumn("load_status", status).withColumn("source_withheld", F.col("n_withheld") > 0).drop("csam")


def ready_only(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.join(docs.where("load_status = 'ready'").select("doc_id"), "doc_id", "left_semi")


def page_rows(pages: DataFrame, judged: DataFrame) -> DataFrame:
    """Pages with their review status: withheld if any asset on them is."""
    held = judged.where("v.withhold AND page_number IS NOT NULL").select("doc_id", "page_number").distinct().withColumn("_held", F.lit(True))
    rows = pages.join(held, ["doc_id", "page_number"], "left")
    return rows.select("doc_id", "page_number", F.when(F.col("page_class").isin(*PAGE_CLASSES), F.col("page_class")).alias("page_class"), F.nullif("content", F.lit("")).alias("ocr_text"), "summary", F.when(F.col("_held"), "withheld").otherwise("none").alias("review_status"))


def findings(pages: DataFrame, judged: DataFrame) -> DataFrame:
    """One row for each scanned unit that carries a signal; assets are told apart by page and image."""
    zero = [F.lit(0).alias(c) for c in SEVERITIES]
    text = pages.where("flag = 'review' OR content_filtered").select("doc_id", F.lit("page_text").alias("modality"), F.concat(F.lit("page:"), "page_number").alias("locator"), *zero, F.lit(False).alias("csam_suspected"))

    is_page = F.col("kind") == "page"
    locator = F.when(is_page, F.concat(F.lit("page:"), "page_number")).otherwise(F.concat(F.lit("artifact:"), F.coalesce("page_number", F.lit(-1)), F.lit(":"), F.coalesce("image_index", F.lit(-1))))
    minor, explicit = (F.coalesce(f"safety.{c}", F.lit(False)) for c in ("minor_indicator", "explicit"))
    image = judged.select("doc_id", F.when(is_page, "page_image").otherwise("artifact_image").alias("modality"), locator.alias("locator"), *map(severity, SEVERITIES), minor.alias("csam_suspected"), explicit.alias("_explicit"))
    image = image.where("hate + sexual + violence + self_harm > 0 OR csam_suspected OR _explicit").drop("_explicit")
    return text.unionByName(image)


def blobs(docs: DataFrame, pages: DataFrame, judged: DataFrame) -> DataFrame:
    """doc_id, artifact, action, source_path, content_type: what is copied and what a placeholder stands for."""
    is_page = (F.col("kind") == "page") & F.col("page_number").isNotNull()
    artifact = F.when(is_page, F.concat(F.lit("ocr/page-"), "page_number", F.lit(".png"))).otherwise(F.concat(F.lit("artifacts/"), ids.document_uuid(F.coalesce("content_sha", "path"), namespace=ids.ARTIFACT_NAMESPACE), F.lit("/image.png")))
    source = docs.select("doc_id", F.lit("source.pdf").alias("artifact"), F.lit("upload").alias("action"), F.col("doc_id").cast("string").alias("source_path"), F.lit("application/pdf").alias("content_type"))
    held = F.col("v.withhold")
    asset = judged.select("doc_id", artifact.alias("artifact"), F.when(held, "placeholder_redacted").otherwise("upload").alias("action"), F.when(~held, F.col("path")).alias("source_path"), F.when(~held, ids.mime(F.col("path"))).alias("content_type"))
    blank = pages.where(S.page_blank(F.col("page_kind"), F.col("content"), F.col("has_visual_content")) & F.col("page_number").isNotNull())
    none = F.lit(None).cast("string")
    blank = blank.select("doc_id", F.concat(F.lit("ocr/page-"), "page_number", F.lit(".png")).alias("artifact"), F.lit("placeholder_blank").alias("action"), none.alias("source_path"), none.alias("content_type"))
    return source.unionByName(asset).unionByName(blank)


def image_vectors(judged: DataFrame, vectors: DataFrame) -> DataFrame:
    """Vectors (embedding_ref, vector) of the assets that are kept and show something; each content once."""
    kept = judged.where("NOT v.withhold AND has_visual_content AND embedding_ref IS NOT NULL")
    rows = kept.join(vectors, "embedding_ref").select("doc_id", "content_sha", F.coalesce("page_number", F.lit(Ingest.placeholder_index)).alias("page_number"), "vector")
    return rows


def first_of(items: DataFrame, key: str, order: list[str], value: str, most: int) -> DataFrame:
    """key, value: an array of the first `most` values of each key in order.  The limit holds before the shuffle too, so a key of any number of items brings few rows."""
    kept = items.withColumn("_at", F.row_number().over(W.partitionBy(key).orderBy(*order))).where(F.col("_at") <= most)
    listed = F.sort_array(F.collect_list(F.struct("_at", F.col(value).alias("_v"))))
    return kept.groupBy(key).agg(F.transform(listed, lambda x: x["_v"]).alias(value))


def asset_context(pages: DataFrame, finals: DataFrame) -> DataFrame:
    """doc_id, summary_text, key_points (50), entities (100), topics (30, sorted and distinct), in page order; nothing for a document without either.

    pages: doc_id, page_number, key_points, entities, topics; finals: doc_id, text, source, no_content.
    """
    at = F.coalesce("page_number", F.lit(2**31 - 1)).alias("_page")
    placed = lambda c: pages.select("doc_id", at, F.posexplode(c).alias("_place", c))
    points = first_of(placed("key_points"), "doc_id", ["_page", "_place"], "key_points", 50)
    entities = first_of(placed("entities"), "doc_id", ["_page", "_place"], "entities", 100)
    topics = first_of(pages.select("doc_id", F.explode("topics").alias("topics")).where("topics <> ''").distinct(), "doc_id", ["topics"], "topics", 30)
    none = F.coalesce("no_content", F.lit(False)) | (F.coalesce("source", F.lit("")) == "no_content")
    # What stands beside the text: its source, the pages and assets it covers, the model.
    beside = [c for c in ("source", "covered_text_pages", "covered_vision_assets", "model") if c in finals.columns]
    rows = finals.select("doc_id", F.when(~none, F.col("text")).alias("summary_text"), *beside)
    for part in (points, entities, topics):
        rows = rows.join(part, "doc_id", "full_outer")
    kinds = {"key_points": "array<string>", "entities": "array<struct<name:string,type:string>>", "topics": "array<string>"}
    rows = rows.select("doc_id", "summary_text", *beside, *(F.coalesce(c, F.array().cast(kind)).alias(c) for c, kind in kinds.items()))
    return rows.where("summary_text IS NOT NULL OR size(key_points) + size(entities) + size(topics) > 0")


def plan(docs: DataFrame, pages: DataFrame, judged: DataFrame, children: DataFrame, store: DataFrame, vectors: DataFrame) -> DataFrame:
    """Counts for each document: load_status, n_withheld, n_images, n_blank, n_children, n_missing."""
    seen = store.select("content_sha", F.lit(True).alias("_seen")).distinct()
    shas = children.select("doc_id", "content_sha").distinct().join(seen, "content_sha", "left").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("_seen").isNull()).alias("n_missing"))
    blank = pages.groupBy("doc_id").agg(F.count_if(S.page_blank(F.col("page_kind"), F.col("content"), F.col("has_visual_content"))).alias("n_blank"))
    images = image_vectors(judged, vectors).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_images"))
    rows = docs.select("doc_id", "load_status", "n_withheld")
    for part in (images, blank, shas):
        rows = rows.join(part, "doc_id", "left")
    counts = ("n_images", "n_blank", "n_children", "n_missing")
    ready = F.col("load_status") == "ready"
    return rows.select("doc_id", "load_status", "n_withheld", *(F.when(ready, F.coalesce(c, F.lit(0))).otherwise(0).alias(c) for c in counts))


def plan_json(plans: DataFrame) -> DataFrame:
    """One JSON text for each document."""
    return plans.select(F.to_json(F.struct(*plans.columns)).alias("value"))
