"""Column functions that derive identifiers from paths, and deterministic ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Namespace of deterministic ids (the DNS namespace of RFC 4122).
NAMESPACE = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
# Namespaces of ids that are kept across runs.
EVENT_NAMESPACE = "b7c4d2e0-0000-5000-8000-0000000000a8"
ARTIFACT_NAMESPACE = "a5e9b1c2-0000-5000-8000-000000000001"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r"\.[^.]+$", 0))


def dataset_key(path: Column, override: Column | None = None) -> Column:
    found = F.nullif(F.regexp_extract(path, r"DataSet-\d+", 0), F.lit(""))
    return found if override is None else F.coalesce(F.nullif(override, F.lit("")), found)


def case_key(path: Column, override: Column | None = None) -> Column:
    found = F.nullif(F.regexp_extract(path, r"VOL\d+", 0), F.lit(""))
    return found if override is None else F.coalesce(F.nullif(override, F.lit("")), found)


def document_uuid(*names: Column, namespace: str = NAMESPACE) -> Column:
    """Version-5 uuid of the names joined by slashes: SHA-1 of namespace and name with version and variant bits set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(F.concat_ws("/", *names), "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def event_ids(tenant: Column, case: Column, dataset: Column, document: Column) -> Column:
    """Ids of a document's ingestion and of its correlation, the same in every run."""
    made = lambda kind: document_uuid(F.lit(kind), tenant, case, dataset, document, namespace=EVENT_NAMESPACE)
    return F.struct(made("ingest").alias("ingestion_id"), made("corr").alias("correlation_id"))


def case_of(relative: Column, path: Column, override: Column | None = None) -> Column:
    """The case in a record's relative path, else in its path; an override wins."""
    found = F.coalesce(case_key(relative), case_key(path))
    return found if override is None else F.coalesce(F.nullif(override, F.lit("")), found)


def vector_ref(path: Column) -> Column:
    """`name/embeddings/file.emb.json` of an asset's path."""
    return F.concat(F.split_part(path, F.lit("/"), F.lit(1)), F.lit("/embeddings/"), stem(path), F.lit(".emb.json"))


# File kinds by extension.
AUDIO = (".m4a", ".wav", ".mp3", ".aac", ".flac", ".ogg", ".oga", ".wma", ".aiff", ".aif", ".opus")
VIDEO = (".mp4", ".avi", ".mov", ".mkv", ".wmv", ".flv", ".webm", ".mpg", ".mpeg", ".m4v", ".3gp", ".3g2", ".ts", ".mts", ".m2ts", ".vob", ".ogv")
IMAGE = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tif", ".tiff", ".webp", ".heic", ".heif")
MIME = {".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".webp": "image/webp", ".pdf": "application/pdf"}


def source_kind(path: Column) -> Column:
    e = extension(path)
    return F.when(e.isin(*AUDIO), "audio").when(e.isin(*VIDEO), "video").when(e.isin(*IMAGE), "image")


def mime(path: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in MIME.items() for x in kv])
    return F.coalesce(table[extension(path)], F.lit("application/octet-stream"))
