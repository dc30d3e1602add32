"""Lanes: JSON records that may be missing or broken, JSONL plans, append-only blocks, error rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

CORRUPT = "_corrupt"


def plain_path(path: Column) -> Column:
    """One spelling of a local path: `file:/x`, which listings and metadata write with one or three slashes."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def read_records(spark: SparkSession, path: str, schema: StructType, pattern: str = "*.json") -> DataFrame:
    """One JSON record in each file, with its path; a broken file is a row with _corrupt set, never a failure."""
    full = StructType([*schema.fields]).add(CORRUPT, StringType())
    rows = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).json(path)
    return rows.select("*", plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_modification_time").alias("modified"))


def write_records(rows: DataFrame, order: list[str], path: str) -> None:
    """Writes rows as JSON lines, fields in the order of the columns, rows in the order given, files one after the other; the files appear when all are written."""
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.option("ignoreNullFields", "false").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def tolerant(expected: DataFrame, records: DataFrame, key: str = "path") -> DataFrame:
    """The expected paths with their records and a parse_status: missing, parse_error or ok."""
    joined = expected.withColumn(key, plain_path(F.col(key))).join(records, key, "left")
    status = F.when(F.col("modified").isNull(), "missing").when(F.col(CORRUPT).isNotNull(), "parse_error").otherwise("ok")
    return joined.withColumn("parse_status", status)


def gate(status: Column, upstream: dict[str, Column], done: Column, force: bool = False) -> Column:
    """What a stage does with a record: the first of no_sidecar, bad_sidecar, not_ok, a missing upstream block, skipped_done; else run."""
    out = F.when(status == "missing", "no_sidecar").when(status == "parse_error", "bad_sidecar").when(status == "error", "not_ok")
    for name, present in upstream.items():
        out = out.when(~F.coalesce(present, F.lit(False)), name)
    if not force:
        out = out.when(F.coalesce(done, F.lit(False)), "skipped_done")
    return out.otherwise("run")


def resume(current: DataFrame, recorded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys (path and digest) weren't recorded yet."""
    return current.join(recorded.select(*keys).distinct(), keys, "left_anti")


def with_block(records: DataFrame, blocks: DataFrame, key: str, name: str) -> DataFrame:
    """Adds a stage's block as one struct; earlier blocks stay as they are."""
    if name in records.columns:
        raise ValueError(f"block {name} is there already")
    rest = [c for c in blocks.columns if c != key]
    return records.join(blocks.select(key, F.struct(*rest).alias(name)), key, "left")


def error_rows(rows: DataFrame, key: str, code: str, message: Column, stage: str) -> DataFrame:
    return rows.select(key, F.lit(stage).alias("stage"), F.lit(code).alias("error_code"), F.substring(message, 1, 300).alias("error_message"))


def grouped_manifest(blobs: DataFrame) -> DataFrame:
    """Manifest rows by document."""
    rest = [c for c in blobs.columns if c not in ("case_key", "dataset_key", "document_name")]
    return blobs.groupBy("case_key", "dataset_key", "document_name").agg(F.sort_array(F.collect_list(F.struct(*rest))).alias("blobs"))


def ordered_shas(parents: Column) -> Column:
    """Content shas of all children of an array of parents, first occurrence kept, in order."""
    return F.array_distinct(F.flatten(F.transform(parents, lambda p: F.transform(p["children"], lambda c: c["content_sha"]))))


def read_image_vectors(spark: SparkSession, path: str, default_model: str = "image-vectors") -> DataFrame:
    """path, model, dim, vector of `*.emb.json` files; files that are broken or hold no vector are left out."""
    schema = StructType.fromDDL("embedding_model string, model_version string, dim int, vector array<float>")
    rows = read_records(spark, path, schema, "*.emb.json").where(F.col(CORRUPT).isNull() & (F.size("vector") > 0))
    return rows.select("path", F.coalesce("embedding_model", F.lit(default_model)).alias("model"), F.coalesce("dim", F.size("vector")).alias("dim"), "vector")


def write_image_vectors(vectors: DataFrame, path: str, model: str, version: str) -> None:
    """Appends image vectors (embedding_ref, vector) with their model, version and dimension; all of a run go to a few files instead of one for each."""
    vectors.select("embedding_ref", F.lit(model).alias("embedding_model"), F.lit(version).alias("model_version"), F.size("vector").alias("dim"), "vector").write.mode("append").parquet(path)


def occurrence_rows(rows: DataFrame) -> DataFrame:
    """Image occurrences with -1 for page, time or frame that isn't a whole number."""
    number = lambda c: F.coalesce(F.col(c).cast("string").try_cast("int"), F.lit(-1)).alias(c)
    numbers = ("page_number", "timestamp_ms", "frame_index")
    return rows.select(*(number(c) if c in numbers else F.col(c) for c in rows.columns))


def escalated(pages: DataFrame, assets: DataFrame) -> DataFrame:
    """New page assets for pages of low quality text that aren't assets yet; running it again adds nothing."""
    low = pages.where(F.array_contains("flags", "low_quality_text")).select("doc_id", "page_number")
    have = assets.where("kind = 'page'").select("doc_id", "page_number")
    return low.join(have, ["doc_id", "page_number"], "left_anti").select("doc_id", F.lit("page").alias("kind"), "page_number", F.lit("low_quality_text").alias("route_reason"))


def escalation_manifest(documents: DataFrame, escalations: DataFrame) -> DataFrame:
    """Documents that were scanned, documents and pages escalated, in one row."""
    by = escalations.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    rows = documents.join(by, "doc_id", "left")
    return rows.agg(F.count(F.lit(1)).alias("documents_scanned"), F.count("_n").alias("documents_escalated"), F.coalesce(F.sum("_n"), F.lit(0)).alias("pages_escalated"))


def with_chunks(plans: DataFrame, chunks: DataFrame, key: str, kind: str) -> DataFrame:
    """Plans with their chunks (an empty list without any) and the path of these: the plan's own, else that derived from the document's name."""
    derived = F.concat(F.regexp_replace("document", r"\.[^.]*$", ""), F.lit(".chunks.json"))
    rows = plans.join(chunks.select(key, "chunks"), key, "left")
    return rows.withColumn("chunks", F.coalesce("chunks", F.array().cast(kind))).withColumn("chunks_path", F.coalesce("chunks_path", derived))


def stale(blocks: DataFrame, versions: DataFrame, key: str) -> DataFrame:
    """Keys whose block was made with other upstream versions than those given (stage, version)."""
    return blocks.join(versions.withColumnRenamed("version", "_now"), "stage").where(~F.col("version").eqNullSafe(F.col("_now"))).select(key, "stage", "version")
