"""Finding files: recursive listings as DataFrames of metadata, with pruning, kinds and precedence as relational steps.

The listing reads no content: only path, time and length are selected from the binary source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.functions import ids
from loomwork.storage import Scratch

PDF = "*.[pP][dD][fF]"
# Directories that never hold source documents.
PRUNED = ("images", "pages", "artifacts", ".embeddings")
PRUNED_MEDIA = ("images", "corrupted", "data", "db-extract", "empty", "missing-natives", "review")


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, modified, length of all files below a root."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return found.select("path", F.col("modificationTime").alias("modified"), "length")


def ancestors(path: Column) -> Column:
    """All directories above a path, the nearest last."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def below(root: str, path: Column) -> Column:
    return F.substr(path, F.length(F.lit(root.rstrip("/"))) + 2)


def pruned(files: DataFrame, root: str, names: tuple[str, ...] = PRUNED) -> DataFrame:
    """Files not below a directory of a pruned name, nor below `x/` where `x.pdf` stands beside it."""
    clean = files.withColumn("_dirs", F.filter(ancestors(F.col("path")), lambda d: F.length(d) > len(root.rstrip("/"))))
    named = F.exists("_dirs", lambda d: F.lower(F.element_at(F.split(d, "/"), -1)).isin(*names))
    clean = clean.where(~named)
    stems = files.where(F.lower("path").endswith(".pdf")).select(F.regexp_replace("path", r"\.[pP][dD][fF]$", "").alias("_stem"))
    inside = clean.select("path", F.explode("_dirs").alias("_stem")).join(stems, "_stem", "left_semi").select("path").distinct()
    return clean.join(inside, "path", "left_anti").drop("_dirs")


def pdfs(spark: SparkSession, root: str, prune: bool = True) -> DataFrame:
    found = listing(spark, root, PDF)
    return pruned(found, root) if prune else found


def media(spark: SparkSession, root: str) -> DataFrame:
    """Audio, video and image files with their kind; outputs in `*.media` directories are left out."""
    return media_of(listing(spark, root), root)


def media_of(files: DataFrame, root: str) -> DataFrame:
    """The media files of a listing with their kind."""
    found = pruned(files, root, PRUNED_MEDIA).withColumn("kind", ids.source_kind(F.col("path")))
    return found.where(F.col("kind").isNotNull() & ~F.exists(ancestors(F.col("path")), lambda d: F.lower(d).endswith(".media")))


def datasets(files: DataFrame) -> DataFrame:
    """dataset and its number of files; files outside any dataset directory count under null."""
    return files.groupBy(ids.dataset_key(F.col("path")).alias("dataset")).agg(F.count(F.lit(1)).alias("n_files"))


def image_dirs(files: DataFrame, root: str) -> DataFrame:
    """Directories of page images: `IMAGES` at the root wins outright, else every `VOL*/IMAGES`."""
    rel = below(root, F.col("path"))
    place = F.when(rel.rlike(r"^IMAGES/"), F.struct(F.lit(0).alias("rank"), F.lit("IMAGES").alias("dir"))).when(rel.rlike(r"^VOL[^/]*/IMAGES/"), F.struct(F.lit(1).alias("rank"), F.regexp_extract(rel, r"^(VOL[^/]*/IMAGES)/", 1).alias("dir")))
    dirs = files.select(place.alias("p")).where("p IS NOT NULL").select("p.*").distinct()
    return dirs.withColumn("_best", F.min("rank").over(W.partitionBy(F.lit(1)))).where("rank = _best").select("dir")


def in_pipeline(path: Column) -> Column:
    return F.exists(F.split(path, "/"), lambda p: F.lower(p) == "images")


def sidecars(files: DataFrame, suffix: str = ".json") -> DataFrame:
    """Each PDF with its sidecar's path, whether it is there, its time and length."""
    docs = files.where(F.lower("path").endswith(".pdf")).select(F.col("path").alias("pdf"), F.concat(F.regexp_replace("path", r"\.[^.]*$", ""), F.lit(suffix)).alias("sidecar"))
    there = files.select(F.col("path").alias("sidecar"), F.col("modified").alias("sidecar_modified"), F.col("length").alias("sidecar_length"))
    return docs.join(there, "sidecar", "left").select("pdf", "sidecar", F.col("sidecar_length").isNotNull().alias("exists"), "sidecar_modified", "sidecar_length", in_pipeline(F.col("pdf")).alias("in_pipeline"))


def first_existing(spark: SparkSession, candidates: list[str]) -> str | None:
    """The first of the candidate folders that exists: explicit store, dataset, its image directories, corpus root, in the caller's order."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for c in candidates:
        p = jvm.org.apache.hadoop.fs.Path(c)
        if p.getFileSystem(conf).exists(p):
            return c
    return None


def store_candidates(dataset_root: str, image_folders: list[str], explicit: str | None = None, corpus_root: str | None = None) -> list[str]:
    at = [explicit] if explicit else []
    at += [f"{dataset_root}/.embeddings", *(f"{dataset_root}/{d}/.embeddings" for d in image_folders)]
    return at + ([f"{corpus_root}/.embeddings"] if corpus_root else [])


def purge_plan(files: DataFrame, folder: str = "pages") -> DataFrame:
    """What a purge of page renders would delete, by directory: files and bytes.  Nothing is deleted."""
    inside = files.where(F.exists(F.split("path", "/"), lambda p: p == folder))
    return inside.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("directory")).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))


def purge(files: DataFrame, folder: str = "pages", delete: bool = False) -> DataFrame:
    """The purge plan with whether each directory was deleted.  Only with delete=True is anything deleted: the directories of that name, whole, one after the other from the driver; run again, it deletes what is left."""
    plan = purge_plan(files, folder)
    if not delete:
        return plan.withColumn("deleted", F.lit(False))
    spark = files.sparkSession
    plan = Scratch(spark, "purge").keep(plan, "plan")
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for row in plan.select("directory").where(F.element_at(F.split("directory", "/"), -1) == folder).toLocalIterator():
        p = path(row["directory"])
        p.getFileSystem(conf).delete(p, True)
    return plan.withColumn("deleted", F.element_at(F.split("directory", "/"), -1) == folder)
