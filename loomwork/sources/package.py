"""Load packages: a plan, vectors for bulk copy, a blob manifest and counts, written side by side and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.storage import Scratch


def vector_literal(vector: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(vector, lambda v: v.cast("double").cast("string")), ","), F.lit("]"))


def write_package(out: str, plan: DataFrame, text_vectors: DataFrame, image_vectors: DataFrame, blobs: DataFrame) -> dict[str, int]:
    """plan and blobs as JSON lines, vectors (content_sha, vector) as tab-separated text, each sha once whatever datasets share it.  Returns the counts, which are written last, so a package with counts is whole."""
    spark = plan.sparkSession
    scratch = Scratch(spark, "package")
    parts = {"plan": plan, "blobs": blobs, "text_vectors": text_vectors.dropDuplicates(["content_sha"]), "image_vectors": image_vectors.dropDuplicates(["content_sha"])}
    counts = {}
    for name, frame in parts.items():
        kept = scratch.keep(frame, name)
        counts[name] = kept.count()
        if name.endswith("vectors"):
            kept.select("content_sha", vector_literal(F.col("vector")).alias("vector")).write.option("sep", "\t").option("quote", "").csv(f"{out}/{name}")
        else:
            kept.write.json(f"{out}/{name}")
    spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} bigint" for k in counts)).coalesce(1).write.json(f"{out}/counts")
    return counts
