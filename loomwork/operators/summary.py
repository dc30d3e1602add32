"""Corpus summaries from a wide digest: one row for each document, flags s2 to s6 telling which stage blocks it has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.operators.rollup import dataset_and_corpus, progress
from loomwork.operators.routing import stage_state

DIGEST = (
    "dataset string, rel string, status string, page_count int, has_image_assets boolean, s2 boolean, s3 boolean, s4 boolean, s5 boolean, s6 boolean, s6_empty boolean, s6_children int, "
    "child_total bigint, child_embedded bigint, s8_done boolean, has_visual int, embedded_ref int, embed_errors int, cost_nano bigint"
)


def stage_grid(digest: DataFrame, stores: DataFrame) -> DataFrame:
    """dataset (null: corpus), stage, applicable, done, state, permille for stages 1 to 8, from one pass over the digest.

    Stages 2, 3, 5 apply to every sound document, 4 to those with image assets, 6 to those with pages, 7 to those
    with children, 8 to every sound one.  stores (dataset, store_present, store_aware): without a store stage 7
    has not started; with one that wasn't compared child by child its state is unknown.  Stage 8 is unknown until
    a check has found something done.
    """
    ok = F.col("status") == "ok"
    children = F.coalesce(F.col("s6") & ~F.coalesce("s6_empty", F.lit(False)) & (F.col("s6_children") > 0), F.lit(False))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    embedded = (F.col("child_total") > 0) & (F.col("child_embedded") >= F.col("child_total"))
    stages = {
        "stage1": (F.lit(True), F.col("status").isin("ok", "error")), "stage2": (ok, yes("s2")), "stage3": (ok, yes("s3")), "stage4": (ok & yes("has_image_assets"), yes("s4")), "stage5": (ok, yes("s5")),
        "stage6": (ok & (F.coalesce("page_count", F.lit(0)) > 0), yes("s6")), "stage7": (ok & children, F.coalesce(embedded, F.lit(False))), "stage8": (ok, yes("s8_done")),
    }
    counts = dataset_and_corpus(digest, "dataset", [c for s, (a, d) in stages.items() for c in (F.count_if(a).alias(f"{s}_a"), F.count_if(a & d).alias(f"{s}_d"))])
    rows = counts.select("dataset", F.explode(F.array(*(F.struct(F.lit(s).alias("stage"), F.col(f"{s}_a").alias("applicable"), F.col(f"{s}_d").alias("done")) for s in stages))).alias("g")).select("dataset", "g.*")
    both = stores.unionByName(stores.agg(F.lit(None).cast("string").alias("dataset"), F.bool_or("store_present").alias("store_present"), F.bool_and(F.col("store_aware") | ~F.col("store_present")).alias("store_aware")))
    rows = rows.join(both.withColumnRenamed("dataset", "_set"), F.col("dataset").eqNullSafe(F.col("_set")), "left")
    present, aware = yes("store_present"), yes("store_aware")
    plain, share = stage_state(F.col("applicable"), F.col("done")), progress(F.col("applicable"), F.col("done"))
    no_store = F.when(F.col("applicable") > 0, "not_started").otherwise("n/a")
    is7, unknown8 = F.col("stage") == "stage7", (F.col("stage") == "stage8") & (F.col("done") == 0)
    state = F.when(is7 & ~present, no_store).when(is7 & ~aware, "n/a").when(unknown8, "n/a").otherwise(plain)
    known = F.when((is7 & present & ~aware) | unknown8, None).otherwise(share)
    return rows.select("dataset", "stage", "applicable", "done", state.alias("state"), known.alias("permille"))


def vision_coverage(digest: DataFrame) -> DataFrame:
    """dataset (null: corpus), has_visual, embedded, not_embedded, embed_errors, docs_with_gap, permille: assets worth seeing and those with a vector."""
    rows = digest.where(F.coalesce("s4", F.lit(False))).select("dataset", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("has_visual", "embedded_ref", "embed_errors")))
    gap = F.greatest(F.col("has_visual") - F.col("embedded_ref"), F.lit(0))
    by = dataset_and_corpus(rows, "dataset", [
        F.sum("has_visual").alias("has_visual"), F.sum("embedded_ref").alias("embedded"), F.sum(gap).alias("not_embedded"), F.sum("embed_errors").alias("embed_errors"),
        F.count_if((gap > 0) | (F.col("embed_errors") > 0)).alias("docs_with_gap"),
    ])
    return by.withColumn("permille", progress(F.col("has_visual"), F.col("embedded")))


def warnings(coverage: DataFrame) -> DataFrame:
    """One line for each dataset with assets that lack a vector."""
    rows = coverage.where("dataset IS NOT NULL AND docs_with_gap > 0")
    return rows.select("dataset", F.format_string("%s: %d documents are missing vision embeddings (%d assets, %d errors); run stage 4 again", "dataset", "docs_with_gap", "not_embedded", "embed_errors").alias("warning"))
