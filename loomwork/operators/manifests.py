"""What a stage says of its run: totals of a document from its final state, counts of what was done, tokens and cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.functions import cost as C

ACTIONS = ("no_sidecar", "skipped_status", "skipped_done", "errored", "done")


def summaries_final(pages: DataFrame, reduces: DataFrame) -> DataFrame:
    """A document's totals from the final state of its pages and its reduce call, whatever this run did.

    pages: doc_id, page_number, status (ok, filtered, error; null: not applicable), truncated, input_tokens,
    output_tokens; reduces: doc_id, calls, prompt, completion.  Cost in whole nano-dollars.
    """
    tokens = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    by = pages.groupBy("doc_id").agg(
        F.count_if(F.col("status") == "ok").alias("summarized"), F.count_if(F.col("status") == "filtered").alias("filtered"), F.count_if(F.col("status") == "error").alias("failed"), F.count_if("truncated").alias("truncated"),
        tokens("input_tokens").alias("page_prompt"), tokens("output_tokens").alias("page_completion"),
    )
    none = lambda c: F.coalesce(c, F.lit(0))
    rows = by.join(reduces, "doc_id", "left")
    prompt, completion = F.col("page_prompt") + none("prompt"), F.col("page_completion") + none("completion")
    return rows.select(
        "doc_id", "summarized", "filtered", "failed", "truncated", (F.col("summarized") + none("calls")).alias("calls"), prompt.alias("prompt_tokens"), completion.alias("completion_tokens"),
        C.usage_cost_nano(prompt, completion, F.lit(0)).alias("cost_nano"),
    )


def vision_final(assets: DataFrame) -> DataFrame:
    """A document's counts from the final state of its assets, and the usage of this run beside them.

    assets: doc_id, kind, source (pregate, vision; null: not judged), has_visual_content, safety, embedding_ref,
    embedding_error, prompt and completion (null where this run made no call).
    """
    c = F.col
    return assets.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("assets"), F.count_if(c("source") == "pregate").alias("pregated"), F.count_if(c("source") == "vision").alias("judged"), F.count_if("has_visual_content").alias("visual"),
        F.count_if("safety.minor_indicator").alias("minor"), F.count_if("safety.explicit").alias("explicit"), F.count_if(c("safety.flag") == "review").alias("review"), F.count_if(c("embedding_ref").isNotNull()).alias("embedded"),
        F.count_if(c("embedding_error").isNotNull()).alias("embedding_errors"), F.count("prompt").alias("run_calls"), F.coalesce(F.sum("prompt"), F.lit(0)).alias("run_prompt"), F.coalesce(F.sum("completion"), F.lit(0)).alias("run_completion"),
    )


def run_manifest(documents: DataFrame, sums: list[str], actions: tuple[str, ...] = ACTIONS) -> DataFrame:
    """One row for a run: documents seen, by action, and sums over those that were done.  documents: action and the columns to sum."""
    done = F.col("action") == "done"
    return documents.agg(F.count(F.lit(1)).alias("seen"), *(F.count_if(F.col("action") == a).alias(a) for a in actions), *(F.coalesce(F.sum(F.when(done, F.col(s))), F.lit(0)).cast("bigint").alias(s) for s in sums))


def run_errors(documents: DataFrame, key: str) -> DataFrame:
    """What went wrong, in order of the documents: a lane of its own, so that a manifest stays one row."""
    return documents.where("action = 'errored'").select(key, "error_code").orderBy(key)


def errored_totals(manifests: DataFrame, stages: list[str]) -> DataFrame:
    """stage, errored: zero for a stage without a manifest.  manifests: stage, errored."""
    spark = manifests.sparkSession
    wanted = spark.createDataFrame([(s,) for s in stages], "stage string")
    by = manifests.groupBy("stage").agg(F.sum("errored").alias("errored"))
    return wanted.join(by, "stage", "left").select("stage", F.coalesce("errored", F.lit(0)).alias("errored"))


def heartbeat(progress: DataFrame) -> DataFrame:
    """Rate and remaining seconds from rows of key, done, total, elapsed_s; null where nothing is done yet."""
    rate = F.when((F.col("done") > 0) & (F.col("elapsed_s") > 0), F.col("done") / F.col("elapsed_s"))
    return progress.withColumn("rate", rate).withColumn("eta_s", F.greatest(F.col("total") - F.col("done"), F.lit(0)) / F.col("rate"))
