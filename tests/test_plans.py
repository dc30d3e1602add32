"""Plans: no text below a join's exchange, filters and columns reach the scan, aggregates are combined before the shuffle."""

import re

import pytest

from loomwork.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["truncate_flag", "needs_vision_routing", "safety_verdict_ladder", "doc_safety_rollup", "blob_action_plan", "collector_digest_wide", "dataset_corpus_rollup", "plan_aggregation_status_histogram", "metadata_bag", "resume_anti_join", "store_membership", "ingest_page_rows", "ingest_blobs", "ingest_plan", "vision_run", "summaries_run", "fusion_interleave", "blob_manifest_by_document"]
)
def test_no_text_is_shuffled_for_a_join(shuffled, name):
    lines = plan_of(catalogue.QUERIES[name](shuffled, SF)).split("\n")
    for at, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = next(x for x in lines[at + 1 :] if "Project [" in x or "Aggregate" in x or "Scan" in x)
            made = re.search(r"(?:Project|output=) ?\[(.*?)\](?:,|$)", below)
            assert not made or not re.search(r"(^|, )(text|content)#\d+", made[1]), (name, below[:200])


def test_chunks_are_numbered_without_a_shuffle(spark):
    """One exchange at most, which deals a single-split input out before the packing; no window, no sort."""
    plan = plan_of(catalogue.QUERIES["parent_child_chunks"](spark, SF))
    assert plan.count("Exchange") <= 1 and not re.search("Window|Sort|Join", plan) and plan.count("MapInArrow") == 1


def test_scans_are_pruned(spark):
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan_of(catalogue.QUERIES["resume_anti_join"](spark, SF))
    assert "content_sha" not in plan_of(catalogue.QUERIES["vector_shard_histogram"](spark, SF)).split("FileScan")[1]
    assert "PushedFilters: [IsNotNull(n_nationkey), LessThan(n_nationkey,20)]" in plan_of(catalogue.QUERIES["insert_if_absent"](spark, SF))


@pytest.mark.parametrize("name", ["quality_gate_by_lang", "usage_accumulator", "dedup_ratio_by_source", "finding_rollup_max"])
def test_aggregates_are_combined_first(spark, name):
    assert "partial_" in plan_of(catalogue.QUERIES[name](spark, SF))
