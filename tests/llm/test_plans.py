"""Plans: native operators run no Python, scans read only what is used, scratch tables go."""

import re
from pathlib import Path

import pytest

from loomwork.llm import near_dedup
from loomwork.llm import queries as Q

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plans_since(spark, first):
    """Descriptions of the plans that ran, from the first one on."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()
    n = int(store.executionsCount())
    if n <= first:
        return n, []
    ran = store.executionsList(first, n - first)
    return n, [ran.apply(k).physicalPlanDescription() for k in range(ran.size())]


@pytest.mark.parametrize("name", ["op2_chat_format", "op7_source_mix", "op10_fingerprint"])
def test_native(spark, name):
    """No plan that the query runs, those of its scratch tables and counts included, starts a Python worker."""
    first = plans_since(spark, 10**9)[0]
    Q.QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()
    _, plans = plans_since(spark, first)
    assert len(plans) >= (1 if name.startswith("op2") else 4)
    assert not any(re.search("Python|Arrow|Pandas", p) for p in plans)


def test_plans_show_python(spark):
    """The check above would see a Python worker in a scratch table's plan."""
    first = plans_since(spark, 10**9)[0]
    Q.QUERIES["op4_topk"](spark, SF).write.format("noop").mode("overwrite").save()
    _, plans = plans_since(spark, first)
    assert sum("MapInArrow" in p for p in plans) >= 2


@pytest.mark.parametrize("name,columns", [("op3_byte_bpe", "doc_id:bigint,text:string"), ("op6_license_scan", "doc_id:bigint,text:string"), ("op8_language_id", "doc_id:bigint,text:string"), ("op9_html_text", "page_id:bigint,url:string,html:string")])
def test_scans_are_pruned(spark, name, columns):
    assert f"struct<{columns}>" in plan_of(Q.QUERIES[name](spark, SF))


def test_wanted_texts_only(spark):
    """The ids whose sets are wanted keep other texts out of the join: by a broadcast while they are few, else by a Bloom filter."""
    from loomwork.storage import Scratch, session_conf

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    wanted = Scratch(spark, "t").keep(docs.selectExpr("doc_id AS node", "1L AS cells")).where("cells > 0").select("node")
    op = near_dedup.NearDuplicates()
    assert "BroadcastHashJoin" in plan_of(op._payloads(docs, wanted))
    with session_conf(spark, near_dedup.BLOOM | {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(op._payloads(docs, wanted))
    assert "might_contain" in plan and "CartesianProduct" not in plan


def test_scratch_tables_go(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir").replace("file://", ""), f"loomwork-{spark.sparkContext.applicationId}")
    before = set(shared.iterdir()) if shared.exists() else set()
    df = near_dedup.NearDuplicates().apply(spark.read.parquet(f"{SF}/documents.parquet"))
    (own,) = set(shared.iterdir()) - before
    left = {p.name.split("-", 1)[1] for p in own.iterdir()}
    assert {"signatures", "classes"} <= left and not left & {"leaders", "members", "stars", "likely", "wanted", "sets", "links", "low", "large", "open", "extra"}
    assert df.count() == 200 == df.count()
