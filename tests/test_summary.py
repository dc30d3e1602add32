"""Progress grid, vision coverage, tenancy and the chunk gate on hand-checked fixtures."""

import pytest
from pyspark.sql import functions as F

from loomwork.operators import summary as S
from loomwork.operators import tenancy as T
from loomwork.operators.chunk import chunk_documents


def doc(dataset, rel, status="ok", pages=2, assets=False, s="", children=0, embedded=0, visual=0, ref=0, errors=0):
    return (dataset, rel, status, pages, assets, *(str(k) in s for k in (2, 3, 4, 5, 6)), False, children, children, embedded, None, visual, ref, errors, 0)


@pytest.fixture(scope="module")
def digest(spark):
    rows = [
        doc("A", "text_done", s="2356", children=2, embedded=2), doc("A", "text_mid", s="2"), doc("A", "vision_done", assets=True, s="23456", children=2, embedded=1, visual=1, ref=1),
        doc("A", "vision_gap", assets=True, s="23456", children=2, embedded=2, visual=2, ref=1, errors=1), doc("A", "quarantined", s="23"), doc("A", "encrypted", status="error", pages=0), doc("A", "gone", status="missing", pages=0),
        doc("A", "corrupt", status="parse_error", pages=0), doc("B", "flat_done", s="2356", children=2, embedded=2),
    ]
    return spark.createDataFrame(rows, S.DIGEST)


def test_progress_grid(spark, digest):
    stores = lambda present, aware: spark.createDataFrame([("A", present, aware), ("B", present, aware)], "dataset string, store_present boolean, store_aware boolean")
    grid = {(r["dataset"], r["stage"]): (r["applicable"], r["done"], r["state"], r["permille"]) for r in S.stage_grid(digest, stores(True, True)).collect()}
    assert grid[("A", "stage3")] == (5, 4, "in_progress", 800) and grid[("A", "stage4")] == (2, 2, "done", 1000)
    assert grid[("A", "stage5")][1] == 3 and grid[("A", "stage6")][:2] == (5, 3) and grid[("A", "stage7")] == (3, 2, "in_progress", 667)
    assert grid[("A", "stage1")][:2] == (8, 6) and grid[("B", "stage4")] == (0, 0, "n/a", None) and grid[("B", "stage7")][2] == "done"
    assert grid[(None, "stage7")][:2] == (4, 3) and grid[("A", "stage8")] == (5, 0, "n/a", None)
    none = {(r["dataset"], r["stage"]): (r["state"], r["permille"]) for r in S.stage_grid(digest, stores(False, False)).collect()}
    assert none[("A", "stage7")][0] == "not_started"
    unknown = {(r["dataset"], r["stage"]): (r["state"], r["permille"]) for r in S.stage_grid(digest, stores(True, False)).collect()}
    assert unknown[("A", "stage7")] == ("n/a", None)


def test_vision_coverage(digest):
    got = {r["dataset"]: (r["has_visual"], r["embedded"], r["not_embedded"], r["embed_errors"], r["docs_with_gap"], r["permille"]) for r in S.vision_coverage(digest).collect()}
    assert got == {"A": (3, 2, 1, 1, 1, 667), None: (3, 2, 1, 1, 1, 667)}
    assert "missing vision embeddings" in S.warnings(S.vision_coverage(digest)).first()["warning"]


def test_tenancy(spark):
    cases = spark.createDataFrame([("c1", "id1")], "case_key string, case_id string")
    sets = spark.createDataFrame([("id1", "s1", "ds1")], "case_id string, dataset_key string, dataset_id string")
    docs = spark.createDataFrame([("a", "c1", "s1"), ("b", "c1", "s2"), ("c", "c2", "s1")], "doc_id string, case_key string, dataset_key string")
    assert {(r["case_key"], r["dataset_key"]): r["found"] for r in T.preflight(docs, cases, sets).collect()} == {("c1", "s1"): True, ("c1", "s2"): False, ("c2", "s1"): False}
    with pytest.raises(T.TenancyError, match="c1/s2, c2/s1"):
        T.resolve(docs, cases, sets)
    more, ds = T.ensured(docs, cases, sets, "t")
    again = T.ensured(docs, more, ds, "t")
    assert (more.count(), ds.count()) == (2, 3) == (again[0].count(), again[1].count())
    got = {r["doc_id"]: (r["case_id"], r["dataset_id"]) for r in T.resolve(docs, more, ds).collect()}
    assert got["a"] == ("id1", "ds1") and got["b"][0] == "id1" and len({x for x in got.values()}) == 3


def test_chunk_gate(spark):
    docs = spark.createDataFrame(
        [("two_text", "ok", 2, None, "two_text", "V", "D"), ("mixed_skip", "ok", 2, None, "mixed_skip", "V", "D"), ("empty_doc", "ok", 1, None, "empty_doc", "V", "D"), ("not_ok", "error", 0, None, "not_ok", "V", "D"), ("no_ids", "ok", 1, None, "no_ids", None, "D"), ("done", "ok", 1, True, "done", "V", "D")],
        "doc_id string, status string, n_pages int, chunked boolean, document_name string, case_key string, dataset_key string",
    )
    pages = spark.createDataFrame([("two_text", 1, "Alpha bravo. Charlie delta."), ("two_text", 2, "Echo. Foxtrot."), ("mixed_skip", 1, "Golf hotel."), ("mixed_skip", 2, " \n  "), ("empty_doc", 1, ""), ("no_ids", 1, "x."), ("done", 1, "y.")], "doc_id string, page_number int, content string")
    children, results = chunk_documents(docs, pages)
    got = {r["doc_id"]: (r["action"], r["parents"], r["children"], r["skipped_pages"], r["empty"]) for r in results.collect()}
    assert got == {"two_text": ("chunked", 2, 2, 0, False), "mixed_skip": ("chunked", 1, 1, 1, False), "empty_doc": ("chunked", 0, 0, 1, True), "not_ok": ("skipped_status", 0, 0, 0, False), "no_ids": ("error", 0, 0, 0, False), "done": ("skipped_done", 0, 0, 0, False)}
    row = children.where((F.col("document_name") == "two_text") & (F.col("page_number") == 1)).first()
    assert row["text"] == "Alpha bravo. Charlie delta." and row["context_prefix"].startswith("[Context: This excerpt is from two_text, V/D.") and len(row["content_sha"]) == 64
