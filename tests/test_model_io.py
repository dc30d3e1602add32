"""Requests, answers, image vectors, escalation, the vision chain."""

import json

import pytest
from pyspark.sql import functions as F

from loomwork.functions import model_io as IO
from loomwork.functions import parse
from loomwork.operators import models as M
from loomwork.sources import lanes as L
from tests.test_functions import one


def test_requests():
    assert IO.is_reasoning("gpt-5-mini") and IO.is_reasoning("x", "my-o3") and not IO.is_reasoning("gpt-4.1") and IO.is_reasoning("gpt-4.1", style="reasoning")
    assert "temperature" not in IO.chat_request("s", "u", {}, 9, reasoning=True) and IO.chat_request("s", "u", {}, 9)["max_tokens"] == 9


def test_answers(spark):
    body = json.dumps({"usage": {"prompt_tokens": 10, "completion_tokens": 3, "prompt_tokens_details": {"cached_tokens": 50}}})
    assert tuple(one(spark, IO.usage(F.col("b")), b=body)) == (10, 3, 10) and tuple(one(spark, IO.usage(F.col("b")), b="{}")) == (0, 0, 0)
    body = json.dumps({"data": [{"index": 1, "embedding": [3, 4]}, {"index": 0, "embedding": [1, 2]}]})
    assert one(spark, IO.vectors_in_order(F.col("b"), 2), b=body) == [[1.0, 2.0], [3.0, 4.0]]
    with pytest.raises(Exception, match="wrong dimensions"):
        one(spark, IO.vectors_in_order(F.col("b"), 3), b=body)
    assert one(spark, IO.transcript_text(F.col("b")), b='{"text": " hi "}') == "hi" and one(spark, IO.transcript_text(F.col("b")), b=" raw ") == "raw"
    parts = F.array(*(F.struct(F.lit(a).alias("type"), F.lit(b).alias("text")) for a, b in (("text", "x" * 40), ("image_url", None))))
    assert one(spark, IO.vision_tokens(parts, F.lit(1100), 5), b="") == 1115


def test_first_object():
    assert parse.first_object('a {"b": [1, {"c": "}"}]} d') == '{"b": [1, {"c": "}"}]}'
    assert parse.first_object('{bad} then {"x": 1}') == '{"x": 1}' and parse.first_object(None) is None and parse.first_object("{") is None


def test_image_vectors_and_occurrences(spark, tmp_path):
    for name, text in (("a.emb.json", '{"embedding_model": "m", "dim": 2, "vector": [1, 2]}'), ("b.emb.json", '{"vector": []}'), ("c.emb.json", "{"), ("d.json", '{"vector": [1]}')):
        (tmp_path / name).write_text(text)
    assert [(r["model"], r["dim"], list(r["vector"])) for r in L.read_image_vectors(spark, str(tmp_path)).collect()] == [("m", 2, [1.0, 2.0])]
    rows = spark.createDataFrame([("h", "3", None, "x")], "content_hash string, page_number string, timestamp_ms string, frame_index string")
    assert tuple(L.occurrence_rows(rows).first()) == ("h", 3, -1, -1)


def test_escalation_is_idempotent(spark):
    pages = spark.createDataFrame([("d", 1, ["low_quality_text"]), ("d", 2, []), ("d", 3, ["low_quality_text"])], "doc_id string, page_number int, flags array<string>")
    assets = spark.createDataFrame([("d", "page", 3)], "doc_id string, kind string, page_number int")
    new = L.escalated(pages, assets)
    assert [tuple(r) for r in new.collect()] == [("d", "page", 1, "low_quality_text")]
    assert L.escalated(pages, assets.unionByName(new.select("doc_id", "kind", "page_number"))).count() == 0


def test_stale_blocks(spark):
    blocks = spark.createDataFrame([("a", "stage3", "1"), ("b", "stage3", "2"), ("c", "stage3", None)], "doc string, stage string, version string")
    now = spark.createDataFrame([("stage3", "2")], "stage string, version string")
    assert sorted(r["doc"] for r in L.stale(blocks, now, "doc").collect()) == ["a", "c"]


def test_vision_chain(spark):
    rows = [(1, 0.001, "never sent"), (2, 0.999, "never sent"), (3, 0.5, "a photo"), (4, None, "please refuse"), (5, 0.5, " ")]
    got = {r["k"]: r for r in M.vision_chain(spark.createDataFrame(rows, "k int, dark_coverage double, caption_input string"), ["k"], M.KeywordVerdict, lambda: M.HashEmbedding(4)).collect()}
    assert {k: (r["content_class"], r["source"], r["status"], r["vector"] is not None) for k, r in got.items()} == {
        1: ("blank", "pregate", "ok", False), 2: ("black_or_redacted", "pregate", "ok", False), 3: ("photo", "vision", "ok", True), 4: (None, "vision", "filtered", False), 5: ("blank", "vision", "ok", False),
    }
