"""Ingest records, media lane, answers of models, batch jobs, page geometry on literal fixtures."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomwork.functions import media as FM
from loomwork.operators import geometry as G
from loomwork.operators import ingest as I
from loomwork.operators import media as MM
from loomwork.operators import models as M
from tests.test_functions import one

CLEAN = ("ok", [], False, False)
A = "a" * 64


def asset(doc, page, index=None, safety=CLEAN, severities=(), visual=True, ref=None, kind="page", filtered=False, error=None, sha=A):
    return (doc, kind, page, index, f"{doc}/{kind}{page}.png", sha, visual, ref, safety, list(severities), filtered, error)


@pytest.fixture(scope="module")
def lanes(spark):
    docs = spark.createDataFrame(
        [("d1", "ok", "d1", "c", "s"), ("d2", "ok", "d2", "c", "s"), ("d3", "ok", "d3", "c", "s"), ("d4", "ok", "d4", "c", "s"), ("d5", "error", "d5", "c", "s"), ("d6", None, "d6", "c", "s"), ("d7", "ok", None, "c", "s")],
        "doc_id string, status string, document_name string, case_key string, dataset_key string",
    )
    assets = spark.createDataFrame(
        [
            asset("d1", 1, ref="v1"), asset("d1", 2, 0, kind="artifact", ref="v2"),
            asset("d2", 1, safety=("review", [], False, True)), asset("d2", 2, severities=[("Violence", "5")]), asset("d2", 3, safety=("review", ["hate"], False, False)),
            asset("d2", 4, filtered=True), asset("d2", 5, safety=None), asset("d2", 6, error="timeout"), asset("d2", 7, safety=("review", [], False, False), visual=False),
            asset("d3", 1, safety=("review", [], True, False)),
        ],
        I.ASSET,
    )
    pages = spark.createDataFrame(
        [("d1", 1, "full_page_visual", "image", "text", None, "s1", "ok", False), ("d1", 2, "x", "blank", "", None, None, "ok", False), ("d2", 1, "x", "image", " ", False, None, "review", False), ("d2", 2, "x", "image", " ", None, None, "ok", True), ("d4", 1, "x", "blank", "t", True, None, "ok", False)],
        "doc_id string, page_number int, page_class string, page_kind string, content string, has_visual_content boolean, summary string, flag string, content_filtered boolean",
    )
    judged = I.asset_verdicts(assets)
    return I.document_status(docs, judged), pages, judged


def test_ingest_plan(spark, lanes):
    docs, pages, judged = lanes
    children = spark.createDataFrame([("d1", 0, "c1"), ("d1", 1, "c2"), ("d1", 2, "c2"), ("d4", 0, "c3")], "doc_id string, place int, content_sha string")
    store = spark.createDataFrame([("c1",), ("c3",)], "content_sha string")
    vectors = spark.createDataFrame([("v1", [1.0]), ("v2", [2.0])], "embedding_ref string, vector array<float>")
    got = {r["doc_id"]: tuple(r)[1:] for r in I.plan(docs, pages, judged, children, store, vectors).collect()}
    assert got == {
        "d1": ("ready", 0, 2, 1, 2, 1), "d2": ("ready", 6, 0, 1, 0, 0), "d3": ("skip_csam", 1, 0, 0, 0, 0), "d4": ("ready", 0, 0, 1, 1, 0),
        "d5": ("skip_status", 0, 0, 0, 0, 0), "d6": ("no_sidecar", 0, 0, 0, 0, 0), "d7": ("error", 0, 0, 0, 0, 0),
    }
    assert json.loads(I.plan_json(I.plan(docs, pages, judged, children, store, vectors).where("doc_id = 'd1'")).first()["value"])["n_missing"] == 1
    assert {r["doc_id"] for r in I.ready_only(pages.select("doc_id").distinct(), docs).collect()} == {"d1", "d2", "d4"}


def test_ingest_tables(lanes):
    docs, pages, judged = lanes
    reasons = {r["page_number"]: r["r"] for r in judged.where("doc_id = 'd2'").select("page_number", F.col("v.reasons").alias("r")).collect()}
    assert reasons == {1: ["explicit"], 2: ["category:violence", "cs:violence=5"], 3: ["category:hate"], 4: ["content_filter"], 5: ["unvetted_verdict"], 6: ["unvetted_verdict"], 7: []}
    status = {(r["doc_id"], r["page_number"]): (r["review_status"], r["ocr_text"]) for r in I.page_rows(pages, judged).collect()}
    assert status[("d1", 1)] == ("none", "text") and status[("d1", 2)] == ("none", None) and status[("d2", 1)][0] == status[("d2", 2)][0] == "withheld"
    found = {(r["doc_id"], r["modality"], r["locator"]): (r["violence"], r["csam_suspected"]) for r in I.findings(pages, judged).collect()}
    assert found == {("d2", "page_text", "page:1"): (0, False), ("d2", "page_text", "page:2"): (0, False), ("d2", "page_image", "page:1"): (0, False), ("d2", "page_image", "page:2"): (5, False), ("d3", "page_image", "page:1"): (0, True)}
    actions = {}
    for r in I.blobs(docs.where("load_status = 'ready'"), pages, I.ready_only(judged, docs)).collect():
        actions.setdefault((r["doc_id"], r["action"]), []).append(r["artifact"])
    assert len(actions[("d2", "placeholder_redacted")]) == 6 and actions[("d1", "placeholder_blank")] == ["ocr/page-2.png"] and "source.pdf" in actions[("d4", "upload")]
    assert len(actions[("d1", "upload")]) == 3


def test_asset_context(spark):
    pages = spark.createDataFrame([("d", 2, ["k2"], [("n", "person")], ["b", "a", ""]), ("d", 1, ["k1"], None, ["b"]), ("e", 1, None, None, None)], "doc_id string, page_number int, key_points array<string>, entities array<struct<name:string,type:string>>, topics array<string>")
    finals = spark.createDataFrame([("d", "text", "fused", False), ("e", "sentinel", "no_content", True)], "doc_id string, text string, source string, no_content boolean")
    got = I.asset_context(pages, finals).collect()
    assert [(r["doc_id"], r["summary_text"], r["key_points"], r["topics"]) for r in got] == [("d", "text", ["k1", "k2"], ["a", "b"])]


def test_probe_metadata(spark):
    probe = json.dumps({"format": {"bit_rate": "128000", "format_name": "mov"}, "streams": [{"codec_type": "video", "codec_name": "h264", "width": 640, "height": 480, "avg_frame_rate": "0/0", "r_frame_rate": "30000/1001", "duration": "12.5"}, {"codec_type": "audio", "codec_name": "aac", "channels": "x"}]})
    m = one(spark, FM.typed_metadata(F.col("p")), p=probe)
    assert (m["duration_seconds"], m["bitrate"], m["frame_rate"], m["video_width"], m["audio_channels"], m["has_audio"], m["has_video"]) == (12.5, 128000, 29.97, 640, None, True, True)
    m = one(spark, FM.typed_metadata(F.col("p")), p="{}")
    assert m["duration_seconds"] is None and m["has_audio"] is False


def test_tool_logs(spark):
    log = "x pts_time:3.5 y pts_time:1 pts_time:3.5"
    assert one(spark, FM.scene_times(F.col("t")), t=log) == [1.0, 3.5]
    log = "silence_start: -0.01\nsilence_end: 4.5 | d\nsilence_start: 9"
    assert [tuple(x) for x in one(spark, FM.silent_intervals(F.col("t")), t=log)] == [(0.0, 4.5), (9.0, None)]
    assert one(spark, FM.keyframe_times(F.array().cast("array<double>"), F.lit(100.0)), t="") == [25.0, 75.0]
    assert one(spark, FM.keyframe_times(F.array(F.lit(40.0)), F.lit(100.0)), t="") == [25.0, 40.0, 75.0]
    assert one(spark, FM.evenly(F.sequence(F.lit(0), F.lit(9)), 3), t="") == [0, 3, 6]


def test_png_size(spark):
    head = bytes.fromhex("89504e470d0a1a0a0000000d49484452") + (640).to_bytes(4, "big") + (480).to_bytes(4, "big")
    rows = spark.createDataFrame([(bytearray(head),), (bytearray(b"GIF89a"),)], "c binary").select(FM.png_size(F.col("c")).alias("s")).collect()
    assert tuple(rows[0]["s"]) == (640, 480) and rows[1]["s"] is None


def test_answers_are_brought_within_bounds(spark):
    a = {"summary": " s ", "key_points": [str(k) for k in range(12)] + [" "], "topics": [" t ", ""], "entities": [{"name": " N ", "type": "robot"}, {"name": "", "type": "person"}], "text_safety": {"flag": "ok", "categories": ["hate"]}}
    got = one(spark, FM.page_answer(F.from_json("j", FM.PAGE_ANSWER)), j=json.dumps(a))
    assert (got["summary"], len(got["key_points"]), got["topics"], [tuple(e) for e in got["entities"]], got["flag"], got["categories"]) == ("s", 8, ["t"], [("N", "other")], "ok", [])
    v = {"content_class": "blank", "has_visual_content": True, "vision_confidence": "7", "safety": {"flag": "review", "categories": ["hate", "odd"], "explicit": True}}
    got = one(spark, FM.vision_answer(F.from_json("j", FM.VISION_ANSWER)), j=json.dumps(v))
    assert (got["content_class"], got["has_visual_content"], got["vision_confidence"], got["safety"]["categories"], got["safety"]["explicit"]) == ("blank", False, 1.0, ["hate"], True)
    got = one(spark, FM.vision_answer(F.from_json("j", FM.VISION_ANSWER)), j="{}")
    assert (got["content_class"], got["safety"]["flag"]) == ("indeterminate", "ok")


def test_media_windows_skip_silence(spark):
    assets = spark.createDataFrame([("a", 250.0), ("b", 100.0), ("c", None)], "asset string, duration_seconds double")
    rows = MM.windows(assets)
    assert sorted((r["asset"], r["index"], r["end_s"]) for r in rows.where("asset <> 'c'").collect()) == [("a", 0, 120.0), ("a", 1, 240.0), ("a", 2, 250.0), ("b", 0, 100.0)]
    silent = spark.createDataFrame([("a", 0.0, 125.0, 250.0), ("a", 239.0, None, 250.0)], "asset string, start_s double, end_s double, duration_seconds double")
    heard = MM.sounding(rows.where("asset <> 'c'"), silent)
    assert {(r["asset"], r["index"]): r["has_sound"] for r in heard.collect()} == {("a", 0): False, ("a", 1): True, ("a", 2): False, ("b", 0): True}
    m = MM.transcribe_manifest(heard).first()
    assert (m["windows"], m["silent"], m["seconds"]) == (4, 2, 220.0)
    assert {r["kind"]: r["duration_ms"] for r in MM.probe_manifest(assets.withColumn("kind", F.lit("audio"))).collect()} == {"audio": 350_000}


def test_frames_and_transcripts(spark):
    frames = spark.createDataFrame([("v", 0, [("Hate", "5")]), ("v", 1, [("Hate", "2"), ("Sexual", "0")]), ("v", 2, []), ("w", 0, [("Hate", "x")])], "asset string, frame_index int, severities array<struct<category:string,severity:string>>")
    judged = MM.frame_verdicts(frames)
    assert {(r["asset"], r["frame_index"]): (r["flag"], r["redacted"], len(r["categories"])) for r in judged.collect()} == {("v", 0): ("block", True, 1), ("v", 1): ("review", False, 1), ("v", 2): ("ok", False, 0), ("w", 0): ("ok", False, 0)}
    assert {r["asset"]: (r["n_block"], r["n_review"], r["flag"]) for r in MM.safety_rollup(judged).collect()} == {"v": (1, 1, "block"), "w": (0, 0, "ok")}
    said = spark.createDataFrame([("a", 1, 120.0, 240.0, " two "), ("a", 0, 0.0, 120.0, "one"), ("a", 2, 240.0, 250.0, "")], "asset string, index int, start_s double, end_s double, text string")
    r = MM.transcripts(said).first()
    assert r["markdown"] == "## [00:00:00]\none\n\n## [00:02:00]\ntwo\n" and r["vtt"].startswith("WEBVTT\n\n00:00:00.000 --> 00:02:00.000\none\n\n00:02:00.000")


def test_media_gates(spark):
    rows = spark.createDataFrame([(None, "audio", None, None, None, None), ("ok", "image", None, True, None, None), ("ok", "video", None, True, False, None), ("ok", "audio", True, True, True, None), ("ok", "audio", None, None, True, None), ("ok", "audio", None, True, True, True)], "s string, k string, d boolean, p boolean, h boolean, u boolean")
    gates = lambda stage: [r["g"] for r in rows.select(MM.gate(stage, *map(F.col, "skdphu")).alias("g")).collect()]
    assert gates("transcribe") == ["no_sidecar", "not_applicable", "no_audio", "skipped_done", "no_probe", "run"]
    assert gates("frames") == ["no_sidecar", "run", "run", "not_applicable", "no_probe", "not_applicable"]
    assert gates("chunk") == ["no_sidecar", "nothing_to_do", "nothing_to_do", "nothing_to_do", "no_probe", "run"]


def test_batch_jobs(spark):
    rows = spark.createDataFrame([(1, 2, "short"), (3, 4, "x" * 50)], "d bigint, p bigint, t string")
    lines, rest = M.batch_requests(rows, "d", "p", "t", 10)
    assert [r["custom_id"] for r in lines.collect()] == ["p1_2"] and rest.count() == 1
    answers = ['{"custom_id": "p1_2", "response": {"a": 1}}', "", '{"custom_id": "p3_4", "error": {"code": "content_filter"}}', '{"custom_id": "p5_6", "error": {"code": "500"}}', '{"custom_id": "junk"}']
    got = sorted((r["doc"], r["page"], r["status"]) for r in M.batch_results(spark.createDataFrame([(a,) for a in answers], "value string")).collect())
    assert got == [(1, 2, "ok"), (3, 4, "filtered"), (5, 6, "error")]


class Flaky:
    """Fails for a text in its first pass, which the row's own text tells."""

    def call(self, items):
        if any(t.startswith("bad") for t in items):
            raise RuntimeError
        return items


def test_passes_repeat_errors_only(spark):
    rows = spark.createDataFrame([(1, "bad"), (2, "good")], "k int, t string")
    calls = []

    def run(part):
        calls.append(part.count())
        text = F.when(F.lit(len(calls) > 1), "now fine").otherwise(F.col("t"))
        return M.called(part.withColumn("t", text), ["k"], "t", Flaky, "x", pa.string(), batch=1)

    assert {r["k"]: (r["x"], r["status"]) for r in M.passes(rows, "k", run).collect()} == {1: ("now fine", "ok"), 2: ("good", "ok")} and calls == [2, 1]


def test_page_state(spark):
    flags = F.array(F.lit("low_quality_text"), F.lit("summary_error"))
    assert one(spark, M.page_state(flags, F.lit("ok")), t="") == ["low_quality_text"]
    assert one(spark, M.page_state(flags, F.lit("filtered")), t="") == ["low_quality_text", "content_filtered"]


def test_pixels_and_runs(spark):
    image = bytearray([0, 0, 255, 255, 0, 0, 255, 255])
    rows = spark.createDataFrame([(image, 4, (0.0, 0.0, 3.0, 9.0), 90), (image, 4, (2.0, 0.0, 2.0, 1.0), 90)], f"p binary, w int, b {G.BOX}, l int")
    assert [round(r["d"], 3) for r in rows.select(G.dark_fraction("p", "w", "b", "l").alias("d")).collect()] == [0.667, 0.0]
    assert G.merge_runs([(0, 0, 10), (1, 5, 12), (2, 20, 30), (4, 20, 30)]) == [(0, 0, 12, 2), (20, 2, 30, 3), (20, 4, 30, 5)]
    lines = spark.createDataFrame([("p", 0, 0, 10), ("p", 1, 5, 12)], "k string, y int, x0 int, x1 int")
    assert [tuple(b) for b in G.vertical_runs(lines, "k").first()["boxes"]] == [(0.0, 0.0, 12.0, 2.0)]


def test_reading_order(spark):
    b = lambda x0, y0, x1: (float(x0), float(y0), float(x1), float(y0 + 5))
    two = [("p", n, b(*v), 0.0, 100.0) for n, v in {"r1": (60, 0, 90), "l2": (0, 10, 40), "l1": (0, 0.04, 40), "r2": (60, 10, 90)}.items()]
    across = [("r", n, b(*v), 0.0, 100.0) for n, v in {"r1": (60, 10, 90), "l2": (0, 20, 40), "l1": (0, 10, 40), "r2": (60, 20, 90), "top": (0, 0, 90)}.items()]
    wide = [("q", n, b(*v), 0.0, 100.0) for n, v in {"b": (0, 10, 40), "a": (0, 0, 90)}.items()]
    rows = G.reading_order(spark.createDataFrame(two + wide + across, f"page string, name string, box {G.BOX}, page_x0 double, page_width double"), "page").orderBy("page", "place").collect()
    assert [(r["name"], r["ambiguous"]) for r in rows] == [(n, False) for n in ("l1", "l2", "r1", "r2", "a", "b")] + [(n, True) for n in ("top", "l1", "l2", "r1", "r2")]
