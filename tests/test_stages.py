"""Batch jobs, settings, ranks, packing, media chunks, vision gates, manifests and ingest rows on hand-checked fixtures."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomwork.config import Chunk
from loomwork.functions.envfile import env_values
from loomwork.operators import chunk as K
from loomwork.operators import ingest as I
from loomwork.operators import manifests as X
from loomwork.operators import media as M
from loomwork.operators import models as P
from loomwork.operators import routing as R
from loomwork.operators import windows as N


def test_env_values():
    text = '﻿A=1\n# comment\n\nB = two words # note\nC="kept # here"\nD=\'x\'\r\nE=a#b\nF=\nnot a line\nA=again\n'
    assert env_values(text) == {"A": "again", "B": "two words", "C": "kept # here", "D": "x", "E": "a#b", "F": ""}


class Service:
    def __init__(self, *states):
        self.states, self.asked = list(states), 0

    def get(self, batch_id):
        self.asked += 1
        return self.states[min(self.asked, len(self.states)) - 1]


def test_batch_jobs_are_awaited():
    waits = []
    done = Service({"status": "validating"}, {"status": "in_progress"}, {"status": "completed", "output": "o"})
    assert P.awaited(done, "b", interval=7, wait=waits.append)["output"] == "o" and waits == [7, 7]
    assert P.awaited(Service({"status": "expired", "output": "part"}), "b")["output"] == "part"
    with pytest.raises(P.BatchFailed, match="ended failed"):
        P.awaited(Service({"status": "failed"}), "b")
    now = iter(range(0, 1000, 10))
    with pytest.raises(P.BatchFailed, match="in_progress after 25"):
        P.awaited(Service({"status": "in_progress"}), "b", most=25, clock=lambda: next(now), wait=lambda _: None)


def test_ranks_of_large_and_null_groups(spark):
    rows = [("hot", k % 50, k) for k in range(500)] + [(None, 1, 1000 + k) for k in range(7)] + [("one", 0, 0)]
    got = N.ranked(spark.createDataFrame(rows, "g string, o int, k int").repartition(3), ["g"], ["o", "k"], "at").collect()
    want = {}
    for g in {r[0] for r in rows}:
        want |= {r: at for at, r in enumerate(sorted(r for r in rows if r[0] == g))}
    assert {(r["g"], r["o"], r["k"]): r["at"] for r in got} == want
    assert N.ranked(spark.createDataFrame([], "g string, o int"), ["g"], ["o"], "at").count() == 0


def test_packing_numbers_through_a_document(spark):
    text = " ".join(f"Sentence number {k} is a little longer than the ones before it." for k in range(120))
    rows = spark.createDataFrame([("d1", [("page 1", text), ("page 2", ""), ("page 3", None), ("page 4", "Short. " * 3)]), ("d2", []), ("d3", None), ("d4", [("page 1", "x" * 9000)])], "doc string, p array<struct<section:string,text:string>>")
    parts = F.transform("p", lambda x: K.part(x["text"], x["section"]))
    got = K.pack_documents(rows.select("doc", parts.alias("parts")), ["doc"]).orderBy("doc", "chunk_index").collect()
    one = [r for r in got if r["doc"] == "d1"]
    want = [(s, p, c, t, len(parent)) for s, x in (("page 1", text), ("page 4", "Short. " * 3)) for p, (parent, children) in enumerate(K.chunked(x)) for c, t in enumerate(children)]
    assert [(r["section"], r["parent_in_part"], r["child_index"], r["text"], r["parent_chars"]) for r in one] == want
    assert [r["chunk_index"] for r in one] == list(range(len(one))) and len(one) > 10
    assert [r["parent_index"] for r in one] == sorted(r["parent_index"] for r in one) and one[-1]["parent_index"] == len({(r["section"], r["parent_in_part"]) for r in one}) - 1
    assert {r["doc"] for r in got} == {"d1", "d4"} and sum(len(r["text"]) for r in got if r["doc"] == "d4") >= 9000


def test_children_of_many_documents_share_batches(spark, monkeypatch):
    rows = spark.createDataFrame([], f"doc bigint, parts {K.PARTS}")
    caught = []
    monkeypatch.setattr(type(rows), "mapInArrow", lambda self, run, schema: caught.append(run) or self.withColumn("kind", F.lit("")))
    K.pack_documents(rows, ["doc"])
    told = {"section": "s", "kind": "text", "page": 1, "start_ms": None, "end_ms": None, "speaker": None}
    parts = [None, []] + [[{**told, "page": k, "text": "One. Two!"}, {**told, "text": None}, {**told, "text": "Three?\n"}] for k in range(2, 300)] + [[{**told, "text": "x" * 1_200_000}], [{**told, "text": "Last."}]]
    element = pa.struct([("section", pa.string()), ("kind", pa.string()), ("page", pa.int64()), ("start_ms", pa.int64()), ("end_ms", pa.int64()), ("speaker", pa.string()), ("text", pa.string())])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(parts))), pa.array(parts, pa.list_(element))], names=["doc", "parts"])
    for cut, first in ((batch, 0), (batch.slice(5), 5)):
        made = list(caught[0](iter([cut])))
        assert len(made) == 2 and max(sum(map(len, b["text"].to_pylist())) for b in made) <= K.BATCH_CHARS + 4 * Chunk.parent_max
        got = [r for b in made for r in b.to_pylist()]
        assert [(r["doc"], r["page"], r["parent_index"], r["chunk_index"], r["text"], r["parent_chars"]) for r in got if r["doc"] < 300] == [x for k in range(max(2, first), 300) for x in ((k, k, 0, 0, "One. Two!", 9), (k, 1, 1, 1, "Three?", 6))]
        assert "".join(r["text"] for r in got if r["doc"] == 300) == "x" * 1_200_000 and [r["chunk_index"] for r in got if r["doc"] == 300] == list(range(sum(r["doc"] == 300 for r in got)))
        assert [(r["doc"], r["chunk_index"], r["text"]) for r in got if r["doc"] > 300] == [(301, 0, "Last.")]


def test_chunks_are_those_of_packing_sentence_by_sentence():
    rng = random.Random(3)
    drawn = ["".join(rng.choice(signs) for _ in range(rng.randrange(400))) for signs in ("ab. ", "a.!? \n\t\x1c", "aé𝒳.?\u2003\u3000\u0085", "abcdefghijklmn. ", ". ") for _ in range(60)]
    long = ["w" * n + tail for n in (599, 600, 601, 2599, 2600, 2601, 2602, 5200, 7000) for tail in ("", ".", ". b.", ".\n\nc", " d. e" * 300)]
    for text in [*drawn, *long, *("A. " + x for x in long), " ", ".", "a.  ", " .\n"]:
        for cfg in (Chunk(), Chunk(5, 6, 2, 3), Chunk(3, 3, 1, 1), Chunk(1, 9, 1, 4), Chunk(9, 5, 2, 3), Chunk(5, 6, 4, 3)):
            assert K.chunked(text, cfg) == K.chunked_plainly(text, cfg)


def test_media_chunk_parts(spark):
    windows = spark.createDataFrame([("a", 1, 120.0, 200.5, "s", "Second."), ("a", 0, 0.0, 120.0, "s", " First. "), ("a", 2, 200.5, None, None, "  "), ("b", 0, 0.0, 60.0, None, None)], "asset string, index int, start_s double, end_s double, speaker string, text string")
    captions = spark.createDataFrame([("a", "video", "A film", "of a street"), ("c", "image", "A photo", None), ("b", "audio", " ", "")], "asset string, kind string, caption string, description string")
    got = {r["asset"]: [(p["section"], p["kind"], p["start_ms"], p["end_ms"], p["speaker"], p["text"]) for p in r["parts"]] for r in M.chunk_parts(windows, captions).collect()}
    assert got == {
        "a": [("[00:00:00]", "transcript", 0, 120000, "s", "First."), ("[00:02:00]", "transcript", 120000, 200500, "s", "Second."), ("caption", "summary", None, None, None, "A film\n\nof a street")],
        "c": [("caption", "image_caption", None, None, None, "A photo")],
    }


def test_vision_gates(spark):
    pages = spark.createDataFrame([("d", 1, 0.001), ("d", 2, 0.5), ("d", 3, None), ("d", None, 0.999)], "doc_id string, page_number int, dark_coverage double")
    assets = spark.createDataFrame([("d", "page", 1, None), ("d", "page", 2, 0.999), ("d", "page", 3, 0.0), ("d", "artifact", 1, None), ("d", "artifact", 2, 0.999), ("d", "page", 9, None)], "doc_id string, kind string, page_number int, measured_dark double")
    got = {(r["kind"], r["page_number"]): (r["content_class"], r["measured"]) for r in R.pregated(R.with_page_dark(assets, pages)).collect()}
    assert got == {("page", 1): ("blank", False), ("page", 2): ("black_or_redacted", True), ("page", 3): ("blank", True), ("artifact", 1): (None, False), ("artifact", 2): ("black_or_redacted", True), ("page", 9): (None, False)}
    images = spark.createDataFrame([("d", 1, 1, 7, 900, 900, True), ("d", 2, 1, 7, 900, 900, False), ("d", 2, 2, 8, 100, 63, False), ("d", 2, 3, 9, 64, 64, False), ("d", 2, 4, 0, 500, 500, False), ("e", 1, 1, 7, 80, 80, False)], "doc_id string, page_number int, image_index int, xref int, width int, height int, is_full_page boolean")
    assert sorted((r["doc_id"], r["xref"]) for r in R.picture_artifacts(images).collect()) == [("d", 9), ("e", 7)]
    kinds = spark.createDataFrame([("page",), ("artifact",)], "kind string")
    assert [r[0] for r in kinds.select(R.safety_scan_applies(F.col("kind"))).collect()] == [False, True] and [r[0] for r in kinds.select(R.safety_scan_applies(F.col("kind"), False)).collect()] == [True, True]


def test_manifests(spark):
    pages = spark.createDataFrame([("d", 1, "ok", False, 100, 10), ("d", 2, "filtered", False, None, None), ("d", 3, None, True, None, None), ("e", 1, "error", False, None, None)], "doc_id string, page_number int, status string, truncated boolean, input_tokens bigint, output_tokens bigint")
    reduces = spark.createDataFrame([("d", 2, 30, 5)], "doc_id string, calls bigint, prompt bigint, completion bigint")
    got = {r["doc_id"]: r.asDict() for r in X.summaries_final(pages, reduces).collect()}
    assert got["d"] | {"doc_id": None} == {"doc_id": None, "summarized": 1, "filtered": 1, "failed": 0, "truncated": 1, "calls": 3, "prompt_tokens": 130, "completion_tokens": 15, "cost_nano": 130 * 100 + 15 * 400}
    assert (got["e"]["failed"], got["e"]["calls"], got["e"]["cost_nano"]) == (1, 0, 0)
    docs = spark.createDataFrame([("b", "errored", "x", 5), ("a", "errored", "y", 5), ("c", "done", None, 7), ("d", "skipped_done", None, 9)], "doc_id string, action string, error_code string, tokens bigint")
    assert X.run_manifest(docs, ["tokens"]).first().asDict() == {"seen": 4, "no_sidecar": 0, "skipped_status": 0, "skipped_done": 1, "errored": 2, "done": 1, "tokens": 7}
    assert [tuple(r) for r in X.run_errors(docs, "doc_id").collect()] == [("a", "y"), ("b", "x")]
    beat = X.heartbeat(spark.createDataFrame([("a", 5, 20, 10.0), ("b", 0, 20, 10.0), ("c", 20, 20, 5.0)], "key string, done bigint, total bigint, elapsed_s double"))
    assert {r["key"]: (r["rate"], r["eta_s"]) for r in beat.collect()} == {"a": (0.5, 30.0), "b": (None, None), "c": (4.0, 0.0)}


def test_bags_leave_nulls_and_empty_groups_out(spark):
    rows = spark.createDataFrame([(1, "s", None), (2, None, None)], "id int, sha string, title string")
    bag = I.metadata_bag({"source": {"sha256": F.col("sha"), "other": F.lit("x")}, "document": {"title": F.col("title")}})
    assert {r["id"]: r["b"] for r in rows.select("id", bag.alias("b")).collect()} == {1: {"source": {"sha256": "s"}}, 2: {}}
    media = I.metadata_bag({"media": {"anything": F.lit(3)}, "caption": {"caption": F.lit("c"), "secret": F.lit("s")}}, I.MEDIA_BAG)
    assert rows.select(I.bag_lines(media)).first()[0] == "caption.caption=c\nmedia.anything=3"


def test_coverage_and_the_guard(spark):
    children = spark.createDataFrame([("d", "a"), ("d", "b"), ("e", "a")], "doc_id string, content_sha string")
    seen = spark.createDataFrame([("a",), ("a",)], "content_sha string")
    assert {tuple(r) for r in P.coverage(children, seen, "doc_id").collect()} == {("d", 2, 1, False), ("e", 1, 0, True)}
    assert P.full_coverage(children.where("doc_id = 'e'"), seen).count() == 1
    with pytest.raises(Exception, match="no vector"):
        P.full_coverage(children, seen).collect()


def test_small_column_functions(spark):
    from loomwork.functions import ids
    from loomwork.functions import media as FM
    from loomwork.operators import geometry as G

    one = spark.range(1)
    assert one.select(ids.vector_ref(F.lit("doc/artifacts/p1-2.png"))).first()[0] == "doc/embeddings/p1-2.emb.json"
    box = F.struct(*(F.lit(v).alias(k) for k, v in (("x0", 20.0), ("y0", 40.0), ("x1", 60.0), ("y1", 80.0))))
    assert tuple(one.select(G.points(box, F.lit(2.0), F.lit(5.0), F.lit(1.0)).alias("b")).first()["b"]) == (15.0, 21.0, 35.0, 41.0)
    answer = F.struct(F.array(F.lit("k")).alias("key_points"), F.array().alias("entities"), F.array(F.lit("t")).alias("topics"))
    made = one.select(FM.summary_json(answer, F.lit(True), F.lit(False), F.lit(7), F.lit(3)).alias("s")).first()["s"].asDict()
    assert made == {"key_points": ["k"], "entities": [], "topics": ["t"], "low_confidence": True, "truncated": False, "input_token_count": 7, "output_token_count": 3}


def test_store_resolution(spark, tmp_path):
    from loomwork.sources import discovery as D

    root = str(tmp_path)
    assert D.store_candidates("/d", ["IMAGES", "VOL1/IMAGES"], "/x", "/c") == ["/x", "/d/.embeddings", "/d/IMAGES/.embeddings", "/d/VOL1/IMAGES/.embeddings", "/c/.embeddings"]
    candidates = D.store_candidates(f"{root}/set", ["IMAGES"], corpus_root=root)
    assert D.first_existing(spark, candidates) is None
    for made, found in ((f"{root}/.embeddings", f"{root}/.embeddings"), (f"{root}/set/IMAGES/.embeddings", f"{root}/set/IMAGES/.embeddings"), (f"{root}/set/.embeddings", f"{root}/set/.embeddings")):
        (tmp_path / made).mkdir(parents=True)
        assert D.first_existing(spark, candidates) == found


def test_driven_rows(spark):
    from loomwork.operators.drive import driven

    def worker(x):
        if x is None or "bad" in x:
            raise KeyError(x)
        return x.upper()

    rows = spark.createDataFrame([(k, None if k == 3 else f"bad {k}" if k % 10 == 0 else f"text {k}") for k in range(200)], "id int, t string").repartition(3)
    for workers in (1, 8):
        got = {r["id"]: (r["result"], r["error"]) for r in driven(rows, ["id"], "t", worker, workers).collect()}
        assert got == {k: (None, "KeyError: None") if k == 3 else (None, f"KeyError: 'bad {k}'") if k % 10 == 0 else (f"TEXT {k}", None) for k in range(200)}


def test_purge_deletes_only_when_told(spark, tmp_path):
    from loomwork.sources import discovery as D

    for name in ("a/pages/1.png", "a/pages/2.png", "a/a.pdf", "b/pages/sub/x.png", "pages.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("12345")
    files = lambda: D.listing(spark, str(tmp_path))
    dry = {r["directory"].rsplit(tmp_path.name, 1)[1]: (r["n_files"], r["bytes"], r["deleted"]) for r in D.purge(files()).collect()}
    assert dry == {"/a/pages": (2, 10, False), "/b/pages/sub": (1, 5, False)} and (tmp_path / "a/pages/1.png").exists()
    done = {r["directory"].rsplit(tmp_path.name, 1)[1]: r["deleted"] for r in D.purge(files(), delete=True).collect()}
    assert done == {"/a/pages": True, "/b/pages/sub": False} and not (tmp_path / "a/pages").exists() and (tmp_path / "a/a.pdf").exists() and (tmp_path / "b/pages/sub/x.png").exists()


FAKE = """#!/usr/bin/env python3
import json, os, sys
a = sys.argv
if "-show_format" in a:
    print(json.dumps({"format": {"duration": "12.5"}, "streams": [{"codec_type": "audio", "codec_name": "mp3"}], "size": os.path.getsize(a[-1])}))
elif "metadata=print" in " ".join(a):
    print("pts_time:2.5\\npts_time:1.25")
elif "silencedetect" in " ".join(a):
    print("silence_start: 3.0 x silence_end: 4.5 x silence_start: 9", file=sys.stderr)
elif "-segment_time" in a:
    for k in range(3):
        open(a[-1] % k, "w").write(a[a.index("-segment_time") + 1])
elif "-ss" in a:
    if float(a[a.index("-ss") + 1]) > 100:
        sys.exit("no such second")
    open(a[-1], "w").write(a[a.index("-ss") + 1])
else:
    for k in (1, 2):
        open(a[-1] % k, "w").write("frame")
"""


def test_media_tools(spark, tmp_path):
    import json

    from loomwork.functions import media as FM
    from loomwork.sources import media_tools as MT

    program = tmp_path / "tool"
    program.write_text(FAKE)
    program.chmod(0o755)
    tools, out = MT.Tools(str(program), str(program)), str(tmp_path / "out")
    (tmp_path / "a.mp4").write_bytes(b"12345")
    assets = spark.createDataFrame([("a", f"file://{tmp_path}/a.mp4", [1.0, 500.0, 2.0], 8, 10.0), ("gone", str(tmp_path / "gone.mp4"), [1.0], 8, None)], "asset string, path string, times array<double>, seconds int, duration_seconds double")
    found = {r["asset"]: r for r in MT.probed(assets, tools).select("*", FM.typed_metadata(F.col("result")).alias("m")).collect()}
    assert found["a"]["m"]["duration_seconds"] == 12.5 and found["a"]["m"]["audio_codec"] == "mp3" and json.loads(found["a"]["result"])["size"] == 5
    assert found["gone"]["result"] is None and "FileNotFoundError" in found["gone"]["error"]
    result = lambda df: json.loads({r["asset"]: r["result"] for r in df.collect()}["a"])
    assert result(MT.frames(assets, out, tools=tools)) == [[f"{out}/a/frame_0001.webp", 1.0], [f"{out}/a/frame_0003.webp", 2.0]]
    assert (tmp_path / "out/a/frame_0003.webp").read_text() == "2.000"
    assert result(MT.posters(assets, out, tools=tools)) == [[f"{out}/a/poster_0001.webp", 5.0]]
    assert result(MT.series(assets, out, "segments", tools=tools)) == [f"{out}/a/segment_{k:04d}.mp3" for k in range(3)] and (tmp_path / "out/a/segment_0002.mp3").read_text() == "8"
    assert result(MT.series(assets, out, "frames", tools=tools)) == [f"{out}/a/frame_0001.webp", f"{out}/a/frame_0002.webp"]
    row = MT.logged(assets.limit(1), "scene", tools).select(FM.scene_times(F.col("result")).alias("t")).first()
    assert row["t"] == [1.25, 2.5]
    row = MT.logged(assets.limit(1), "silence", tools).select(FM.silent_intervals(F.col("result")).alias("t")).first()
    assert [tuple(x) for x in row["t"]] == [(3.0, 4.5), (9.0, None)]
    missing = MT.probed(assets.limit(1), MT.Tools(str(tmp_path / "nowhere"))).first()
    assert missing["result"] is None and missing["error"].startswith("ToolError") and "is missing" in missing["error"]


def test_pixels():
    import zlib

    import numpy as np

    from loomwork.operators import pixels as X

    def decoded(data):
        assert data[:8] == b"\x89PNG\r\n\x1a\n"
        w, h = int.from_bytes(data[16:20], "big"), int.from_bytes(data[20:24], "big")
        n = int.from_bytes(data[33:37], "big")
        lines = np.frombuffer(zlib.decompress(data[41 : 41 + n]), np.uint8).reshape(h, 1 + 3 * w)
        return lines[:, 1:].reshape(h, w, 3)

    r = np.random.default_rng(0)
    rgb = r.integers(0, 256, (5, 7, 3)).astype(np.uint8)
    assert (decoded(X.png(X.as_rgb(rgb.tobytes(), 7, 3))) == rgb).all()
    grey = r.integers(0, 256, (4, 3, 1)).astype(np.uint8)
    assert (X.as_rgb(grey.tobytes(), 3, 1) == grey).all()
    assert X.as_rgb(bytes([0, 0, 0, 0, 255, 0, 0, 0, 0, 0, 0, 255]), 3, 4).tolist() == [[[255, 255, 255], [0, 255, 255], [0, 0, 0]]]
    big = r.integers(0, 256, (40, 60, 3)).astype(np.uint8)
    small = X.smaller(big, 15)
    assert small.shape == (10, 15, 3) and (small == big.reshape(10, 4, 15, 4, 3).astype(int).sum(axis=(1, 3)) // 16).all() and X.smaller(rgb, 7) is rgb
