"""Discovery, lanes, store, packages, providers, streaming, reports."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from loomwork.operators import models as M
from loomwork.plans import report as R
from loomwork.sources import discovery as D
from loomwork.sources import lanes as L
from loomwork.sources.package import write_package
from loomwork.sources.store import StoreMismatch, VectorStore
from loomwork.streaming import incremental as S


def put(path, text="x"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def names(df, column="path"):
    return sorted(r[column].rsplit("/corpus/", 1)[-1] for r in df.collect())


@pytest.fixture
def corpus(tmp_path):
    root = tmp_path / "corpus"
    for f in ("DataSet-1/VOL00001/IMAGES/a.pdf", "DataSet-1/VOL00001/IMAGES/B.PDF", "DataSet-1/VOL00001/IMAGES/a/inner.pdf", "DataSet-1/VOL00001/IMAGES/pages/p.pdf", "DataSet-2/c.pdf", "DataSet-2/clip.MP4", "DataSet-2/clip.media/frame.jpg", "DataSet-2/voice.mp3", "DataSet-2/c.json"):
        put(root / f)
    return f"file:{root}"


def test_discovery(spark, corpus):
    every = D.listing(spark, corpus)
    assert names(D.pdfs(spark, corpus, prune=False)) == ["DataSet-1/VOL00001/IMAGES/B.PDF", "DataSet-1/VOL00001/IMAGES/a.pdf", "DataSet-1/VOL00001/IMAGES/a/inner.pdf", "DataSet-1/VOL00001/IMAGES/pages/p.pdf", "DataSet-2/c.pdf"]
    kept = D.pruned(D.listing(spark, corpus, D.PDF), corpus, names=tuple(n for n in D.PRUNED if n != "images"))
    assert names(kept) == ["DataSet-1/VOL00001/IMAGES/B.PDF", "DataSet-1/VOL00001/IMAGES/a.pdf", "DataSet-2/c.pdf"]
    assert names(D.media(spark, corpus)) == ["DataSet-2/clip.MP4", "DataSet-2/voice.mp3"]
    assert dict(map(tuple, D.datasets(every).collect())) == {"DataSet-1": 4, "DataSet-2": 5}
    assert [r["dir"] for r in D.image_dirs(every, f"{corpus}/DataSet-1").collect()] == ["VOL00001/IMAGES"]
    cars = {r["pdf"].rsplit("/", 1)[-1]: (r["exists"], r["in_pipeline"]) for r in D.sidecars(every).collect()}
    assert cars["c.pdf"] == (True, False) and cars["a.pdf"] == (False, True)


def test_tolerant_records(spark, tmp_path):
    put(tmp_path / "r/good.json", '{"doc": "a", "pages": 2}')
    put(tmp_path / "r/bad.json", '{"doc": "b", "pag')
    schema = StructType([StructField("doc", StringType()), StructField("pages", LongType())])
    records = L.read_records(spark, str(tmp_path / "r"), schema)
    base = f"file://{tmp_path}/r/"
    expected = spark.createDataFrame([(base + f"{n}.json",) for n in ("good", "bad", "none")], "path string")
    got = {r["path"].rsplit("/", 1)[-1]: r for r in L.tolerant(expected, records).collect()}
    assert {k: v["parse_status"] for k, v in got.items()} == {"good.json": "ok", "bad.json": "parse_error", "none.json": "missing"}
    assert got["good.json"]["pages"] == 2


def test_gates_and_blocks(spark):
    rows = spark.createDataFrame([("missing", None, None), ("parse_error", None, None), ("error", True, None), ("ok", None, None), ("ok", True, True), ("ok", True, None)], "status string, stage2 boolean, stage3 boolean")
    act = [r["a"] for r in rows.select(L.gate(F.col("status"), {"no_stage2": F.col("stage2")}, F.col("stage3")).alias("a")).collect()]
    assert act == ["no_sidecar", "bad_sidecar", "not_ok", "no_stage2", "skipped_done", "run"]
    docs = spark.createDataFrame([("a", 1), ("b", 2)], "doc string, pages int")
    done = L.with_block(docs, spark.createDataFrame([("a", "fused")], "doc string, source string"), "doc", "stage5")
    assert {r["doc"]: r["stage5"] and r["stage5"]["source"] for r in done.collect()} == {"a": "fused", "b": None}
    with pytest.raises(ValueError):
        L.with_block(done, docs, "doc", "stage5")
    assert names(L.resume(docs, docs.limit(1), ["doc", "pages"]), "doc") == ["b"]


def test_store(spark, tmp_path):
    sha = lambda k: f"{k:064x}"
    store = VectorStore(spark, str(tmp_path / "s"), "m", 2)
    frame = lambda rows: spark.createDataFrame(rows, "content_sha string, vector array<float>")
    assert store.keys().count() == 0
    store.append(frame([(sha(1), [1.0, 2.0]), (sha(2), [3.0, 4.0])]), 0)
    store.append(frame([(sha(1), [9.0, 9.0])]), 1)
    assert {r["content_sha"]: list(r["vector"]) for r in store.latest().collect()} == {sha(1): [9.0, 9.0], sha(2): [3.0, 4.0]}
    wanted = spark.createDataFrame([(sha(1),), (sha(3),), ("bad",)], "content_sha string")
    assert [r["content_sha"] for r in store.lookup(wanted).collect()] == [sha(1)]
    assert names(store.missing(wanted), "content_sha") == [sha(3), "bad"]
    with pytest.raises(Exception, match="bad vector"):
        store.append(frame([(sha(4), [1.0])]))
    assert store.rows().count() == 3
    with pytest.raises(StoreMismatch):
        VectorStore(spark, str(tmp_path / "s"), "m", 3)


def test_package(spark, tmp_path):
    v = spark.createDataFrame([("a", [1.0, 2.5]), ("a", [1.0, 2.5]), ("b", [0.0, -1.0])], "content_sha string, vector array<float>")
    plan = spark.createDataFrame([("d1", "ready")], "document_name string, status string")
    counts = write_package(str(tmp_path / "p"), plan, v, v.limit(0), plan)
    assert counts == {"plan": 1, "blobs": 1, "text_vectors": 2, "image_vectors": 0}
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "p/text_vectors")).collect()) == ["a\t[1.0,2.5]", "b\t[0.0,-1.0]"]
    assert spark.read.json(str(tmp_path / "p/counts")).first()["text_vectors"] == 2


class Fragile:
    def __init__(self):
        self.calls = 0

    def call(self, items):
        self.calls += 1
        if self.calls % 2:
            raise M.Throttled(0.0)
        if any("boom" in t for t in items):
            raise RuntimeError
        if any("refuse" in t for t in items):
            raise M.Refused
        return [t.upper() for t in items]


def test_provider_failures_are_isolated(spark):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(["a", "refuse", "b", "c"])], "k int, t string").coalesce(1)
    got = {r["k"]: (r["x"], r["status"]) for r in M.called(rows, ["k"], "t", Fragile, "x", pa.string(), batch=4).collect()}
    assert got == {0: ("A", "ok"), 1: (None, "filtered"), 2: ("B", "ok"), 3: ("C", "ok")}
    one = spark.createDataFrame([(1, "boom")], "k int, t string")
    assert M.called(one, ["k"], "t", Fragile, "x", pa.string()).first()["status"] == "error"


def test_embedding_is_called_once_for_each_sha(spark):
    child = spark.createDataFrame([("s1", "t"), ("s1", "t"), ("s2", "u"), ("s3", "v")], "content_sha string, text string")
    seen = spark.createDataFrame([("s3",)], "content_sha string")
    got = M.embedded(child, seen, lambda: M.HashEmbedding(8)).collect()
    assert sorted(r["content_sha"] for r in got) == ["s1", "s2"] and all(len(r["vector"]) == 8 for r in got)
    with pytest.raises(Exception, match="no vector"):
        M.full_coverage(child, seen).collect()


def test_reduce_depth(spark):
    rows = [("short", 1, "Only one. Rest")] + [("long", k, f"{'x' * 900}{k}. tail") for k in range(100)]
    got = {r["d"]: r for r in M.reduced(spark.createDataFrame(rows, "d string, p int, t string"), "d", "p", "t", M.FirstSentence).collect()}
    assert got["short"]["summary"] == "Only one" and got["short"]["depth"] == 1 and got["long"]["depth"] == 2


def test_stream_resumes(spark, tmp_path):
    schema = StructType([StructField("k", LongType()), StructField("v", StringType())])
    frame = lambda rows: spark.createDataFrame(rows, schema)
    src, target, check = (str(tmp_path / n) for n in ("src", "target", "check"))
    frame([(1, "a"), (2, "b"), (2, "b")]).write.parquet(src)
    S.ingest_new(spark, src, schema, target, check, "k")
    frame([(2, "again"), (3, "c")]).write.mode("append").parquet(src)
    for _ in range(2):
        S.ingest_new(spark, src, schema, target, check, "k")
    assert sorted(map(tuple, S.ingested(spark, target, schema).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_stream_limiter(spark, tmp_path):
    rows = [("d", k, float(k), 10) for k in range(5)] + [("e", 9, 0.0, 500)]
    src = str(tmp_path / "src")
    spark.createDataFrame(rows, "deployment string, request_id bigint, at double, tokens bigint").write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = S.admitted(stream, requests=3, tokens=100).writeStream.format("memory").queryName("admitted").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r["request_id"]: r["admitted_at"] for r in spark.table("admitted").collect()}
    assert got == {0: 0.0, 1: 1.0, 2: 2.0, 3: 60.0, 4: 61.0, 9: 0.0}


def test_stream_windows_and_sessions(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(x AS INT)) AS ts, 'u' AS user_id FROM VALUES (0), (1), (7), (90) AS t(x)").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(src)
    stream = lambda: spark.readStream.schema("ts timestamp, user_id string").parquet(src)
    for name, df, want in (("acts", S.activity(stream(), "ts", "user_id"), [1, 1, 2]), ("sess", S.sessions(stream(), "ts", "user_id"), [1, 3])):
        df.writeStream.format("memory").queryName(name).outputMode("complete" if name == "acts" else "append").trigger(availableNow=True).start().awaitTermination()
        got = sorted(r["n"] for r in spark.table(name).collect())
        assert got == want or name == "sess" and got in ([3], [1, 3])


def test_report(spark):
    rollup = spark.createDataFrame([("a", 3, 9, 2_000_000_000, 1), (None, 3, 9, 2_000_000_000, 1)], "dataset string, docs bigint, pages bigint, cost_nano bigint, quarantined bigint")
    grid = spark.createDataFrame([("a", "stage3", 3, 2, "in_progress", 667)], "dataset string, stage string, applicable bigint, done bigint, state string, permille bigint")
    made = R.build(rollup, grid, "2024-01-01T00:00:00Z")
    assert json.loads(R.as_json(made))["datasets"][0]["stages"]["stage3"]["done"] == 2
    assert "| a | 3 | ◐ 2/3 66.7% | $2.00 |" in R.as_markdown(made) and "**$2.00** spent" in R.as_markdown(made) and "a: 1 documents" in R.as_html(made)
    assert R.human_bytes(None) == "n/a" and R.human_bytes(1536) == "1.5 KB" and R.percent(None) == "n/a"


def test_dashboards(spark):
    """Warnings, tiles, grid and cards, in both forms; what a rollup lacks is left out."""
    rollup = spark.createDataFrame([("a<b", 3, 1, 9, 5000, 2_000_000_000, 1), ("c", 2, 0, 4, 70, 500_000_000, 0), (None, 5, 1, 13, 5070, 2_500_000_000, 1)], "dataset string, docs bigint, docs_error bigint, pages bigint, chars bigint, cost_nano bigint, quarantined bigint")
    grid = spark.createDataFrame([("a<b", "stage3", 3, 2, "in_progress", 667), ("a<b", "stage4", 0, 0, "n/a", None), ("c", "stage3", 2, 2, "done", 1000), ("c", "stage4", 2, 0, "not_started", 0), (None, "stage3", 5, 4, "in_progress", 800)], "dataset string, stage string, applicable bigint, done bigint, state string, permille bigint")
    coverage = spark.createDataFrame([("a<b", 4, 3, 1, 2, 1, 750), (None, 4, 3, 1, 2, 1, 750)], "dataset string, has_visual bigint, embedded bigint, not_embedded bigint, embed_errors bigint, docs_with_gap bigint, permille bigint")
    projected = spark.createDataFrame([("c", 300_000_000), (None, 300_000_000)], "dataset string, projected_nano bigint")
    made = R.build(rollup, grid, "2024-01-01T00:00:00Z", coverage=coverage, projected=projected)
    assert len(made["warnings"]) == 2 and "3 of 4 assets (75.0%), 1 documents with gaps, 2 errors" in made["warnings"][0]
    text, page = R.as_markdown(made), R.as_html(made)
    assert text.index("> a<b: vision") < text.index("## Corpus") < text.index("## Progress") < text.index("### a<b") < text.index("### c")
    assert "| a<b | 3 | ◐ 2/3 66.7% | – | $2.00 |" in text and "| c | 2 | ✔ 2/2 100.0% | ○ 0/2 0.0% | $0.50 |" in text and "| **all** | 5 | ◐ 4/5 80.0% | – | $2.50 |" in text
    assert "- **$2.50** spent (about $0.30 to finish)" in text and "- documents: 3, 1 with errors" in text and "- vision embeddings: 3 of 4 (75.0%), 1 documents with gaps" in text
    assert page.count("class='tile'") == 5 and page.count("class='card'") == 2 and page.count("class='warning'") == 2 and "a&lt;b" in page and "a<b" not in page and "width:66.7%" in page and "<script" not in page
    few = R.build(rollup.select("dataset", "docs"), grid.limit(0), "t")
    assert "n/a" in R.as_markdown(few) and R.as_html(few).count("class='tile'") == 2


def test_scratch_is_swept(spark, tmp_path):
    import os

    from loomwork.storage import Scratch, shared_dir, sweep

    here = shared_dir(spark).removeprefix("file://")
    kept = Scratch(spark, "kept").keep(spark.range(3))
    old, young = f"{here}/loomwork-old-app", f"{here}/loomwork-young-app"
    for p in (old, young):
        os.makedirs(p, exist_ok=True)
    os.utime(old, (0, 0))
    assert sweep(spark, 30) == ["loomwork-old-app"] and not os.path.exists(old) and os.path.exists(young) and kept.count() == 3
    os.rmdir(young)


def test_blobs_are_copied(spark, tmp_path):
    from loomwork.sources import blobs as B

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(b"12345")
    plan = spark.createDataFrame([(1, "source.pdf", "upload", "a.pdf"), (1, "ocr/page-1.png", "placeholder_blank", None), (2, "ocr/page-1.png", "placeholder_redacted", None), (2, "source.pdf", "upload", "gone.pdf"), (3, "x", "upload", None)], "doc_id bigint, artifact string, action string, source_path string")
    out = str(tmp_path / "out")
    for _ in range(2):
        got = {(r["action"]): (r["copied"], r["missing"], r["bytes"]) for r in B.flushed(B.copy_blobs(plan, out, str(tmp_path / "in"))).collect()}
        assert got["upload"] == (1, 2, 5) and got["placeholder_blank"][:2] == (1, 0) and got["placeholder_redacted"][:2] == (1, 0)
    assert (tmp_path / "out" / "1" / "source.pdf").read_bytes() == b"12345" and (tmp_path / "out" / "2" / "ocr" / "page-1.png").read_bytes()[:4] == b"\x89PNG"


def test_shared_dir(spark, monkeypatch):
    from types import SimpleNamespace

    from loomwork.storage import shared_dir

    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    unset = lambda master: SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master))
    assert shared_dir(unset("local[2]")).startswith("file:///") and shared_dir(unset("local[2]")) == shared_dir(unset("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(unset("yarn"))
