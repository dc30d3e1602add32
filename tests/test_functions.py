"""Column functions and ladders on literal rows."""

import uuid

import pytest
from pyspark.sql import functions as F

from loomwork.config import Extract
from loomwork.functions import ids, parse, timefmt
from loomwork.functions import text as T
from loomwork.operators import geometry, routing, safety
from loomwork.operators import windows as N
from loomwork.operators.chunk import chunked, pack
from loomwork.operators.merge import insert_if_absent, replace_by_key, upsert


def one(spark, column, **values):
    frame = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return frame.select(column.alias("x")).first()["x"]


def test_quality_gate(spark):
    gate = lambda text: one(spark, T.quality_gate(T.quality(F.col("t"))), t=text)
    assert gate("The quick brown fox jumps over the lazy dog again and again.")
    assert not gate("short text")
    assert not gate("")
    assert not gate("#### 1234 $$$$ 5678 %%%% 9012 &&&& 3456 **** 7890 @@@@")
    assert not gate(" ".join(["supercalifragilistic"] * 10))


def test_ratios_round_after_the_gate(spark):
    r = one(spark, T.quality_ratios(T.quality(F.col("t"))), t="abc def 1")
    assert (r["alpha_ratio"], r["wordlike_ratio"], r["mean_word_len"]) == (0.6667, 1.0, 3.0)


@pytest.mark.parametrize("text,n", [("[REDACTED] ab c\n[REDACTED]", 3), ("", 0), (None, 0), ("aé 漢", 3)])
def test_visible_chars(spark, text, n):
    assert one(spark, T.visible_chars(F.col("t").cast("string")), t=text) == n


@pytest.mark.parametrize("text,stamp", [("x ABCD00012345 y", "ABCD00012345"), ("AB-1234567", "AB-1234567"), ("A1234567", None), ("AB12345", None), (None, None)])
def test_bates(spark, text, stamp):
    assert one(spark, T.bates_stamp(F.col("t").cast("string")), t=text) == stamp


def test_pages_cover_the_whole_text(spark):
    for text in ("", "a" * 1999, "b" * 2000, "c" * 2001, "é\n" * 5000, "🙂" * 2500):
        parts = one(spark, T.pages_of(F.col("t")), t=text)
        assert "".join(parts) == text and all(len(p) <= 2000 for p in parts) and len(parts) == max(1, -(-len(text) // 2000))
    assert one(spark, T.pages_of(F.lit(None).cast("string")), t="") == [""]


def test_content_sha_keeps_null_parts(spark):
    import hashlib

    assert one(spark, T.content_sha(F.lit("m"), F.lit(None).cast("string"), F.lit("t")), t="") == hashlib.sha256(b"m\n\nt").hexdigest()


def test_identifiers(spark):
    path = "/data/DataSet-9/VOL00009/IMAGES/0001/ABCD01.PDF"
    assert one(spark, ids.dataset_key(F.col("p")), p=path) == "DataSet-9"
    assert one(spark, ids.case_key(F.col("p"), F.lit("own")), p=path) == "own"
    assert one(spark, ids.case_key(F.col("p")), p="/tmp/x.pdf") is None
    assert one(spark, ids.stem(F.col("p")), p=path) == "ABCD01"
    assert one(spark, ids.source_kind(F.col("p")), p="a/b.MP4") == "video"
    assert one(spark, ids.mime(F.col("p")), p="a/b.webp") == "image/webp"
    assert one(spark, ids.mime(F.col("p")), p="a/b") == "application/octet-stream"


def test_document_uuid_is_version_5(spark):
    assert one(spark, ids.document_uuid(F.lit("t"), F.lit("c"), F.lit("d")), p="") == str(uuid.uuid5(uuid.NAMESPACE_DNS, "t/c/d"))
    both = one(spark, ids.event_ids(*map(F.lit, ("t", "c", "s", "d"))), p="")
    assert tuple(both) == tuple(str(uuid.uuid5(uuid.UUID(ids.EVENT_NAMESPACE), f"{k}/t/c/s/d")) for k in ("ingest", "corr"))
    assert one(spark, ids.case_of(F.lit("VOL2/x"), F.col("p")), p="VOL1/x") == "VOL2" and one(spark, ids.case_of(F.lit(None).cast("string"), F.col("p")), p="VOL1/x") == "VOL1"


def test_times(spark):
    assert one(spark, timefmt.hms(F.col("s")), s=3661.9) == "01:01:01"
    assert one(spark, timefmt.vtt(F.col("s")), s=3_661_042) == "01:01:01.042"
    assert one(spark, timefmt.adaptive_interval(F.col("s"), 10), s=3600.0) == 30.0
    assert one(spark, timefmt.adaptive_interval(F.col("s"), 10), s=60.0) == 10.0
    assert [tuple(w)[1:] for w in one(spark, timefmt.windows_of(F.col("s")), s=250)] == [(0.0, 120.0), (120.0, 240.0), (240.0, 250.0)]
    assert one(spark, timefmt.floor_grid(F.col("s"), F.lit(10.0)), s=0.0) == [0.0]
    assert one(spark, timefmt.floor_grid(F.col("s"), F.lit(10.0)), s=30.0) == [0.0, 10.0, 20.0]
    assert one(spark, timefmt.rational_fps(F.col("s")), s="30000/1001") == 29.97
    assert one(spark, timefmt.rational_fps(F.col("s")), s="0/0") is None


def test_loose_values(spark):
    assert [one(spark, parse.whole(F.col("v")), v=v) for v in ("7", "7.9", "x", "", "true")] == [7, 7, 0, 0, 0]
    assert parse.first_object('noise {"a": "}", "b": {"c": 1}} tail') == '{"a": "}", "b": {"c": 1}}'
    assert parse.first_object("no { object") is None
    got = one(spark, parse.structured(F.col("v"), "a int"), v='Sure! ```json\n{"a": 3}\n```')
    assert got["a"] == 3
    assert one(spark, parse.structured(F.col("v"), "a int"), v='```json\n{"a": 4}\n```')["a"] == 4
    for body, hit in (('{"error": {"code": "content_filter"}}', True), ("the content management policy", True), ('{"error": {"code": "429"}}', False), ("", False)):
        assert one(spark, parse.content_filtered(F.col("v")), v=body) is hit


def verdict(spark, filtered=False, explicit=False, minor=False, flagged=(), severe=(), visual=True, vetted=True):
    array = lambda a: F.array(*map(F.lit, a)).cast("array<string>")
    v = safety.verdict(F.lit(filtered), F.lit(explicit), F.lit(minor), array(flagged), array(severe), F.lit(visual), F.lit(vetted))
    r = one(spark, v, t="")
    return r["csam"], r["withhold"], r["tier"]


def test_verdict_matrix(spark):
    assert verdict(spark) == (False, False, None)
    assert verdict(spark, minor=True, explicit=True) == (True, True, "csam")
    assert verdict(spark, explicit=True) == (False, True, "sexual")
    assert verdict(spark, flagged=["violence"]) == (False, True, "violence")
    assert verdict(spark, severe=["hate"]) == (False, True, "hate")
    assert verdict(spark, severe=["selfharm"]) == (False, True, "self_harm")
    assert verdict(spark, flagged=["self-harm", "violence"]) == (False, True, "self_harm")
    assert verdict(spark, filtered=True, flagged=["hate"]) == (False, True, "content_filter")
    assert verdict(spark, vetted=False) == (False, True, "unvetted")
    assert verdict(spark, vetted=False, visual=False) == (False, False, None)
    assert verdict(spark, flagged=["csam"], filtered=True) == (True, True, "csam")


def test_severity_threshold_skips_bad_values(spark):
    cats = F.array(*(F.struct(F.lit(c).alias("category"), F.lit(s).alias("severity")) for c, s in (("Hate", "4"), ("Violence", "x"), ("Sexual", "3"))))
    assert one(spark, safety.over_threshold(cats), t="") == ["hate"]


def test_absent_is_not_false(spark):
    blank = lambda visual: one(spark, safety.page_blank(F.lit("text"), F.lit("  "), F.lit(visual).cast("boolean")), t="")
    assert (blank(False), blank(True), blank(None)) == (True, False, False)


def test_page_ladders(spark):
    kind = lambda **k: one(
        spark,
        routing.page_kind(*(F.lit({"reason": "x", "ink": None, "dark": None, "runs": 0, "visible": 100, "bars": None, "coverage": 0.0, "n": 100, "images": 0, **k}[c]) for c in ("reason", "ink", "dark", "runs", "visible", "bars", "coverage", "n", "images"))),
        t="",
    )
    assert kind() == "text"
    assert kind(reason="blank", n=500) == "blank"
    assert kind(ink=0.0001) == "blank" and kind(dark=0.9999) == "blank"
    assert kind(runs=2, visible=10, bars=0.7) == "redacted" and kind(runs=2, visible=10, bars=0.5) == "text" and kind(runs=2, visible=10) == "text"
    assert kind(coverage=0.9, n=10) == "image"
    assert kind(coverage=0.3, images=1) == "mixed" and kind(coverage=0.01, images=1) == "text"
    assert kind(n=10) == "image"
    reason = lambda red=False, n=100, ink=None, gate=True, fig=False: one(spark, routing.vision_reason(F.lit(red), F.lit(n), F.lit(ink), F.lit(0.0), F.lit(gate), F.lit(fig)), t="")
    assert [reason(), reason(red=True, n=0), reason(n=5, ink=0.0001), reason(n=5, ink=0.1), reason(gate=False, fig=True), reason(fig=True)] == ["text_sufficient", "redaction_suspected", "blank", "low_text", "quality_fail", "has_figures"]
    assert [one(spark, routing.document_routing(F.lit(a), F.lit(b)), t="") for a, b in ((9, 10), (5, 10), (1, 10), (0, 0))] == ["text_primary", "mixed", "vision_primary", "vision_primary"]
    assert [one(spark, routing.pregate(F.lit(d).cast("double")), t="") for d in (0.001, 0.999, 0.5, None)] == ["blank", "black_or_redacted", None, None]
    assert [one(spark, routing.text_layer(F.lit(i), F.lit(t), F.lit(s)), t="") for i, t, s in ((0, 0, 0), (6, 10, 9), (0, 10, 3), (3, 10, 5), (6, 10, 3), (0, 10, 9))] == ["none", "ocr_layer", "born_digital", "mixed", "mixed", "mixed"]


def test_chunk_packing():
    assert pack(["a" * 400] * 6, 125, 150) == ["a" * 400] * 6
    parents = chunked(" ".join(f"Sentence number {k} is here." for k in range(400)))
    assert all(len(p) // 4 <= 650 for p, _ in parents) and all(len(c) // 4 <= 150 for _, cs in parents for c in cs)
    assert " ".join(p for p, _ in parents) == " ".join(f"Sentence number {k} is here." for k in range(400))
    assert all(" ".join(cs) == p for p, cs in parents)
    assert chunked("") == [] and chunked(None) == []
    assert "".join(c for _, cs in chunked("x" * 10_000) for c in cs) == "x" * 10_000


def test_merges(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d"), (3, "d")], "k int, v string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(insert_if_absent(old, new, ["k"])) == [(1, "a"), (2, "b"), (3, "d")]
    assert rows(replace_by_key(old, new.distinct(), ["k"])) == [(1, "a"), (2, "c"), (3, "d")]
    o = spark.createDataFrame([(1, {"x": "1", "y": "1"}), (2, None)], "k int, m map<string,string>")
    n = spark.createDataFrame([(1, {"y": "2"}), (3, {"z": "3"})], "k int, m map<string,string>")
    assert dict(map(tuple, upsert(o, n, ["k"], ("m",)).collect())) == {1: {"x": "1", "y": "2"}, 2: None, 3: {"z": "3"}}


def test_subsample_uses_a_float_step(spark):
    for n, most in ((130, 120), (10, 3), (7, 7), (5, 8), (1999, 120)):
        rows = spark.range(n).select(F.lit(1).alias("g"), "id")
        got = sorted(r["id"] for r in N.subsample(rows, ["g"], ["id"], most).collect())
        assert got == (list(range(n)) if n <= most else sorted({int(i * (n / most)) for i in range(most)}))


def test_sound_spans(spark):
    rows = [("a", 5.0, 10.0, 60.0), ("a", 8.0, 12.0, 60.0), ("a", 50.0, None, 60.0), ("b", 0.0, 60.0, 60.0), ("c", -5.0, 1.0, 2.0)]
    got = sorted(map(tuple, N.sound_spans(spark.createDataFrame(rows, "k string, a double, b double, d double"), "k", "a", "b", "d").collect()))
    assert got == [("a", 0.0, 5.0), ("a", 12.0, 50.0), ("c", 1.0, 2.0)]


def test_geometry(spark):
    box = lambda *v: F.struct(*(F.lit(float(x)).alias(n) for x, n in zip(v, ("x0", "y0", "x1", "y1"))))
    bars = F.array(box(0, 0, 10, 10))
    assert one(spark, geometry.glyph_in_bar(box(4, 4, 12, 8), bars), t="") is True
    assert one(spark, geometry.glyph_in_bar(box(8, 4, 16, 8), bars), t="") is False
    assert one(spark, geometry.line_has_bar(box(50, 4, 60, 14), bars), t="") is True
    assert one(spark, geometry.bar_coverage(bars, F.lit(400.0)), t="") == 0.25
    assert one(spark, geometry.upper_median(F.array(*map(F.lit, (4, 1, 3, 2)))), t="") == 3
    assert one(spark, geometry.clamped_dpi(F.lit(7200.0), F.lit(7200.0), 200, 40_000_000, 36), t="") == 63
    page = spark.createDataFrame([(1, [(0.0, 0.0, 10.0, 5.0), (5.0, 4.0, 20.0, 8.0), (50.0, 50.0, 60.0, 60.0)])], f"p int, bars array<{geometry.BOX}>")
    merged = geometry.merged_bars(page, "p").first()["bars"]
    assert [tuple(b) for b in merged] == [(0.0, 0.0, 20.0, 8.0), (50.0, 50.0, 60.0, 60.0)]
    cover = spark.createDataFrame([(bytearray([0, 100, 250, 255]),), (None,)], "p binary").select(geometry.pixel_coverage("p", F.lit(245), F.lit(90)).alias("c")).collect()
    assert tuple(cover[0]["c"]) == (0.5, 0.25) and cover[1]["c"]["ink"] is None


def test_config_echo():
    assert Extract().echo()["min_chars"] == 40


def test_page_flags(spark):
    flags = lambda *v: one(spark, routing.page_flags(*map(F.lit, v)), t="")
    assert flags("blank", True, 1, 0, 0, 0) == ["blank_black", "image_safety_required"]
    assert flags("blank", False, 1, 9, 3, 90) == ["slip_sheet", "heavy_invisible_layer", "image_safety_required", "rotated"]
    assert flags("blank", None, 0, 0, 0, None) == ["blank_page"] and flags("low_text", None, 0, 2, 0, 0) == []
    base = F.array(F.lit("rotated"))
    assert one(spark, routing.with_quality_flag(base, F.lit("text"), F.lit("quality_fail")), t="") == ["rotated", "low_quality_text"]
    assert one(spark, routing.with_quality_flag(base, F.lit("image"), F.lit("quality_fail")), t="") == ["rotated"]
    assert one(spark, routing.low_confidence(F.lit(False), F.array(F.lit("low_quality_text"))), t="") is True
    why = lambda kind, n, cover: one(spark, routing.kind_reason(F.lit(kind), F.lit(n), F.lit(cover), F.lit(0.7)), t="")
    assert [why("redacted", 0, 0.0), why("text", 99, 0.0), why("image", 3, 0.9), why("image", 3, 0.1)] == ["bars_cover_0.700", "text_sufficient", "full_page_image_low_text", "low_text_failsafe"]
