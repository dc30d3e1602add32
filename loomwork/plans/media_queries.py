"""Chunks, transcripts, media windows, samples, rate windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.config import Media
from loomwork.functions import text as T
from loomwork.functions import timefmt as M
from loomwork.operators import geometry as G
from loomwork.operators import safety as S
from loomwork.operators import windows as N
from loomwork.plans.base import PAGES, Tables, big, pages, query


@query("SELECT CASE role WHEN 'assistant' THEN 'summary' WHEN 'user' THEN 'transcript' ELSE 'image_caption' END AS chunk_kind, count(*) AS n_children, count(DISTINCT conv_id) AS n_documents FROM conversations GROUP BY 1")
def chunk_counts_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("role") == "assistant", "summary").when(F.col("role") == "user", "transcript").otherwise("image_caption")
    by = Tables(spark, sf_dir).conversations.groupBy(kind.alias("chunk_kind"), "conv_id").agg(F.count(F.lit(1)).alias("n"))
    return by.groupBy("chunk_kind").agg(F.sum("n").alias("n_children"), F.count(F.lit(1)).alias("n_documents"))


@query(
    """WITH d AS (SELECT event_id, CAST(floor(value) AS BIGINT) * 7 AS dur FROM events), n AS (SELECT *, unnest(range(0, CAST(greatest(1, ceil(dur / 120.0)) AS BIGINT))) AS i FROM d)
SELECT event_id, i AS window_index, CAST(i * 120 AS DOUBLE) AS start_s, CASE WHEN dur > 0 THEN CAST(least((i + 1) * 120, dur) AS DOUBLE) END AS end_s FROM n"""
)
def transcript_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 120 s over each recording; an event's value stands for its length."""
    seconds = big(F.floor("value")) * 7
    rows = Tables(spark, sf_dir).events.select("event_id", F.explode(M.windows_of(seconds)).alias("w"))
    return rows.select("event_id", F.col("w.index").alias("window_index"), "w.start_s", "w.end_s")


@query(
    """SELECT conv_id, count(*) AS n_windows, sha256(string_agg('## [' || printf('%02d:%02d:%02d', turn * 120 // 3600, turn * 120 % 3600 // 60, turn * 120 % 60) || ']' || chr(10) || trim(text), chr(10) || chr(10) ORDER BY turn)) AS markdown_sha
FROM conversations WHERE trim(coalesce(text, '')) <> '' GROUP BY conv_id"""
)
def transcript_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Tables(spark, sf_dir).conversations.where(F.trim(F.coalesce("text", F.lit(""))) != "")
    line = F.concat(F.lit("## ["), M.hms(F.col("turn") * Media.window_s), F.lit("]\n"), F.trim("text"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"]), "\n\n")
    return rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_windows"), F.sha2(joined, 256).alias("markdown_sha"))


@query(
    """WITH t AS (SELECT conv_id, turn, text, turn * 4321 AS a, turn * 4321 + 4000 AS b FROM conversations)
SELECT conv_id, sha256('WEBVTT' || chr(10) || string_agg(chr(10) || printf('%02d:%02d:%02d.%03d', a // 3600000, a % 3600000 // 60000, a % 60000 // 1000, a % 1000) || ' --> ' || printf('%02d:%02d:%02d.%03d', b // 3600000, b % 3600000 // 60000, b % 60000 // 1000, b % 1000) || chr(10) || text || chr(10), '' ORDER BY turn)) AS vtt_sha
FROM t GROUP BY conv_id"""
)
def transcript_vtt(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("turn") * 4321
    cue = F.concat(F.lit("\n"), M.vtt(start), F.lit(" --> "), M.vtt(start + 4000), F.lit("\n"), "text", F.lit("\n"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", cue.alias("cue")))), lambda x: x["cue"]), "")
    return Tables(spark, sf_dir).conversations.groupBy("conv_id").agg(F.sha2(F.concat(F.lit("WEBVTT\n"), joined), 256).alias("vtt_sha"))


SILENT_SQL = """silent AS (
  SELECT user_id, CAST(epoch(ts) - epoch(TIMESTAMP '2024-01-01') AS DOUBLE) AS a, CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(epoch(ts) - epoch(TIMESTAMP '2024-01-01') AS DOUBLE) + event_id % 3000 END AS b, 2592000.0::DOUBLE AS d FROM events WHERE event_id % 2 = 0),
cut AS (SELECT user_id, d, greatest(0, least(a, d)) AS a, least(coalesce(b, d), d) AS b FROM silent),
upto AS (SELECT *, coalesce(max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS u FROM cut),
spans AS (
  SELECT user_id, u AS span_start, a AS span_end FROM upto WHERE a > u
  UNION ALL SELECT user_id, max(b), max(d) FROM cut GROUP BY user_id HAVING max(b) < max(d))"""


def _seconds(ts: str = "ts") -> Column:
    return (F.unix_seconds(F.col(ts).cast("timestamp")) - 1704067200).cast("double")


def _spans(t: Tables) -> DataFrame:
    a = _seconds()
    silent = t.events.where("event_id % 2 = 0").select("user_id", a.alias("a"), F.when(F.col("event_id") % 97 != 0, a + F.col("event_id") % 3000).alias("b"), F.lit(2592000.0).alias("d"))
    return N.sound_spans(silent, "user_id", "a", "b", "d")


@query(f"WITH {SILENT_SQL} SELECT user_id, span_start, span_end FROM spans".replace("epoch(ts)", "floor(epoch(ts))"))
def silence_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(Tables(spark, sf_dir))


@query(
    f"""WITH {SILENT_SQL}, w AS (SELECT event_id, user_id, CAST(epoch(ts) - epoch(TIMESTAMP '2024-01-01') AS DOUBLE) AS s FROM events WHERE event_id % 2 = 1)
SELECT event_id, user_id FROM w WHERE EXISTS (SELECT 1 FROM spans p WHERE p.user_id = w.user_id AND p.span_start < w.s + 60 AND p.span_end > w.s)""".replace("epoch(ts)", "floor(epoch(ts))")
)
def window_has_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    rows = t.events.where("event_id % 2 = 1").select("event_id", "user_id", _seconds().alias("start_s"), (_seconds() + 60).alias("end_s"))
    return N.overlapping(rows, _spans(t), "user_id", 3600).select("event_id", "user_id")


@query(
    """SELECT event_id, count(*) OVER w AS requests, CAST(sum(CAST(floor(value) AS BIGINT)) OVER w AS BIGINT) AS tokens_in_window
FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events) WINDOW w AS (PARTITION BY event_type, user_id ORDER BY s RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW)"""
)
def sliding_rate_limiter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Tables(spark, sf_dir).events.select("event_id", "ts", F.struct("event_type", "user_id").alias("deployment"), big(F.floor("value")).alias("tokens"))
    return N.rate_usage(rows, "deployment", "ts", "tokens", 3600).select("event_id", "requests", "tokens_in_window")


@query("SELECT source, doc_id, CAST(r AS INTEGER) AS rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 3")
def first_k_per_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.first_k(Tables(spark, sf_dir).documents.select("source", "doc_id"), "source", ["doc_id"], 3)


@query(
    """WITH n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS place, count(*) OVER (PARTITION BY user_id) AS n FROM events),
i AS (SELECT unnest(range(0, 8)) AS i)
SELECT user_id, event_id FROM n WHERE n <= 8 UNION ALL SELECT user_id, event_id FROM n JOIN i ON place = CAST(floor(i * (CAST(n AS DOUBLE) / 8)) AS BIGINT) WHERE n > 8"""
)
def subsample_evenly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.subsample(Tables(spark, sf_dir).events.select("user_id", "event_id"), ["user_id"], ["event_id"], Media.caption_frames).select("user_id", "event_id")


@query("SELECT conv_id, role, turn, row_number() OVER (PARTITION BY conv_id ORDER BY role, turn) - 1 AS chunk_index FROM conversations")
def continuous_reindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.reindexed(Tables(spark, sf_dir).conversations.select("conv_id", "role", "turn"), "conv_id", ["role", "turn"])


@query(
    """WITH d AS (SELECT event_id, CAST(value AS DOUBLE) AS dur FROM events)
SELECT event_id, len(list_filter(list_transform(range(0, CAST(floor(dur / 10.0) AS BIGINT) + 1), lambda i: i * 10.0::DOUBLE), lambda x: x < dur)) AS n_grid, (0 + 0.5) / 5 * dur AS first_centre, (4 + 0.5) / 5 * dur AS last_centre,
  greatest(10.0::DOUBLE, CAST(ceil(dur / 120) AS DOUBLE)) AS step FROM d WHERE dur > 0"""
)
def frame_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("value").cast("double")
    centres = M.even_centres(d, F.lit(5).cast("bigint"))
    rows = Tables(spark, sf_dir).events.where("value > 0")
    return rows.select("event_id", big(F.size(M.floor_grid(d, F.lit(10.0)))).alias("n_grid"), centres[0].alias("first_centre"), centres[4].alias("last_centre"), M.adaptive_interval(d, 10).alias("step"))


@query("SELECT l_suppkey, list_sort(list(l_quantity))[len(list(l_quantity)) // 2 + 1] AS body_size FROM lineitem GROUP BY l_suppkey")
def body_size_upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper median of sizes; sizes are counted first, so a key brings one row for each distinct size, not one for each glyph."""
    sizes = Tables(spark, sf_dir).lineitem.groupBy("l_suppkey", "l_quantity").agg(F.count(F.lit(1)).alias("n"))
    here = W.partitionBy("l_suppkey")
    upto = F.sum("n").over(here.orderBy("l_quantity"))
    rows = sizes.select("l_suppkey", "l_quantity", upto.alias("upto"), F.floor(F.sum("n").over(here) / 2).alias("half"))
    return rows.where("upto > half").groupBy("l_suppkey").agg(F.min("l_quantity").alias("body_size"))


@query("SELECT event_id, sev, CASE WHEN sev >= 4 THEN 'block' WHEN sev >= 2 THEN 'review' ELSE 'ok' END AS flag FROM (SELECT event_id, CAST(floor(value) AS BIGINT) % 7 AS sev FROM events)")
def severity_flagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    sev = big(F.floor("value")) % 7
    return Tables(spark, sf_dir).events.select("event_id", sev.alias("sev"), S.severity_flag(sev).alias("flag"))


@query("SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 32 AS batch FROM events")
def fixed_size_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.bounded_batches(Tables(spark, sf_dir).events.select("user_id", "event_id", "ts"), ["ts", "event_id"], "user_id", 32).select("user_id", "event_id", "batch")


BOX_SQL = """boxes AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 500 AS DOUBLE) AS x0, CAST(l_suppkey * 7 % 700 AS DOUBLE) AS y0, CAST(l_partkey % 500 AS DOUBLE) + l_quantity AS x1, CAST(l_suppkey * 7 % 700 AS DOUBLE) + l_quantity / 2 AS y1, l_returnflag = 'R' AS is_bar FROM lineitem)"""


@query(
    f"""WITH {BOX_SQL}
SELECT l_orderkey, l_linenumber, EXISTS (SELECT 1 FROM boxes b WHERE b.is_bar AND b.l_orderkey = a.l_orderkey AND (a.x1 - a.x0) * (a.y1 - a.y0) > 0
  AND greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) >= (a.x1 - a.x0) * (a.y1 - a.y0) * 0.5) AS covered
FROM boxes a WHERE NOT is_bar"""
)
def glyphs_under_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Glyph boxes of each page (order) at least half covered by a bar; a page's bars travel as one array to its glyphs."""
    x, y, q = (F.col("l_partkey") % 500).cast("double"), (F.col("l_suppkey") * 7 % 700).cast("double"), F.col("l_quantity")
    box = F.struct(x.alias("x0"), y.alias("y0"), (x + q).alias("x1"), (y + q / 2).alias("y1"))
    rows = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", box.alias("box"), (F.col("l_returnflag") == "R").alias("is_bar"))
    per_page = rows.groupBy("l_orderkey").agg(F.collect_list(F.when(F.col("is_bar"), F.col("box"))).alias("bars"), F.collect_list(F.when(~F.col("is_bar"), F.struct("l_linenumber", "box"))).alias("glyphs"))
    each = per_page.select("l_orderkey", "bars", F.explode("glyphs").alias("g"))
    return each.select("l_orderkey", "g.l_linenumber", G.glyph_in_bar(F.col("g.box"), F.col("bars")).alias("covered"))


@query(f"WITH {PAGES}, c AS (SELECT doc_id, page_number, sha256('text-embedding-3-small' || chr(10) || '' || chr(10) || content) AS s FROM pages_of) SELECT count(*) AS n_children, count(DISTINCT s) AS n_unique FROM c")
def page_dedup_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages(Tables(spark, sf_dir)).groupBy(T.content_sha(F.lit("text-embedding-3-small"), F.lit(None).cast("string"), F.col("content")).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return rows.agg(F.sum("n").alias("n_children"), F.count(F.lit(1)).alias("n_unique"))
