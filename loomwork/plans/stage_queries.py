"""Stages: media gates, windows, frames and chunks; vision gates; final counts and manifests; coverage and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import media as FM
from loomwork.operators import chunk as K
from loomwork.operators import manifests as X
from loomwork.operators import media as M
from loomwork.operators import models as P
from loomwork.operators import routing as R
from loomwork.operators import safety as S
from loomwork.operators import summary as Y
from loomwork.plans.base import PAGES, Tables, big, query
from loomwork.plans.ingest_queries import MEDIA_SQL, media_lane
from loomwork.plans.lanes import ASSETS_SQL, DOCS_SQL, PAGES_SQL, assets_lane, docs_lane, judged_lane, pages_lane

# -- media -------------------------------------------------------------------------------------------


@query(
    f"""WITH {MEDIA_SQL}, g AS (SELECT *, CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN 'error' ELSE 'ok' END AS status, doc_id % 5 = 0 AS done, doc_id % 7 <> 0 AS probed, doc_id % 4 <> 0 AS has_audio, doc_id % 3 <> 0 AS upstream FROM media)
SELECT asset, CASE WHEN status IS NULL THEN 'no_sidecar' WHEN status <> 'ok' THEN 'not_ok' WHEN NOT probed THEN 'no_probe' WHEN kind = 'image' THEN 'not_applicable' WHEN done THEN 'skipped_done' WHEN NOT has_audio THEN 'no_audio' ELSE 'run' END AS transcribe,
  CASE WHEN status IS NULL THEN 'no_sidecar' WHEN status <> 'ok' THEN 'not_ok' WHEN NOT probed THEN 'no_probe' WHEN kind = 'audio' THEN 'not_applicable' WHEN done THEN 'skipped_done' ELSE 'run' END AS frames,
  CASE WHEN status IS NULL THEN 'no_sidecar' WHEN status <> 'ok' THEN 'not_ok' WHEN NOT probed THEN 'no_probe' WHEN NOT upstream THEN 'nothing_to_do' WHEN done THEN 'skipped_done' ELSE 'run' END AS caption FROM g"""
)
def media_stage_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the media stages do with each asset."""
    d = F.col("doc_id")
    rows = media_lane(Tables(spark, sf_dir))
    status = F.when(d % 13 == 0, None).when(d % 11 == 0, "error").otherwise("ok")
    gate = lambda stage: M.gate(stage, status, F.col("kind"), d % 5 == 0, d % 7 != 0, d % 4 != 0, d % 3 != 0).alias(stage)
    return rows.select("asset", gate("transcribe"), gate("frames"), gate("caption"))


WINDOWS_SQL = f"""{MEDIA_SQL}, w AS (SELECT doc_id, asset, seconds, unnest(range(0, CAST(greatest(1, ceil(seconds / 120.0)) AS BIGINT))) AS i FROM media WHERE kind <> 'image'),
windows AS (SELECT doc_id, asset, i AS index, i * 120.0::DOUBLE AS start_s, CASE WHEN seconds > 0 THEN least((i + 1) * 120.0::DOUBLE, seconds) END AS end_s, six FROM w JOIN (SELECT asset AS a, six FROM media) ON a = asset),
sound AS (SELECT *, six <> 3 OR start_s < 100 OR coalesce(end_s, start_s) > 400 AS has_sound FROM windows)"""


def _windows(t: Tables) -> DataFrame:
    """Windows of recordings; those of every sixth kind are silent from 100 to 400 seconds."""
    rows = media_lane(t).where("kind <> 'image'").withColumnRenamed("seconds", "duration_seconds")
    silent = rows.where("six = 3").select("asset", F.lit(100.0).alias("start_s"), F.lit(400.0).alias("end_s"), "duration_seconds")
    return M.sounding(M.windows(rows), silent)


@query(f"WITH {WINDOWS_SQL} SELECT asset, index, start_s, end_s, has_sound FROM sound")
def media_sounding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of recordings and whether silence leaves anything of them."""
    return _windows(Tables(spark, sf_dir)).select("asset", "index", "start_s", "end_s", "has_sound")


@query(f"WITH {WINDOWS_SQL} SELECT count(*) AS windows, CAST(count_if(NOT has_sound) AS BIGINT) AS silent, CAST(round(sum(CASE WHEN has_sound THEN coalesce(end_s - start_s, 0) ELSE 0 END) * 10) AS BIGINT) AS tenths FROM sound")
def transcribe_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a transcription run, those skipped for silence, and the tenths of seconds that are sent."""
    made = M.transcribe_manifest(_windows(Tables(spark, sf_dir)))
    return made.select("windows", "silent", big(F.round(F.col("seconds") * 10)).alias("tenths"))


@query(f"WITH {MEDIA_SQL} SELECT kind, count(*) AS n, CAST(sum(CAST(round(seconds * 1000) AS BIGINT)) AS BIGINT) AS duration_ms FROM media GROUP BY kind")
def probe_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.probe_manifest(media_lane(Tables(spark, sf_dir)).withColumnRenamed("seconds", "duration_seconds"))


@query(
    f"""WITH {MEDIA_SQL} SELECT asset, CASE WHEN six = 0 THEN NULL ELSE seconds END AS duration_seconds, CAST(doc_id * 1000 AS BIGINT) AS bitrate, CASE WHEN kind <> 'image' THEN 'aac' END AS audio_codec, CASE WHEN kind <> 'image' THEN CAST(six AS INTEGER) END AS audio_channels,
  CASE WHEN kind <> 'audio' THEN CAST(640 AS INTEGER) END AS video_width, CASE WHEN kind = 'audio' THEN NULL WHEN six % 2 = 0 THEN round(30000::DOUBLE / 1001, 4) ELSE 25.0::DOUBLE END AS frame_rate, kind <> 'image' AS has_audio, kind <> 'audio' AS has_video FROM media"""
)
def probe_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed metadata of a probe's JSON."""
    c = F.col
    rows = media_lane(Tables(spark, sf_dir))
    audio = F.when(c("kind") != "image", F.concat(F.lit('{"codec_type":"audio","codec_name":"aac","channels":"'), c("six"), F.lit('"}')))
    video = F.when(c("kind") != "audio", F.concat(F.lit('{"codec_type":"video","width":"640","avg_frame_rate":"'), F.when(c("six") % 2 == 0, "30000/1001").otherwise("0/0"), F.lit('","r_frame_rate":"25/1"}')))
    length = F.when(c("six") == 0, "N/A").otherwise(c("seconds").cast("string"))
    probe = F.concat(F.lit('{"format":{"duration":"'), length, F.lit('","bit_rate":"'), c("doc_id") * 1000, F.lit('"},"streams":['), F.concat_ws(",", audio, video), F.lit("]}"))
    return rows.select("asset", FM.typed_metadata(probe).alias("m")).select("asset", *(f"m.{k}" for k in ("duration_seconds", "bitrate", "audio_codec", "audio_channels", "video_width", "frame_rate", "has_audio", "has_video")))


@query(
    """WITH e AS (SELECT event_id, round(value::DOUBLE, 3) AS a, round(value::DOUBLE + event_id % 50, 3) AS b FROM events)
SELECT event_id, array_to_string(list_sort(list_distinct([a, b])), ',') AS scenes, a AS silent_from, CASE WHEN event_id % 3 <> 0 THEN b END AS silent_to FROM e"""
)
def detector_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene changes and silences read from detectors' logs; the last silence may be open."""
    a, b = F.round(F.col("value").cast("double"), 3), F.round(F.col("value").cast("double") + F.col("event_id") % 50, 3)
    scenes = F.concat(F.lit("[x] pts_time:"), b, F.lit(" pos:1\n[x] pts_time:"), a, F.lit("\n[x] pts_time:"), b)
    silence = F.concat(F.lit("silence_start: "), a, F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("\nsilence_end: "), b, F.lit(" | d"))).otherwise(""))
    rows = Tables(spark, sf_dir).events.select("event_id", FM.scene_times(scenes).alias("s"), F.get(FM.silent_intervals(silence), F.lit(0)).alias("i"))
    return rows.select("event_id", F.array_join(F.transform("s", lambda x: x.cast("string")), ",").alias("scenes"), F.col("i.start_s").alias("silent_from"), F.col("i.end_s").alias("silent_to"))


FRAMES_SQL = f"""{MEDIA_SQL}, fr AS (SELECT doc_id, asset, unnest(range(0, six)) AS frame_index FROM media), frames AS (
  SELECT *, (doc_id + frame_index) % 8 AS a, (doc_id * 3 + frame_index) % 5 AS b, greatest((doc_id + frame_index) % 8, (doc_id * 3 + frame_index) % 5) AS worst FROM fr),
flagged AS (SELECT *, CASE WHEN worst >= 4 THEN 'block' WHEN worst >= 2 THEN 'review' ELSE 'ok' END AS flag FROM frames)"""


def _frames(t: Tables) -> DataFrame:
    rows = media_lane(t).where("six > 0").select("doc_id", "asset", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("six") - 1)).alias("frame_index"))
    d, i = F.col("doc_id"), F.col("frame_index")
    mark = lambda name, level: F.struct(F.lit(name).alias("category"), level.cast("string").alias("severity"))
    return M.frame_verdicts(rows.withColumn("severities", F.array(mark("Hate", (d + i) % 8), mark("Violence", (d * 3 + i) % 5), F.struct(F.lit("x").alias("category"), F.lit("n/a").alias("severity")))))


@query(
    f"""WITH {FRAMES_SQL}, c AS (SELECT *, list_filter(CASE WHEN b > a THEN ['Violence=' || b, 'Hate=' || a] ELSE ['Hate=' || a, 'Violence=' || b] END, lambda x: CAST(string_split(x, '=')[2] AS INTEGER) >= 2) AS kept FROM flagged)
SELECT asset, frame_index, CAST(worst AS INTEGER) AS max_severity, flag, flag = 'block' AS redacted, array_to_string(kept, ',') AS categories FROM c"""
)
def media_frame_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of keyframes: the worst severity decides, blocked ones are redacted."""
    named = F.array_join(F.transform("categories", lambda c: F.concat(c["category"], F.lit("="), c["severity"])), ",")
    return _frames(Tables(spark, sf_dir)).select("asset", "frame_index", "max_severity", "flag", "redacted", named.alias("categories"))


@query(f"WITH {FRAMES_SQL} SELECT asset, CAST(count_if(flag = 'block') AS BIGINT) AS n_block, CAST(count_if(flag = 'review') AS BIGINT) AS n_review, CAST(max(worst) AS INTEGER) AS max_severity, CASE WHEN count_if(flag = 'block') > 0 THEN 'block' WHEN count_if(flag = 'review') > 0 THEN 'review' ELSE 'ok' END AS flag FROM flagged GROUP BY asset")
def media_frame_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.safety_rollup(_frames(Tables(spark, sf_dir)))


@query(
    f"""WITH {FRAMES_SQL}, r AS (SELECT *, (doc_id + frame_index) % 9 <> 0 AS has_ref, (doc_id + frame_index) % 9 = 0 AND doc_id % 2 = 0 AS failed FROM flagged)
SELECT count(*) AS keyframes, CAST(count_if(has_ref AND flag <> 'block') AS BIGINT) AS embedded, CAST(count_if(flag = 'block') AS BIGINT) AS redacted, CAST(count_if(flag = 'review') AS BIGINT) AS review, CAST(count_if(flag = 'block') AS BIGINT) AS block, CAST(count_if(failed) AS BIGINT) AS errors FROM r"""
)
def frames_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a frame run."""
    missing = (F.col("doc_id") + F.col("frame_index")) % 9 == 0
    rows = _frames(Tables(spark, sf_dir))
    return M.frames_manifest(rows.withColumn("embedding_ref", F.when(~missing, F.col("asset"))).withColumn("error", F.when(missing & (F.col("doc_id") % 2 == 0), "failed")))


@query(
    f"""WITH {MEDIA_SQL}, a AS (SELECT *, CASE six WHEN 0 THEN 'error' WHEN 1 THEN 'skipped_done' WHEN 2 THEN 'nothing_to_do' ELSE 'run' END AS action, CAST(floor(seconds) AS BIGINT) AS prompt FROM media),
s AS (SELECT CAST(count_if(action = 'run') AS BIGINT) AS n_run, CAST(count_if(action = 'error') AS BIGINT) AS n_error, CAST(count_if(action = 'skipped_done') AS BIGINT) AS n_skipped_done, CAST(count_if(action = 'nothing_to_do') AS BIGINT) AS n_nothing_to_do,
  CAST(coalesce(sum(prompt) FILTER (action = 'run'), 0) AS BIGINT) AS prompt_tokens, CAST(coalesce(sum(doc_id % 90) FILTER (action = 'run'), 0) AS BIGINT) AS completion_tokens, CAST(coalesce(sum(prompt // 4) FILTER (action = 'run'), 0) AS BIGINT) AS cached_tokens FROM a)
SELECT *, CAST((prompt_tokens - cached_tokens) * 250 + cached_tokens * 25 + completion_tokens * 2000 AS BIGINT) AS cost_nano FROM s"""
)
def caption_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions, tokens and cost of a caption run."""
    six, prompt = F.col("six"), big(F.floor("seconds"))
    action = F.when(six == 0, "error").when(six == 1, "skipped_done").when(six == 2, "nothing_to_do").otherwise("run")
    return M.caption_manifest(media_lane(Tables(spark, sf_dir)).select(action.alias("action"), prompt.alias("prompt"), (F.col("doc_id") % 90).alias("completion"), big(F.floor(prompt / 4)).alias("cached")))


# Greedy packing as a recursion over the parts of a text: each step adds a part or begins the next chunk.
PACK_SQL = r"""
sentences AS (
  SELECT {keys}, unnest(x) AS t, unnest(range(1, len(x) + 1)) AS i FROM (
    SELECT {keys}, list_filter(string_split(regexp_replace(regexp_replace({text}, '^\s+|\s+$', '', 'g'), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: s <> '') AS x FROM {source})),
parent_pieces AS (SELECT {keys}, i, substring(t, 2600 * k + 1, 2600) AS t, row_number() OVER (PARTITION BY {keys} ORDER BY i, k) AS j FROM (SELECT *, unnest(range(0, CAST(ceil(length(t) / 2600.0) AS BIGINT))) AS k FROM sentences)),
parents AS (
  SELECT {keys}, j, length(t) AS size, 0 AS p FROM parent_pieces WHERE j = 1
  UNION ALL
  SELECT {k_keys}, k.j, CASE WHEN (r.size + length(k.t) + 1) // 4 > 650 OR r.size // 4 >= 500 THEN length(k.t) ELSE r.size + length(k.t) + 1 END, CASE WHEN (r.size + length(k.t) + 1) // 4 > 650 OR r.size // 4 >= 500 THEN r.p + 1 ELSE r.p END
  FROM parents r JOIN parent_pieces k ON {same} AND k.j = r.j + 1),
placed AS (SELECT {k_keys}, k.t, k.j, r.p FROM parent_pieces k JOIN parents r ON {same} AND k.j = r.j),
parent_chars AS (SELECT {keys}, p, sum(length(t)) + count(*) - 1 AS chars FROM placed GROUP BY {keys}, p),
child_pieces AS (SELECT {keys}, p, substring(t, 600 * k + 1, 600) AS t, row_number() OVER (PARTITION BY {keys}, p ORDER BY j, k) AS j FROM (SELECT *, unnest(range(0, CAST(ceil(length(t) / 600.0) AS BIGINT))) AS k FROM placed)),
children AS (
  SELECT {keys}, p, j, length(t) AS size, 0 AS c FROM child_pieces WHERE j = 1
  UNION ALL
  SELECT {k_keys}, k.p, k.j, CASE WHEN (r.size + length(k.t) + 1) // 4 > 150 OR r.size // 4 >= 125 THEN length(k.t) ELSE r.size + length(k.t) + 1 END, CASE WHEN (r.size + length(k.t) + 1) // 4 > 150 OR r.size // 4 >= 125 THEN r.c + 1 ELSE r.c END
  FROM children r JOIN child_pieces k ON {same} AND k.p = r.p AND k.j = r.j + 1),
made AS (SELECT {k_keys}, k.p, r.c, string_agg(k.t, ' ' ORDER BY k.j) AS text FROM child_pieces k JOIN children r ON {same} AND k.p = r.p AND k.j = r.j GROUP BY {k_keys}, k.p, r.c)"""


def pack_sql(source: str, text: str, *keys: str) -> str:
    return PACK_SQL.format(source=source, text=text, keys=", ".join(keys), k_keys=", ".join(f"k.{k}" for k in keys), same=" AND ".join(f"k.{k} = r.{k}" for k in keys))


CHILD_SQL = f"""WITH RECURSIVE {PAGES}, texts AS (SELECT * FROM pages_of WHERE trim(content) <> ''), {pack_sql("texts", "content", "doc_id", "page_number")},
told AS (SELECT m.*, d.lang, d.source, '[Context: This excerpt is from ' || m.doc_id || ', ' || d.lang || '/' || d.source || '. Section: page ' || m.page_number || '.]' AS context_prefix, h.chars FROM made m JOIN documents d USING (doc_id) JOIN parent_chars h ON h.doc_id = m.doc_id AND h.page_number = m.page_number AND h.p = m.p)
SELECT doc_id, lang, source, page_number, CAST(p AS BIGINT) AS parent_in_page, CAST(c AS BIGINT) AS child_index, text AS child_text, context_prefix, CAST(length(text) // 4 AS BIGINT) AS token_count, CAST(chars // 4 AS BIGINT) AS parent_tokens,
  sha256('text-embedding-3-small' || chr(10) || context_prefix || chr(10) || text) AS content_sha, 'text' AS chunk_kind, row_number() OVER (PARTITION BY doc_id ORDER BY page_number, p, c) - 1 AS chunk_index FROM told"""


@query(CHILD_SQL)
def parent_child_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of all pages with their digests, numbered through each document, which is packed in one pass over it."""
    from loomwork.functions import text as T
    from loomwork.storage import spread

    cut = spread(Tables(spark, sf_dir).documents, "doc_id").select("doc_id", "lang", "source", T.pages_of(F.col("text")).alias("cut"))
    parts = F.filter(F.transform("cut", lambda c, i: K.part(c, F.concat(F.lit("page "), i + 1), page=i + 1)), lambda p: F.trim(p["text"]) != "")
    made = K.with_identity(K.pack_documents(cut.select("doc_id", "lang", "source", parts.alias("parts")), ["doc_id", "lang", "source"]), "doc_id", "lang", "source")
    return made.select(
        "doc_id", "lang", "source", F.col("page").alias("page_number"), F.col("parent_in_part").alias("parent_in_page"), "child_index", F.col("text").alias("child_text"), "context_prefix", "token_count", "parent_tokens", "content_sha", "chunk_kind", "chunk_index",
    )


MEDIA_CHUNKS_SQL = f"""WITH RECURSIVE parts AS (
  SELECT conv_id AS asset, 0 AS list, turn AS place, '[' || printf('%02d:%02d:%02d', turn * 120 // 3600, turn * 120 % 3600 // 60, turn * 120 % 60) || ']' AS section, 'transcript' AS kind, turn * 120000 AS start_ms, turn * 120000 + 120000 AS end_ms, role AS speaker, text FROM conversations WHERE trim(text) <> ''
  UNION ALL SELECT doc_id, 1, 0, 'caption', CASE WHEN doc_id % 3 = 0 THEN 'image_caption' ELSE 'summary' END, NULL, NULL, NULL, 'A caption of ' || lang || '.' || chr(10) || chr(10) || trim(text) FROM documents WHERE trim(text) <> ''),
{pack_sql("parts", "text", "asset", "list", "place")},
n AS (SELECT m.*, q.section, q.kind, q.start_ms, q.end_ms, q.speaker, '[Context: This excerpt is from ' || m.asset || ', case/set. Section: ' || q.section || '.]' AS context_prefix FROM made m JOIN parts q ON q.asset = m.asset AND q.list = m.list AND q.place = m.place)
SELECT asset, section, kind AS chunk_kind, start_ms, end_ms, speaker, dense_rank() OVER (PARTITION BY asset ORDER BY list, place, p) - 1 AS parent_index, row_number() OVER (PARTITION BY asset ORDER BY list, place, p, c) - 1 AS chunk_index, CAST(c AS BIGINT) AS child_index, text,
  sha256('text-embedding-3-small' || chr(10) || context_prefix || chr(10) || text) AS content_sha FROM n"""


def _media_children(t: Tables) -> DataFrame:
    start = (F.col("turn") * 120).cast("double")
    windows = t.conversations.select(F.col("conv_id").alias("asset"), F.col("turn").alias("index"), start.alias("start_s"), (start + 120).alias("end_s"), F.col("role").alias("speaker"), "text")
    captions = t.documents.where(F.trim(F.coalesce("text", F.lit(""))) != "").select(F.col("doc_id").alias("asset"), F.when(F.col("doc_id") % 3 == 0, "image").otherwise("video").alias("kind"), F.concat(F.lit("A caption of "), "lang", F.lit(".")).alias("caption"), F.col("text").alias("description"))
    packed = K.pack_documents(M.chunk_parts(windows, captions), ["asset"])
    return K.with_identity(packed.withColumn("case_key", F.lit("case")).withColumn("dataset_key", F.lit("set")), "asset", "case_key", "dataset_key")


@query(MEDIA_CHUNKS_SQL)
def media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of transcripts and captions: windows in order, then the caption, numbered through each asset."""
    return _media_children(Tables(spark, sf_dir)).select("asset", "section", "chunk_kind", "start_ms", "end_ms", "speaker", "parent_index", "chunk_index", "child_index", "text", "content_sha")


@query(f"SELECT chunk_kind, count(DISTINCT (asset, parent_index)) AS parents, count(*) AS children FROM ({MEDIA_CHUNKS_SQL}) GROUP BY chunk_kind")
def media_chunk_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = _media_children(Tables(spark, sf_dir)).groupBy("chunk_kind").agg(F.count_if(F.col("child_index") == 0).alias("parents"), F.count(F.lit(1)).alias("children"))
    return by


# -- vision ------------------------------------------------------------------------------------------

DARK_SQL = f"""{ASSETS_SQL}, dark AS (SELECT j.*, CASE WHEN (doc_id + page_number) % 4 = 0 THEN NULL ELSE ((doc_id * 7 + page_number) % 300) / 299.0::DOUBLE END AS page_dark, CASE WHEN doc_id % 5 = 0 THEN ((doc_id + page_number) % 3) / 2.0::DOUBLE END AS own_dark FROM judged j),
gated AS (SELECT *, CASE WHEN kind = 'page' AND page_dark < 0.004 THEN 'blank' WHEN kind = 'page' AND page_dark > 0.995 THEN 'black_or_redacted' END AS by_page FROM dark)"""


def _pregated(t: Tables) -> DataFrame:
    d, p = F.col("doc_id"), F.col("page_number")
    dark = pages_lane(t).select("doc_id", "page_number", F.when((d + p) % 4 != 0, (d * 7 + p) % 300 / 299.0).alias("dark_coverage"))
    own = assets_lane(t).withColumn("measured_dark", F.when(d % 5 == 0, (d + p) % 3 / 2.0))
    return R.pregated(R.with_page_dark(own, dark))


@query(f"WITH {DARK_SQL} SELECT doc_id, page_number, coalesce(by_page, CASE WHEN own_dark < 0.004 THEN 'blank' WHEN own_dark > 0.995 THEN 'black_or_redacted' END) AS content_class, by_page IS NULL AND own_dark IS NOT NULL AS measured, kind = 'artifact' AS scanned FROM gated")
def asset_pregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images that darkness alone decides: a page's own share first, then the picture's; and which go to the safety scan."""
    return _pregated(Tables(spark, sf_dir)).select("doc_id", "page_number", "content_class", "measured", R.safety_scan_applies(F.col("kind")).alias("scanned"))


IMAGES_SQL = """images AS (SELECT l_orderkey AS doc_id, l_linenumber AS page_number, l_partkey % 20 AS xref, CAST(l_quantity AS BIGINT) * 10 AS width, CAST(floor(l_extendedprice) AS BIGINT) % 300 AS height, l_returnflag = 'R' AND l_partkey % 3 = 0 AS is_full_page FROM lineitem)"""


@query(f"WITH {IMAGES_SQL} SELECT doc_id, page_number, xref FROM images i WHERE xref > 0 AND least(width, height) >= 64 AND NOT EXISTS (SELECT 1 FROM images s WHERE s.is_full_page AND s.doc_id = i.doc_id AND s.xref = i.xref)")
def picture_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedded pictures without those that are a page's scan anywhere in the document, and without icons."""
    c = F.col
    rows = Tables(spark, sf_dir).lineitem.select(
        c("l_orderkey").alias("doc_id"), c("l_linenumber").alias("page_number"), (c("l_partkey") % 20).alias("xref"), (big("l_quantity") * 10).alias("width"), (big(F.floor("l_extendedprice")) % 300).alias("height"), ((c("l_returnflag") == "R") & (c("l_partkey") % 3 == 0)).alias("is_full_page"),
    )
    return R.picture_artifacts(rows).select("doc_id", "page_number", "xref")


@query(
    f"""WITH {DARK_SQL}, c AS (SELECT *, CASE WHEN by_page IS NOT NULL THEN 'pregate' WHEN judged THEN 'vision' END AS src FROM gated)
SELECT doc_id, count(*) AS assets, CAST(count_if(src = 'pregate') AS BIGINT) AS pregated, CAST(coalesce(count_if(src = 'vision'), 0) AS BIGINT) AS judged, CAST(count_if(has_visual_content) AS BIGINT) AS visual, CAST(count_if(judged AND minor) AS BIGINT) AS minor, CAST(count_if(judged AND explicit) AS BIGINT) AS explicit,
  CAST(count_if(judged AND toxic) AS BIGINT) AS review, CAST(count(embedding_ref) AS BIGINT) AS embedded, CAST(count(error_code) AS BIGINT) AS embedding_errors, CAST(coalesce(count_if(src = 'vision' AND page_number % 2 = 0), 0) AS BIGINT) AS run_calls,
  CAST(coalesce(sum(CASE WHEN src = 'vision' AND page_number % 2 = 0 THEN 1100 END), 0) AS BIGINT) AS run_prompt, CAST(coalesce(sum(CASE WHEN src = 'vision' AND page_number % 2 = 0 THEN 230 END), 0) AS BIGINT) AS run_completion FROM c GROUP BY doc_id""".replace("count_if(src = 'pregate')", "coalesce(count_if(src = 'pregate'), 0)")
)
def vision_final_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's asset counts in its final state, with the calls of this run beside them."""
    own = R.pregate(F.when(F.col("kind") == "page", F.col("dark_coverage")))
    rows = _pregated(Tables(spark, sf_dir)).withColumn("source", F.when(own.isNotNull() & ~F.col("measured"), "pregate").when(F.col("safety").isNotNull(), "vision"))
    called = (F.col("source") == "vision") & (F.col("page_number") % 2 == 0)
    return X.vision_final(rows.withColumn("embedding_error", F.col("error_code")).withColumn("prompt", F.when(called, F.lit(1100).cast("bigint"))).withColumn("completion", F.when(called, F.lit(230).cast("bigint"))))


# -- final counts and manifests -----------------------------------------------------------------------

FINAL_SQL = f"""{PAGES_SQL}, st AS (SELECT *, CASE WHEN page_kind = 'blank' THEN NULL WHEN content_filtered THEN 'filtered' WHEN page_number % 7 = 6 THEN 'error' ELSE 'ok' END AS status FROM lane_pages),
tok AS (SELECT *, CASE WHEN status = 'ok' THEN CAST(length(content) // 4 AS BIGINT) END AS input_tokens, CASE WHEN status = 'ok' THEN CAST(40 + page_number AS BIGINT) END AS output_tokens FROM st),
by_doc AS (SELECT doc_id, CAST(count_if(coalesce(status, '') = 'ok') AS BIGINT) AS summarized, CAST(count_if(coalesce(status, '') = 'filtered') AS BIGINT) AS filtered, CAST(count_if(coalesce(status, '') = 'error') AS BIGINT) AS failed, CAST(count_if(length(content) = 2000) AS BIGINT) AS truncated, CAST(coalesce(sum(input_tokens), 0) AS BIGINT) AS pp, CAST(coalesce(sum(output_tokens), 0) AS BIGINT) AS pc FROM tok GROUP BY doc_id),
fin AS (SELECT b.doc_id, summarized, filtered, failed, truncated, summarized + CASE WHEN b.doc_id % 2 = 0 THEN 2 ELSE 0 END AS calls, pp + CASE WHEN b.doc_id % 2 = 0 THEN 300 ELSE 0 END AS prompt_tokens, pc + CASE WHEN b.doc_id % 2 = 0 THEN 90 ELSE 0 END AS completion_tokens FROM by_doc b),
finals AS (SELECT *, CAST(prompt_tokens * 100 + completion_tokens * 400 AS BIGINT) AS cost_nano FROM fin)"""


def _finals(t: Tables) -> DataFrame:
    p = F.col("page_number")
    rows = pages_lane(t).withColumn("status", F.when(F.col("page_kind") == "blank", None).when(F.col("content_filtered"), "filtered").when(p % 7 == 6, "error").otherwise("ok"))
    ok = F.col("status") == "ok"
    rows = rows.select("doc_id", "page_number", "status", (F.col("n_chars") == 2000).alias("truncated"), F.when(ok, big(F.floor(F.col("n_chars") / 4))).alias("input_tokens"), F.when(ok, big(p + 40)).alias("output_tokens"))
    reduces = t.documents.where("doc_id % 2 = 0").select("doc_id", F.lit(2).cast("bigint").alias("calls"), F.lit(300).cast("bigint").alias("prompt"), F.lit(90).cast("bigint").alias("completion"))
    return X.summaries_final(rows, reduces)


@query(f"WITH {FINAL_SQL} SELECT * FROM finals")
def summaries_final_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's summaries, tokens and cost from the state of all its pages, whichever run made them."""
    return _finals(Tables(spark, sf_dir))


ACTION_SQL = "CASE WHEN status IS NULL THEN 'no_sidecar' WHEN status <> 'ok' THEN 'skipped_status' WHEN doc_id % 6 = 0 THEN 'skipped_done' WHEN doc_id % 17 = 0 THEN 'errored' ELSE 'done' END"


def _acted(t: Tables) -> DataFrame:
    d = F.col("doc_id")
    action = F.when(F.col("status").isNull(), "no_sidecar").when(F.col("status") != "ok", "skipped_status").when(d % 6 == 0, "skipped_done").when(d % 17 == 0, "errored").otherwise("done")
    return docs_lane(t).select("doc_id", action.alias("action"), F.when(action == "errored", F.concat(F.lit("code_"), d % 3)).alias("error_code"))


@query(
    f"""WITH {DOCS_SQL}, {FINAL_SQL}, a AS (SELECT f.*, {ACTION_SQL} AS action FROM lane_docs d JOIN finals f USING (doc_id))
SELECT count(*) AS seen, CAST(count_if(action = 'no_sidecar') AS BIGINT) AS no_sidecar, CAST(count_if(action = 'skipped_status') AS BIGINT) AS skipped_status, CAST(count_if(action = 'skipped_done') AS BIGINT) AS skipped_done, CAST(count_if(action = 'errored') AS BIGINT) AS errored, CAST(count_if(action = 'done') AS BIGINT) AS done,
  CAST(sum(summarized) FILTER (action = 'done') AS BIGINT) AS summarized, CAST(sum(prompt_tokens) FILTER (action = 'done') AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) FILTER (action = 'done') AS BIGINT) AS completion_tokens, CAST(sum(cost_nano) FILTER (action = 'done') AS BIGINT) AS cost_nano FROM a"""
)
def summaries_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a summary run: documents by action, and sums over those that were done."""
    t = Tables(spark, sf_dir)
    return X.run_manifest(_acted(t).join(_finals(t), "doc_id"), ["summarized", "prompt_tokens", "completion_tokens", "cost_nano"])


@query(
    f"""WITH {DOCS_SQL}, {ASSETS_SQL}, v AS (SELECT doc_id, count(*) AS assets, CAST(count_if(withhold) AS BIGINT) AS withheld, CAST(count(embedding_ref) AS BIGINT) AS embedded FROM judged GROUP BY doc_id), a AS (SELECT v.*, {ACTION_SQL} AS action FROM lane_docs d JOIN v USING (doc_id))
SELECT count(*) AS seen, CAST(count_if(action = 'no_sidecar') AS BIGINT) AS no_sidecar, CAST(count_if(action = 'skipped_status') AS BIGINT) AS skipped_status, CAST(count_if(action = 'skipped_done') AS BIGINT) AS skipped_done, CAST(count_if(action = 'errored') AS BIGINT) AS errored, CAST(count_if(action = 'done') AS BIGINT) AS done,
  CAST(sum(assets) FILTER (action = 'done') AS BIGINT) AS assets, CAST(sum(withheld) FILTER (action = 'done') AS BIGINT) AS withheld, CAST(sum(embedded) FILTER (action = 'done') AS BIGINT) AS embedded FROM a"""
)
def vision_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a vision run, with its safety and embedding counters."""
    t = Tables(spark, sf_dir)
    by = judged_lane(t).groupBy("doc_id").agg(F.count(F.lit(1)).alias("assets"), F.count_if("v.withhold").alias("withheld"), F.count("embedding_ref").alias("embedded"))
    return X.run_manifest(_acted(t).join(by, "doc_id"), ["assets", "withheld", "embedded"])


@query(f"WITH {DOCS_SQL}, a AS (SELECT doc_id, {ACTION_SQL} AS action FROM lane_docs) SELECT doc_id, 'code_' || (doc_id % 3) AS error_code FROM a WHERE action = 'errored'")
def run_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.run_errors(_acted(Tables(spark, sf_dir)), "doc_id")


@query(f"WITH {DOCS_SQL}, a AS (SELECT doc_id, {ACTION_SQL} AS action FROM lane_docs) SELECT * FROM (VALUES ('caption', CAST(0 AS BIGINT))) t(stage, errored) UNION ALL SELECT 'frames', CAST(count_if(doc_id % 2 = 1) AS BIGINT) FROM a WHERE action = 'errored' UNION ALL SELECT 'transcribe', CAST(count_if(doc_id % 2 = 0) AS BIGINT) FROM a WHERE action = 'errored'")
def errored_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left in error by stage, from the runs' manifests; a stage without one counts none."""
    acted = _acted(Tables(spark, sf_dir)).withColumn("stage", F.when(F.col("doc_id") % 2 == 0, "transcribe").otherwise("frames"))
    manifests = acted.groupBy("stage").agg(F.count_if(F.col("action") == "errored").alias("errored"))
    return X.errored_totals(manifests, ["transcribe", "frames", "caption"])


@query("WITH p AS (SELECT user_id AS key, count(*) FILTER (event_type = 'click') AS done, count(*) AS total, CAST(max(event_id) % 100 AS DOUBLE) AS elapsed_s FROM events GROUP BY user_id), r AS (SELECT *, CASE WHEN done > 0 AND elapsed_s > 0 THEN done / elapsed_s END AS rate FROM p) SELECT key, done, total, round(rate, 6) AS rate, round((total - done) / rate, 6) AS eta_s FROM r")
def run_heartbeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and remaining time of runs."""
    by = Tables(spark, sf_dir).events.groupBy(F.col("user_id").alias("key")).agg(F.count_if(F.col("event_type") == "click").alias("done"), F.count(F.lit(1)).alias("total"), (F.max("event_id") % 100).cast("double").alias("elapsed_s"))
    return X.heartbeat(by).select("key", "done", "total", F.round("rate", 6).alias("rate"), F.round("eta_s", 6).alias("eta_s"))


# -- coverage, grids, warnings ---------------------------------------------------------------------------

COVER_SQL = f"""{PAGES_SQL}, seen AS (SELECT DISTINCT content_sha FROM lane_pages WHERE doc_id % 3 <> 0)"""


@query(f"WITH {COVER_SQL} SELECT p.doc_id, count(*) AS n_children, CAST(count_if(s.content_sha IS NULL) AS BIGINT) AS n_missing, count_if(s.content_sha IS NULL) = 0 AS covered FROM lane_pages p LEFT JOIN seen s USING (content_sha) GROUP BY p.doc_id")
def guard_full_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether all children of a document have a vector in the store, for every document; models.full_coverage stops a job at the first that hasn't."""
    rows = pages_lane(Tables(spark, sf_dir)).select("doc_id", "content_sha")
    return P.coverage(rows, rows.where("doc_id % 3 <> 0").select("content_sha"), "doc_id")


DIGEST_SQL = f"""{DOCS_SQL}, {ASSETS_SQL}, assets AS (SELECT doc_id, CAST(count_if(has_visual_content) AS INTEGER) AS has_visual, CAST(count(embedding_ref) FILTER (has_visual_content) AS INTEGER) AS embedded_ref, CAST(count(error_code) AS INTEGER) AS embed_errors, count(*) AS n FROM judged GROUP BY doc_id),
digest AS (SELECT d.source AS dataset, d.doc_id, d.status, d.page_count, a.n > 1 AS has_image_assets, d.doc_id % 2 = 0 AS s2, d.doc_id % 3 <> 0 AS s3, d.doc_id % 5 <> 0 AS s4, d.doc_id % 7 <> 0 AS s5, d.doc_id % 4 <> 0 AS s6, d.doc_id % 8 = 1 AS s6_empty, d.page_count AS s6_children, d.page_count AS child_total, CASE WHEN d.doc_id % 3 = 0 THEN d.page_count - 1 ELSE d.page_count END AS child_embedded, false AS s8_done, a.has_visual, a.embedded_ref, a.embed_errors FROM lane_docs d JOIN assets a USING (doc_id))"""


def _digest(t: Tables) -> DataFrame:
    d, n = F.col("doc_id"), F.col("page_count")
    by = assets_lane(t).groupBy("doc_id").agg(F.count_if("has_visual_content").cast("int").alias("has_visual"), F.count(F.when(F.col("has_visual_content"), F.col("embedding_ref"))).cast("int").alias("embedded_ref"), F.count("error_code").cast("int").alias("embed_errors"), F.count(F.lit(1)).alias("n"))
    return docs_lane(t).join(by, "doc_id").select(
        F.col("source").alias("dataset"), "doc_id", "status", "page_count", (F.col("n") > 1).alias("has_image_assets"), (d % 2 == 0).alias("s2"), (d % 3 != 0).alias("s3"), (d % 5 != 0).alias("s4"), (d % 7 != 0).alias("s5"), (d % 4 != 0).alias("s6"), (d % 8 == 1).alias("s6_empty"),
        n.alias("s6_children"), n.alias("child_total"), F.when(d % 3 == 0, n - 1).otherwise(n).alias("child_embedded"), F.lit(False).alias("s8_done"), "has_visual", "embedded_ref", "embed_errors",
    )


STAGE_ROWS = [
    ("stage1", "true", "status IN ('ok', 'error')"), ("stage2", "status = 'ok'", "s2"), ("stage3", "status = 'ok'", "s3"), ("stage4", "status = 'ok' AND has_image_assets", "s4"), ("stage5", "status = 'ok'", "s5"),
    ("stage6", "status = 'ok' AND page_count > 0", "s6"), ("stage7", "status = 'ok' AND s6 AND NOT s6_empty AND s6_children > 0", "child_total > 0 AND child_embedded >= child_total"), ("stage8", "status = 'ok'", "s8_done"),
]
GRID_SQL = " UNION ALL ".join(f"SELECT dataset, '{s}' AS stage, CAST(coalesce(count_if({a}), 0) AS BIGINT) AS applicable, CAST(coalesce(count_if(({a}) AND ({d})), 0) AS BIGINT) AS done FROM digest GROUP BY GROUPING SETS ((dataset), ())" for s, a, d in STAGE_ROWS)


@query(
    f"""WITH {DIGEST_SQL}, g AS ({GRID_SQL}), s AS (SELECT *, CASE WHEN dataset IS NULL THEN true ELSE dataset <> 'src1' END AS present, CASE WHEN dataset IS NULL THEN false ELSE dataset <> 'src2' END AS aware FROM g)
SELECT dataset, stage, applicable, done, CASE WHEN stage = 'stage7' AND NOT present THEN CASE WHEN applicable > 0 THEN 'not_started' ELSE 'n/a' END WHEN stage = 'stage7' AND NOT aware THEN 'n/a' WHEN stage = 'stage8' AND done = 0 THEN 'n/a'
    WHEN applicable = 0 THEN 'n/a' WHEN done = 0 THEN 'not_started' WHEN done >= applicable THEN 'done' ELSE 'in_progress' END AS state,
  CASE WHEN (stage = 'stage7' AND present AND NOT aware) OR (stage = 'stage8' AND done = 0) OR applicable = 0 THEN NULL ELSE CAST((done * 2000 + applicable) // (applicable * 2) AS BIGINT) END AS permille FROM s"""
)
def stage_progress_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of eight stages by dataset and for the corpus."""
    t = Tables(spark, sf_dir)
    stores = t.documents.select(F.col("source").alias("dataset")).distinct().select("dataset", (F.col("dataset") != "src1").alias("store_present"), (F.col("dataset") != "src2").alias("store_aware"))
    return Y.stage_grid(_digest(t), stores)


GAPS_SQL = """cov AS (SELECT dataset, CAST(sum(has_visual) AS BIGINT) AS has_visual, CAST(sum(embedded_ref) AS BIGINT) AS embedded, CAST(sum(greatest(has_visual - embedded_ref, 0)) AS BIGINT) AS not_embedded, CAST(sum(embed_errors) AS BIGINT) AS embed_errors, CAST(count_if(has_visual > embedded_ref OR embed_errors > 0) AS BIGINT) AS docs_with_gap FROM digest WHERE s4 GROUP BY GROUPING SETS ((dataset), ()))"""


@query(f"WITH {DIGEST_SQL}, {GAPS_SQL} SELECT *, CASE WHEN has_visual > 0 THEN CAST((embedded * 2000 + has_visual) // (has_visual * 2) AS BIGINT) END AS permille FROM cov")
def vision_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets worth seeing and those with a vector."""
    return Y.vision_coverage(_digest(Tables(spark, sf_dir)))


@query(f"WITH {DIGEST_SQL}, {GAPS_SQL} SELECT dataset, dataset || ': ' || docs_with_gap || ' documents are missing vision embeddings (' || not_embedded || ' assets, ' || embed_errors || ' errors); run stage 4 again' AS warning FROM cov WHERE dataset IS NOT NULL AND docs_with_gap > 0")
def coverage_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.warnings(Y.vision_coverage(_digest(Tables(spark, sf_dir))))


@query(f"WITH {PAGES_SQL} SELECT doc_id, page_number, page_kind = 'blank' OR (trim(content) = '' AND NOT has_visual_content) AS blank FROM lane_pages")
def page_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages_lane(Tables(spark, sf_dir))
    return rows.select("doc_id", "page_number", S.page_blank(F.col("page_kind"), F.when(F.col("empty"), "").otherwise("x"), F.col("has_visual_content")).alias("blank"))
