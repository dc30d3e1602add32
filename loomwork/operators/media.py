"""Media lane: gates, window skipping, frame verdicts, transcripts, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.config import Media
from loomwork.functions import text as T
from loomwork.functions import timefmt as M
from loomwork.operators import chunk as K
from loomwork.operators import windows as N
from loomwork.operators.safety import severity_flag


def gate(stage: str, status: Column, kind: Column, done: Column, probed: Column, has_audio: Column, upstream: Column) -> Column:
    """What a media stage (transcribe, frames, caption, chunk) does with an asset; first match wins."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    out = F.when(status.isNull(), "no_sidecar").when(status != "ok", "not_ok").when(~yes(probed), "no_probe")
    if stage == "transcribe":
        out = out.when(~kind.isin("audio", "video"), "not_applicable").when(yes(done), "skipped_done").when(~yes(has_audio), "no_audio")
    elif stage == "frames":
        out = out.when(~kind.isin("video", "image"), "not_applicable").when(yes(done), "skipped_done")
    else:
        out = out.when(~yes(upstream), "nothing_to_do").when(yes(done), "skipped_done")
    return out.otherwise("run")


def windows(assets: DataFrame, width: int = Media.window_s) -> DataFrame:
    """asset, index, start_s, end_s of the transcript windows; assets: asset, duration_seconds."""
    return assets.select("asset", F.explode(M.windows_of(F.col("duration_seconds"), width)).alias("w")).select("asset", "w.*")


def sounding(rows: DataFrame, silent: DataFrame, width: int = Media.window_s) -> DataFrame:
    """Windows with has_sound: those of recordings without silence, or that overlap what silence leaves.  silent: asset, start_s, end_s, duration_seconds."""
    spans = N.sound_spans(silent, "asset", "start_s", "end_s", "duration_seconds")
    heard = N.overlapping(rows.select("asset", "index", "start_s", "end_s"), spans, "asset", width).select("asset", "index", F.lit(True).alias("heard"))
    any_silence = silent.select("asset", F.lit(True).alias("cut")).distinct()
    joined = rows.join(any_silence, "asset", "left").join(heard, ["asset", "index"], "left")
    return joined.withColumn("has_sound", F.coalesce("heard", F.col("cut").isNull())).drop("heard", "cut")


def frame_verdicts(frames: DataFrame, cfg: Media = Media()) -> DataFrame:
    """frames (asset, frame_index, severities array<struct<category, severity>>) with max_severity, flag, categories worth a review (worst first), and redacted: blocked imagery is never embedded."""
    worst = F.coalesce(F.array_max(F.transform("severities", lambda s: F.coalesce(s["severity"].try_cast("int"), F.lit(0)))), F.lit(0))
    number = lambda s: F.coalesce(s["severity"].try_cast("int"), F.lit(0))
    listed = F.transform(F.filter("severities", lambda s: number(s) >= cfg.review), lambda s: F.struct((-number(s)).alias("order"), s["category"].alias("category")))
    kept = F.transform(F.array_sort(listed), lambda s: F.struct(s["category"].alias("category"), (-s["order"]).alias("severity")))
    return frames.select("*", worst.alias("max_severity"), severity_flag(worst, cfg).alias("flag"), kept.alias("categories"), (worst >= cfg.block).alias("redacted"))


def safety_rollup(frames: DataFrame) -> DataFrame:
    """asset, n_block, n_review, max_severity, flag."""
    by = frames.groupBy("asset").agg(F.count_if(F.col("flag") == "block").alias("n_block"), F.count_if(F.col("flag") == "review").alias("n_review"), F.max("max_severity").alias("max_severity"))
    return by.withColumn("flag", F.when(F.col("n_block") > 0, "block").when(F.col("n_review") > 0, "review").otherwise("ok"))


def transcripts(rows: DataFrame, key: str = "asset") -> DataFrame:
    """key, markdown and vtt of the windows with text, in order; rows: key, index, start_s, end_s, text."""
    said = rows.where(F.trim(F.coalesce("text", F.lit(""))) != "")
    ms = lambda c: F.round(F.coalesce(c, F.lit(0.0)) * 1000).cast("bigint")
    heading = F.concat(F.lit("## ["), M.hms(F.col("start_s")), F.lit("]\n"), F.trim("text"))
    cue = F.concat(M.vtt(ms(F.col("start_s"))), F.lit(" --> "), M.vtt(ms(F.coalesce("end_s", "start_s"))), F.lit("\n"), F.trim("text"))
    by = said.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("index", heading.alias("h"), cue.alias("c")))).alias("w"))
    text = lambda f: F.array_join(F.transform("w", lambda x: x[f]), "\n\n")
    return by.select(key, F.concat(text("h"), F.lit("\n")).alias("markdown"), F.concat(F.lit("WEBVTT\n\n"), text("c"), F.lit("\n")).alias("vtt"))


def chunk_parts(windows: DataFrame, captions: DataFrame, key: str = "asset") -> DataFrame:
    """key, parts for chunk.pack_documents: the windows with text as transcript parts, in order, then caption and description.

    windows: key, index, start_s, end_s, speaker, text; captions: key, kind, caption, description.  A caption is a
    summary of audio and video and an image_caption of images; assets without any text have no row.
    """
    ms = lambda c: F.round(F.coalesce(c, F.lit(0.0)) * 1000).cast("bigint")
    at = F.struct(F.lit(0).alias("list"), F.col("index").cast("bigint").alias("index"))
    said = windows.where(F.trim(F.coalesce("text", F.lit(""))) != "")
    clock = F.concat(F.lit("["), M.hms(F.col("start_s")), F.lit("]"))
    spoken = said.select(key, at.alias("at"), K.part(F.trim("text"), clock, "transcript", start_ms=ms("start_s"), end_ms=ms("end_s"), speaker=F.col("speaker")).alias("part"))
    text = T.caption_text(F.col("caption"), F.col("description"))
    kind = F.when(F.col("kind") == "image", "image_caption").otherwise("summary")
    told = captions.where(text != "").select(key, F.struct(F.lit(1).alias("list"), F.lit(0).cast("bigint").alias("index")).alias("at"), K.part(text, F.lit("caption"), kind).alias("part"))
    by = spoken.unionByName(told).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("_p"))
    return by.select(key, F.transform("_p", lambda x: x["part"]).alias("parts"))


def caption_manifest(assets: DataFrame) -> DataFrame:
    """Actions, tokens and cost of a caption run, in one row; assets: action, prompt, completion, cached."""
    used = lambda c: F.coalesce(F.sum(F.when(F.col("action") == "run", F.col(c))), F.lit(0))
    tokens = assets.agg(*(F.count_if(F.col("action") == a).alias(f"n_{a}") for a in ("run", "error", "skipped_done", "nothing_to_do")), *(used(c).cast("bigint").alias(f"{c}_tokens") for c in ("prompt", "completion", "cached")))
    nano = F.greatest(F.lit(0), F.col("prompt_tokens") - F.col("cached_tokens")) * 250 + F.col("cached_tokens") * 25 + F.col("completion_tokens") * 2000
    return tokens.withColumn("cost_nano", nano)


def frames_manifest(frames: DataFrame) -> DataFrame:
    """Keyframes, embedded, redacted, under review and errors of a frame run, in one row; frames: flag, redacted, embedding_ref, error."""
    c = F.col
    return frames.agg(
        F.count(F.lit(1)).alias("keyframes"), F.count_if(c("embedding_ref").isNotNull() & ~c("redacted")).alias("embedded"), F.count_if("redacted").alias("redacted"), F.count_if(c("flag") == "review").alias("review"),
        F.count_if(c("flag") == "block").alias("block"), F.count_if(c("error").isNotNull()).alias("errors"),
    )


def probe_manifest(assets: DataFrame) -> DataFrame:
    """Counts and whole milliseconds of duration by kind."""
    ms = F.sum(F.round(F.coalesce("duration_seconds", F.lit(0.0)) * 1000).cast("bigint"))
    return assets.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), ms.alias("duration_ms"))


def transcribe_manifest(rows: DataFrame, cfg: Media = Media()) -> DataFrame:
    """Windows, silent windows, seconds sent and their cost."""
    seconds = F.sum(F.when(F.col("has_sound"), F.coalesce(F.col("end_s") - F.col("start_s"), F.lit(0.0))).otherwise(0.0))
    return rows.agg(F.count(F.lit(1)).alias("windows"), F.count_if(~F.col("has_sound")).alias("silent"), seconds.alias("seconds"), (seconds / 60 * cfg.usd_per_minute).alias("cost_usd"))
