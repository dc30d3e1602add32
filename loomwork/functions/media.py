"""Column functions on probe JSON, tool logs, image headers and model answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwork.functions.timefmt import even_centres, rational_fps

STREAM = "struct<codec_type:string,codec_name:string,channels:string,sample_rate:string,width:string,height:string,avg_frame_rate:string,r_frame_rate:string,duration:string>"
PROBE = f"struct<format:struct<duration:string,bit_rate:string,format_name:string>,streams:array<{STREAM}>>"


def typed_metadata(probe: Column) -> Column:
    """Typed fields of a probe's JSON: first audio and first video stream; the duration of the container, else the video, else the audio."""
    p = F.from_json(probe, PROBE)
    first = lambda kind: F.get(F.filter(p["streams"], lambda s: s["codec_type"] == kind), F.lit(0))
    audio, video = first("audio"), first("video")
    rate = F.when(video["avg_frame_rate"].isin("0/0", "N/A"), None).otherwise(video["avg_frame_rate"])
    return F.struct(
        F.coalesce(p["format"]["duration"].try_cast("double"), video["duration"].try_cast("double"), audio["duration"].try_cast("double")).alias("duration_seconds"),
        p["format"]["bit_rate"].try_cast("bigint").alias("bitrate"), p["format"]["format_name"].alias("format_name"),
        audio["codec_name"].alias("audio_codec"), audio["channels"].try_cast("int").alias("audio_channels"), audio["sample_rate"].try_cast("int").alias("sample_rate"),
        video["codec_name"].alias("video_codec"), video["width"].try_cast("int").alias("video_width"), video["height"].try_cast("int").alias("video_height"),
        rational_fps(F.coalesce(rate, video["r_frame_rate"])).alias("frame_rate"), audio.isNotNull().alias("has_audio"), video.isNotNull().alias("has_video"),
    )


def scene_times(log: Column) -> Column:
    """Sorted distinct times of scene changes in a detector's log."""
    found = F.regexp_extract_all(log, F.lit(r"pts_time:([0-9]+\.?[0-9]*)"), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda t: F.round(t.cast("double"), 3))))


def silent_intervals(log: Column) -> Column:
    """(start, end) of silences in a detector's log, in order; a last silence without an end is open (null)."""
    number = r":\s*(-?[0-9]+\.?[0-9]*)"
    starts = F.transform(F.regexp_extract_all(log, F.lit("silence_start" + number), F.lit(1)), lambda t: F.greatest(F.lit(0.0), t.cast("double")))
    ends = F.transform(F.regexp_extract_all(log, F.lit("silence_end" + number), F.lit(1)), lambda t: t.cast("double"))
    return F.transform(starts, lambda s, i: F.struct(s.alias("start_s"), F.get(ends, i).alias("end_s")))


def evenly(items: Column, most: int) -> Column:
    """At most `most` items of an array, at floor(i * n / most) in floating point."""
    step = F.size(items).cast("double") / most
    return F.when(F.size(items) <= most, items).otherwise(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.get(items, F.floor(i * step).cast("int"))))


def keyframe_times(scenes: Column, duration: Column, least: int = 2, most: int = 120) -> Column:
    """Scene changes, filled up with even centres when there are too few, thinned evenly when there are too many."""
    even = F.transform(even_centres(duration, F.lit(least).cast("bigint")), lambda t: F.round(t, 3))
    floor = F.when(duration > 0, even).otherwise(F.array(F.lit(0.0)))
    enough = F.when(F.size(scenes) >= least, scenes).otherwise(F.array_sort(F.array_union(scenes, floor)))
    return evenly(enough, most)


def png_size(content: Column) -> Column:
    """Width and height from a PNG's header; null where it is none."""
    number = lambda at: F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("int")
    sound = (F.hex(F.substring(content, 1, 8)) == "89504E470D0A1A0A") & (F.hex(F.substring(content, 13, 4)) == "49484452")
    return F.when(sound, F.struct(number(17).alias("width"), number(21).alias("height")))


# -- answers of models, brought within their bounds ---------------------------------------------------

# Names that a model may use.
ENTITY_TYPES = ("person", "org", "place", "date", "other")
CLASSES = ("photo", "document_scan", "diagram_chart", "handwriting", "blank", "black_or_redacted", "broken_placeholder", "text_only", "indeterminate")
NO_CONTENT = ("blank", "black_or_redacted", "broken_placeholder", "text_only")
FLAGS = ("ok", "review")
CATEGORIES = ("hate", "sexual", "violence", "self_harm", "csam_suspected")


def _texts(items: Column, most: int) -> Column:
    clean = F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")
    return F.slice(clean, 1, most)


def _safety(s: Column) -> tuple[Column, Column]:
    flag = F.when(s["flag"].isin(*FLAGS), s["flag"]).otherwise("ok")
    kept = F.filter(F.coalesce(s["categories"], F.array().cast("array<string>")), lambda c: c.isin(*CATEGORIES))
    return flag, F.when(flag == "review", kept).otherwise(F.array().cast("array<string>"))


PAGE_ANSWER = "struct<summary:string,key_points:array<string>,topics:array<string>,entities:array<struct<name:string,type:string>>,text_safety:struct<flag:string,categories:array<string>>>"


def page_answer(a: Column) -> Column:
    """A page summary (PAGE_ANSWER): 8 key points, 6 topics, named entities of known types, categories only under review."""
    named = F.filter(F.coalesce(a["entities"], F.array().cast("array<struct<name:string,type:string>>")), lambda e: F.trim(F.coalesce(e["name"], F.lit(""))) != "")
    entities = F.transform(named, lambda e: F.struct(F.trim(e["name"]).alias("name"), F.when(e["type"].isin(*ENTITY_TYPES), e["type"]).otherwise("other").alias("type")))
    flag, categories = _safety(a["text_safety"])
    return F.struct(F.trim(F.coalesce(a["summary"], F.lit(""))).alias("summary"), _texts(a["key_points"], 8).alias("key_points"), entities.alias("entities"), _texts(a["topics"], 6).alias("topics"), flag.alias("flag"), categories.alias("categories"))


VISION_ANSWER = "struct<caption:string,description:string,content_class:string,has_visual_content:boolean,vision_confidence:string,safety:struct<flag:string,categories:array<string>,minor_indicator:boolean,explicit:boolean>>"


def vision_answer(a: Column) -> Column:
    """An asset's verdict (VISION_ANSWER): a known class, no content where the class has none, confidence from 0 to 1."""
    kind = F.when(a["content_class"].isin(*CLASSES), a["content_class"]).otherwise("indeterminate")
    flag, categories = _safety(a["safety"])
    yes = lambda c: F.coalesce(c, F.lit(False))
    confidence = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(a["vision_confidence"].try_cast("double"), F.lit(0.0))))
    return F.struct(
        F.trim(F.coalesce(a["caption"], F.lit(""))).alias("caption"), F.trim(F.coalesce(a["description"], F.lit(""))).alias("description"), kind.alias("content_class"),
        (yes(a["has_visual_content"]) & ~kind.isin(*NO_CONTENT)).alias("has_visual_content"), F.round(confidence, 4).alias("vision_confidence"),
        F.struct(flag.alias("flag"), categories.alias("categories"), yes(a["safety"]["minor_indicator"]).alias("minor_indicator"), yes(a["safety"]["explicit"]).alias("explicit")).alias("safety"),
    )


def summary_json(answer: Column, low_confidence: Column, truncated: Column, prompt: Column, completion: Column) -> Column:
    return F.struct(answer["key_points"].alias("key_points"), answer["entities"].alias("entities"), answer["topics"].alias("topics"), low_confidence.alias("low_confidence"), truncated.alias("truncated"), prompt.alias("input_token_count"), completion.alias("output_token_count"))
