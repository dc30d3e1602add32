"""Column functions on seconds: clock texts, frame grids, intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwork.config import Media


def hms(seconds: Column) -> Column:
    s = F.floor(F.greatest(seconds, F.lit(0))).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def vtt(millis: Column) -> Column:
    """Cue time of whole milliseconds."""
    ms = F.greatest(millis, F.lit(0)).cast("bigint")
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3_600_000), F.floor(ms % 3_600_000 / 60_000), F.floor(ms % 60_000 / 1000), ms % 1000)


def even_centres(duration: Column, n: Column) -> Column:
    """Centres of n equal parts of the duration, unrounded."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: (i.cast("double") + 0.5) / n * duration)).otherwise(F.array().cast("array<double>"))


def floor_grid(duration: Column, interval: Column) -> Column:
    """Multiples of the interval below the duration; one zero where either isn't positive."""
    grid = F.transform(F.sequence(F.lit(0).cast("bigint"), F.floor(duration / interval)), lambda i: i.cast("double") * interval)
    return F.when((duration > 0) & (interval > 0), F.filter(grid, lambda x: x < duration)).otherwise(F.array(F.lit(0.0)))


def adaptive_interval(duration: Column, base: float, most: int = Media.max_frames) -> Column:
    return F.when(duration > 0, F.greatest(F.lit(float(base)), F.ceil(duration / most).cast("double"))).otherwise(F.lit(max(1.0, float(base))))


def windows_of(duration: Column, width: int = Media.window_s) -> Column:
    """Array of (index, start, end) of fixed windows over the duration, the last one cut short; one open window where it is unknown."""
    n = F.greatest(F.ceil(duration / width), F.lit(1))
    made = F.transform(
        F.sequence(F.lit(0).cast("bigint"), n - 1),
        lambda i: F.struct(i.alias("index"), (i * width).cast("double").alias("start_s"), F.least((i + 1) * width, duration).cast("double").alias("end_s")),
    )
    unknown = F.array(F.struct(F.lit(0).cast("bigint").alias("index"), F.lit(0.0).alias("start_s"), F.lit(None).cast("double").alias("end_s")))
    return F.when(duration > 0, made).otherwise(unknown)


def rational_fps(rate: Column) -> Column:
    """`30000/1001` to 29.97; null for 0/0 and other texts."""
    top, bottom = F.split_part(rate, F.lit("/"), F.lit(1)).try_cast("double"), F.coalesce(F.nullif(F.split_part(rate, F.lit("/"), F.lit(2)), F.lit("")), F.lit("1")).try_cast("double")
    return F.when((top > 0) & (bottom > 0), F.round(top / bottom, 4))
