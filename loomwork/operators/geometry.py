"""Page geometry on arrays of boxes: struct<x0, y0, x1, y1: double>."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from loomwork.config import Extract

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def area(b: Column) -> Column:
    return F.greatest(b["x1"] - b["x0"], F.lit(0.0)) * F.greatest(b["y1"] - b["y0"], F.lit(0.0))


def common_area(a: Column, b: Column) -> Column:
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def line_has_bar(line: Column, bars: Column, share: float = Extract.bar_overlap) -> Column:
    """Some bar covers at least the share of the line's height."""
    height = line["y1"] - line["y0"]
    return F.exists(bars, lambda b: (height > 0) & (F.least(line["y1"], b["y1"]) - F.greatest(line["y0"], b["y0"]) >= height * share))


def glyph_in_bar(glyph: Column, bars: Column, share: float = Extract.bar_overlap) -> Column:
    return F.exists(bars, lambda b: (area(glyph) > 0) & (common_area(glyph, b) >= area(glyph) * share))


def centre_in(glyph: Column, bars: Column) -> Column:
    x, y = (glyph["x0"] + glyph["x1"]) / 2, (glyph["y0"] + glyph["y1"]) / 2
    return F.exists(bars, lambda b: (x >= b["x0"]) & (x <= b["x1"]) & (y >= b["y0"]) & (y <= b["y1"]))


def is_figure(image: Column, words: Column, page_area: Column, cfg: Extract = Extract()) -> Column:
    """A mid-size image with few words over it."""
    share = area(image) / page_area
    over = F.size(F.filter(words, lambda w: common_area(w, image) > 0))
    return (share >= cfg.figure) & (share < cfg.full_page) & (over < cfg.figure_words)


def bar_coverage(bars: Column, page_area: Column) -> Column:
    return F.least(F.lit(1.0), F.aggregate(bars, F.lit(0.0), lambda acc, b: acc + area(b)) / page_area)


def occluder_kind(luminance: Column) -> Column:
    return F.when(luminance < 0.25, "dark").when(luminance > 0.90, "white").otherwise("other")


def luminance(rgb: Column) -> Column:
    """Mean of the components; null where there are none."""
    return F.when(F.size(rgb) > 0, F.aggregate(rgb, F.lit(0.0), lambda acc, c: acc + c) / F.size(rgb))


def upper_median(values: Column) -> Column:
    """The element at n div 2 of the sorted values."""
    return F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int"))


def merged_bars(pages: DataFrame, key: str, bars: str = "bars") -> DataFrame:
    """key and the bars merged greedily in (y, x) order: a bar that overlaps one before grows it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame[bars] = [_merge(b) for b in frame[bars]]
            yield frame

    rows = pages.select(key, F.col(bars).cast(f"array<{BOX}>").alias(bars))
    return rows.mapInPandas(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, `{bars}` array<{BOX}>")


def _merge(bars) -> list[dict]:
    out: list[dict] = []
    for b in sorted((dict(x.asDict() if hasattr(x, "asDict") else x) for x in (bars if bars is not None else [])), key=lambda r: (r["y0"], r["x0"])):
        for o in out:
            if b["x0"] <= o["x1"] and b["x1"] >= o["x0"] and b["y0"] <= o["y1"] and b["y1"] >= o["y0"]:
                o["x0"], o["y0"], o["x1"], o["y1"] = min(o["x0"], b["x0"]), min(o["y0"], b["y0"]), max(o["x1"], b["x1"]), max(o["y1"], b["y1"])
                break
        else:
            out.append(b)
    return out


def reading_order(blocks: DataFrame, page: str, left: str = "page_x0", width: str = "page_width", gutter: float = 0.05, ties: Sequence[str] = ()) -> DataFrame:
    """Blocks (box) with their place and whether that is ambiguous.

    Two columns, left then right, where each side of the page's middle (give or take the gutter's share of the width)
    has two blocks and at most one, or a tenth, lies across; else one column.  Within a column by y, then x, to a
    tenth of a point; ties: columns that order blocks of one place.  Blocks that lie across go with the left column, so that none is lost.
    """
    middle, margin = F.col(left) + F.col(width) / 2, F.col(width) * gutter
    side = F.when(F.col("box.x1") <= middle + margin, 0).when(F.col("box.x0") >= middle - margin, 1)
    here = W.partitionBy(page)
    across = F.count_if(side.isNull()).over(here)
    two = (F.count_if(side == 0).over(here) >= 2) & (F.count_if(side == 1).over(here) >= 2) & (across <= F.greatest(F.lit(1), F.floor(F.count(F.lit(1)).over(here) / 10)))
    marked = blocks.withColumn("_two", two).withColumn("ambiguous", two & (across > 0)).withColumn("_column", F.when(F.col("_two"), F.coalesce(side, F.lit(0))).otherwise(0))
    order = here.orderBy("_column", F.round(F.col("box.y0"), 1), F.round(F.col("box.x0"), 1), *ties)
    return marked.withColumn("place", F.row_number().over(order)).drop("_column", "_two")


def _doubles(*names: str) -> StructType:
    return StructType([StructField(n, DoubleType()) for n in names])


@F.pandas_udf(_doubles("ink", "dark"))
def pixel_coverage(pixels: pd.Series, white: pd.Series, dark: pd.Series) -> pd.DataFrame:
    """Shares of the bytes of a grey image below the two levels."""
    rows = []
    for p, w, d in zip(pixels, white, dark):
        a = np.frombuffer(p or b"", np.uint8)
        rows.append((float((a < w).mean()), float((a < d).mean())) if len(a) else (None, None))
    return pd.DataFrame(rows, columns=["ink", "dark"])


@F.pandas_udf(_doubles("mean", "stddev"))
def region_stats(pixels: pd.Series) -> pd.DataFrame:
    """Mean and population deviation of the bytes of a grey region."""
    rows = []
    for p in pixels:
        a = np.frombuffer(p or b"", np.uint8).astype(float)
        rows.append((float(a.mean()), float(a.std())) if len(a) else (None, None))
    return pd.DataFrame(rows, columns=["mean", "stddev"])


def clamped_dpi(width_pt: Column, height_pt: Column, dpi: int, most: int, least: int) -> Column:
    px = (width_pt * dpi / 72) * (height_pt * dpi / 72)
    return F.when(px > most, F.greatest(F.lit(least), F.floor(F.lit(float(dpi)) * F.sqrt(most / px)).cast("int"))).otherwise(dpi)


@F.pandas_udf(DoubleType())
def dark_fraction(pixels: pd.Series, width: pd.Series, box: pd.DataFrame, level: pd.Series) -> pd.Series:
    """Share of the pixels of a box (clamped to the image, in pixels) that are darker than the level; 0 for an empty box."""
    out = []
    for p, w, x0, y0, x1, y1, at in zip(pixels, width, box["x0"], box["y0"], box["x1"], box["y1"], level):
        image = np.frombuffer(p or b"", np.uint8).reshape(-1, w)
        h = image.shape[0]
        cut = image[max(0, min(int(y0), h)) : max(0, min(int(y1), h)), max(0, min(int(x0), w)) : max(0, min(int(x1), w))]
        out.append(float((cut < at).mean()) if cut.size else 0.0)
    return pd.Series(out)


def points(box: Column, scale: Column, x: Column, y: Column) -> Column:
    """A box of pixels in page points."""
    return F.struct((box["x0"] / scale + x).alias("x0"), (box["y0"] / scale + y).alias("y0"), (box["x1"] / scale + x).alias("x1"), (box["y1"] / scale + y).alias("y1"))


def merge_runs(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Boxes (x0, y0, x1, y1) of scanline runs (y, x0, x1): a run joins a box of the line before that it overlaps."""
    open_: list[list[int]] = []
    done: list[tuple[int, int, int, int]] = []
    line = None
    for y, x0, x1 in sorted(runs):
        if y != line:
            done += [tuple(b) for b in open_ if b[3] < y]
            open_ = [b for b in open_ if b[3] >= y]
            line = y
        for b in open_:
            if b[3] >= y and x0 < b[2] and x1 > b[0]:
                b[0], b[2], b[3] = min(b[0], x0), max(b[2], x1), y + 1
                break
        else:
            open_.append([x0, y, x1, y + 1])
    return sorted(done + [tuple(b) for b in open_], key=lambda b: (b[1], b[0]))


def vertical_runs(lines: DataFrame, key: str) -> DataFrame:
    """key, boxes of the dark runs (y, x0, x1) of each page; a page's runs are one group of at most its height in lines."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["boxes"] = [[dict(zip(("x0", "y0", "x1", "y1"), map(float, b))) for b in merge_runs([(r["y"], r["x0"], r["x1"]) for r in rows])] for rows in frame["runs"]]
            yield frame[[key, "boxes"]]

    grouped = lines.groupBy(key).agg(F.collect_list(F.struct(*(F.col(c).cast("int").alias(c) for c in ("y", "x0", "x1")))).alias("runs"))
    return grouped.mapInPandas(run, f"`{key}` {grouped.schema[0].dataType.simpleString()}, boxes array<{BOX}>")
