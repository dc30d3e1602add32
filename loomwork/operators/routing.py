"""Ordered ladders as data: each is a list of (condition, value), first match wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.config import Extract, Render, Vision


def ladder(rungs: Sequence[tuple[Column, str | bool | None]], otherwise: str | bool | None) -> Column:
    out = F.when(F.coalesce(rungs[0][0], F.lit(False)), F.lit(rungs[0][1]))
    for condition, value in rungs[1:]:
        out = out.when(F.coalesce(condition, F.lit(False)), F.lit(value))
    return out.otherwise(F.lit(otherwise))


def page_class(text: Column, images: Column, cfg: Extract = Extract()) -> Column:
    has_text = F.length(F.trim(text)) >= cfg.class_text_chars
    return ladder(
        [(has_text & (images == 0), "ocr_backing_scan"), (has_text & (images > 0), "mixed_content"), (~has_text & (images > 1), "embedded_subimage")], "full_page_visual"
    )


def text_layer(invisible: Column, total: Column, sizes: Column, cfg: Extract = Extract()) -> Column:
    """none, ocr_layer (mostly invisible glyphs of many sizes), born_digital (few of both) or mixed."""
    share = F.try_divide(invisible.cast("double"), total.cast("double"))
    return ladder(
        [
            (total == 0, "none"),
            ((share >= cfg.ocr_invisible_min) & (sizes >= cfg.ocr_sizes_min), "ocr_layer"),
            ((share < cfg.born_invisible_max) & (sizes <= cfg.born_sizes_max), "born_digital"),
        ],
        "mixed",
    )


def vision_reason(redacted: Column, n_chars: Column, ink: Column, dark: Column, gate: Column, figures: Column, cfg: Extract = Extract()) -> Column:
    low = n_chars < cfg.min_chars
    return ladder(
        [
            (redacted, "redaction_suspected"),
            (low & ((ink < cfg.blank_ink_max) | (dark > 1.0 - cfg.blank_ink_max)), "blank"),
            (low, "low_text"),
            (~gate, "quality_fail"),
            (figures, "has_figures"),
        ],
        "text_sufficient",
    )


def needs_vision(reason: Column) -> Column:
    return ~reason.isin("blank", "text_sufficient")


def page_kind(reason: Column, ink: Column, dark: Column, runs: Column, visible: Column, bars: Column, coverage: Column, n_chars: Column, images: Column, cfg: Extract = Extract()) -> Column:
    enough = n_chars >= cfg.min_chars
    return ladder(
        [
            ((reason == "blank") | F.coalesce(ink < cfg.blank_ink_max, F.lit(False)) | F.coalesce(dark > 1.0 - cfg.blank_ink_max, F.lit(False)), "blank"),
            ((runs > 0) & (visible < cfg.min_chars) & (bars >= cfg.fully_redacted), "redacted"),
            ((coverage >= cfg.full_page) & ~enough, "image"),
            (enough & (images >= 1) & (coverage >= cfg.figure) & (coverage < cfg.full_page), "mixed"),
            (enough, "text"),
        ],
        "image",
    )


def summarise_page(kind: Column, flags: Column, text: Column) -> Column:
    return kind.isin("text", "mixed") & ~F.array_contains(flags, "low_quality_text") & (F.trim(text) != "")


def document_routing(sufficient: Column, pages: Column, cfg: Extract = Extract()) -> Column:
    """From counts of pages, compared as products: at least 90 % sufficient, at most 10 %, else."""
    return ladder([(pages == 0, "vision_primary"), (sufficient * 10 >= pages * 9, "text_primary"), (sufficient * 10 <= pages, "vision_primary")], "mixed")


def pregate(dark: Column, cfg: Vision = Vision()) -> Column:
    """blank, black_or_redacted, or null: to be looked at."""
    return F.when(dark < cfg.blank_max, "blank").when(dark > cfg.black_min, "black_or_redacted")


def with_page_dark(assets: DataFrame, pages: DataFrame) -> DataFrame:
    """Assets with dark_coverage: of a page asset that of its page, null where it wasn't measured, and for pictures."""
    measured = pages.select("doc_id", "page_number", F.col("dark_coverage").alias("_dark")).where("page_number IS NOT NULL")
    rows = assets.join(measured, ["doc_id", "page_number"], "left")
    return rows.withColumn("dark_coverage", F.when(F.col("kind") == "page", F.col("_dark"))).drop("_dark")


def pregated(assets: DataFrame, cfg: Vision = Vision()) -> DataFrame:
    """Assets with content_class, hint: decided by darkness alone where the page's share or else the measured one is clear; null: to be looked at."""
    own = pregate(F.when(F.col("kind") == "page", F.col("dark_coverage")), cfg)
    kind = F.coalesce(own, pregate(F.col("measured_dark"), cfg))
    return assets.withColumn("content_class", kind).withColumn("measured", own.isNull() & F.col("measured_dark").isNotNull())


def safety_scan_applies(kind: Column, artifacts_only: bool = True) -> Column:
    """Whether an image goes to the content safety scan: pictures only, unless all are to be scanned."""
    return kind == "artifact" if artifacts_only else F.lit(True)


def picture_artifacts(images: DataFrame, least: int = Render.artifact_min_px) -> DataFrame:
    """Of a document's embedded images (doc_id, page_number, image_index, xref, width, height, is_full_page), those that are pictures of their own.

    An image that fills some page of its document is that page's scan wherever it stands, and small ones are icons.
    """
    scans = images.where("is_full_page").select("doc_id", "xref").distinct()
    return images.join(scans, ["doc_id", "xref"], "left_anti").where((F.col("xref") > 0) & (F.least("width", "height") >= least))


def glyph_counts(glyphs: Column) -> Column:
    """Struct (invisible, visible) of an array of glyphs (struct<mode, opacity, ...>): render mode 3 or no opacity is invisible."""
    hidden = lambda g: (g["mode"] == 3) | (g["opacity"] == 0)
    n = F.size(F.filter(glyphs, hidden))
    return F.struct(n.alias("invisible"), (F.size(glyphs) - n).alias("visible"))


def invisible_boxes(glyphs: Column) -> Column:
    """Boxes of the invisible glyphs."""
    return F.transform(F.filter(glyphs, lambda g: (g["mode"] == 3) | (g["opacity"] == 0)), lambda g: g["box"])


def fusion_route(has_vision: Column, has_text: Column) -> Column:
    return ladder([(has_vision & has_text, "fused"), (has_vision & ~has_text, "image_only"), (~has_vision & has_text, "promoted")], "no_content")


def demoted_kind(kind: Column, rejected: Column) -> Column:
    return F.when((kind == "image") & rejected, "blank").otherwise(kind)


def stage_state(applicable: Column, done: Column) -> Column:
    return ladder([(applicable == 0, "n/a"), (done == 0, "not_started"), (done >= applicable, "done")], "in_progress")


def page_flags(reason: Column, black: Column, images: Column, invisible: Column, visible: Column, rotation: Column) -> Column:
    """Flags of a page in a fixed order: what kind of blank it is, a heavy invisible layer, images to be scanned, rotation."""
    blank = F.when(reason == "blank", F.when(F.coalesce(black, F.lit(False)), "blank_black").when(images > 0, "slip_sheet").otherwise("blank_page"))
    return F.array_compact(
        F.array(
            blank,
            F.when(invisible >= 3 * F.greatest(F.lit(1), visible), "heavy_invisible_layer"),
            F.when(images > 0, "image_safety_required"),
            F.when(F.coalesce(rotation, F.lit(0)) != 0, "rotated"),
        )
    )


def with_quality_flag(flags: Column, kind: Column, reason: Column) -> Column:
    """Adds low_quality_text to text and mixed pages that failed the quality gate, once."""
    bad = kind.isin("text", "mixed") & (reason == "quality_fail")
    return F.when(bad, F.array_union(flags, F.array(F.lit("low_quality_text")))).otherwise(flags)


def low_confidence(truncated: Column, flags: Column) -> Column:
    return truncated | F.array_contains(flags, "low_quality_text")


def kind_reason(kind: Column, n_chars: Column, coverage: Column, bars: Column, cfg: Extract = Extract()) -> Column:
    """Why a page is of its kind."""
    full = (coverage >= cfg.full_page) & (n_chars < cfg.min_chars)
    fixed = {"blank": "stage1_blank", "mixed": "text_with_figure", "text": "text_sufficient"}
    out = F.when(kind == "redacted", F.concat(F.lit("bars_cover_"), F.format_string("%.3f", bars.cast("double"))))
    for k, v in fixed.items():
        out = out.when(kind == k, v)
    return out.when(full, "full_page_image_low_text").otherwise("low_text_failsafe")
