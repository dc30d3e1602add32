"""Safety verdicts, severities and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.config import Ingest, Media
from loomwork.operators.routing import ladder

# Category names.
WITHHOLD = ("hate", "self-harm", "self_harm", "selfharm", "sexual", "violence")
REPORT = ("csam", "csam_suspected", "minor")
COLUMNS = {"hate": "hate", "sexual": "sexual", "violence": "violence", "selfharm": "self_harm", "self_harm": "self_harm", "self-harm": "self_harm"}


def over_threshold(categories: Column, threshold: int = Ingest.severity) -> Column:
    """Lower-case names of the (category, severity) structs at or over the threshold; severities that aren't numbers don't count."""
    hit = F.filter(F.coalesce(categories, F.array().cast("array<struct<category:string,severity:string>>")), lambda c: F.coalesce(c["severity"].try_cast("int"), F.lit(0)) >= threshold)
    return F.transform(hit, lambda c: F.lower(F.coalesce(c["category"], F.lit(""))))


def severity_marks(categories: Column, threshold: int = Ingest.severity) -> Column:
    """`cs:category=severity` for the categories that withhold at or over the threshold, in their order."""
    hit = F.filter(
        F.coalesce(categories, F.array().cast("array<struct<category:string,severity:string>>")),
        lambda c: (F.coalesce(c["severity"].try_cast("int"), F.lit(0)) >= threshold) & F.lower(c["category"]).isin(*WITHHOLD),
    )
    return F.transform(hit, lambda c: F.concat(F.lit("cs:"), F.lower(c["category"]), F.lit("="), c["severity"]))


def verdict(
    filtered: Column, explicit: Column, minor: Column, flagged: Column, severe: Column, visual: Column, vetted: Column, withhold_unvetted: bool = Ingest.withhold_unvetted, marks: Column | None = None
) -> Column:
    """Struct (csam, withhold, reasons, tier).

    flagged, severe: arrays of lower-case category names, from the model and over the severity threshold;
    marks: what severity_marks() gives, if the reasons are to name the severities.
    Signals for reporting come first; then a refused request, explicit content and categories in order of
    their names; last, content that was never vetted.  A bare flag for review withholds nothing.
    """
    flagged, severe = (F.coalesce(c, F.array().cast("array<string>")) for c in (flagged, severe))
    yes = lambda c: F.coalesce(c, F.lit(False))
    every = F.array_union(flagged, severe)
    report = F.array_sort(F.array_intersect(every, F.array(*map(F.lit, REPORT))))
    hold = F.array_sort(F.array_intersect(every, F.array(*map(F.lit, WITHHOLD))))
    csam = yes(minor) | (F.size(report) > 0)
    named = lambda a: F.transform(a, lambda c: F.concat(F.lit("category:"), c))
    only = lambda c, name: F.when(yes(c), F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    held = F.concat(only(filtered, "content_filter"), only(explicit, "explicit"), named(hold), *([] if marks is None else [marks]))
    unvetted = (F.size(held) == 0) & yes(visual) & ~yes(vetted) & F.lit(withhold_unvetted)
    reasons = F.when(csam, F.concat(only(minor, "minor_indicator"), named(report))).otherwise(F.array_distinct(F.concat(held, only(unvetted, "unvetted_verdict"))))
    first = F.replace(F.replace(F.get(hold, F.lit(0)), F.lit("-"), F.lit("_")), F.lit("selfharm"), F.lit("self_harm"))
    tier = F.when(csam, "csam").when(yes(filtered), "content_filter").when(yes(explicit), "sexual").when(F.size(hold) > 0, first).when(unvetted, "unvetted")
    return F.struct(csam.alias("csam"), (csam | (F.size(reasons) > 0)).alias("withhold"), reasons.alias("reasons"), tier.alias("tier"))


def severity_flag(severity: Column, cfg: Media = Media()) -> Column:
    return ladder([(severity >= cfg.block, "block"), (severity >= cfg.review, "review")], "ok")


def page_blank(kind: Column, text: Column, visual: Column) -> Column:
    """Blank by kind, or without text and known (not just missing) to show nothing."""
    return F.coalesce(F.lower(kind) == "blank", F.lit(False)) | ((F.trim(F.coalesce(text, F.lit(""))) == "") & visual.eqNullSafe(F.lit(False)))


def rollup_findings(findings: DataFrame, key: str) -> DataFrame:
    """Element-wise maximum of the severities and OR of the report signal for each key."""
    return findings.groupBy(key).agg(*(F.max(c).alias(c) for c in ("hate", "sexual", "violence", "self_harm")), F.bool_or("csam_suspected").alias("csam_suspected"))


def quarantine_reasons(signals: dict[str, Column]) -> Column:
    """The names of the signals that hold, in the given order."""
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in signals.items())))
