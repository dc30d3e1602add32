"""Column functions on texts: quality, visible characters, stamps, truncation, identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwork.config import Chunk, Embed, Extract


def chars(text: Column) -> Column:
    return F.length(text).cast("bigint")


def pages_of(text: Column, size: int = Extract.page_chars) -> Column:
    """Array of consecutive slices of `size` characters; one empty slice for an empty or null text.  One pass over the text."""
    cut = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.size(cut) == 0, F.array(F.lit(""))).otherwise(cut)


def quality(text: Column, cfg: Extract = Extract()) -> Column:
    """Struct of counts for the gate.  Ratios are compared as products of whole numbers, so no rounding enters the gate.

    The words are bound to a lambda's variable, so that they are extracted once for the three counts made of them.
    """
    words = F.regexp_extract_all(text, F.lit("[A-Za-z]{2,}"), F.lit(0))
    counts = lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_tokens"),
        F.size(F.filter(w, lambda x: F.length(x) <= cfg.wordlike_max)).cast("bigint").alias("n_wordlike"),
        chars(F.array_join(w, "")).alias("token_chars"),
    )
    told = lambda c: F.struct(
        chars(text).alias("n_chars"),
        chars(F.regexp_replace(text, r"[^\p{L}]+", "")).alias("n_alpha"),
        c["n_tokens"].alias("n_tokens"),
        c["n_wordlike"].alias("n_wordlike"),
        c["token_chars"].alias("token_chars"),
    )
    return F.transform(F.transform(F.array(words), counts), told)[0]


def quality_gate(q: Column, cfg: Extract = Extract()) -> Column:
    return (
        (q["n_chars"] >= cfg.min_chars)
        & (q["n_alpha"] * 100 >= q["n_chars"] * cfg.min_alpha_percent)
        & (q["n_tokens"] > 0)
        & (q["n_wordlike"] * 100 >= q["n_tokens"] * cfg.min_wordlike_percent)
        & (q["token_chars"] * 10 >= q["n_tokens"] * cfg.min_word_len_tenths)
        & (q["token_chars"] * 10 <= q["n_tokens"] * cfg.max_word_len_tenths)
    )


def quality_ratios(q: Column) -> Column:
    """alpha_ratio, wordlike_ratio, mean_word_len, rounded to 4 places after the gate; 0 where there is nothing to divide by."""
    ratio = lambda a, b: F.round(F.coalesce(F.try_divide(q[a].cast("double"), q[b].cast("double")), F.lit(0.0)), 4)
    return F.struct(ratio("n_alpha", "n_chars").alias("alpha_ratio"), ratio("n_wordlike", "n_tokens").alias("wordlike_ratio"), ratio("token_chars", "n_tokens").alias("mean_word_len"))


def visible_chars(text: Column, marker: str = Extract.marker) -> Column:
    """Characters left when every marker, then all white space, is gone."""
    return chars(F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit(marker), F.lit(" ")), r"\s+", ""))


def bates_stamp(text: Column) -> Column:
    found = F.regexp_extract(text, r"\b[A-Z]{2,8}[-_]?\d{6,}\b", 0)
    return F.when(found != "", found)


def truncated(text: Column, most: int) -> Column:
    return F.struct(F.substring(text, 1, most).alias("text"), (F.length(text) > most).alias("truncated"))


def page_markdown(text: Column) -> Column:
    return F.concat(F.lit("## Transcription\n\n"), text)


def context_prefix(document: Column, case: Column, dataset: Column, section: Column) -> Column:
    return F.concat(F.lit("[Context: This excerpt is from "), document, F.lit(", "), case, F.lit("/"), dataset, F.lit(". Section: "), section, F.lit(".]"))


def content_sha(model: Column, prefix: Column, text: Column) -> Column:
    """Hex digest of model, prefix and text on three lines; null parts count as empty."""
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.sha2(F.concat(part(model), F.lit("\n"), part(prefix), F.lit("\n"), part(text)), 256)


def embed_input(prefix: Column, text: Column) -> Column:
    return F.concat(prefix, F.lit(" "), text)


def shard(sha: Column) -> Column:
    return F.substring(sha, 1, Embed.shard_digits)


def caption_text(caption: Column, description: Column) -> Column:
    """Caption, blank line, description; blank parts are left out."""
    part = lambda c: F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))
    return F.concat_ws("\n\n", part(caption), part(description))


def sentences(text: Column) -> Column:
    return F.split(F.trim(text), r"(?<=[.!?])\s+")


CHUNK = Chunk()
