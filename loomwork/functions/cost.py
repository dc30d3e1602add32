"""Column functions for tokens and cost.  Money is whole micro-dollars wherever sums are compared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwork.config import Embed, Media, Summarise, Vision


def chat_tokens(n_chars: Column, max_output: int = 0) -> Column:
    return F.floor(n_chars / 4).cast("bigint") + F.lit(max_output).cast("bigint")


def embed_tokens(text: Column) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), F.floor(F.length(text) / 4).cast("bigint"))


def dry_run_tokens(n_chars: Column, cfg: Summarise = Summarise()) -> Column:
    return F.floor(F.least(n_chars, F.lit(cfg.max_chars)) / 4).cast("bigint")


def image_tokens(kind: Column, cfg: Vision = Vision()) -> Column:
    return F.when(kind == "artifact", cfg.artifact_in).otherwise(cfg.page_in).cast("bigint")


def usage_cost_usd(prompt: Column, completion: Column, cached: Column, cfg: Summarise | Vision = Summarise(), batch: bool = False) -> Column:
    uncached = F.greatest(F.lit(0), prompt - cached)
    cost = (uncached * cfg.in_usd + cached * cfg.cached_usd + completion * cfg.out_usd) / 1e6
    return cost * (cfg.batch_discount if batch else 1.0)


def usage_cost_nano(prompt: Column, completion: Column, cached: Column) -> Column:
    """The text model's cost in whole nano-dollars: 100, 25 and 400 for each token."""
    return (F.greatest(F.lit(0), prompt - cached) * 100 + cached * 25 + completion * 400).cast("bigint")


def embed_cost_usd(tokens: Column, cfg: Embed = Embed()) -> Column:
    return tokens / 1e6 * cfg.usd


def transcribe_cost_usd(seconds: Column, cfg: Media = Media()) -> Column:
    return F.greatest(F.lit(0.0), seconds) / 60 * cfg.usd_per_minute


def cached_within(prompt: Column, cached: Column) -> Column:
    return F.least(F.coalesce(cached, F.lit(0)), F.coalesce(prompt, F.lit(0)))
