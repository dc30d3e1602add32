"""All queries of the library by name, with oracle SQL."""

from __future__ import annotations

from loomwork.plans import ingest_queries, media_queries, model_queries, page_queries, rollup_queries, run_queries, safety_queries, source_queries, stage_queries, store_queries, text_queries  # noqa: F401
from loomwork.plans.base import ORACLE_SQL, QUERIES  # noqa: F401
