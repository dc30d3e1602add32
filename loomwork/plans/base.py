"""What the queries share: a registry, table access, and the page lane with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import text as T
from loomwork.storage import read_table, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its oracle SQL if SQL can express it."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


class Tables:
    """Tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self._spark, self._dir, name)


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def pages(t: Tables, *keep: str) -> DataFrame:
    """doc_id, kept columns, page_number (from 1), content: slices of 2,000 characters."""
    return spread(t.documents, "doc_id").select("doc_id", *keep, F.posexplode(T.pages_of(F.col("text"))).alias("at", "content")).select("doc_id", *keep, big(F.col("at") + 1).alias("page_number"), "content")


def judged(t: Tables, *made: Column) -> DataFrame:
    """doc_id, lang, source, what is made of the texts, and labels; toxic and quality are null where a document was never judged.

    What is needed of a text is computed before the join, so that no text is shuffled.
    """
    rows = t.documents.select("doc_id", "lang", "source", *made)
    return rows.join(t.labels.select(F.col("doc_id").alias("_id"), "quality", "toxic"), F.col("doc_id") == F.col("_id"), "left").drop("_id")


PAGES = """pages_of AS (
  SELECT doc_id, lang, source, k AS page_number, substring(text, 2000 * (k - 1) + 1, 2000) AS content
  FROM (SELECT doc_id, lang, source, coalesce(text, '') AS text, unnest(range(1, CAST(greatest(1, ceil(length(coalesce(text, '')) / 2000.0)) AS BIGINT) + 1)) AS k FROM documents))"""

QUALITY = """quality AS (
  SELECT *, length(content) AS n_chars, length(regexp_replace(content, '[^\\p{L}]', '', 'g')) AS n_alpha,
         len(regexp_extract_all(content, '[A-Za-z]{2,}')) AS n_tokens,
         len(list_filter(regexp_extract_all(content, '[A-Za-z]{2,}'), lambda w: length(w) <= 15)) AS n_wordlike,
         length(array_to_string(regexp_extract_all(content, '[A-Za-z]{2,}'), '')) AS token_chars FROM pages_of),
gated AS (
  SELECT *, (n_chars >= 40 AND n_alpha * 100 >= n_chars * 45 AND n_tokens > 0 AND n_wordlike * 100 >= n_tokens * 60
             AND token_chars * 10 >= n_tokens * 25 AND token_chars * 10 <= n_tokens * 90) AS passed FROM quality)""".replace("\\\\", "\\")

WHOLE = "pages_of AS (SELECT doc_id, lang, source, coalesce(text, '') AS content FROM documents)"
