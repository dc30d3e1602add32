"""Model-backed and streaming queries, on local providers."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import text as T
from loomwork.operators import models as M
from loomwork.plans.base import PAGES, Tables, pages, query
from loomwork.storage import Scratch
from loomwork.streaming.incremental import ingest_new, ingested


@query(
    """WITH t AS (SELECT DISTINCT source, coalesce(text, '') AS text FROM documents), v AS (SELECT sha256('local' || chr(10) || source || chr(10) || text) AS content_sha, sha256('0:' || text) AS a, sha256('1:' || text) AS b FROM t)
SELECT content_sha, CAST(64 AS BIGINT) AS dims, round((CAST('0x' || substr(a, 1, 2) AS INTEGER) - 127.5::DOUBLE) / 127.5, 5) AS first_value, round((CAST('0x' || substr(b, 63, 2) AS INTEGER) - 127.5::DOUBLE) / 127.5, 5) AS last_value, 'ok' AS status FROM v"""
)
def fake_embedding_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of all distinct texts of a source, called once each, in batches of 32; shown by their ends."""
    t = Tables(spark, sf_dir)
    child = t.documents.select(T.content_sha(F.lit("local"), F.col("source"), F.col("text")).alias("content_sha"), F.coalesce("text", F.lit("")).alias("text"))
    made = M.embedded(child, spark.createDataFrame([], "content_sha string"), lambda: M.HashEmbedding(64))
    end = lambda at: F.round(F.element_at("vector", at).cast("double"), 5)
    return made.select("content_sha", F.size("vector").cast("bigint").alias("dims"), end(1).alias("first_value"), end(-1).alias("last_value"), "status")


SUMMARY_SQL = f"{PAGES}, summaries AS (SELECT doc_id, page_number, left(split_part(content, '. ', 1), 200) AS summary, 'ok' AS status FROM pages_of)"


@query(f"WITH {SUMMARY_SQL} SELECT * FROM summaries")
def page_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary of each page."""
    return M.called(pages(Tables(spark, sf_dir)), ["doc_id", "page_number"], "content", M.FirstSentence, "summary", pa.string())


@query(f"WITH {SUMMARY_SQL} SELECT doc_id, left(split_part(string_agg(summary, chr(10) || chr(10) ORDER BY page_number), '. ', 1), 200) AS summary, CAST(1 AS INTEGER) AS depth, 'ok' AS status FROM summaries GROUP BY doc_id")
def source_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary of each document folded from its pages' summaries."""
    found = page_summaries(spark, sf_dir).where("status = 'ok'")
    return M.reduced(found, "doc_id", "page_number", "summary", M.FirstSentence)


@query("SELECT * FROM events")
def streaming_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events taken in as a stream of files, twice; the second run adds nothing."""
    schema = Tables(spark, sf_dir).events.schema
    scratch = Scratch(spark, "stream")
    for _ in range(2):
        ingest_new(spark, f"{sf_dir}/events.parquet*", schema, f"{scratch.root}/target", f"{scratch.root}/checkpoint", "event_id")
    return ingested(spark, f"{scratch.root}/target", schema)
