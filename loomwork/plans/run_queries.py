"""Runs over rows: plain functions, passes over what failed, the vision chain, ids made on request, records written in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.operators import models as P
from loomwork.operators import tenancy as T
from loomwork.operators import windows as N
from loomwork.operators.drive import driven
from loomwork.plans.base import PAGES, Tables, big, pages, query
from loomwork.plans.ingest_queries import UUID_SQL
from loomwork.plans.lanes import PAGES_SQL, pages_lane
from loomwork.sources import lanes as L
from loomwork.storage import Scratch


def _last_word(text: str) -> str:
    """The last word between single spaces; a text without any is an error."""
    if " " not in text:
        raise ValueError("one word only")
    return text.rsplit(" ", 1)[1]


@query(f"WITH {PAGES} SELECT doc_id, page_number, CASE WHEN contains(content, ' ') THEN regexp_extract(content, '(?s)^.* ([^ ]*)$', 1) END AS result, CASE WHEN NOT contains(content, ' ') THEN 'ValueError: one word only' END AS error FROM pages_of")
def driven_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain function over pages, four calls at a time in a task; what it raises becomes a row."""
    return driven(pages(Tables(spark, sf_dir)), ["doc_id", "page_number"], "content", _last_word, workers=4)


@query(f"WITH {PAGES} SELECT doc_id * 1000 + page_number AS id, CASE WHEN page_number % 13 = 0 THEN 'error' WHEN page_number % 3 = 0 THEN 'ok' ELSE 'ok' END AS status, CASE WHEN page_number % 13 <> 0 AND page_number % 3 = 0 THEN 2 ELSE CASE WHEN page_number % 13 = 0 THEN 3 ELSE 1 END END AS made_in FROM pages_of")
def mop_up_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that fail are run again, three passes at most; every third page fails in the first, every thirteenth in all."""
    rows = pages(Tables(spark, sf_dir)).select((F.col("doc_id") * 1000 + F.col("page_number")).alias("id"), "page_number")
    passes = []

    def run(todo: DataFrame) -> DataFrame:
        passes.append(1)
        p, n = F.col("page_number"), len(passes)
        failed = (p % 13 == 0) | ((p % 3 == 0) & F.lit(n == 1))
        return todo.select("id", "page_number", F.when(failed, "error").otherwise("ok").alias("status"), F.lit(n).alias("made_in"))

    return P.passes(rows, "id", run).select("id", "status", "made_in")


CHAIN_SQL = f"""{PAGES_SQL}, a AS (SELECT doc_id, page_number, ((doc_id * 7 + page_number) % 300) / 299.0::DOUBLE AS dark, CASE WHEN doc_id % 11 = 0 THEN 'refuse this' WHEN doc_id % 7 = 0 THEN ' ' ELSE flag || ' ' || lang END AS caption FROM lane_pages),
g AS (SELECT *, CASE WHEN dark < 0.004 THEN 'blank' WHEN dark > 0.995 THEN 'black_or_redacted' END AS gate, coalesce(caption, '') AS c FROM a WHERE caption IS NOT NULL)"""


@query(
    f"""WITH {CHAIN_SQL} SELECT doc_id, page_number, CASE WHEN gate IS NOT NULL THEN gate WHEN contains(c, 'refuse') THEN NULL WHEN trim(c) = '' THEN 'blank' ELSE 'photo' END AS content_class, CASE WHEN gate IS NULL THEN 'vision' ELSE 'pregate' END AS source,
  CASE WHEN gate IS NULL AND contains(c, 'refuse') THEN 'filtered' ELSE 'ok' END AS status, gate IS NULL AND NOT contains(c, 'refuse') AND trim(c) <> '' AS embedded FROM g"""
)
def vision_chain_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images decided by darkness, judged by a local provider, embedded where they show something; a refusal is no error."""
    d = F.col("doc_id")
    caption = F.when(d % 11 == 0, "refuse this").when(d % 7 == 0, " ").otherwise(F.concat("flag", F.lit(" "), "lang"))
    rows = pages_lane(Tables(spark, sf_dir)).select("doc_id", "page_number", ((d * 7 + F.col("page_number")) % 300 / 299.0).alias("dark_coverage"), caption.alias("caption_input")).where("caption_input IS NOT NULL")
    made = P.vision_chain(rows, ["doc_id", "page_number"], P.KeywordVerdict, lambda: P.HashEmbedding(8))
    return made.select("doc_id", "page_number", "content_class", "source", "status", F.col("vector").isNotNull().alias("embedded"))


@query(
    f"""WITH h AS (SELECT doc_id, sha1(unhex('6ba7b8109dad11d180b4' || '00c04fd430c8') || encode('t1/' || lang)) AS c, sha1(unhex('6ba7b8109dad11d180b4' || '00c04fd430c8') || encode('t1/' || lang || '/' || source)) AS d, lang, source FROM documents)
SELECT doc_id, CASE WHEN lang = 'en' THEN 'case-en' ELSE {UUID_SQL.format(h="c")} END AS case_id, CASE WHEN lang = 'en' AND source = 'src1' THEN 'set-1' ELSE {UUID_SQL.format(h="d")} END AS dataset_id FROM h"""
)
def tenancy_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case and dataset ids of documents: those registered, else made on request, the same in every run."""
    docs = Tables(spark, sf_dir).documents.select("doc_id", F.col("lang").alias("case_key"), F.col("source").alias("dataset_key"))
    cases = spark.createDataFrame([("en", "case-en")], "case_key string, case_id string")
    sets = spark.createDataFrame([("case-en", "src1", "set-1")], "case_id string, dataset_key string, dataset_id string")
    cases, sets = T.ensured(docs, cases, sets, "t1")
    return T.resolve(docs, cases, sets).select("doc_id", "case_id", "dataset_id")


@query("""SELECT '{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '","n_chars":' || n_chars || '}' AS line, CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS place FROM documents""")
def records_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON with a fixed order of fields and rows, so that two runs write the same bytes; read again with their places."""
    rows = Tables(spark, sf_dir).documents.select("doc_id", "lang", "source", "n_chars")
    out = f"{Scratch(spark, 'records').root}/json"
    L.write_records(rows, ["doc_id"], out)
    text = spark.read.text(out).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    return N.ranked(text, [], ["file", "block", "at"], "place").select("line", (F.col("place") + 1).alias("place"))


@query(f"WITH {PAGES} SELECT regexp_replace('file:/c/' || lang || '/' || doc_id || '/pages/' || page_number || '.png', '/[^/]*$', '') AS directory, count(*) AS n_files, CAST(sum(length(content)) AS BIGINT) AS bytes, false AS deleted FROM pages_of GROUP BY 1")
def purge_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a purge of page renders would delete; without being told to, it deletes nothing."""
    from loomwork.sources import discovery as D

    files = pages(Tables(spark, sf_dir), "lang").select(F.concat(F.lit("file:/c/"), "lang", F.lit("/"), "doc_id", F.lit("/pages/"), "page_number", F.lit(".png")).alias("path"), big(F.length("content")).alias("length"))
    return D.purge(files)
