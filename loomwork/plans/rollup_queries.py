"""Merges, tenancy, rollups, ingest plans, digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import cost as C
from loomwork.functions import parse as J
from loomwork.functions import text as T
from loomwork.operators import merge as G
from loomwork.operators import rollup as R
from loomwork.operators import routing as L
from loomwork.operators import safety as S
from loomwork.operators.dedup import last_written, ordered_distinct
from loomwork.operators.ingest import first_of
from loomwork.plans.base import PAGES, Tables, big, judged, pages, query

# -- tenancy and merges --------------------------------------------------------------------------


@query(
    "SELECT c_custkey, n_nationkey AS dataset_id, r_regionkey AS case_id, c_nationkey % 5 <> 4 AS resolved FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND c_nationkey % 5 <> 4 LEFT JOIN region ON r_regionkey = n_regionkey"
)
def tenancy_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case and dataset ids of each document's keys; a fifth of the keys is left unregistered."""
    t = Tables(spark, sf_dir)
    known = t.nation.where("n_nationkey % 5 <> 4").join(t.region, F.col("r_regionkey") == F.col("n_regionkey")).select("n_nationkey", "r_regionkey")
    rows = t.customer.select("c_custkey", "c_nationkey").join(known, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select("c_custkey", F.col("n_nationkey").alias("dataset_id"), F.col("r_regionkey").alias("case_id"), F.col("n_nationkey").isNotNull().alias("resolved"))


@query("WITH p AS (SELECT DISTINCT s_nationkey AS k FROM supplier) SELECT k AS nation_key, EXISTS (SELECT 1 FROM nation WHERE n_nationkey = k AND n_regionkey < 3) AS found FROM p")
def tenancy_preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    pairs = t.supplier.select(F.col("s_nationkey").alias("nation_key")).distinct()
    known = t.nation.where("n_regionkey < 3").select(F.col("n_nationkey").alias("nation_key"), F.lit(True).alias("found"))
    return pairs.join(known, "nation_key", "left").select("nation_key", F.coalesce("found", F.lit(False)).alias("found"))


@query(
    """WITH old AS (SELECT c_custkey AS k, c_name AS title, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS status FROM customer WHERE c_custkey % 3 <> 0),
new AS (SELECT o_custkey AS k, CAST(NULL AS VARCHAR) AS title, arg_max(o_orderpriority, o_orderkey) AS segment, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY o_custkey)
SELECT coalesce(o.k, n.k) AS k, coalesce(n.title, o.title) AS title, coalesce(n.segment, o.segment) AS segment, coalesce(n.status, o.status) AS status FROM old o FULL OUTER JOIN new n ON o.k = n.k"""
)
def upsert_merge_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert of documents whose metadata is a bag: new entries win, others stay.  The bag is read back as columns."""
    t = Tables(spark, sf_dir)
    bag = lambda **kv: F.map_filter(F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull())
    old = t.customer.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("title"), bag(segment=F.col("c_mktsegment")).alias("metadata"))
    last = last_written(t.orders.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"), ["o_custkey"], "o_orderkey")
    new = last.select(F.col("o_custkey").alias("k"), F.lit(None).cast("string").alias("title"), bag(segment=F.col("o_orderpriority"), status=F.col("o_orderstatus")).alias("metadata"))
    merged = G.upsert(old, new, ["k"], ("metadata",))
    return merged.select("k", "title", F.col("metadata")["segment"].alias("segment"), F.col("metadata")["status"].alias("status"))


@query("SELECT n_nationkey AS k, n_name AS name FROM nation WHERE n_nationkey < 20 UNION ALL SELECT DISTINCT s_nationkey, 'nation of suppliers' FROM supplier WHERE s_nationkey >= 20")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    target = t.nation.where("n_nationkey < 20").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    return G.insert_if_absent(target, t.supplier.select(F.col("s_nationkey").alias("k"), F.lit("nation of suppliers").alias("name")), ["k"])


@query(
    """WITH log AS (SELECT user_id, event_type, max(event_id) AS last FROM events WHERE event_id % 2 = 0 GROUP BY ALL), fresh AS (SELECT user_id, event_type, max(event_id) AS last FROM events WHERE event_id % 5 = 0 GROUP BY ALL)
SELECT * FROM fresh UNION ALL SELECT * FROM log l WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.user_id = l.user_id AND f.event_type = l.event_type)"""
)
def fail_log_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).events
    log = lambda every: e.where(f"event_id % {every} = 0").groupBy("user_id", "event_type").agg(F.max("event_id").alias("last"))
    return G.replace_by_key(log(2), log(5), ["user_id", "event_type"])


# -- progress, cost, coverage ----------------------------------------------------------------------

DIGEST_SQL = """digest AS (
  SELECT d.doc_id, d.source AS dataset, CASE WHEN d.doc_id % 29 = 0 THEN 'error' WHEN d.doc_id % 31 = 0 THEN 'missing' ELSE 'ok' END AS status, CAST(greatest(1, ceil(length(d.text) / 2000.0)) AS BIGINT) AS pages,
    CAST(length(d.text) AS BIGINT) AS chars, e.vec_id IS NOT NULL AS has_assets, l.doc_id IS NOT NULL AS s3, l.doc_id IS NOT NULL AND l.quality = 1 AS s5, d.doc_id % 4 <> 0 AS s6,
    CASE WHEN l.doc_id IS NOT NULL THEN CAST(length(d.text) // 4 * 100 AS BIGINT) ELSE 0 END AS s3_nano, coalesce(l.toxic, 0) = 1 AS review, d.doc_id % 37 = 0 AS filtered, coalesce(e.label, -1) = 7 AS minor, d.doc_id % 43 = 0 AS final_filtered
  FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN embeddings e ON e.vec_id = d.doc_id)"""


def _digest(t: Tables) -> DataFrame:
    d = F.col("doc_id")
    rows = judged(t, T.chars(F.col("text")).alias("chars")).join(t.embeddings.select(F.col("vec_id").alias("doc_id"), "label"), "doc_id", "left")
    seen = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    n = F.col("chars")
    return rows.select(
        "doc_id", F.col("source").alias("dataset"), F.when(d % 29 == 0, "error").when(d % 31 == 0, "missing").otherwise("ok").alias("status"), big(F.greatest(F.lit(1), F.ceil(n / 2000))).alias("pages"), "chars",
        F.col("label").isNotNull().alias("has_assets"), seen.alias("s3"), (seen & (F.coalesce("quality", F.lit(0)) == 1)).alias("s5"), (d % 4 != 0).alias("s6"), F.when(seen, C.chat_tokens(n) * 100).otherwise(0).alias("s3_nano"),
        (F.coalesce("toxic", F.lit(0)) == 1).alias("review"), (d % 37 == 0).alias("filtered"), (F.coalesce("label", F.lit(-1)) == 7).alias("minor"), (d % 43 == 0).alias("final_filtered"),
    )



@query(
    f"""WITH {DIGEST_SQL}, grid AS (
  SELECT dataset, 'stage3' AS stage, count_if(status = 'ok') AS applicable, count_if(status = 'ok' AND s3) AS done FROM digest GROUP BY dataset
  UNION ALL SELECT dataset, 'stage4', count_if(status = 'ok' AND has_assets), count_if(status = 'ok' AND has_assets AND s3) FROM digest GROUP BY dataset
  UNION ALL SELECT dataset, 'stage6', count_if(status = 'ok' AND pages > 0), count_if(status = 'ok' AND pages > 0 AND s6) FROM digest GROUP BY dataset)
SELECT dataset, stage, CAST(applicable AS BIGINT) AS applicable, CAST(done AS BIGINT) AS done,
  CASE WHEN applicable = 0 THEN 'n/a' WHEN done = 0 THEN 'not_started' WHEN done >= applicable THEN 'done' ELSE 'in_progress' END AS state, CASE WHEN applicable > 0 THEN CAST((done * 2000 + applicable) // (applicable * 2) AS BIGINT) END AS permille FROM grid"""
)
def stage_applicability_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.col("status") == "ok"
    stages = {"stage3": (ok, F.col("s3")), "stage4": (ok & F.col("has_assets"), F.col("s3")), "stage6": (ok & (F.col("pages") > 0), F.col("s6"))}
    one = _digest(Tables(spark, sf_dir)).groupBy("dataset").agg(*(F.struct(F.count_if(a).alias("applicable"), F.count_if(a & done).alias("done")).alias(s) for s, (a, done) in stages.items()))
    rows = one.select("dataset", F.explode(F.array(*(F.struct(F.lit(s).alias("stage"), f"{s}.applicable", f"{s}.done") for s in stages))).alias("g")).select("dataset", "g.*")
    return rows.select("*", L.stage_state(F.col("applicable"), F.col("done")).alias("state"), R.progress(F.col("applicable"), F.col("done")).alias("permille"))


@query(
    f"""WITH {DIGEST_SQL} SELECT dataset, count(*) AS docs, CAST(count_if(status = 'ok') AS BIGINT) AS docs_ok, CAST(count_if(status = 'error') AS BIGINT) AS docs_error, CAST(sum(CASE WHEN status = 'ok' THEN pages ELSE 0 END) AS BIGINT) AS pages,
  CAST(sum(CASE WHEN status = 'ok' THEN chars ELSE 0 END) AS BIGINT) AS chars, CAST(sum(s3_nano) AS BIGINT) AS cost_nano, CAST(count_if(review OR filtered OR minor OR final_filtered) AS BIGINT) AS quarantined
FROM digest GROUP BY GROUPING SETS ((dataset), ())"""
)
def dataset_corpus_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, c = F.col("status") == "ok", F.col
    return R.dataset_and_corpus(_digest(Tables(spark, sf_dir)), "dataset", [
        F.count(F.lit(1)).alias("docs"), F.count_if(ok).alias("docs_ok"), F.count_if(c("status") == "error").alias("docs_error"), F.sum(F.when(ok, c("pages")).otherwise(0)).alias("pages"),
        F.sum(F.when(ok, c("chars")).otherwise(0)).alias("chars"), F.sum("s3_nano").alias("cost_nano"), F.count_if(c("review") | c("filtered") | c("minor") | c("final_filtered")).alias("quarantined"),
    ])


@query(
    f"""WITH {DIGEST_SQL}, each AS (SELECT dataset, CAST(sum(s3_nano) AS BIGINT) AS cost, CAST(count_if(status = 'ok' AND s3) AS BIGINT) AS done, CAST(count_if(status = 'ok') AS BIGINT) AS applicable FROM digest GROUP BY dataset),
p AS (SELECT dataset, CASE WHEN done > 0 AND applicable > done THEN CAST(floor(CAST(cost * (applicable - done) AS DOUBLE) / done) AS BIGINT) ELSE 0 END AS projected_nano FROM each)
SELECT dataset, projected_nano FROM p UNION ALL SELECT NULL, CAST(sum(projected_nano) AS BIGINT) FROM p"""
)
def projected_cost_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains is projected for each dataset at its own rate; the corpus is the sum of these."""
    ok = F.col("status") == "ok"
    by = _digest(Tables(spark, sf_dir)).groupBy("dataset").agg(F.sum("s3_nano").alias("cost"), F.count_if(ok & F.col("s3")).alias("done"), F.count_if(ok).alias("applicable"))
    each = by.select("dataset", R.projected_nano(F.col("cost"), F.col("done"), F.col("applicable")).alias("projected_nano"))
    return R.dataset_and_corpus(each, "dataset", [F.sum("projected_nano").alias("projected_nano")])


@query("WITH s AS (SELECT DISTINCT source, lang AS store, CAST(length(lang) * 1000 AS BIGINT) AS embedded FROM documents), one AS (SELECT DISTINCT store, embedded FROM s) SELECT count(*) AS n_stores, CAST(sum(embedded) AS BIGINT) AS embedded FROM one")
def distinct_store_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets that share a store count it once."""
    per_dataset = Tables(spark, sf_dir).documents.select("source", F.col("lang").alias("store"), (T.chars(F.col("lang")) * 1000).alias("embedded")).distinct()
    return per_dataset.select("store", "embedded").dropDuplicates(["store"]).agg(F.count(F.lit(1)).alias("n_stores"), F.sum("embedded").alias("embedded"))


@query(
    f"""WITH {DIGEST_SQL} SELECT doc_id, array_to_string(list_filter([CASE WHEN filtered THEN 'text_content_filtered' END, CASE WHEN review THEN 'text_safety_review' END, CASE WHEN minor THEN 'image_minor_indicator' END,
  CASE WHEN final_filtered THEN 'final_content_filtered' END], lambda x: x IS NOT NULL), ',') AS reasons FROM digest WHERE filtered OR review OR minor OR final_filtered"""
)
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals = {"text_content_filtered": F.col("filtered"), "text_safety_review": F.col("review"), "image_minor_indicator": F.col("minor"), "final_content_filtered": F.col("final_filtered")}
    rows = _digest(Tables(spark, sf_dir)).select("doc_id", S.quarantine_reasons(signals).alias("r"))
    return rows.where(F.size("r") > 0).select("doc_id", F.array_join("r", ",").alias("reasons"))


@query(f"WITH {DIGEST_SQL} SELECT dataset, doc_id FROM digest WHERE filtered OR review ORDER BY dataset, doc_id LIMIT 200")
def quarantine_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's list: the first 200 in order (the limit is the feature)."""
    return _digest(Tables(spark, sf_dir)).where("filtered OR review").select("dataset", "doc_id").orderBy("dataset", "doc_id").limit(200)


@query("SELECT user_id, strftime(max(greatest(ts, CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 90 SECOND END)), '%Y-%m-%d %H:%M:%S') AS last_activity FROM events GROUP BY user_id")
def last_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = F.when(F.col("event_id") % 2 == 0, F.col("ts") + F.expr("INTERVAL 90 SECOND"))
    rows = Tables(spark, sf_dir).events.groupBy("user_id").agg(F.max(R.latest(F.col("ts"), later)).alias("m"))
    return rows.select("user_id", F.date_format("m", "yyyy-MM-dd HH:mm:ss").alias("last_activity"))


@query(
    f"""WITH {PAGES}, s AS (SELECT doc_id, page_number, sha256(content) AS s FROM pages_of)
SELECT doc_id, CAST(len(p[:50]) AS BIGINT) AS n_points, sha256(array_to_string(p[:50], '|')) AS points_sha, array_to_string(t[:30], '|') AS topics
FROM (SELECT doc_id, list(substr(s, 1, 20) ORDER BY page_number) AS p, list_sort(list(DISTINCT substr(s, 1, 3))) AS t FROM s GROUP BY doc_id)"""
)
def asset_context_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 50 key points of each document in page order and its 30 first topics in order (the limits are the feature); parts of whole pages' digests stand for a model's points and topics."""
    sha = F.sha2("content", 256)
    told = pages(Tables(spark, sf_dir)).select("doc_id", "page_number", F.substring(sha, 1, 20).alias("point"), F.substring(sha, 1, 3).alias("topic"))
    points = first_of(told, "doc_id", ["page_number"], "point", 50)
    topics = first_of(told.select("doc_id", "topic").distinct(), "doc_id", ["topic"], "topic", 30)
    return points.join(topics, "doc_id").select("doc_id", big(F.size("point")).alias("n_points"), F.sha2(F.array_join("point", "|"), 256).alias("points_sha"), F.array_join("topic", "|").alias("topics"))


STATUS_SQL = """plan AS (SELECT d.source, CASE WHEN d.doc_id % 23 = 0 THEN 'skipped_csam' WHEN d.doc_id % 19 = 0 THEN 'no_chunks' WHEN l.toxic = 1 THEN 'withheld' ELSE 'ready' END AS status, CAST(length(d.text) // 500 + 1 AS BIGINT) AS vectors FROM documents d LEFT JOIN labels l USING (doc_id))"""


def _plan(t: Tables) -> DataFrame:
    d = F.col("doc_id")
    status = F.when(d % 23 == 0, "skipped_csam").when(d % 19 == 0, "no_chunks").when(F.col("toxic") == 1, "withheld").otherwise("ready")
    rows = judged(t, big(F.floor(F.length("text") / 500) + 1).alias("vectors"))
    return rows.select("doc_id", "source", "lang", status.alias("status"), "vectors")


@query(f"WITH {STATUS_SQL} SELECT source, CAST(count_if(status = 'ready') AS BIGINT) AS n_ready, CAST(count_if(status = 'withheld') AS BIGINT) AS n_withheld, CAST(count_if(status = 'no_chunks') AS BIGINT) AS n_no_chunks, CAST(count_if(status = 'skipped_csam') AS BIGINT) AS n_skipped_csam, count(*) AS n FROM plan GROUP BY source")
def plan_aggregation_status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.status_histogram(_plan(Tables(spark, sf_dir)), "source", "status", ["ready", "withheld", "no_chunks", "skipped_csam"])


@query(
    f"""WITH {PAGES}, b AS (SELECT p.source, CASE WHEN trim(content) = '' OR p.doc_id % 41 = 0 THEN 'placeholder_blank' WHEN l.toxic = 1 AND page_number % 2 = 1 THEN 'placeholder_withheld' ELSE 'copy' END AS action FROM pages_of p LEFT JOIN labels l USING (doc_id))
SELECT source, action, count(*) AS n FROM b GROUP BY ALL"""
)
def blob_action_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    blank = S.page_blank(F.when(F.col("doc_id") % 41 == 0, "blank"), F.col("content"), F.lit(False))
    rows = pages(t, "source").select("doc_id", "source", "page_number", blank.alias("blank")).join(t.labels.select("doc_id", "toxic"), "doc_id", "left")
    action = F.when(F.col("blank"), "placeholder_blank").when((F.col("toxic") == 1) & (F.col("page_number") % 2 == 1), "placeholder_withheld").otherwise("copy")
    return rows.groupBy("source", action.alias("action")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT l_suppkey, count(*) AS calls, CAST(sum(l_partkey) AS BIGINT) AS prompt_tokens, CAST(sum(least(l_orderkey % 1000, l_partkey)) AS BIGINT) AS cached_tokens, CAST(sum((l_partkey - least(l_orderkey % 1000, l_partkey)) * 100 + least(l_orderkey % 1000, l_partkey) * 25 + CAST(l_quantity AS BIGINT) * 400) AS BIGINT) AS cost_nano FROM lineitem GROUP BY l_suppkey"
)
def usage_accumulator(spark: SparkSession, sf_dir: str) -> DataFrame:
    cached = C.cached_within(F.col("l_partkey"), F.col("l_orderkey") % 1000)
    nano = C.usage_cost_nano(F.col("l_partkey"), big(F.col("l_quantity")), cached)
    return Tables(spark, sf_dir).lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("calls"), F.sum("l_partkey").alias("prompt_tokens"), F.sum(cached).alias("cached_tokens"), F.sum(nano).alias("cost_nano"))


@query(f"WITH {DIGEST_SQL} SELECT * FROM digest")
def collector_digest_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(Tables(spark, sf_dir))


# -- JSON, HTML, metadata, caches ------------------------------------------------------------------


@query("SELECT event_id, CAST(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def json_props_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).events.select("event_id", J.json_int(F.col("props"), "$.k").alias("k"), F.get_json_object("props", "$.missing").alias("missing"))


@query(
    r"""WITH b AS (SELECT page_id, regexp_extract_all(html, '<(h1|p)>([^<]*)', 2) AS texts, len(regexp_extract_all(html, '<li>')) AS n_items, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS title FROM pages)
SELECT page_id, '# ' || title AS heading, CAST(len(texts) AS BIGINT) AS n_blocks, CAST(n_items AS BIGINT) AS n_items, sha256(array_to_string(texts, chr(10) || chr(10))) AS blocks_sha FROM b"""
)
def html_block_reconstruct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings, paragraphs and list items of a page, joined by blank lines."""
    texts = F.regexp_extract_all("html", F.lit("<(h1|p)>([^<]*)"), F.lit(2))
    items = big(F.regexp_count("html", F.lit("<li>")))
    return Tables(spark, sf_dir).pages.select("page_id", F.concat(F.lit("# "), F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)).alias("heading"), big(F.size(texts)).alias("n_blocks"), items.alias("n_items"), F.sha2(F.array_join(texts, "\n\n"), 256).alias("blocks_sha"))


CACHE_SQL = "cache AS (SELECT doc_id, n_chars AS size, doc_id % 7 AS version FROM documents WHERE doc_id % 3 <> 0)"


@query(f"WITH {CACHE_SQL} SELECT CAST(count_if(c.doc_id IS NOT NULL) AS BIGINT) AS hits, CAST(count_if(c.doc_id IS NULL) AS BIGINT) AS misses FROM documents d LEFT JOIN cache c ON c.doc_id = d.doc_id AND c.size = d.n_chars AND c.version <> 3")
def incremental_digest_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of another version, or of another size or time, are misses."""
    d = Tables(spark, sf_dir).documents.select("doc_id", "n_chars")
    cache = d.where("doc_id % 3 <> 0 AND doc_id % 7 <> 3").select("doc_id", "n_chars", F.lit(True).alias("hit"))
    found = d.join(cache, ["doc_id", "n_chars"], "left").select(F.coalesce("hit", F.lit(False)).alias("hit"))
    return found.agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"))


@query("SELECT conv_id, count(*) AS n, array_to_string(list_distinct_ordered, ',') AS roles FROM (SELECT conv_id, turn, list_transform(list_sort(list_distinct(list({'r': first_turn, 'role': role}) OVER (PARTITION BY conv_id))), lambda x: x.role) AS list_distinct_ordered FROM (SELECT conv_id, turn, role, min(turn) OVER (PARTITION BY conv_id, role) AS first_turn FROM conversations)) GROUP BY conv_id, roles")
def ordered_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of a list in order of first appearance."""
    rows = Tables(spark, sf_dir).conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("x"))
    return rows.select("conv_id", "n", F.array_join(ordered_distinct(F.transform("x", lambda s: s["role"])), ",").alias("roles"))


@query("SELECT source || '/' || lang AS pair, count(*) AS n FROM documents GROUP BY ALL HAVING count(*) > 1")
def tenancy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair: Column = F.concat_ws("/", "source", "lang")
    return Tables(spark, sf_dir).documents.groupBy(pair.alias("pair")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
