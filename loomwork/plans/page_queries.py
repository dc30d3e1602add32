"""Page geometry, pixels, glyphs, headers and what models answer, over shapes made from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import media as FM
from loomwork.functions import model_io as IO
from loomwork.functions import parse as J
from loomwork.operators import geometry as G
from loomwork.operators import models as P
from loomwork.operators import pixels as X
from loomwork.operators import routing as R
from loomwork.plans.base import PAGES, Tables, big, pages, query

# -- boxes -------------------------------------------------------------------------------------------

BOX_SQL = """boxes AS (SELECT l_orderkey AS page, l_linenumber AS n, CAST(l_partkey % 500 AS DOUBLE) AS x0, CAST(l_suppkey * 7 % 700 AS DOUBLE) AS y0, CAST(l_partkey % 500 AS DOUBLE) + l_quantity * 4 AS x1, CAST(l_suppkey * 7 % 700 AS DOUBLE) + l_quantity * 2 AS y1, l_returnflag AS flag, l_discount AS disc, l_tax AS tax FROM lineitem)"""


def _boxes(t: Tables) -> DataFrame:
    x, y, q = (F.col("l_partkey") % 500).cast("double"), (F.col("l_suppkey") * 7 % 700).cast("double"), F.col("l_quantity")
    box = F.struct(x.alias("x0"), y.alias("y0"), (x + q * 4).alias("x1"), (y + q * 2).alias("y1"))
    return t.lineitem.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("n"), box.alias("box"), F.col("l_returnflag").alias("flag"), F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"))


@query(
    f"""WITH {BOX_SQL}, w AS (SELECT page, list({{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}) AS words FROM boxes WHERE flag <> 'A' GROUP BY page)
SELECT b.page, b.n, (x1 - x0) * (y1 - y0) / 15000 >= 0.05 AND (x1 - x0) * (y1 - y0) / 15000 < 0.8
  AND len(list_filter(coalesce(w.words, []), lambda o: greatest(least(o.x1, b.x1) - greatest(o.x0, b.x0), 0) * greatest(least(o.y1, b.y1) - greatest(o.y0, b.y0), 0) > 0)) < 5 AS figure
FROM boxes b LEFT JOIN w USING (page) WHERE flag = 'A'"""
)
def figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of middle size with few words over them; a page's words travel as one array to its images."""
    rows = _boxes(Tables(spark, sf_dir))
    by = rows.groupBy("page").agg(F.collect_list(F.when(F.col("flag") != "A", F.col("box"))).alias("words"), F.collect_list(F.when(F.col("flag") == "A", F.struct("n", "box"))).alias("images"))
    return by.select("page", "words", F.explode("images").alias("i")).select("page", F.col("i.n").alias("n"), G.is_figure(F.col("i.box"), F.col("words"), F.lit(15000.0)).alias("figure"))


@query(f"WITH {BOX_SQL} SELECT page, round(least(1.0::DOUBLE, sum((x1 - x0) * (y1 - y0)) / 150000), 9) AS coverage FROM boxes GROUP BY page")
def bar_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of a page that its bars cover."""
    by = _boxes(Tables(spark, sf_dir)).groupBy("page").agg(F.sort_array(F.collect_list("box")).alias("bars"))
    return by.select("page", F.round(G.bar_coverage(F.col("bars"), F.lit(150000.0)), 9).alias("coverage"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN (l_discount * 3 + l_tax * 3 + l_quantity / 50) / 3 < 0.25 THEN 'dark' WHEN (l_discount * 3 + l_tax * 3 + l_quantity / 50) / 3 > 0.90 THEN 'white' ELSE 'other' END AS kind FROM lineitem")
def occluders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of filled shapes by the mean of their colour."""
    colour = F.array(F.col("l_discount") * 3, F.col("l_tax") * 3, F.col("l_quantity") / 50)
    return Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", G.occluder_kind(G.luminance(colour)).alias("kind"))


@query(
    """WITH p AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS w, l_quantity * 40 AS h FROM lineitem), x AS (SELECT *, (w * 200 / 72) * (h * 200 / 72) AS px FROM p)
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN px > 40000000 THEN greatest(36, floor(200 * sqrt(40000000 / px))) ELSE 200 END AS INTEGER) AS dpi FROM x"""
)
def render_dpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolution of a page's render, lowered for large pages."""
    return Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", G.clamped_dpi(F.col("l_extendedprice"), F.col("l_quantity") * 40, 200, 40_000_000, 36).alias("dpi"))


@query(
    f"""WITH {BOX_SQL}, s AS (SELECT *, CASE WHEN x1 <= 300 + 30 THEN 0 WHEN x0 >= 300 - 30 THEN 1 END AS side FROM boxes),
p AS (SELECT *, count(*) OVER w AS n_all, count(*) FILTER (side IS NULL) OVER w AS across, count(*) FILTER (side = 0) OVER w AS l, count(*) FILTER (side = 1) OVER w AS r FROM s WINDOW w AS (PARTITION BY page)),
t AS (SELECT *, l >= 2 AND r >= 2 AND across <= greatest(1, n_all // 10) AS two FROM p)
SELECT page, n, CAST(row_number() OVER (PARTITION BY page ORDER BY CASE WHEN two THEN coalesce(side, 0) ELSE 0 END, round(y0, 1), round(x0, 1), n) AS INTEGER) AS place, two AND across > 0 AS ambiguous FROM t"""
)
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of blocks in reading order, in two columns where the page has them."""
    rows = _boxes(Tables(spark, sf_dir)).withColumn("page_x0", F.lit(0.0)).withColumn("page_width", F.lit(600.0))
    return G.reading_order(rows, "page", ties=["n"]).select("page", "n", "place", "ambiguous")


@query(
    """WITH g AS (SELECT l_orderkey, count(*) AS total, CAST(count_if(l_linenumber % 3 = 0 OR l_discount = 0) AS BIGINT) AS invisible, count(DISTINCT l_quantity) AS sizes FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, invisible, total - invisible AS visible, CASE WHEN total = 0 THEN 'none' WHEN invisible / total >= 0.5 AND sizes >= 8 THEN 'ocr_layer' WHEN invisible / total < 0.1 AND sizes <= 4 THEN 'born_digital' ELSE 'mixed' END AS layer FROM g"""
)
def text_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invisible and visible glyphs of a page, and what kind of text layer they make."""
    glyph = F.struct(F.when(F.col("l_linenumber") % 3 == 0, 3).otherwise(0).alias("mode"), F.when(F.col("l_discount") == 0, 0.0).otherwise(1.0).alias("opacity"), F.col("l_quantity").alias("size"))
    by = Tables(spark, sf_dir).lineitem.groupBy("l_orderkey").agg(F.collect_list(glyph).alias("glyphs"))
    rows = by.select("l_orderkey", R.glyph_counts(F.col("glyphs")).alias("c"), F.size("glyphs").alias("total"), F.size(F.array_distinct(F.transform("glyphs", lambda g: g["size"]))).alias("sizes"))
    return rows.select("l_orderkey", big("c.invisible").alias("invisible"), big("c.visible").alias("visible"), R.text_layer(F.col("c.invisible"), F.col("total"), F.col("sizes")).alias("layer"))


@query(f"WITH {BOX_SQL} SELECT page, count(*) AS n_boxes, sum(x0) AS x0, sum(y1) AS y1 FROM boxes WHERE n % 3 = 0 OR disc = 0 GROUP BY page")
def invisible_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of invisible glyphs."""
    glyph = F.struct(F.when(F.col("n") % 3 == 0, 3).otherwise(0).alias("mode"), F.when(F.col("disc") == 0, 0.0).otherwise(1.0).alias("opacity"), "box")
    by = _boxes(Tables(spark, sf_dir)).groupBy("page").agg(F.collect_list(glyph).alias("g"))
    each = by.select("page", F.explode(R.invisible_boxes(F.col("g"))).alias("b"))
    return each.groupBy("page").agg(F.count(F.lit(1)).alias("n_boxes"), F.sum("b.x0").alias("x0"), F.sum("b.y1").alias("y1"))


@query(
    f"""WITH {BOX_SQL} SELECT page, n, array_to_string(list_filter([CASE WHEN flag = 'R' THEN CASE WHEN disc > 0.05 THEN 'blank_black' WHEN n % 3 > 0 THEN 'slip_sheet' ELSE 'blank_page' END END,
  CASE WHEN CAST(x0 AS BIGINT) >= 3 * greatest(1, CAST(y0 AS BIGINT)) THEN 'heavy_invisible_layer' END, CASE WHEN n % 3 > 0 THEN 'image_safety_required' END, CASE WHEN n % 4 <> 0 THEN 'rotated' END], lambda x: x IS NOT NULL), ',') AS flags,
  CASE WHEN flag = 'N' THEN 'blank' ELSE 'image' END AS kind FROM boxes"""
)
def page_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of a page in their order, and image pages that turned out to show nothing."""
    c = F.col
    made = R.page_flags(F.when(c("flag") == "R", "blank").otherwise("low_text"), c("disc") > 0.05, c("n") % 3, big("box.x0"), big("box.y0"), c("n") % 4)
    return _boxes(Tables(spark, sf_dir)).select("page", "n", F.array_join(made, ",").alias("flags"), R.demoted_kind(F.lit("image"), c("flag") == "N").alias("kind"))


# -- pixels: the 32 bytes of a text's digest stand for a grey image of 8 by 4 ---------------------------

PIXEL_SQL = """px AS (SELECT doc_id, list_transform(range(0, 32), lambda i: CAST('0x' || substr(sha256(text), 2 * i + 1, 2) AS INTEGER)) AS b FROM documents)"""


@query(
    f"""WITH {PIXEL_SQL} SELECT doc_id, len(list_filter(b, lambda x: x < 250)) / 32.0::DOUBLE AS ink, len(list_filter(b, lambda x: x < 60)) / 32.0::DOUBLE AS dark, round(list_avg(b), 9) AS mean, round(list_stddev_pop(b), 9) AS stddev,
  (len(list_filter(b[10:12], lambda x: x < 60)) + len(list_filter(b[18:20], lambda x: x < 60))) / 6.0::DOUBLE AS box_dark FROM px""".replace("list_stddev_pop(b)", "list_aggregate(b, 'stddev_pop')")
)
def pixel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of ink and of dark pixels, mean and deviation, and the dark share of a box."""
    rows = Tables(spark, sf_dir).documents.select("doc_id", F.unhex(F.sha2("text", 256)).alias("p"))
    box = F.struct(F.lit(1.0).alias("x0"), F.lit(1.0).alias("y0"), F.lit(4.0).alias("x1"), F.lit(3.0).alias("y1"))
    made = rows.select("doc_id", G.pixel_coverage("p", F.lit(250), F.lit(60)).alias("c"), G.region_stats("p").alias("s"), G.dark_fraction("p", F.lit(8), box, F.lit(60)).alias("box_dark"))
    return made.select("doc_id", "c.ink", "c.dark", F.round("s.mean", 9).alias("mean"), F.round("s.stddev", 9).alias("stddev"), "box_dark")


@query(
    """WITH d AS (SELECT doc_id, [1, 3, 4][CAST(doc_id % 3 AS INTEGER) + 1] AS c, CAST(doc_id % 9 + 1 AS BIGINT) AS w, CAST(doc_id % 5 + 1 AS BIGINT) AS h, sha256(text) AS s FROM documents),
b AS (SELECT *, CAST('0x' || substr(s, 1, 2) AS INTEGER) AS b1, CAST('0x' || substr(s, 3, 2) AS INTEGER) AS b2, CAST('0x' || substr(s, 5, 2) AS INTEGER) AS b3, CAST('0x' || substr(s, 7, 2) AS INTEGER) AS b4 FROM d)
SELECT doc_id, CAST(w AS INTEGER) AS width, CAST(h AS INTEGER) AS height, CAST(CASE WHEN greatest(w, h) <= 4 THEN w ELSE greatest(1, w * 4 // greatest(w, h)) END AS INTEGER) AS small_width, CAST(CASE WHEN greatest(w, h) <= 4 THEN h ELSE greatest(1, h * 4 // greatest(w, h)) END AS INTEGER) AS small_height FROM b"""
)
def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of pictures brought to RGB and of their thumbnails; pixels are repeated digests in one, three or four components."""
    d = F.col("doc_id")
    rows = Tables(spark, sf_dir).documents.select("doc_id", F.element_at(F.array(F.lit(1), F.lit(3), F.lit(4)), (d % 3 + 1).cast("int")).alias("c"), (d % 9 + 1).cast("int").alias("w"), (d % 5 + 1).cast("int").alias("h"), F.sha2("text", 256).alias("s"))
    pixels = F.unhex(F.substr(F.repeat("s", F.lit(6)), F.lit(1), F.col("c") * F.col("w") * F.col("h") * 2))
    made = rows.select("doc_id", FM.png_size(X.normalised(pixels, F.col("w"), F.col("c"))).alias("p"), FM.png_size(X.thumbnail(pixels, F.col("w"), F.col("c"), 4)).alias("t"))
    return made.select("doc_id", F.col("p.width").alias("width"), F.col("p.height").alias("height"), F.col("t.width").alias("small_width"), F.col("t.height").alias("small_height"))


@query("SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN CAST(n_chars % 4096 AS INTEGER) END AS width, CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id % 4096 AS INTEGER) END AS height FROM documents")
def image_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width and height of images from their headers; none for what isn't an image."""
    four = lambda c: F.lpad(F.hex(c), 8, "0")
    start = F.when(F.col("doc_id") % 5 != 0, "89504E470D0A1A0A").otherwise("0000000000000000")
    content = F.unhex(F.concat(start, F.lit("0000000D49484452"), four(F.col("n_chars") % 4096), four(F.col("doc_id") % 4096), F.lit("0802")))
    return Tables(spark, sf_dir).documents.select("doc_id", FM.png_size(content).alias("s")).select("doc_id", "s.width", "s.height")


@query(
    """WITH e AS (SELECT event_id, floor(value)::DOUBLE AS d, event_id % 4 AS k FROM events), s AS (SELECT *, list_transform(range(0, k), lambda i: i * 1.5::DOUBLE) AS scenes, CASE WHEN d > 0 THEN [round(0.25 * d, 3), round(0.75 * d, 3)] ELSE [0.0::DOUBLE] END AS even FROM e),
m AS (SELECT *, CASE WHEN k >= 2 THEN scenes ELSE list_sort(list_distinct(list_concat(scenes, even))) END AS x FROM s)
SELECT event_id, CAST(len(x) AS BIGINT) AS n, x[1] AS first_s, x[len(x)] AS last_s FROM m"""
)
def keyframe_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of keyframes: scene changes, with even ones where there are too few."""
    k, d = F.col("event_id") % 4, F.floor("value").cast("double")
    scenes = F.when(k > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), F.greatest(k, F.lit(1)) - 1), lambda i: i * 1.5)).otherwise(F.array().cast("array<double>"))
    rows = Tables(spark, sf_dir).events.select("event_id", FM.keyframe_times(scenes, d).alias("x"))
    return rows.select("event_id", big(F.size("x")).alias("n"), F.element_at("x", 1).alias("first_s"), F.element_at("x", -1).alias("last_s"))


# -- answers of models -----------------------------------------------------------------------------------


def _json(t: Tables) -> Column:
    d = F.col("doc_id")
    return F.to_json(
        F.struct(
            F.concat(F.lit(" s"), d, F.lit(" ")).alias("summary"), F.transform(F.sequence(F.lit(1).cast("bigint"), d % 12 + 1), lambda i: F.concat(F.lit("k"), i)).alias("key_points"), F.array(F.lit(" a "), F.lit(""), F.col("lang")).alias("topics"),
            F.array(F.struct(F.lit(" N ").alias("name"), F.when(d % 2 == 0, "org").otherwise("ship").alias("type")), F.struct(F.lit(" ").alias("name"), F.lit("org").alias("type"))).alias("entities"),
            F.struct(F.element_at(F.array(F.lit("ok"), F.lit("review"), F.lit("bad")), (d % 3 + 1).cast("int")).alias("flag"), F.array(F.lit("hate"), F.lit("boats")).alias("categories")).alias("text_safety"),
        )
    )


@query(
    """SELECT doc_id, 's' || doc_id AS summary, array_to_string(list_transform(range(1, least(8, doc_id % 12 + 1) + 1), lambda i: 'k' || i), ',') AS points, 'a,' || lang AS topics, CASE WHEN doc_id % 2 = 0 THEN 'N/org' ELSE 'N/other' END AS entities,
  CASE WHEN doc_id % 3 = 1 THEN 'review' ELSE 'ok' END AS flag, CASE WHEN doc_id % 3 = 1 THEN 'hate' ELSE '' END AS categories FROM documents"""
)
def page_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page model's answers brought within their bounds; every third is fenced, every fifth has words around it."""
    t, d = Tables(spark, sf_dir), F.col("doc_id")
    text = F.when(d % 3 == 0, F.concat(F.lit("```json\n"), _json(t), F.lit("\n```"))).when(d % 5 == 0, F.concat(F.lit("Here {it} is: "), _json(t), F.lit(" that's all"))).otherwise(_json(t))
    rows = t.documents.select("doc_id", FM.page_answer(J.structured(text, FM.PAGE_ANSWER)).alias("a"))
    entities = F.array_join(F.transform("a.entities", lambda e: F.concat(e["name"], F.lit("/"), e["type"])), ",")
    return rows.select("doc_id", "a.summary", F.array_join("a.key_points", ",").alias("points"), F.array_join("a.topics", ",").alias("topics"), entities.alias("entities"), "a.flag", F.array_join("a.categories", ",").alias("categories"))


@query(
    """WITH v AS (SELECT doc_id, ['photo','blank','unheard','text_only','handwriting'][CAST(doc_id % 5 AS INTEGER) + 1] AS c, doc_id % 2 = 0 AS seen, (doc_id % 30) / 20.0::DOUBLE AS conf FROM documents)
SELECT doc_id, CASE WHEN c = 'unheard' THEN 'indeterminate' ELSE c END AS content_class, seen AND c NOT IN ('blank', 'text_only') AS has_visual_content, CASE WHEN doc_id % 7 = 0 THEN 0 ELSE least(1, conf) END::DOUBLE AS confidence, doc_id % 4 = 0 AS minor FROM v"""
)
def vision_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vision model's verdicts brought within their bounds."""
    d = F.col("doc_id")
    kind = F.element_at(F.array(*map(F.lit, ("photo", "blank", "unheard", "text_only", "handwriting"))), (d % 5 + 1).cast("int"))
    confidence = F.when(d % 7 == 0, "high").otherwise((d % 30 / 20.0).cast("double").cast("string"))
    text = F.to_json(F.struct(kind.alias("content_class"), (d % 2 == 0).alias("has_visual_content"), confidence.alias("vision_confidence"), F.struct(F.lit("ok").alias("flag"), F.when(d % 4 == 0, True).alias("minor_indicator")).alias("safety")))
    rows = Tables(spark, sf_dir).documents.select("doc_id", FM.vision_answer(J.structured(text, FM.VISION_ANSWER)).alias("a"))
    return rows.select("doc_id", "a.content_class", "a.has_visual_content", F.col("a.vision_confidence").alias("confidence"), F.col("a.safety.minor_indicator").alias("minor"))


@query(
    """WITH e AS (SELECT event_id, CAST(floor(value) AS BIGINT) AS p FROM events) SELECT event_id, CASE WHEN event_id % 6 = 5 THEN 0 ELSE p END AS prompt, CASE WHEN event_id % 6 = 5 THEN 0 ELSE event_id % 70 END AS completion, CASE WHEN event_id % 6 = 5 THEN 0 ELSE least(p, 50) END AS cached,
  event_id % 5 IN (1, 2, 3) AS refused FROM e"""
)
def call_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of answers, cached ones never over the prompt's, and refusals by code, inner code or words."""
    e = F.col("event_id")
    prompt = big(F.floor("value"))
    usage = F.when(e % 6 == 5, "{}").otherwise(F.concat(F.lit('{"usage":{"prompt_tokens":'), prompt, F.lit(',"completion_tokens":'), e % 70, F.lit(',"prompt_tokens_details":{"cached_tokens":50}}}')))
    body = F.when(e % 5 == 1, '{"error":{"code":"content_filter"}}').when(e % 5 == 2, '{"error":{"code":"x","innererror":{"code":"ResponsibleAIPolicyViolation"}}}').when(e % 5 == 3, "not JSON: the Content Management Policy says no").otherwise('{"error":{"code":"timeout"}}')
    return Tables(spark, sf_dir).events.select("event_id", IO.usage(usage).alias("u"), J.content_filtered(body).alias("refused")).select("event_id", "u.prompt", "u.completion", "u.cached", "refused")


@query("SELECT vec_id, CAST(len(embedding) AS BIGINT) AS dims, round(embedding[1]::DOUBLE, 4) AS first_value, round(-embedding[1]::DOUBLE, 4) AS second_first FROM embeddings")
def vector_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of an embedding answer by their index, whatever the order of its entries."""
    v = F.transform("embedding", lambda x: F.round(x.cast("double"), 4))
    body = F.to_json(F.struct(F.array(F.struct(F.lit(1).alias("index"), F.transform(v, lambda x: -x).alias("embedding")), F.struct(F.lit(0).alias("index"), v.alias("embedding"))).alias("data")))
    t = Tables(spark, sf_dir)
    dims = int(t.embeddings.select(F.max(F.size("embedding"))).first()[0] or 0)
    rows = t.embeddings.select("vec_id", IO.vectors_in_order(body, dims).alias("v"))
    first = lambda k: F.round(F.get(F.get("v", F.lit(k)), F.lit(0)).cast("double"), 4)
    return rows.select("vec_id", big(F.size(F.get("v", F.lit(0)))).alias("dims"), first(0).alias("first_value"), first(1).alias("second_first"))


@query("SELECT conv_id, turn, trim(text) AS said, CAST(length(text) // 4 + 85 + 300 AS BIGINT) AS tokens FROM conversations")
def transcript_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of transcription answers, as JSON or bare, and the tokens of a request with a text and an image."""
    body = F.when(F.col("turn") % 2 == 0, F.to_json(F.struct("text"))).otherwise(F.concat(F.lit("  "), "text", F.lit(" ")))
    parts = F.array(F.struct(F.lit("text").alias("type"), "text"), F.struct(F.lit("image").alias("type"), F.lit("ignored").alias("text")))
    return Tables(spark, sf_dir).conversations.select("conv_id", "turn", IO.transcript_text(body).alias("said"), IO.vision_tokens(parts, F.lit(85).cast("bigint"), 300).alias("tokens"))


# -- batch jobs ---------------------------------------------------------------------------------------------


class FileService:
    """A batch service on files: answers each request line with its text's length, refuses some pages and fails others in the first round."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out, self.jobs, self.asked = spark, out, {}, {}

    def submit(self, folder: str) -> str:
        name = f"job-{len(self.jobs)}"
        body = lambda path: F.get_json_object("value", path)
        page = F.regexp_extract(body("$.custom_id"), r"_(\d+)$", 1).cast("bigint")
        size = F.length(F.get_json_object(body("$.body"), "$.input"))
        first = not self.jobs
        code = F.when(page % 11 == 0, "content_filter").when(F.lit(first) & (page % 3 == 0) | (page % 13 == 0), "server_error")
        line = F.to_json(F.struct(body("$.custom_id").alias("custom_id"), F.when(code.isNull(), size.cast("string")).alias("response"), F.when(code.isNotNull(), F.struct(code.alias("code"))).alias("error")))
        self.spark.read.text(folder).select(line.alias("value")).write.text(f"{self.out}/{name}")
        self.jobs[name] = 0
        return name

    def get(self, batch_id: str) -> dict:
        self.jobs[batch_id] += 1
        return {"status": "in_progress"} if self.jobs[batch_id] < 3 else {"status": "completed", "output": f"{self.out}/{batch_id}"}


BATCH_SQL = f"WITH {PAGES}, p AS (SELECT doc_id, page_number AS page, content AS text FROM pages_of)"


@query(f"{BATCH_SQL} SELECT doc_id AS doc, page, CASE WHEN page % 11 <> 0 AND page % 13 <> 0 THEN CAST(length(text) AS VARCHAR) END AS result, CASE WHEN page % 11 = 0 THEN 'filtered' WHEN page % 13 = 0 THEN 'error' ELSE 'ok' END AS status FROM p")
def batch_job_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages sent as batch jobs: what fails goes again in the next round, what is refused doesn't."""
    from loomwork.storage import Scratch

    rows = pages(Tables(spark, sf_dir)).select("doc_id", F.col("page_number").alias("page"), F.col("content").alias("text"))
    out = Scratch(spark, "batch-files").root
    return P.batch_rounds(rows, FileService(spark, f"{out}/answers"), "doc_id", "page", "text", out, rounds=3, interval=0.0)


@query(f"{BATCH_SQL} SELECT doc_id, page, CASE page % 4 WHEN 0 THEN 'rotated' WHEN 1 THEN 'rotated,content_filtered' WHEN 2 THEN 'rotated,summary_error' ELSE 'rotated' END AS flags FROM p")
def page_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's flags after a run: stale marks go, a refusal or failure leaves its own."""
    rows = pages(Tables(spark, sf_dir)).select("doc_id", F.col("page_number").alias("page"))
    before = F.when(F.col("page") % 2 == 0, F.array(F.lit("rotated"), F.lit("content_filtered"))).otherwise(F.array(F.lit("summary_error"), F.lit("rotated")))
    status = F.when(F.col("page") % 4 == 1, "filtered").when(F.col("page") % 4 == 2, "error").otherwise("ok")
    return rows.select("doc_id", "page", F.array_join(P.page_state(before, status), ",").alias("flags"))
