"""Mixing sources to target weights by a low-discrepancy schedule.

Method: 2^k slots are van der Corput points; each is mapped through the cumulative target shares to a
source.  The first 2^k points are all multiples of 2^-k, so a source's slots are a range of integers v and
slot v stands at position bitreverse(v): the map is exact and each source's slots are within one of its
share.  Slots are ranked per source; a source's documents, shuffled by a hash, are one stream of tokens
cut into blocks of equal size; the slot of rank r takes block r, going round the stream again when it
ends.  Closing slots, numbered after all points, source by source in turn, take what the targets lack.

What the mix takes is thus ordered: by slot, then by place in the stream.  first_slot is where a document
stands first; copies() gives every taking of a document with its slot, and in_order() deals rows out so
that files follow the schedule.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share budget times all
sizes; a target stops at most times its source's size and the excess is shared by weight among the rest.
With ratio = limit / weight ascending, the common level of those that aren't stopped is the largest of
(budget - limits of smaller ratio) / (weights from here on), which is what resharing ends with.

Everything is DataFrame operations.  Ranks and running sums are made in hash buckets and joined with the
buckets' offsets, so a source with a third of all rows is spread over many tasks; the number of buckets
follows from the number of documents and slots, PER_BUCKET in each.  Rows that a single task sees together:
one for each source, or for each bucket of a source.

Defined results: null text has size 0; a document of size 0 is taken 0 times; null is a source of its own;
an empty table gives an empty mix.  Ids are expected to be unique (they shuffle the stream); repeated rows
each have their own place in it.  Reruns agree.  Columns other than id, text and source are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.storage import Scratch

#: Documents, or slots, of a source in one bucket, if they are all of one source; least number of buckets, as a power of two.
PER_BUCKET, LEAST_BUCKETS = 50_000, 8
#: Slots that one row stands for before they are dealt out.
CHUNK = 4096

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Shape:
    """Tokens of the whole mix; 2^k slots of block tokens; sources; 2^bits buckets."""

    total: float
    k: int
    block: int
    sources: int
    bits: int


class SourceMix:
    """weights: by a source's place; budget, most: in multiples of the sizes; block: largest tokens of a slot."""

    def __init__(self, weights: tuple[int, ...] = (5, 2, 1), budget: float = 1.5, most: float = 2.0, block: int = 1024, seed: str = "mix"):
        self.weights, self.budget, self.most, self.block, self.seed = weights, budget, most, block, seed

    def sizes(self, docs: DataFrame) -> DataFrame:
        """doc_id, source, size."""
        return docs.select("doc_id", F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))

    def plan(self, sized: DataFrame) -> DataFrame:
        """source, sid, source_size, docs, target: one row for each source."""
        by = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
        place = F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1
        weight = F.element_at(F.array(*map(F.lit, self.weights)), (F.pmod(place, F.lit(len(self.weights))) + 1).cast("int"))
        by = by.select("source", "source_size", "docs", place.alias("sid"), weight.cast("double").alias("weight"), (F.col("source_size") * F.lit(self.most)).alias("limit"))
        order = W.orderBy(F.col("limit") / F.col("weight"), "sid")
        before = F.coalesce(F.sum("limit").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
        rest = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
        everyone = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        by = by.withColumn("level", (F.sum("source_size").over(everyone) * F.lit(self.budget) - before) / rest)
        return by.select("source", "sid", "source_size", "docs", F.least("limit", F.max("level").over(everyone) * F.col("weight")).alias("target"))

    @staticmethod
    def _offset(rows: DataFrame, amount: Column) -> DataFrame:
        """sid, bucket, offset: the sum of amount in the buckets before, for each sid."""
        sums = rows.groupBy("sid", "bucket").agg(F.sum(amount).alias("own"))
        return sums.select("sid", "bucket", (F.sum("own").over(W.partitionBy("sid").orderBy("bucket")) - F.col("own")).alias("offset"))

    def shape(self, plan: DataFrame) -> Shape:
        total, docs, sources = plan.agg(F.sum("target"), F.sum("docs"), F.max("sid") + 1).first()
        total = total or 0.0
        k = max(0, ceil(log2(max(1.0, total / self.block))))
        bits = max(LEAST_BUCKETS, ceil(log2(max(docs or 1, 1 << k) / PER_BUCKET)))
        return Shape(total, k, max(1, ceil(total / (1 << k))), sources or 0, min(24, bits))

    def schedule(self, plan: DataFrame, shape: Shape) -> DataFrame:
        """slot, sid, rank, low, high: the tokens [low, high) of its source's stream that each slot takes; slots from 2^k on are closing ones."""
        total, k, block = shape.total, shape.k, shape.block
        n = 1 << k
        upto = F.sum("target").over(W.orderBy("sid"))
        share = plan.select(
            "sid",
            F.floor("target").alias("quota"),
            F.ceil((upto - F.col("target")) * F.lit(n / total if total else 0.0)).alias("first"),
            F.ceil(upto * F.lit(n / total if total else 0.0)).alias("end"),
        )
        share = share.withColumn("end", F.least("end", F.lit(n)))
        chunks = share.where("end > first").select("sid", "quota", "end", F.explode(F.sequence("first", F.col("end") - 1, F.lit(CHUNK))).alias("at"))
        chunks = chunks.repartition("sid", "at")
        points = chunks.select("sid", "quota", F.explode(F.sequence("at", F.least(F.col("at") + CHUNK, "end") - 1)).alias("v"))
        slot = F.conv(F.reverse(F.lpad(F.bin("v"), k, "0")), 2, 10).cast("bigint") if k else F.lit(0).cast("bigint")
        slots = points.select("sid", "quota", slot.alias("slot")).withColumn("bucket", F.shiftright("slot", max(0, k - shape.bits)))
        offsets = self._offset(slots, F.lit(1))
        ranked = slots.withColumn("place", F.row_number().over(W.partitionBy("sid", "bucket").orderBy("slot")) - 1).join(offsets, ["sid", "bucket"])
        ranked = ranked.select("slot", "sid", (F.col("place") + F.col("offset")).alias("rank"), "quota")
        closing = share.select("sid", "quota", F.greatest(F.col("end") - F.col("first"), F.lit(0)).alias("had"))
        closing = closing.where(F.col("had") * block < F.col("quota")).select("sid", "quota", "had", F.explode(F.sequence("had", F.floor((F.col("quota") - 1) / block))).alias("rank"))
        closing = closing.select((n + (F.col("rank") - F.col("had")) * shape.sources + F.col("sid")).alias("slot"), "sid", "rank", "quota")
        low = F.col("rank") * block
        return ranked.union(closing).select("slot", "sid", "rank", low.alias("low"), F.least(low + block, "quota").alias("high")).where("low < high")

    def stream(self, sized: DataFrame, plan: DataFrame, shape: Shape) -> DataFrame:
        """doc_id, size, sid, start: places of the documents of size over 0 in their sources' shuffled streams."""
        key = F.md5(F.concat(F.lit(self.seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        rows = sized.where("size > 0").join(plan.select("source", "sid"), sized["source"].eqNullSafe(plan["source"])).select("doc_id", "size", "sid", key.alias("key"))
        rows = rows.withColumn("bucket", F.shiftright(F.conv(F.substring("key", 1, 6), 16, 10).cast("int"), 24 - shape.bits))
        here = W.partitionBy("sid", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
        placed = rows.withColumn("upto", F.sum("size").over(here)).join(self._offset(rows, F.col("size")), ["sid", "bucket"])
        return placed.select("doc_id", "size", "sid", (F.col("upto") - F.col("size") + F.col("offset")).alias("start"))

    def assignments(self, placed: DataFrame, plan: DataFrame, slots: DataFrame, block: int) -> DataFrame:
        """doc_id, size, sid, start, round, slot, taken: the tokens that each slot takes from each document, in its stream's first or second round; a document without any has slot null and taken 0."""
        rounds = placed.join(plan.select("sid", "source_size", F.floor("target").alias("quota")), "sid")
        rounds = rounds.withColumn("round", F.explode(F.array(F.lit(0), F.lit(1)))).where("round = 0 OR quota > source_size + start")
        low = F.col("start") + F.col("round") * F.col("source_size")
        parts = rounds.withColumn("a", low).withColumn("b", low + F.col("size"))
        last = F.floor((F.greatest(F.least("b", "quota"), F.col("a") + 1) - 1) / block)
        parts = parts.withColumn("rank", F.explode(F.sequence(F.floor(F.col("a") / block), last)))
        got = F.greatest(F.least("b", "high") - F.greatest("a", "low"), F.lit(0))
        return parts.join(slots.select("slot", "sid", "rank", "low", "high"), ["sid", "rank"], "left").select(
            "doc_id", "size", "sid", "start", "round", "slot", F.when(F.col("high").isNull(), 0).otherwise(got).alias("taken")
        )

    def _mixed(self, docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, Shape]:
        """Sizes, plan, assignments and shape of a mix."""
        scratch = Scratch(docs.sparkSession, "mix")
        sized = scratch.keep(self.sizes(docs), "sizes")
        plan = scratch.keep(self.plan(sized), "plan")
        shape = self.shape(plan)
        slots = scratch.keep(self.schedule(plan, shape), "slots")
        return sized, plan, self.assignments(self.stream(sized, plan, shape), plan, slots, shape.block), shape

    def apply(self, docs: DataFrame) -> DataFrame:
        """doc_id, size, source_size, target, taken, first_slot (null if nothing is taken): one row for each row of docs."""
        sized, plan, parts, _ = self._mixed(docs)
        first = F.min(F.when(F.col("taken") > 0, F.col("slot")))
        taken = parts.groupBy("sid", "start", "doc_id", "size").agg(F.sum("taken").alias("taken"), first.alias("first_slot"))
        none = sized.where("size = 0").join(plan, sized["source"].eqNullSafe(plan["source"])).select("sid", "doc_id", "size", F.lit(0).cast("bigint").alias("taken"), F.lit(None).cast("bigint").alias("first_slot"))
        every = taken.select("sid", "doc_id", "size", "taken", "first_slot").union(none)
        return every.join(plan.select("sid", "source_size", "target"), "sid").select("doc_id", "size", "source_size", "target", "taken", "first_slot")

    def copies(self, docs: DataFrame) -> tuple[DataFrame, int]:
        """doc_id, slot, start: one row for each time that the mix takes an id (twice at most), where it stands first; and the number of slots.

        Of rows that repeat an id the first place counts.
        """
        _, _, parts, shape = self._mixed(docs)
        taken = parts.where("taken > 0").groupBy("doc_id", "round").agg(F.min(F.struct("slot", "start")).alias("place"))
        return taken.select("doc_id", "place.slot", "place.start"), 1 << shape.k

    @staticmethod
    def in_order(rows: DataFrame, slots: int) -> DataFrame:
        """The rows dealt out by slot: partitions, and so files, follow each other in the order of the schedule, and so do their rows."""
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        part = F.least(F.floor(F.col("slot") * parts / slots), F.lit(parts - 1)).cast("int")
        return rows.repartitionById(parts, part).sortWithinPartitions("slot", "start")


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid, source_size * 2.0::DOUBLE AS lim FROM by_source),
leveled AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(lim) OVER (ORDER BY lim / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY lim / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
plan AS (
  SELECT source, sid, source_size, least(lim, max(level) OVER () * weight) AS target FROM leveled),
shape AS (
  SELECT total, k, CAST(power(2, k) AS BIGINT) AS n, greatest(1, CAST(ceil(total / power(2, k)) AS BIGINT)) AS block, sources
  FROM (SELECT total, sources, CAST(greatest(0, ceil(log2(greatest(1.0::DOUBLE, total / 1024)))) AS BIGINT) AS k FROM (SELECT sum(target) AS total, count(*) AS sources FROM plan))),
share AS (
  SELECT p.sid, CAST(floor(target) AS BIGINT) AS quota, k, n, block, sources, CAST(ceil((upto - target) * (n / total)) AS BIGINT) AS first_v, least(n, CAST(ceil(upto * (n / total)) AS BIGINT)) AS end_v
  FROM (SELECT *, sum(target) OVER (ORDER BY sid) AS upto FROM plan) p, shape),
points AS (SELECT sid, k, unnest(range(first_v, end_v)) AS v FROM share),
slots AS (
  SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank
  FROM (SELECT sid, CAST(list_sum(list_transform(range(0, k), lambda i: ((v >> i) & 1) << (k - 1 - i))) AS BIGINT) AS slot FROM points)),
placed AS (
  SELECT s.doc_id, s.size, p.sid, p.source_size, p.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY md5('mix:' || coalesce(CAST(s.doc_id AS VARCHAR), '')), s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
taking AS (
  SELECT *, CAST(greatest(least(upto, floor(target)) - (upto - size), 0)
          + greatest(least(source_size + upto, floor(target)) - (source_size + upto - size), 0) AS BIGINT) AS taken FROM placed)
SELECT t.doc_id, t.size, t.source_size, t.target, t.taken,
       CASE WHEN t.taken > 0 THEN coalesce(s.slot, CAST(h.n + ((t.upto - t.size) // h.block - greatest(0, h.end_v - h.first_v)) * h.sources + t.sid AS BIGINT)) END AS first_slot
FROM taking t JOIN share h ON h.sid = t.sid LEFT JOIN slots s ON s.sid = t.sid AND s.rank = (t.upto - t.size) // h.block
"""
