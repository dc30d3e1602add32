"""Document fingerprints (SimHash), as DataFrame operations.

Method: the terms of a text are its pairs of neighbouring words (the last word stands alone), lower-cased;
a term's 64-bit hash votes, with the term's weight, for each bit; a bit of the fingerprint is one if its
votes outweigh the rest.  Longer terms are rarer and weigh more (1 to 16, by bytes).

Votes are counted in the map-side aggregate: 32 sums hold two 32-bit counters each, so one row per text
leaves each task.

All fingerprints within a Hamming radius r are found by permuted block tables: the 64 bits are cut into b
blocks, at least b - r of which must be equal, so each choice of b - r blocks keys one table and an equal
join on (table, key) finds every pair; equal fingerprints are one class before that.  b follows from the
number n of fingerprints, so that keys have SPARE bits more than n and chance meetings stay in proportion to
n.  Keys of one fingerprint meet nothing and go before the join; a key of more than HOT fingerprints is cut
into parts that meet each other in pairs of parts, each in a task of its own.  A pair counts in the first
table in which it meets, so pairs need not be made distinct.

The edited text of a document needs the start of the next document in order of ids.  Ids are dealt by
ranges, followed within each range, and ranges are linked by their first ids; then the start is brought by
equal joins.  No task sees more than a range of ids and one row for each range.

Defined results: null and empty texts are one empty term.  Ids are expected to be unique; rows that repeat
an id share the next document, and the next document of rows before them is the smallest text of that id.
Rows without an id come in no order: they have no next document, so nothing replaces the end of their edited
text and near_next is null.  A document alone is
its own next.  Columns other than id and text are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.storage import Scratch

SPACE = r"[\x20\x09-\x0D]+"
#: Bits 0 and 32: two counters in one sum.
LANES = (1 << 32) | 1
#: Ids in a range.
RANGE = 250_000
#: Bits that keys of block tables have beyond those of the number of fingerprints; fingerprints of one key that meet in one task.
SPARE, HOT = 4, 2048


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def fingerprints(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, copies (rows that share them) and their fingerprint as a long; rows with equal keys must have equal texts."""
    words = F.split(F.lower(F.col(text)), SPACE)
    terms = rows.select(*keys, words.alias("w")).select(*keys, F.posexplode(F.arrays_zip(F.col("w").alias("a"), F.slice("w", F.lit(2), F.size("w")).alias("b"))).alias("at", "term"))
    weight = F.least(F.octet_length("term.a") + F.coalesce(F.octet_length("term.b"), F.lit(0)), F.lit(15)) + 1
    terms = terms.select(*keys, "at", F.xxhash64("term.a", "term.b").alias("h"), weight.cast("bigint").alias("weight"))
    lane = lambda i: F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(LANES)) * F.col("weight")).alias(f"v{i}")
    votes = terms.groupBy(*keys).agg(F.sum("weight").alias("all"), F.count_if(F.col("at") == 0).alias("copies"), *(lane(i) for i in range(32)))
    bits = []
    for i in range(32):
        low, high = F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"v{i}", 32)
        # The sign bit of all - 2 * votes is the bit's value.
        bits += [F.shiftleft(F.shiftrightunsigned(F.col("all") - x * 2, 63), at) for at, x in ((i, low), (i + 32, high))]
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2])]
    return votes.select(*keys, "copies", bits[0].alias("fingerprint"))


def blocks_for(n: int, radius: int) -> int:
    """The least number of blocks whose keys have SPARE bits more than n."""
    return next((b for b in range(radius + 2, 17) if 64 * (b - radius) // b >= n.bit_length() + SPARE), 16)


def neighbours(found: DataFrame, radius: int = 3) -> DataFrame:
    """a, b, distance: all pairs of different fingerprints within the radius, a < b; found: fingerprint (copies collapse)."""
    one = found.where("fingerprint IS NOT NULL").select("fingerprint").distinct()
    blocks = blocks_for(one.count(), radius)
    edges = [64 * k // blocks for k in range(blocks + 1)]
    masks = [((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in range(blocks)]
    signed = lambda m: F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint")
    choices = list(combinations(range(blocks), blocks - radius))
    keys = [F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(signed(sum(masks[k] for k in c))).alias("x")) for t, c in enumerate(choices)]
    tables = one.select("fingerprint", F.explode(F.array(*keys)).alias("k")).select("fingerprint", "k.*")
    shared = tables.groupBy("t", "x").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / HOT)
    dealt = tables.join(shared, ["t", "x"]).withColumn("own", F.pmod(F.xxhash64("fingerprint"), parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    # Part p meets part q in the cell (p, q), p <= q: as the left side from p and as the right one from q.
    cell = dealt.select("t", "x", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "fingerprint")
    left, right = cell.where("own = p").select("t", "x", "p", "q", F.col("fingerprint").alias("a")), cell.where("own = q").select("t", "x", "p", "q", F.col("fingerprint").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    same = [differ.bitwiseAND(signed(m)) == 0 for m in masks]
    # The first choice of equal blocks is that of the first blocks - radius ones that are equal: no block before the last chosen one is equal but not chosen.
    first = F.lit(False)
    for t, c in enumerate(choices):
        skipped = [k for k in range(c[-1]) if k not in c]
        own = F.col("t") == t
        for k in skipped:
            own &= ~same[k]
        first |= own
    met = left.join(right, ["t", "x", "p", "q"]).where(F.when(F.col("p") == F.col("q"), F.col("a") < F.col("b")).otherwise(F.lit(True)))
    met = met.where((F.bit_count(differ) <= radius) & first)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.bit_count(differ).alias("distance"))


def followers(ids: DataFrame) -> DataFrame:
    """doc_id, need, next_id for distinct ids: the next larger id, after the last the first; need is passed on."""
    session = ids.sparkSession
    scratch = Scratch(session, "order")
    ids = scratch.keep(ids, "ids")
    ranges = max(1, ceil(ids.count() / RANGE))
    dealt = scratch.keep(ids.repartitionByRange(ranges, "doc_id").withColumn("part", F.spark_partition_id()), "dealt")
    scratch.drop("ids")
    ends = dealt.groupBy("part").agg(F.min("doc_id").alias("first"))
    order = W.orderBy("part")
    ends = ends.select("part", F.coalesce(F.lead("first").over(order), F.min("first").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("after"))
    inside = dealt.withColumn("inside", F.lead("doc_id").over(W.partitionBy("part").orderBy("doc_id")))
    return inside.join(ends, "part").select("doc_id", "need", F.coalesce("inside", "after").alias("next_id"))


def _with_edit(rows: DataFrame) -> DataFrame:
    """doc_id, n_chars, text, edited_text, edited_sha256 from doc_id, text and start (of the next document)."""
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    text = F.concat(F.substr("text", F.lit(1), n - quarter), F.substr("start", F.lit(1), quarter))
    return rows.select("doc_id", n.cast("bigint").alias("n_chars"), "text", text.alias("edited_text")).withColumn("edited_sha256", F.sha2("edited_text", 256))


def edited(known: DataFrame, order: DataFrame) -> DataFrame:
    """The rows of known (doc_id and text, neither null) with their edited texts; order: what followers() gives.

    Both joins read the same rows dealt by doc_id, so the texts are shuffled once and that exchange is reused;
    what follows groups by doc_id and more, so it needs no other exchange.
    """
    wanted = order.select(F.col("next_id"), F.col("doc_id").alias("for_id"), "need").hint("shuffle_hash")
    starts = known.join(wanted, known["doc_id"] == F.col("next_id")).select("for_id", F.substr("text", F.lit(1), F.col("need")).alias("start"))
    starts = starts.groupBy("for_id").agg(F.min("start").alias("start"))
    return _with_edit(known.join(starts, known["doc_id"] == starts["for_id"], "left").select("doc_id", "text", F.coalesce("start", F.lit("")).alias("start")))


def both_fingerprints(rows: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, copies, own, new: fingerprints of the texts and of the edited texts; rows of one id with other texts are kept apart.

    Every term carries the keys to its counters, so the digest is carried as four numbers.
    """
    words = [F.conv(F.substring("edited_sha256", 1 + 16 * k, 16), 16, -10).cast("bigint").alias(f"sha{k}") for k in range(4)]
    keys = ["doc_id", "n_chars", *(f"sha{k}" for k in range(4)), "text_hash"]
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited_text").alias("text")))
    sides = rows.select("doc_id", "n_chars", *words, F.xxhash64("text").alias("text_hash"), F.explode(kinds).alias("x")).select(*keys, "x.kind", "x.text")
    found = fingerprints(sides, [*keys, "kind"])
    side = lambda k: F.max(F.when(F.col("kind") == k, F.col("fingerprint")))
    by = found.groupBy(*keys).agg(F.max("copies").alias("copies"), side(0).alias("own"), side(1).alias("new"))
    return by.select("doc_id", "n_chars", F.concat(*(as_hex(F.col(f"sha{k}")) for k in range(4))).alias("edited_sha256"), "copies", "own", "new")


class Fingerprints:
    """radius: Hamming distance within which fingerprints of different texts are linked."""

    def __init__(self, radius: int = 3):
        self.radius = radius

    def links(self, rows: DataFrame, fingerprint: str, scratch: Scratch) -> DataFrame:
        """fingerprint, n_links: how many other fingerprints are within the radius, for those that have any."""
        ends = neighbours(rows.select(F.col(fingerprint).alias("fingerprint")), self.radius).select(F.explode(F.array("a", "b")).alias("fingerprint"))
        return scratch.keep(ends.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_links")), "links")

    def apply(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_links: one row for each row of docs.

        n_links counts the other fingerprints within the radius; documents with equal fingerprints are one class.
        """
        # Only what isn't a bigint is cast: a renamed column on one side of the joins would keep their exchanges apart.
        doc_id = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("bigint").alias("doc_id")
        base = docs.select(doc_id, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        known = base.where("doc_id IS NOT NULL")
        ids = known.groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 4).cast("int")).alias("need"))
        scratch = Scratch(docs.sparkSession, "fingerprints")
        order = scratch.keep(followers(ids), "order")
        placeless = _with_edit(base.where("doc_id IS NULL").select("doc_id", "text", F.lit("").alias("start")))
        rows = scratch.keep(both_fingerprints(edited(known, order)).unionByName(both_fingerprints(placeless)), "found")
        following = rows.groupBy("doc_id").agg(F.min("own").alias("following")).withColumnRenamed("doc_id", "next_id")
        nexts = order.select("doc_id", "next_id").join(following, "next_id").select("doc_id", "following")
        links = self.links(rows, "own", scratch).withColumnRenamed("fingerprint", "own")
        every = rows.join(nexts, "doc_id", "left").join(links, "own", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        return every.select(
            "doc_id", "n_chars", "edited_sha256", as_hex(F.col("own")).alias("fingerprint"), as_hex(F.col("new")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("new")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
