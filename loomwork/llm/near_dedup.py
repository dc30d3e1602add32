"""MinHash near-duplicate detection.

Method: every text becomes its set of word shingles; many universal hash minima make a signature;
bands of the signature are buckets of candidates; candidates are verified, first on signatures and
then on the full sets; links become components by alternating large-star and small-star.

How it keeps whole results without emitting all pairs of a bucket:

* Texts with equal shingle sets are one class and only its representative goes on, so a group of
  copies that holds a third of all rows costs one row after a map-side aggregate.
* In each bucket every member is compared with the bucket's leader only, on short signatures before
  full sets are brought together.  Once the components of these links are known, only buckets whose
  members still lie in different components are compared member by member, in blocks of bounded size,
  and only across components and between sets whose sizes allow the similarity.  Every pair that
  meets in a bucket is thus either verified or already connected.
* Full sets are made for members of buckets alone; Catalyst's Bloom filter of their ids keeps most other
  texts out of that shuffle as long as it isn't full.

Work that can't be avoided: a bucket of n sets of like sizes, all below the threshold with each other, takes
n * n / 2 comparisons, dealt over (n / BLOCK)^2 / 2 groups, each set being sent n / BLOCK times.

The chance that a pair at the threshold meets in none of the bands is (1 - 0.85**5)**20 < 1e-5.

Defined results: null text, empty text and text without words have an empty set, are linked with
nothing and are kept.  Rows without an id are linked with nothing and are kept.  Repeated rows share
their class.  Ids are expected to be unique; a row that repeats an id with another text is placed by
its own text, and texts that have the same smallest id are one node, linked by what any of them is linked by.  Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.storage import Scratch, arrow_batches, session_conf

#: Bound of a worker's table of word hashes; it is emptied when full.
WORD_MEMO = 100_000
#: Shingles that are hashed with all functions at once.
CHUNK = 1024
#: Bound of the members of one block when a bucket is compared member by member.
BLOCK = 256
#: For joins of texts with the few ids that are wanted: a Bloom filter of 2 MB, whatever the sides' sizes.
BLOOM = {f"spark.sql.optimizer.runtime.bloomFilter.{k}": v for k, v in {"enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": "1t", "expectedNumItems": "2000000", "numBits": str(1 << 24)}.items()}
#: Bytes that go to a Python worker at once while sets and signatures are compared.
BATCH = "16m"
#: Bound of the set members of one block, and of the columns that are multiplied at once.
BLOCK_SHINGLES, COLUMNS = 1_000_000, 4096


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMO:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, words_in: int, memo: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    base = np.uint64(0x9E3779B97F4A7C15)
    if n < words_in:
        h = np.array([n], np.uint64)
        for x in w:
            h = h * base + x
        return _mix(h)
    h = w[: n - words_in + 1].copy()
    for k in range(1, words_in):
        h *= base
        h += w[k : n - words_in + 1 + k]
    return np.unique(_mix(h))


def universal(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of n multiply-shift hash functions."""
    r = np.random.default_rng(seed)
    a = r.integers(0, 2**64, (n, 1), np.uint64, endpoint=False) | np.uint64(1)
    return a, r.integers(0, 2**64, (n, 1), np.uint64, endpoint=False)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), CHUNK):
        np.minimum(low, (a * shingles[k : k + CHUNK] + b).min(axis=1), out=low)
    return low >> np.uint64(32)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on full sets of distinct values."""
    both = len(x) + len(y)
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = both - len(np.unique(np.concatenate((x, y))))
    return 100 * common >= percent * (both - common)


def intersections(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[rows] with sets[cols]; values in one set only are left out, the rest go in bounded columns."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, value, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    keep = times[value] > 1
    owner, value = owner[keep], shared[value[keep]]
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    common = np.zeros((len(rows), len(cols)), np.float64)
    for low in range(0, int(value[-1]) + 1 if len(value) else 0, COLUMNS):
        a, b = np.searchsorted(value, (low, low + COLUMNS))
        grid = np.zeros((len(sets), COLUMNS), np.float32)
        grid[owner[a:b], value[a:b] - low] = 1
        common += grid[rows] @ grid[cols].T
    return common.astype(np.int64)


class NearDuplicates:
    """percent: least Jaccard similarity in hundredths; words: words of a shingle."""

    def __init__(self, words: int = 5, percent: int = 85, bands: int = 20, rows: int = 5, seed: int = 7):
        self.words, self.percent, self.bands, self.rows, self.seed = words, percent, bands, rows, seed
        #: A pair at the threshold falls this far below it in fewer than one of a million signatures.
        n = bands * rows
        p = percent / 100
        self.least_estimate = max(0.0, p - 5.5 * (p * (1 - p) / n) ** 0.5)

    # -- per-document work -------------------------------------------------------------------

    def _signatures(self, docs: DataFrame) -> DataFrame:
        words, bands, rows, seed = self.words, self.bands, self.rows, self.seed

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memo = _WordHash()
            a, b = universal(bands * rows, seed)
            salt = _mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            for batch in batches:
                n_shingles, keys, sigs, cells = [], [], [], []
                for text in batch.column(1):
                    s = shingle_set(text.as_py(), words, memo)
                    n_shingles.append(len(s))
                    if not len(s):
                        keys.append(None)
                        sigs.append(None)
                        cells.append(None)
                        continue
                    m = minima(s, a, b)
                    cell = salt.copy()
                    for k in range(rows):
                        cell = _mix(cell + m[k::rows])
                    keys.append(xxhash.xxh128_hexdigest(s.tobytes()))
                    sigs.append(m.astype(np.uint8).tobytes())
                    cells.append(cell.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(n_shingles, pa.int64()),
                        pa.array(keys, pa.string()),
                        pa.array(sigs, pa.binary()),
                        pa.array(cells, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "set_key", "sig", "cells"],
                )

        return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, set_key string, sig binary, cells array<bigint>")

    def _likely(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """Of the pairs (a, b), those whose signatures agree often enough; a byte of each minimum agrees at least as often as the whole."""
        least = self.least_estimate
        left, right = classes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), classes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
        sides = pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (2, 3))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

        return sides.mapInArrow(run, "a bigint, b bigint").distinct()

    def _payloads(self, docs: DataFrame, nodes: DataFrame) -> DataFrame:
        """node and its full set, for the nodes that share a bucket; a node has a row for each of its sets."""
        words = self.words
        wanted = docs.join(nodes, docs["doc_id"] == F.col("node")).select("node", "text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memo = _WordHash()
            for batch in batches:
                sets = [shingle_set(t.as_py(), words, memo).tobytes() for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "members"])

        return wanted.mapInArrow(run, "node bigint, members binary").where(F.octet_length("members") > 0).distinct()

    def _verified(self, pairs: DataFrame, payloads: DataFrame) -> DataFrame:
        """Of the pairs (a, b), those of which some full sets reach the threshold."""
        percent = self.percent
        left = payloads.select(F.col("node").alias("a"), F.col("members").alias("set_a"))
        right = payloads.select(F.col("node").alias("b"), F.col("members").alias("set_b"))
        sides = pairs.where("a <> b").join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = [similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent) for x, y in zip(batch.column(2), batch.column(3))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

        return sides.mapInArrow(run, "a bigint, b bigint").distinct()

    # -- candidates --------------------------------------------------------------------------

    def _across(self, mixed: DataFrame) -> DataFrame:
        """Links between members of one bucket in different components, found block by block on full sets.

        mixed: cell, band, blocks (number of blocks of the cell's band), node, root, members (the full set).
        """
        percent = self.percent
        own = F.pmod(F.xxhash64("node"), F.col("blocks"))
        dealt = mixed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("cell", "band", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "root", "members")

        def compare(key: tuple, table: pa.Table) -> pa.Table:
            x, y = key[2].as_py(), key[3].as_py()
            node, root, block = (table.column(c).to_numpy() for c in ("node", "root", "own"))
            sets = [np.frombuffer(m, np.uint64) for m in table.column("members").to_pylist()]
            size = np.array([len(s) for s in sets])
            common = intersections(sets, np.flatnonzero(block == x), np.flatnonzero(block == y))
            rows, cols = np.flatnonzero(block == x)[:, None], np.flatnonzero(block == y)[None, :]
            good = (100 * common >= percent * (size[rows] + size[cols] - common)) & (root[rows] != root[cols])
            i, j = np.nonzero(good)
            a, b = node[rows[i, 0]], node[cols[0, j]]
            return pa.table({"a": pa.array(np.maximum(a, b), pa.int64()), "b": pa.array(np.minimum(a, b), pa.int64())})

        return dealt.groupBy("cell", "band", "x", "y").applyInArrow(compare, "a bigint, b bigint").distinct()

    # -- the operator ------------------------------------------------------------------------

    def apply(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, n_shingles, component_id, kept: one row for each row of docs."""
        docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        scratch = Scratch(docs.sparkSession, "near-dedup")
        with arrow_batches(docs.sparkSession, BATCH), session_conf(docs.sparkSession, BLOOM):
            return self._apply(docs, scratch)

    def _apply(self, docs: DataFrame, scratch: Scratch) -> DataFrame:
        signed = scratch.keep(self._signatures(docs), "signatures")

        classes = scratch.keep(
            signed.where("doc_id IS NOT NULL AND n_shingles > 0")
            .groupBy("set_key")
            .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("cells").alias("cells")),
            "classes",
        )
        in_cell = classes.select("node", F.explode("cells").alias("cell"))
        # Written before it is joined: an aggregate's own rows can't be dealt anew, a table's can, so a hot cell is split.
        leaders = scratch.keep(in_cell.groupBy("cell").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1"), "leaders")
        members = scratch.keep(in_cell.join(leaders, "cell"), "members")

        stars = scratch.keep(members.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct(), "stars")
        likely = scratch.keep(self._likely(stars, classes), "likely")
        # Written, and read with a filter, as Catalyst makes Bloom filters only of filtered tables.
        wanted = scratch.keep(members.groupBy("node").agg(F.count(F.lit(1)).alias("cells")), "wanted").where("cells > 0").select("node")
        payloads = scratch.keep(self._payloads(docs, wanted), "sets")
        links = scratch.keep(self._verified(likely, payloads), "links")
        roots = components(links, scratch)

        # Sets whose sizes allow the similarity are in one band or in neighbouring ones: a set goes to its own band and the one below.
        sizes = classes.groupBy("node").agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"))
        rooted = members.where("n > 2").join(roots, "node", "left").select("cell", "node", F.coalesce("root", "node").alias("root")).distinct()
        width = log(100 / self.percent) + 1e-6
        band = lambda c: F.floor(F.log(c) / width)
        rooted = rooted.join(sizes, "node").withColumn("band", F.explode(F.sequence(band("least") - 1, band("most")))).withColumn("above", band("least") > F.col("band"))
        open_cells = scratch.keep(
            rooted.groupBy("cell", "band")
            .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("most").alias("all"), F.bool_and("above").alias("above"))
            .where("low <> high AND NOT above")  # sets that are all of the band above meet there
            .select("cell", "band", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("all") / BLOCK_SHINGLES)).alias("blocks")),
            "open",
        )
        mixed = rooted.select("cell", "band", "node", "root").join(open_cells, ["cell", "band"]).join(payloads.select("node", "members"), "node")
        extra = scratch.keep(self._across(mixed), "extra")
        if not extra.isEmpty():
            roots = components(links.union(extra), scratch)

        # What is left is read from the signatures, the classes and the last stars.
        scratch.drop("leaders", "members", "stars", "likely", "wanted", "sets", "links", "open", "extra")

        placed = classes.select("set_key", "node").join(roots, "node", "left").select("set_key", F.coalesce("root", "node").alias("root"))
        return signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(placed, "set_key", "left").select(
            "doc_id",
            "n_shingles",
            F.coalesce("root", "doc_id").alias("component_id"),
            F.col("doc_id").eqNullSafe(F.coalesce("root", "doc_id")).alias("kept"),
        )


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root (the smallest node it can reach) for every node with a link; links: a, b.

    Alternating large-star and small-star; each round is written to the shared folder, so lineage stays short.
    The minima are written before they are joined, so that the edges of a star's centre can be dealt to many tasks.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = scratch.keep(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before, label = state(edges), "edges"
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        low = scratch.keep(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = scratch.keep(large, "large")
        low = scratch.keep(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        old, label = label, f"small-{scratch.n}"
        edges = scratch.keep(small.union(low.select("a", F.col("m").alias("b"))).distinct(), label)
        scratch.drop("low", "large", old)
        after = state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct()).groupBy("node").agg(F.min("root").alias("root"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN ways e ON e.a = r.b),
components AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT c.doc_id, coalesce(n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM components c LEFT JOIN sizes USING (doc_id)
"""
