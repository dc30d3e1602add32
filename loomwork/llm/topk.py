"""Exact top-k search by Fagin's threshold algorithm.

Index: the vectors of each input partition are packed into blocks of bounded size; a block holds, for
every dimension, the list of its rows sorted by that component.  The lists are read side by side, from the
ends where components make products large; every row met is scored in full (random access), and a query's
search of the block stops when no row that hasn't been met can beat its k-th best: when the score of
a row that had the last value read in every list is below the k-th best score.  A tie could still win by a
smaller id, so the bound must be strictly below.  The queries of a group share what they read.

The k-th best is carried from block to block.  The most promising rows, the ROWS longest vectors, are
searched first, by all queries; what is the k-th best there is a floor below which no block has to look, so
a block whose list ends can't reach a query's floor isn't read for it at all.  A task hands the k-th best
on to its next blocks.  With count_reads, rows_read says how many rows of the index were scored for a query.

Queries and blocks meet in a grid: queries in groups of QUERIES, blocks in groups of rows, one equal join
on the cell.  Blocks are sent once for each group of queries, so an index of n rows is sent n / (QUERIES *
every) times.  Nothing is broadcast by this module and no task holds more than one block of either side at a
time beyond its Arrow batch; a task merges what its blocks find, and k rows for each query and task are
merged by a window whose limit is applied before the shuffle.

Defined results: vectors that are null or hold null, NaN or infinite components take no part, nor do rows
without an id.  Vectors meet only vectors of as many components.  Of rows that repeat an id the smallest
vector (the one of fewest components first) is the query; all others, equal ones too, are candidates of it
and of other queries.  Scaled components beyond 64 bits become the nearest 64-bit number; scores are 64-bit
sums that wrap, and where they could, no search stops early.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.storage import Scratch

#: Rows of a block of the index, rows for each group of blocks, queries of a group, and those of a group that are searched together.
ROWS, GROUP, QUERIES, TOGETHER = 2048, 8192, 16_384, 1024
#: Ranks that all lists are read before the bound is checked again after the first look; twice as many each next time.
FIRST_DEPTH = 4


def largest(x: np.ndarray) -> float:
    """The largest absolute value, also of the smallest integer."""
    return max(float(x.max()), -float(x.min())) if x.size else 0.0


class Best:
    """Each query's k best rows so far, its floor (a score that k rows are known to reach), and the rows scored for it."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.n, self.k, self.floor = n, k, floor.copy()
        self.query, self.ids, self.scores = (np.empty(0, np.int64) for _ in range(3))
        self.read = np.zeros(n, np.int64)

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        query, ids, scores = (np.concatenate(x) for x in ((self.query, query), (self.ids, ids), (self.scores, scores)))
        best = np.lexsort((ids, np.invert(scores), query))
        query, ids, scores = query[best], ids[best], scores[best]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        self.query, self.ids, self.scores = (x[place < self.k] for x in (query, ids, scores))
        full = np.flatnonzero(place == self.k - 1)
        self.floor[query[full]] = np.maximum(self.floor[query[full]], scores[full])


def threshold_search(best: Best, queries: np.ndarray, owns: np.ndarray, values: np.ndarray, order: np.ndarray, ids: np.ndarray) -> None:
    """Adds each query's rows of a block that may be among its k best.

    order: for each dimension, rows by ascending value.  The lists are read from both ends, for all queries
    at once; a row met in any list is scored against every query that is still searching.  For a query
    the bound takes, in each dimension, the last value read at the end that its component's sign asks for.
    """
    n, dim = values.shape
    reach = largest(values) * largest(queries) * max(1, dim)
    exact, wraps = reach < 2**53, reach >= 2**62
    kind = np.float64 if exact else np.int64
    v, q = values.astype(kind), queries.astype(kind)
    ranked = np.take_along_axis(v, order, axis=0)
    met = np.zeros(n, bool)
    active = np.arange(len(q))
    depth, step = 0, 0
    while depth < n and len(active):
        if not wraps:
            upto = max(depth - 1, 0)
            bound = np.maximum(q[active], 0) @ ranked[n - 1 - upto] + np.minimum(q[active], 0) @ ranked[upto]
            active = active[~(bound < best.floor[active])]
            if not len(active):
                break
        step = n if wraps or not dim else 2 * step or FIRST_DEPTH
        upto = min(n, depth + step)
        rows = np.unique(np.concatenate((order[depth:upto].ravel(), order[n - upto : n - depth].ravel()))) if dim else np.arange(n)
        rows = rows[~met[rows]].astype(np.int64)
        met[rows] = True
        best.read[active] += len(rows)
        score = q[active] @ v[rows].T
        own, at = np.nonzero(owns[active][:, None] == ids[rows][None, :])
        same = (queries[active[own]] == values[rows[at]]).all(axis=1)
        score[own[same], at[same]] = -np.inf if exact else np.iinfo(np.int64).min
        good = score >= best.floor[active][:, None].astype(kind)
        if score.shape[1] > best.k:
            good &= score >= np.partition(score, -best.k, axis=1)[:, -best.k][:, None]
        good[own[same], at[same]] = False
        at, row = np.nonzero(good)
        best.add(active[at], ids[rows[row]], score[at, row].astype(np.int64))
        depth = upto
        if met.all():
            break


def _pack(rows: int, sort: bool):
    """Packs (dim, vec_id, v, floor) rows of a partition into blocks of one dim."""

    def block(dim: int, ids: list, vectors: list, floors: list) -> pa.RecordBatch:
        v = np.array(vectors, np.int64).reshape(len(ids), dim)
        if v.size and v.min() >= -(2**31) and v.max() < 2**31:
            v = v.astype(np.int32)
        lists = np.argsort(v, axis=0, kind="stable").astype(np.uint16).tobytes() if sort else np.array(floors, np.int64).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary()), pa.array([lists], pa.binary())], names=["dim", "ids", "vals", "lists"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list, list]] = {}
        for batch in batches:
            for dim, vec_id, v, floor in zip(*(c.to_pylist() for c in batch.columns)):
                ids, vectors, floors = held.setdefault(dim, ([], [], []))
                ids.append(vec_id)
                vectors.append(v)
                floors.append(floor)
                if len(ids) == rows:
                    yield block(dim, *held.pop(dim))
        for dim, columns in held.items():
            yield block(dim, *columns)

    return run


PACKED = "dim int, ids binary, vals binary, lists binary"


def _unpack(dim: int, ids: bytes, vals: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    wide = len(vals) == 8 * len(i) * dim and dim
    return i, np.frombuffer(vals, np.int64 if wide else np.int32).reshape(len(i), dim).astype(np.int64)


class TopK:
    """k best candidates for each query; every: rows whose id it divides are the queries; scale: components become floor(scale * x)."""

    def __init__(self, k: int = 5, every: int = 50, scale: int = 256, count_reads: bool = False):
        self.k, self.every, self.scale, self.count_reads = k, every, scale, count_reads

    def scaled(self, vectors: DataFrame) -> DataFrame:
        """dim, vec_id, v: the rows that take part, as integers."""
        e, scale = F.col("embedding"), F.lit(float(self.scale))
        rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        rows = rows.where(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        return rows.select(F.size(e).alias("dim"), "vec_id", F.transform(e, lambda x: F.floor(x * scale)).alias("v"))

    def _grid(self, index: DataFrame, queries: DataFrame, columns: int, groups: int) -> DataFrame:
        """query_id, vec_id, score, rows_read: what each task finds for each query; a row without vec_id has the rows that were read.

        index: dim, vec_id, v; queries: dim, vec_id, v, floor.
        """
        k, count_reads = self.k, self.count_reads
        asked = queries.repartition(groups, F.xxhash64("vec_id")).select("dim", "vec_id", "v", "floor").mapInArrow(_pack(QUERIES, False), PACKED)
        asked = asked.select("dim", F.col("ids").alias("q_ids"), F.col("vals").alias("q_vals"), F.col("lists").alias("floors"))
        asked = asked.withColumn("g", F.pmod(F.xxhash64("q_ids"), F.lit(groups))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
        packed = index.select("dim", "vec_id", "v", F.lit(0).cast("bigint").alias("floor")).mapInArrow(_pack(ROWS, True), PACKED)
        packed = packed.withColumn("c", F.pmod(F.xxhash64("ids"), F.lit(columns))).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        cells = packed.join(asked, ["dim", "g", "c"]).sortWithinPartitions("dim", "g", "q_ids").select("dim", "ids", "vals", "lists", "q_ids", "q_vals", "floors")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, parts = None, []

            def found() -> Iterator[pa.RecordBatch]:
                for own, _, best in parts:
                    none = pa.nulls(len(own), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(own[best.query]), pa.array(best.ids), pa.array(best.scores), pa.nulls(len(best.ids), pa.int64())], names=["query_id", "vec_id", "score", "rows_read"])
                    if count_reads:
                        yield pa.RecordBatch.from_arrays([pa.array(own), none, none, pa.array(best.read)], names=["query_id", "vec_id", "score", "rows_read"])

            for batch in batches:
                for r in range(batch.num_rows):
                    dim, ids, vals, lists, q_ids, q_vals, floors = (c[r].as_py() for c in batch.columns)
                    if (dim, q_ids) != key:  # another group of queries: what was found for the one before goes on
                        yield from found()
                        key = dim, q_ids
                        owns, asked_for = _unpack(dim, q_ids, q_vals)
                        floor = np.frombuffer(floors, np.int64)
                        parts = [(owns[x : x + TOGETHER], asked_for[x : x + TOGETHER], Best(len(owns[x : x + TOGETHER]), k, floor[x : x + TOGETHER])) for x in range(0, len(owns), TOGETHER)]
                    ids, values = _unpack(dim, ids, vals)
                    order = np.frombuffer(lists, np.uint16).reshape(values.shape)
                    for own, asked_for, best in parts:
                        threshold_search(best, asked_for, own, values, order, ids)
            yield from found()

        return cells.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint, rows_read bigint")

    def search(self, candidates: DataFrame, queries: DataFrame) -> DataFrame:
        """query_id, rank, vec_id, score, and with count_reads rows_read; both sides: dim, vec_id, v."""
        k, scratch = self.k, Scratch(candidates.sparkSession, "topk")
        n = candidates.count()
        groups, columns = max(1, ceil(queries.count() / QUERIES)), max(1, ceil(n / GROUP))
        copies = queries.groupBy("vec_id", "dim", "v").agg(F.count(F.lit(1)).alias("n"))
        one = copies.groupBy("vec_id").agg(F.min(F.struct("dim", "v", "n")).alias("q")).select("vec_id", "q.dim", "q.v", "q.n")
        one = scratch.keep(one, "queries")
        low = F.lit(-(2**63)).cast("bigint")
        # The longest vectors first: the k-th best among them is a floor for all that follows.
        square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
        promising = candidates.orderBy(F.desc(square), "vec_id").limit(ROWS)
        first = self._grid(promising, one.withColumn("floor", low), 1, groups).where("vec_id IS NOT NULL")
        floors = first.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).select("query_id", F.get("s", F.lit(k - 1)).alias("floor"))
        floors = scratch.keep(one.join(floors, one["vec_id"] == F.col("query_id"), "left").select("dim", "vec_id", "v", F.coalesce("floor", low).alias("floor")), "floors")
        found = scratch.keep(self._grid(candidates, floors, columns, groups), "found")
        scratch.drop("floors")
        # Equal rows of a query's own id are candidates too, but for the query itself.
        again = one.where("n > 1").select(F.col("vec_id").alias("query_id"), "vec_id", F.aggregate("v", F.lit(0).cast("bigint"), lambda s, x: s + x * x).alias("score"), F.explode(F.sequence(F.lit(2), F.least("n", F.lit(k + 1).cast("bigint")).cast("int"))).alias("_"))
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        best = found.where("vec_id IS NOT NULL").select("query_id", "vec_id", "score").union(again.select("query_id", "vec_id", "score"))
        best = best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        if not self.count_reads:
            return best
        read = found.groupBy("query_id").agg(F.sum("rows_read").alias("rows_read"))
        return best.join(read, "query_id")

    def apply(self, vectors: DataFrame) -> DataFrame:
        rows = self.scaled(vectors)
        return self.search(rows, rows.where(F.col("vec_id") % self.every == 0))


ORACLE_SQL = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
long AS (SELECT vec_id, len(e) AS dim, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS at FROM v),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM long q JOIN long c ON q.at = c.at AND q.dim = c.dim AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
