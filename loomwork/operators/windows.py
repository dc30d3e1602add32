"""Samples, ranks, intervals and rate windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.storage import Scratch


def ranked(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Places from 0 within each group, for groups of any size.

    Rows are dealt by ranges of group and order and written; places are counted within a range, and the sums of the
    ranges before, one row for each group and range, are added.  No task sees more than a range.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = Scratch(spark, "ranks").keep(rows.repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id()), "dealt")
    sums = dealt.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sums.select(*(F.col(g).alias(f"_g{k}") for k, g in enumerate(group)), F.col("_part").alias("_p"), (F.sum("_n").over(W.partitionBy(*group).orderBy("_part")) - F.col("_n")).alias("_before"))
    local = dealt.withColumn("_at", F.row_number().over(W.partitionBy("_part", *group).orderBy(*order)) - 1)
    same = dealt["_part"] == before["_p"]
    for k, g in enumerate(group):
        same &= local[g].eqNullSafe(before[f"_g{k}"])
    return local.join(before, same).select(*rows.columns, (F.col("_at") + F.col("_before")).cast("bigint").alias(name))


def first_k(rows: DataFrame, group: str, order: list[str], k: int) -> DataFrame:
    """The first k rows of each group; the limit is applied before the shuffle as well."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)


def subsample(rows: DataFrame, group: list[str], order: list[str], most: int) -> DataFrame:
    """At most `most` rows of each group, evenly spaced: those at floor(i * n / most), reckoned in floating point."""
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    counted = ranked(rows, group, order, "at")
    same = F.lit(True)
    for g in group:
        same &= counted[g].eqNullSafe(sizes[g])
    counted = counted.join(sizes, same).select(*(counted[c] for c in counted.columns), "n")
    step = F.col("n").cast("double") / most
    i = F.ceil(F.col("at") / step)
    # at is chosen if some i < most has floor(i * step) = at; i is the first whole number with i * step >= at.
    near = F.exists(F.array(i - 1, i, i + 1), lambda j: (j >= 0) & (j < most) & (F.floor(j * step) == F.col("at")))
    return counted.where((F.col("n") <= most) | near)


def reindexed(rows: DataFrame, group: str, order: list[str], name: str = "chunk_index") -> DataFrame:
    return ranked(rows, [group], order, name)


def sound_spans(silent: DataFrame, key: str, start: str, end: str, duration: str) -> DataFrame:
    """key, span_start, span_end: what silence leaves of [0, duration]; a null end reaches the end.  Silent intervals may overlap.

    silent: one row for each interval, the duration repeated; a key's rows meet in one task, as many as it has intervals.
    """
    here = W.partitionBy(key).orderBy("_a", "_b")
    cut = silent.select(
        key, F.col(duration).alias("_d"), F.greatest(F.lit(0.0), F.least(F.col(start).cast("double"), F.col(duration))).alias("_a"), F.least(F.coalesce(F.col(end).cast("double"), F.col(duration)), F.col(duration)).alias("_b")
    ).where("_d > 0")
    upto = F.coalesce(F.max("_b").over(here.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    before = cut.withColumn("_u", F.greatest(upto, F.lit(0.0))).where("_a > _u").select(key, F.col("_u").alias("span_start"), F.col("_a").alias("span_end"))
    tail = cut.groupBy(key).agg(F.max("_b").alias("_u"), F.max("_d").alias("_d")).where("_u < _d").select(key, F.col("_u").alias("span_start"), F.col("_d").alias("span_end"))
    return before.union(tail)


def has_overlap(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    """Half-open overlap."""
    return (start < other_end) & (end > other_start)


def overlapping(rows: DataFrame, spans: DataFrame, key: str, width: int, start: str = "start_s", end: str = "end_s", span_start: str = "span_start", span_end: str = "span_end") -> DataFrame:
    """Rows that overlap any span of their key.  Both sides are dealt to cells of `width` seconds, so the join is equal on (key, cell) and long recordings spread over tasks."""
    cells = lambda a, b: F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width))
    left = rows.withColumn("_cell", F.explode(cells(start, end)))
    right = spans.select(F.col(key).alias("_key"), span_start, span_end, F.explode(cells(span_start, span_end)).alias("_span_cell"))
    meets = (left[key] == right["_key"]) & (left["_cell"] == right["_span_cell"]) & has_overlap(left[start], left[end], right[span_start], right[span_end])
    return left.join(right, meets, "left_semi").drop("_cell").distinct()


def rate_usage(events: DataFrame, key: str, ts: str, tokens: str, seconds: int = 60) -> DataFrame:
    """Requests and tokens of the seconds up to each event, itself included.

    Time is cut into stretches of 16 windows; an event in the last window of one is also sent to the next, where it
    only counts.  So the frame of a busy key is spread over tasks by time, for a sixteenth more rows at most.
    """
    at = F.col(ts).cast("timestamp").cast("long")
    width = 16 * seconds
    stretch = F.floor(at / width)
    late = F.pmod(at, F.lit(width)) >= width - seconds
    dealt = events.withColumn("_at", at).withColumn("_own", stretch).withColumn("_stretch", F.explode(F.when(late, F.array(stretch, stretch + 1)).otherwise(F.array(stretch))))
    here = W.partitionBy(key, "_stretch").orderBy("_at").rangeBetween(-(seconds - 1), 0)
    counted = dealt.withColumn("requests", F.count(F.lit(1)).over(here)).withColumn("tokens_in_window", F.sum(tokens).over(here))
    return counted.where("_own = _stretch").drop("_at", "_own", "_stretch")


def bounded_batches(rows: DataFrame, order: list[str], group: str, size: int) -> DataFrame:
    """Batches of `size` rows within each group, in order; the last may be smaller."""
    return ranked(rows, [group], order, "batch").withColumn("batch", F.floor(F.col("batch") / size).cast("bigint"))
