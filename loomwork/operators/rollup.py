"""Rollups from documents to datasets and the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dataset_and_corpus(digest: DataFrame, dataset: str, aggregates: list[Column]) -> DataFrame:
    """One row for each dataset and one, with dataset null, for the corpus: both from one pass over partial sums.  Aggregates must be sums, counts, minima or maxima."""
    return digest.groupingSets([[F.col(dataset)], []], F.col(dataset)).agg(*aggregates)


def progress(applicable: Column, done: Column) -> Column:
    """Share done in tenths of a percent, whole; null where nothing applies."""
    return F.when(applicable > 0, F.floor((done * 2000 + applicable) / (applicable * 2)).cast("bigint"))


def projected_nano(cost: Column, done: Column, applicable: Column) -> Column:
    """Cost of what remains at the average cost of what is done, in whole nano-dollars."""
    remaining = F.greatest(F.lit(0), applicable - done)
    return F.when((done > 0) & (remaining > 0), F.floor(cost * remaining / done)).otherwise(0).cast("bigint")


def status_histogram(rows: DataFrame, group: str, status: str, values: list[str]) -> DataFrame:
    """A column of counts for each status, in one aggregate."""
    return rows.groupBy(group).agg(*(F.count_if(F.col(status) == v).alias(f"n_{v}") for v in values), F.count(F.lit(1)).alias("n"))


def latest(*stamps: Column) -> Column:
    """Latest of ISO texts or times; nulls are skipped."""
    return F.greatest(*stamps)
