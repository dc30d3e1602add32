"""Three kinds of winners, kept apart on purpose: first seen, last written, first writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_seen(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key: the one that comes first in the given order.  A minimum, so it is combined before the shuffle and a hot key costs one row for each task."""
    rest = [c for c in rows.columns if c != key and c not in order]
    best = rows.groupBy(key).agg(F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("_w"))
    return best.select(key, *(F.col(f"_w.{c}").alias(c) for c in [*order, *rest])).select(*rows.columns)


def last_written(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key: the one with the largest order value."""
    rest = [c for c in rows.columns if c not in keys and c != order]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(order, *rest), F.col(order)).alias("_w"))
    return best.select(*keys, *(F.col(f"_w.{c}").alias(c) for c in [order, *rest])).select(*rows.columns)


def occurrences(rows: DataFrame, keys: list[str], place: Column) -> DataFrame:
    """First place and number of places for each key."""
    return rows.groupBy(*keys).agg(F.min(place).alias("first_place"), F.count(F.lit(1)).alias("n_places"))


def ordered_distinct(values: Column) -> Column:
    """Distinct values, first occurrence kept, in order."""
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull()))
