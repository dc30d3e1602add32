"""Upserts without a transactional table: each returns the table's new content."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _absent_from(entries: Column) -> Callable[[Column, Column], Column]:
    return lambda k, _: ~F.coalesce(F.map_contains_key(entries, k), F.lit(False))


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """First writer wins: rows whose keys are in the target change nothing."""
    new = rows.dropDuplicates(keys).join(target.select(*keys).distinct(), keys, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def replace_by_key(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace those of the target with the same keys."""
    return target.join(rows.select(*keys).distinct(), keys, "left_anti").unionByName(rows, allowMissingColumns=True)


def upsert(target: DataFrame, rows: DataFrame, keys: list[str], merge_maps: tuple[str, ...] = ()) -> DataFrame:
    """Full outer merge: new non-null values win; map columns are merged entry by entry, new entries win."""
    old, new = target.alias("o"), rows.alias("n")
    same = reduce(lambda a, b: a & b, (F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys))
    out = []
    for c in target.columns:
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}") if c in rows.columns else F.lit(None)
        if c in merge_maps:
            merged = F.map_concat(F.map_filter(o, _absent_from(n)), n)
            out.append(F.when(o.isNull(), n).when(n.isNull(), o).otherwise(merged).alias(c))
        else:
            out.append(F.coalesce(n, o).alias(c))
    return old.join(new, same, "full_outer").select(*out)
