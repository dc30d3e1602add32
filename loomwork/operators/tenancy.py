"""Case and dataset ids of documents' keys: looked up, or created on request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.functions.ids import document_uuid
from loomwork.operators.merge import insert_if_absent

KEYS = ["case_key", "dataset_key"]


class TenancyError(ValueError):
    pass


def preflight(pairs: DataFrame, cases: DataFrame, datasets: DataFrame) -> DataFrame:
    """case_key, dataset_key, found, for each distinct pair.  cases: case_key, case_id; datasets: case_id, dataset_key, dataset_id."""
    known = cases.join(datasets, "case_id").select(*KEYS, F.lit(True).alias("found"))
    return pairs.select(*KEYS).distinct().join(known, KEYS, "left").select(*KEYS, F.coalesce("found", F.lit(False)).alias("found"))


def ensured(pairs: DataFrame, cases: DataFrame, datasets: DataFrame, tenant: str) -> tuple[DataFrame, DataFrame]:
    """The two tables with what the pairs lack; ids are made of the names, so doing it again changes nothing."""
    names = [F.lit(tenant), F.col("case_key")]
    cases = insert_if_absent(cases, pairs.select("case_key").distinct().select("case_key", document_uuid(*names).alias("case_id")), ["case_key"])
    wanted = pairs.select(*KEYS).distinct().join(cases, "case_key").select("case_id", "dataset_key", document_uuid(*names, F.col("dataset_key")).alias("dataset_id"))
    return cases, insert_if_absent(datasets, wanted, ["case_id", "dataset_key"])


def resolve(docs: DataFrame, cases: DataFrame, datasets: DataFrame) -> DataFrame:
    """docs with case_id and dataset_id; raises, naming them, if pairs are missing."""
    missing = preflight(docs, cases, datasets).where("NOT found").orderBy(*KEYS).limit(20).collect()
    if missing:
        raise TenancyError("not registered: " + ", ".join(f"{r['case_key']}/{r['dataset_key']}" for r in missing))
    return docs.join(cases, "case_key").join(datasets, ["case_id", "dataset_key"])
