"""Shared scratch tables: a written copy cuts lineage and survives the loss of an executor."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="loomwork-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where it is unset and Spark runs on one machine (tests), a folder of this process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own_dir()
    return folder.rstrip("/")


def _own_root(spark: SparkSession) -> str:
    """The folder of a session's scratch tables; it goes when the driver ends.  What a driver that was killed leaves, sweep() deletes."""
    name = f"loomwork-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        system.mkdirs(path)
        system.deleteOnExit(path)
    return name


def sweep(spark: SparkSession, days: float) -> list[str]:
    """Deletes scratch folders of other sessions to which nothing was added for so many days; returns their names.

    A session that may run longer than that must not be swept: its results may still read its tables.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    own, gone = f"loomwork-{spark.sparkContext.applicationId}", []
    for status in system.listStatus(root) if system.exists(root) else ():
        name = status.getPath().getName()
        if name.startswith("loomwork-") and name != own and status.getModificationTime() < (time.time() - days * 86_400) * 1000:
            system.delete(status.getPath(), True)
            gone.append(name)
    return gone


class Scratch:
    """Tables that one run of an operator writes under the shared folder and rereads.

    drop() deletes what a result no longer reads; the rest goes with the driver.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{_own_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        self.written: dict[str, list[str]] = {}

    def keep(self, df: DataFrame, label: str = "t") -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}-{label}"
        df.write.parquet(path)
        self.written.setdefault(label, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        """Deletes the tables of these labels; nothing that is still to run may read them."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for label in labels:
            for path in self.written.pop(label, []):
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Within it, plans are made with these settings."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def arrow_batches(spark: SparkSession, most: str) -> AbstractContextManager[None]:
    """Within it, plans are made with Arrow batches of at most so many bytes."""
    return session_conf(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": most})


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def lies_in_files(df: DataFrame) -> bool:
    """Whether df is a table as it was read, nothing done to it."""
    return df._jdf.queryExecution().analyzed().children().isEmpty() and bool(df.inputFiles())


def with_written_place(df: DataFrame, file: str = "__file", row: str = "__row") -> tuple[DataFrame, DataFrame, int]:
    """A Parquet table as it was read with each row's file and place in it; file, before (rows in the files before it) of its files; its number of rows.

    Spark reads files by size, so the order in which rows were written is lost to what reads them; before + row gives it back.
    A window sees one row for each file; the table of files is written first, so that a join knows how small it is.
    """
    meta = df.metadataColumn("_metadata")
    placed = df.select("*", meta["file_name"].alias(file), meta["row_index"].alias(row))
    number = lambda pattern: F.expr(f"try_cast(regexp_extract(`{file}`, '{pattern}', 1) AS bigint)")
    upto = F.sum("n").over(W.orderBy(number("^part-([0-9]+)"), number("-c([0-9]+)"), file))
    files = Scratch(df.sparkSession, "places").keep(placed.groupBy(file).agg(F.count(F.lit(1)).alias("n")).select(file, "n", (upto - F.col("n")).alias("before")), "files")
    return placed, files.select(file, "before"), files.agg(F.sum("n")).first()[0] or 0


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deals the rows of an input with fewer splits than the session has cores out by a key, before costly work on each row.

    That is a small input, as a single file of one row group; an input of many splits is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
