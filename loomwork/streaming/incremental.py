"""Incremental ingest: files that are new since the last run, content that was never seen before."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.types import StructType


def _there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


#: Parts of an ingest target, by a hash of the key.
PARTS = 64


def ingest_new(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, key: str, files_per_trigger: int = 1000) -> None:
    """Appends to target the rows whose key isn't in it; ingested() reads it.

    The checkpoint remembers files; content is compared with the target itself by an anti join, so nothing has
    to be kept as state and no watermark forgets old content.  A batch that is run again after a failure
    finds its own rows in the target, which makes it idempotent.  The target lies in PARTS parts by a hash of the
    key; a batch reads the keys of the parts that it has rows for, and nothing else of them.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    part = F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int").alias("_part")

    def write(batch: DataFrame, _: int) -> None:
        new = batch.dropDuplicates([key]).select("*", part)
        if _there(spark, target):
            touched = [r[0] for r in batch.select(part).distinct().collect()]
            known = spark.read.schema(StructType([*schema.fields]).add("_part", "integer")).parquet(target).where(F.col("_part").isin(touched))
            new = new.join(known.select(key, "_part"), [key, "_part"], "left_anti").select(*schema.fieldNames(), "_part")
        new.repartition("_part").write.mode("append").partitionBy("_part").parquet(target)

    rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingested(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(target).select(*schema.fieldNames())


def activity(stream: DataFrame, ts: str, key: str, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts by window and key, late rows up to the watermark included."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count(F.lit(1)).alias("n"))


def sessions(stream: DataFrame, ts: str, key: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap), key).agg(F.count(F.lit(1)).alias("n"))


LIMITED = "deployment string, request_id bigint, at double, tokens bigint, admitted_at double"


def admitted(stream: DataFrame, requests: int, tokens: int, seconds: float = 60.0) -> DataFrame:
    """When each request (deployment, request_id, at, tokens) may go so that no window of `seconds` holds more than the limits (0: none).

    A request over the token limit goes alone, when its window is empty.  State for each deployment: the admissions of the last window.
    """

    def limit(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held: deque[tuple[float, float]] = deque(zip(*state.get)) if state.exists else deque()
        used = sum(size for _, size in held)
        rows = pd.concat(frames).sort_values(["at", "request_id"])
        out = []
        for r in rows.itertuples():
            now = max(r.at, held[-1][0] if held else r.at)
            while True:
                while held and held[0][0] <= now - seconds:
                    used -= held.popleft()[1]
                if (not requests or len(held) < requests) and (not tokens or used + r.tokens <= tokens or not used):
                    break
                now = held[0][0] + seconds
            held.append((now, float(r.tokens)))
            used += float(r.tokens)
            out.append((key[0], r.request_id, r.at, r.tokens, now))
        state.update(([h[0] for h in held], [h[1] for h in held]))
        yield pd.DataFrame(out, columns=["deployment", "request_id", "at", "tokens", "admitted_at"])

    return stream.groupBy("deployment").applyInPandasWithState(limit, LIMITED, "times array<double>, sizes array<double>", "append", "NoTimeout")
