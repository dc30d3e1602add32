"""Vector store: Parquet by shard of the content sha, append only, the last written vector of a sha wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.text import shard
from loomwork.operators.dedup import last_written

SCHEMA = "content_sha string, seq bigint, vector array<float>, shard string"
MANIFEST = "embedding_model string, dimensions int, api_version string"


class StoreMismatch(ValueError):
    pass


class VectorStore:
    def __init__(self, spark: SparkSession, root: str, model: str, dimensions: int, api_version: str = "1"):
        self.spark, self.root = spark, root.rstrip("/")
        self.identity = (model, dimensions, api_version)
        known = self.manifest()
        if known is None:
            spark.createDataFrame([self.identity], MANIFEST).coalesce(1).write.parquet(f"{self.root}/manifest")
        elif known != self.identity:
            raise StoreMismatch(f"the store holds {known}, not {self.identity}")

    def _exists(self, path: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def manifest(self) -> tuple | None:
        if not self._exists(f"{self.root}/manifest"):
            return None
        return tuple(self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest").first())

    def rows(self) -> DataFrame:
        if not self._exists(f"{self.root}/vectors"):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(f"{self.root}/vectors")

    def keys(self) -> DataFrame:
        """Distinct shas; only that column is read."""
        return self.rows().select("content_sha").distinct()

    def missing(self, wanted: DataFrame) -> DataFrame:
        """Rows of wanted (content_sha, ...) without a vector, one for each sha."""
        return wanted.dropDuplicates(["content_sha"]).join(self.keys(), "content_sha", "left_anti")

    def append(self, vectors: DataFrame, seq: int = 0) -> None:
        """vectors: content_sha, vector.  Wrong dimensions or keys stop the write; a stopped write leaves nothing behind."""
        dims = self.identity[1]
        sound = (F.size("vector") == dims) & F.col("content_sha").rlike("^[0-9a-f]{64}$")
        checked = vectors.select("content_sha", F.lit(seq).cast("bigint").alias("seq"), F.when(F.assert_true(sound, "bad vector or key").isNull(), F.col("vector").cast("array<float>")).alias("vector"))
        # One task writes a shard, so an append adds one file to it, however many tasks the vectors came from.
        checked.withColumn("shard", shard(F.col("content_sha"))).repartition("shard").write.mode("append").partitionBy("shard").parquet(f"{self.root}/vectors")

    def latest(self) -> DataFrame:
        return last_written(self.rows(), ["shard", "content_sha"], "seq").select("content_sha", "vector")

    def lookup(self, shas: DataFrame) -> DataFrame:
        """content_sha, vector of the wanted shas; only their shards are read.  Malformed shas find nothing."""
        wanted = shas.select("content_sha").distinct().where(F.col("content_sha").rlike("^[0-9a-f]{64}$")).withColumn("shard", shard(F.col("content_sha")))
        return last_written(self.rows().join(wanted, ["shard", "content_sha"], "left_semi"), ["shard", "content_sha"], "seq").select("content_sha", "vector")

    def shard_counts(self) -> DataFrame:
        return self.rows().groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
