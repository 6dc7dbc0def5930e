"""A store of text embeddings that encodes each distinct text once and resumes where it stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftlink.operators.neighbours import hashed_embedding

SCHEMA = "text_hash string, vec array<double>"


class EmbeddingStore:
    """(text_hash, vec) rows in a folder, keyed by the text itself, so changed texts are never mistaken for old ones."""

    def __init__(self, spark: SparkSession, folder: str, encoder: Callable[[DataFrame, str], DataFrame] = hashed_embedding):
        self.spark, self.folder, self.encoder = spark, folder, encoder

    def table(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.read.schema(SCHEMA).parquet(self.folder).dropDuplicates(["text_hash"])
        return self.spark.createDataFrame([], T.StructType.fromDDL(SCHEMA))

    @staticmethod
    def _hash(text: str):
        return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)

    def ensure(self, rows: DataFrame, text: str) -> int:
        """Encode the texts that the store lacks; how many those were. Texts of like length go together."""
        distinct = rows.select(F.coalesce(F.col(text), F.lit("")).alias("_text")).distinct().withColumn("text_hash", self._hash("_text"))
        missing = distinct.join(self.table().select("text_hash"), "text_hash", "left_anti")
        before = self.table().count()
        lined = missing.withColumn("_n", F.length("_text")).repartition("text_hash").sortWithinPartitions("_n").drop("_n")
        self.encoder(lined, "_text").select("text_hash", "vec").write.mode("append").parquet(self.folder)
        return self.table().count() - before

    def attach(self, rows: DataFrame, text: str, name: str = "vec") -> DataFrame:
        """rows with each text's vector."""
        known = self.table().select(F.col("text_hash").alias("_h"), F.col("vec").alias(name))
        return rows.withColumn("_key", self._hash(text)).join(known, F.col("_key") == F.col("_h"), "left").drop("_key", "_h")
