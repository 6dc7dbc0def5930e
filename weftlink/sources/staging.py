"""Stage tables: Parquet that is computed once, cuts lineage, and is read again by later stages."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where unset, a temporary folder for a local master and the warehouse for any other."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] == "local":
        return f"file://{tempfile.gettempdir()}/weftlink-stages"
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/weftlink-stages"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """df, written to the shared folder and read back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fingerprint(df: DataFrame) -> str:
    """A name for the rows of df, whatever their order: their number and two sums of hashes over all columns."""
    names = sorted(df.columns)
    one, two = F.xxhash64(*names), F.xxhash64(F.lit(7), *names)
    found = df.agg(F.count("*"), F.sum(one.cast("decimal(20,0)")), F.bit_xor(two)).first()
    return hashlib.sha256(repr((names, *map(str, found))).encode()).hexdigest()[:16]


class StageStore:
    """Named stage tables under one folder; a stage is computed only if it is missing or forced.

    Names must tell inputs apart: callers put a fingerprint of theirs in.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def get(self, name: str, make, force: bool = False) -> DataFrame:
        if force or not self.exists(name):
            make().write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")
