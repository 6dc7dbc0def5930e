"""Tab-separated record tables, links as id lists, and their writers.

Files are UTF-8 with a header, no quoting and \\n line ends; empty cells are empty strings.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_COLUMNS = ["entity_id", "business_name", "business_address", "country"]


def data_folder(*places: str) -> str:
    """The first folder, of WEFTLINK_DATA and the given places, that holds train/train_source1.tsv; on any file system that Spark reads."""
    tried = [p for p in (os.environ.get("WEFTLINK_DATA"), *places, "data") if p]
    for place in tried:
        if _exists(f"{place}/train/train_source1.tsv"):
            return place
    raise FileNotFoundError(f"no train/train_source1.tsv in {tried}")


def _exists(path: str) -> bool:
    spark = SparkSession.getActiveSession()
    if "://" not in path or spark is None:
        return os.path.exists(path)
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """All cells as text; nothing is taken for null."""
    header = spark.read.text(path).first()
    if header is None:
        raise ValueError(f"{path} is empty")
    names = header[0].rstrip("\r").split("\t")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    out = spark.read.csv(path, sep="\t", header=True, schema=schema, quote="", escape="", encoding="UTF-8", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, mode="PERMISSIVE")
    out = out.na.fill("")
    out = out.select(*columns) if columns else out
    return out.limit(limit) if limit is not None else out


def read_source(spark: SparkSession, folder: str, split: str, number: int) -> DataFrame:
    """One source of a split, with its required columns and a source column (S1, S2 or S3)."""
    path = f"{folder}/{split}/{split}_source{number}.tsv"
    out = read_tsv(spark, path)
    missing = [c for c in RECORD_COLUMNS if c not in out.columns]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    return out.withColumn("source", F.lit(f"S{number}"))


def as_lists(df: DataFrame, key: str, ids: str) -> DataFrame:
    """key and an array of distinct ids from a comma-joined column; empty text is an empty array."""
    return df.select(key, F.when(F.col(ids) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(ids, ","))).alias(ids))


def as_links(df: DataFrame, key: str, ids: str, name: str = "cand_entity_id") -> DataFrame:
    return as_lists(df, key, ids).select(key, F.explode(ids).alias(name))


def read_truth(spark: SparkSession, folder: str, split: str = "train") -> tuple[DataFrame, DataFrame]:
    """(keys, links): every S1 id, and its true matches one per row."""
    raw = read_tsv(spark, f"{folder}/{split}/{split}_ground_truth.tsv")
    keys = raw.select(F.col("source1_entity_id").alias("s1_entity_id")).distinct()
    return keys, as_links(raw, "source1_entity_id", "matched_entity_ids").withColumnRenamed("source1_entity_id", "s1_entity_id").distinct()


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One id per line, trimmed, without blanks."""
    return spark.read.text(path).select(F.trim("value").alias("entity_id")).where("entity_id <> ''")


def first_column(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed ids of a table's first column."""
    table = read_tsv(spark, path)
    return table.select(F.trim(F.col(table.columns[0])).alias("entity_id")).where("entity_id <> ''").distinct()


def row_count(spark: SparkSession, path: str) -> int:
    return read_tsv(spark, path).count()


def write_tsv(df: DataFrame, path: str) -> None:
    """One file in a folder; for tables of the size of a result, not of an input."""
    df.coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True, quote="", escape="", emptyValue="", nullValue="", lineSep="\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def id_lists(required: DataFrame, links: DataFrame, key: str, ids: str) -> DataFrame:
    """Every required id once, with its sorted distinct linked ids joined by commas."""
    joined = links.groupBy("s1_entity_id").agg(F.array_join(F.array_sort(F.collect_set("cand_entity_id")), ",").alias("_ids"))
    keys = required.select("s1_entity_id").distinct()
    return keys.join(joined, "s1_entity_id", "left").select(F.col("s1_entity_id").alias(key), F.coalesce("_ids", F.lit("")).alias(ids))


def write_matches(required: DataFrame, links: DataFrame, path: str) -> None:
    write_tsv(id_lists(required, links, "source1_entity_id", "matched_entity_ids"), path)


def write_candidates(required: DataFrame, links: DataFrame, path: str) -> None:
    write_tsv(id_lists(required, links, "source1_entity_id", "candidate_entity_ids"), path)
