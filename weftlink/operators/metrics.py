"""Entity-level precision, recall and F0.5.

Every measure comes from one row per S1 id: n_pred, n_true and tp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entity_counts(keys: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """s1_entity_id, n_pred, n_true and tp of every key; links are (s1_entity_id, cand_entity_id)."""
    marked = predicted.select("s1_entity_id", "cand_entity_id").distinct().withColumn("p", F.lit(1)).withColumn("t", F.lit(0))
    marked = marked.unionByName(truth.select("s1_entity_id", "cand_entity_id").distinct().withColumn("p", F.lit(0)).withColumn("t", F.lit(1)))
    pairs = marked.groupBy("s1_entity_id", "cand_entity_id").agg(F.max("p").alias("p"), F.max("t").alias("t"))
    counts = pairs.groupBy("s1_entity_id").agg(F.sum("p").alias("n_pred"), F.sum("t").alias("n_true"), F.sum(F.col("p") * F.col("t")).alias("tp"))
    joined = keys.select("s1_entity_id").distinct().join(counts, "s1_entity_id", "left")
    return joined.select("s1_entity_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_pred", "n_true", "tp")))


def f05(n_pred: Column, n_true: Column, tp: Column) -> Column:
    """F0.5 of one entity: without true matches 1 for no prediction, else 0."""
    precision, recall = tp / n_pred, tp / n_true
    return F.when(n_true == 0, (n_pred == 0).cast("double")).when(tp == 0, 0.0).otherwise(1.25 * precision * recall / (0.25 * precision + recall))


def _or_one(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 1.0).otherwise(part / whole)


def summary(counts: DataFrame) -> DataFrame:
    """One row: f05, precision_micro, recall_micro, precision_macro, recall_macro."""
    n_pred, n_true, tp = (F.col(c) for c in ("n_pred", "n_true", "tp"))
    precision = F.when(n_pred == 0, (n_true == 0).cast("double")).otherwise(tp / n_pred)
    recall = F.when(n_true == 0, 1.0).otherwise(tp / n_true)
    return counts.agg(
        F.avg(f05(n_pred, n_true, tp)).alias("f05"),
        _or_one(F.sum(tp), F.sum(n_pred)).alias("precision_micro"), _or_one(F.sum(tp), F.sum(n_true)).alias("recall_micro"),
        F.avg(precision).alias("precision_macro"), F.avg(recall).alias("recall_macro"),
    )


def evaluate(keys: DataFrame, predicted: DataFrame, truth: DataFrame) -> DataFrame:
    return summary(entity_counts(keys, predicted, truth))


def match_rate(keys: DataFrame, predicted: DataFrame, group: str = "country") -> DataFrame:
    """Share of keys with a prediction, by group."""
    has = predicted.select("s1_entity_id").distinct().withColumn("_has", F.lit(1.0))
    return keys.join(has, "s1_entity_id", "left").groupBy(group).agg(F.avg(F.coalesce("_has", F.lit(0.0))).alias("match_rate"), F.count("*").alias("n"))


def country_audit(links: DataFrame, records: DataFrame) -> DataFrame:
    """Share of links whose two known countries differ; 0 without links."""
    own = records.select(F.col("entity_id").alias("s1_entity_id"), F.col("country").alias("_c1"))
    other = records.select(F.col("entity_id").alias("cand_entity_id"), F.col("country").alias("_c2"))
    joined = links.join(own, "s1_entity_id", "left").join(other, "cand_entity_id", "left")
    return joined.agg(F.coalesce(F.avg(F.coalesce(F.col("_c1") != F.col("_c2"), F.lit(False)).cast("double")), F.lit(0.0)).alias("cross_country"), F.count("*").alias("links"))
