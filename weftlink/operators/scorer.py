"""Scores of a written result against known truth."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.operators import metrics
from weftlink.sources import tables


@dataclass
class Scores:
    measures: DataFrame
    missing: int
    ceiling: float | None


def score_files(spark: SparkSession, matches: str, keys: DataFrame, truth: DataFrame, ids: str | None = None, candidates: str | None = None) -> Scores:
    """Measures of a matches file over keys (those of an ids file, if given), the number of keys that the
    file lacks, and, with a candidates file, the F0.5 that a perfect choice among its pairs would reach."""
    if ids:
        wanted = tables.read_ids(spark, ids).select(F.col("entity_id").alias("s1_entity_id"))
        keys = keys.join(wanted, "s1_entity_id", "left_semi")
    rows = tables.read_tsv(spark, matches)
    have = rows.select(F.col("source1_entity_id").alias("s1_entity_id"))
    known = truth.join(keys, "s1_entity_id", "left_semi")
    links = lambda table, column: tables.as_links(table, "source1_entity_id", column).withColumnRenamed("source1_entity_id", "s1_entity_id")
    found = links(rows, "matched_entity_ids").join(keys, "s1_entity_id", "left_semi")
    ceiling = None
    if candidates:
        offered = links(tables.read_tsv(spark, candidates), "candidate_entity_ids")
        reachable = known.join(offered, ["s1_entity_id", "cand_entity_id"], "left_semi")
        ceiling = metrics.evaluate(keys, reachable, known).first()["f05"]
    return Scores(metrics.evaluate(keys, found, known), keys.join(have, "s1_entity_id", "left_anti").distinct().count(), ceiling)
