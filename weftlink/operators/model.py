"""Labels, training sample, boosted trees and isotonic calibration."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftlink.operators.features import FEATURES
from weftlink.operators.split import fraction


def label(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """rows with label: 1 for true links."""
    known = truth.select("s1_entity_id", "cand_entity_id").distinct().withColumn("label", F.lit(1))
    return rows.join(known, ["s1_entity_id", "cand_entity_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def hard_negatives(rows: DataFrame, per_entity: int = 12) -> DataFrame:
    """All positives, and the best-ranked negatives of each S1."""
    order = Window.partitionBy("s1_entity_id", "label").orderBy("rank_for_s1", "cand_entity_id")
    return rows.withColumn("_r", F.row_number().over(order)).where((F.col("label") == 1) | (F.col("_r") <= per_entity)).drop("_r")


def fit(train: DataFrame, rounds: int = 60, depth: int = 6, rate: float = 0.05, features: list[str] | None = None, seed: int = 42) -> PipelineModel:
    """Boosted trees; a tenth of the S1 ids, by hash, decides when to stop."""
    names = features or FEATURES
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=0.8, featureSubsetStrategy="0.8",
        minInstancesPerNode=5, validationIndicatorCol="_held", seed=seed,
    )
    held = train.withColumn("_held", fraction("s1_entity_id", seed + 1) < 0.1)
    return PipelineModel([assembler, trees.fit(assembler.transform(held))])


def raw_scores(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows with raw_proba."""
    drop = [c for c in ("features", "rawPrediction", "probability", "prediction") if c not in rows.columns]
    return model.transform(rows).withColumn("raw_proba", vector_to_array("probability")[1]).drop(*drop)


def fit_calibration(scored: DataFrame) -> IsotonicRegressionModel:
    return IsotonicRegression(labelCol="label", featuresCol="raw_proba", isotonic=True).fit(scored.select(F.col("label").cast("double"), "raw_proba"))


def calibrated(calibration: IsotonicRegressionModel, scored: DataFrame) -> DataFrame:
    """scored with calib_proba in [0, 1]."""
    out = calibration.setPredictionCol("calib_proba").transform(scored)
    return out.withColumn("calib_proba", F.least(F.greatest("calib_proba", F.lit(0.0)), F.lit(1.0)))


def save(model: PipelineModel, calibration: IsotonicRegressionModel, folder: str) -> None:
    model.write().overwrite().save(f"{folder}/trees")
    calibration.write().overwrite().save(f"{folder}/isotonic")


def load(folder: str) -> tuple[PipelineModel, IsotonicRegressionModel]:
    return PipelineModel.load(f"{folder}/trees"), IsotonicRegressionModel.load(f"{folder}/isotonic")
