"""From scored pairs to matches: one owner per candidate, thresholds, and expected F0.5."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftlink.operators import metrics
from weftlink.operators.split import fraction

#: Thresholds of the sweep are these integers over 200: 0.05 to 0.99.
GRID = range(10, 199)


def one_owner(scored: DataFrame, score: str = "calib_proba") -> DataFrame:
    """Each candidate's best pair, by score, ann_sim, tfidf_sim and least S1 id."""
    order = Window.partitionBy("source", "cand_entity_id").orderBy(F.desc(score), F.desc(F.coalesce("ann_sim", F.lit(-1.0))), F.desc("tfidf_sim"), "s1_entity_id")
    return scored.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def at_threshold(assigned: DataFrame, threshold: float, score: str = "calib_proba") -> DataFrame:
    return assigned.where(F.col(score) >= threshold).select("s1_entity_id", "cand_entity_id")


def threshold_sweep(assigned: DataFrame, keys: DataFrame, truth: DataFrame, score: str = "calib_proba") -> DataFrame:
    """threshold and f05 over all keys, for every threshold of GRID.

    A pair counts up to the last grid point that its score reaches. Only entities that change
    at a grid point have rows there; running sums fill in the points between, so one
    pass over the pairs serves all thresholds.
    """
    spark = assigned.sparkSession
    wanted = keys.select("s1_entity_id").distinct()
    links = truth.select("s1_entity_id", "cand_entity_id").distinct()
    true = wanted.join(links.groupBy("s1_entity_id").agg(F.count("*").alias("n_true")), "s1_entity_id", "left").select("s1_entity_id", F.coalesce("n_true", F.lit(0)).alias("n_true"))
    rows = assigned.join(wanted, "s1_entity_id", "left_semi").join(links.withColumn("_t", F.lit(1)), ["s1_entity_id", "cand_entity_id"], "left")
    grid = F.array(*(F.lit(i / 200) for i in GRID))
    reached = F.size(F.filter(grid, lambda t: F.col(score) >= t))
    steps = rows.select("s1_entity_id", reached.alias("_i"), F.coalesce("_t", F.lit(0)).alias("_t")).where("_i > 0").groupBy("s1_entity_id", "_i").agg(F.count("*").alias("p"), F.sum("_t").alias("t"))
    down = Window.partitionBy("s1_entity_id").orderBy(F.desc("_i"))
    until = F.lead("_i", 1, 0).over(down)
    runs = steps.select("s1_entity_id", "_i", until.alias("_next"), F.sum("p").over(down).alias("n_pred"), F.sum("t").over(down).alias("tp")).join(true, "s1_entity_id")
    # Points _next + 1 .. _i of the entity have these counts; elsewhere it predicts nothing.
    gain = metrics.f05(F.col("n_pred"), F.col("n_true"), F.col("tp")) - F.when(F.col("n_true") == 0, 1.0).otherwise(0.0)
    deltas = runs.select(gain.alias("g"), F.explode(F.sequence(F.col("_next") + 1, F.col("_i"))).alias("i")).groupBy("i").agg(F.sum("g").alias("g"))
    base = true.agg(F.count("*").alias("n"), F.sum((F.col("n_true") == 0).cast("int")).alias("empty"))
    points = spark.range(1, len(GRID) + 1).select(F.col("id").cast("int").alias("i"), ((F.col("id") + (GRID[0] - 1)) / F.lit(200.0)).alias("threshold"))
    return points.join(deltas, "i", "left").crossJoin(F.broadcast(base)).select("threshold", ((F.coalesce("g", F.lit(0.0)) + F.col("empty")) / F.col("n")).alias("f05"))


def best_threshold(sweep: DataFrame) -> tuple[float, float]:
    """(threshold, f05) of the least threshold of highest F0.5, among GRID's rows."""
    rows = [(r["threshold"], r["f05"]) for r in sweep.orderBy("threshold").collect()]
    known = [r for r in rows if r[1] is not None]
    if not known:
        return rows[0][0], float("nan")
    top = max(f for _, f in known)
    return next(r for r in known if r[1] >= top - 1e-12)


def expected_f05(assigned: DataFrame, score: str = "calib_proba", floor: float = 0.02) -> DataFrame:
    """Links of the prefix that maximizes each S1's expected F0.5, the score taken for the chance of a match.

    Pairs below floor are left out. Predicting nothing has the chance that no pair matches;
    a longer prefix must be strictly better, so ties keep the shorter one.
    """
    entity = Window.partitionBy("s1_entity_id")
    line = entity.orderBy(F.desc(score), "cand_entity_id")
    p = F.col(score)
    rows = (
        assigned.where(p >= floor)
        .withColumn("_m", F.row_number().over(line))
        .withColumn("_cum", F.sum(p).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("_all", F.sum(p).over(entity))
        .withColumn("_none", F.aggregate(F.array_sort(F.collect_list(p).over(entity)), F.lit(1.0), lambda s, x: s * (1 - x)))
    )
    precision, recall = F.col("_cum") / F.col("_m"), F.col("_cum") / F.col("_all")
    rows = rows.withColumn("_f", 1.25 * precision * recall / (0.25 * precision + recall)).withColumn("_best", F.max("_f").over(entity))
    rows = rows.withColumn("_keep", F.min(F.when(F.col("_f") == F.col("_best"), F.col("_m"))).over(entity))
    return rows.where("_best > _none and _m <= _keep").select("s1_entity_id", "cand_entity_id")


def choose(assigned: DataFrame, keys: DataFrame, truth: DataFrame, score: str = "calib_proba", floor: float = 0.02) -> dict:
    """The decision rule of higher F0.5 on keys: a global threshold unless the per-entity rule beats it."""
    threshold, reached = best_threshold(threshold_sweep(assigned, keys, truth, score))
    entity = metrics.evaluate(keys, expected_f05(assigned, score, floor), truth).first()["f05"]
    if entity is not None and entity > reached:
        return {"mode": "per_entity", "floor": floor, "f05": entity}
    return {"mode": "global_threshold", "threshold": threshold, "f05": reached}


def apply(assigned: DataFrame, decision: dict, score: str = "calib_proba") -> DataFrame:
    if decision["mode"] == "per_entity":
        return expected_f05(assigned, score, decision["floor"])
    return at_threshold(assigned, decision["threshold"], score)


def cross_fit(assigned: DataFrame, keys: DataFrame, truth: DataFrame, score: str = "calib_proba", seed: int = 7) -> float:
    """Mean F0.5 of each half of the keys at the other half's best threshold."""
    side = keys.select("s1_entity_id").distinct().withColumn("_a", fraction("s1_entity_id", seed) < 0.5)
    halves = [side.where("_a").select("s1_entity_id"), side.where("not _a").select("s1_entity_id")]
    total = 0.0
    for tune, test in (halves, halves[::-1]):
        threshold, _ = best_threshold(threshold_sweep(assigned, tune, truth.join(tune, "s1_entity_id", "left_semi"), score))
        own = truth.join(test, "s1_entity_id", "left_semi")
        found = at_threshold(assigned, threshold, score).join(test, "s1_entity_id", "left_semi")
        total += metrics.evaluate(test, found, own).first()["f05"] or 0.0
    return total / 2
