"""The linkage stages as one lazy plan per stage, with optional stage tables."""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import asdict, dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.functions import text
from weftlink.operators import blocking, decide, features, metrics, model, neighbours, split, tfidf
from weftlink.sources import tables
from weftlink.sources.staging import StageStore, fingerprint, shared_folder, staged


@dataclass
class Settings:
    seed: int = 42
    native_embedding: bool = False
    k_ann: int = 20
    k_ann_reverse: int = 3
    k_phonetic: int = 10
    k_housenum: int = 10
    bucket_cap: int = 0
    window: int = 5
    k_final: int = 0
    hard_negatives: int = 12
    val_fraction: float = 0.15
    calib_fraction: float = 0.05
    train_ids: int = 600_000
    rounds: int = 60
    depth: int = 6
    rate: float = 0.05
    floor: float = 0.02

    @classmethod
    def from_environment(cls) -> Settings:
        """Defaults, with what WEFTLINK_<NAME> variables set."""
        found = {}
        for f in fields(cls):
            value = os.environ.get(f"WEFTLINK_{f.name.upper()}")
            if value is not None:
                kind = type(f.default)
                found[f.name] = value.lower() in ("1", "true", "yes") if kind is bool else kind(value)
        return cls(**found)


class Linkage:
    """Normalize, block, featurize, train, tune, predict and validate.

    With a folder, each stage's table is kept there under a name that holds a fingerprint of
    what it was made from, and computed only if missing or forced.
    """

    def __init__(self, spark: SparkSession, settings: Settings | None = None, folder: str | None = None, force: bool = False):
        self.spark, self.settings, self.force = spark, settings or Settings(), force
        self.store = StageStore(spark, folder) if folder else None

    def _run(self, *inputs: DataFrame | str) -> str:
        """A name for what a run is made from; nothing is read if no tables are kept."""
        if not self.store:
            return ""
        parts = [i if isinstance(i, str) else fingerprint(i) for i in inputs]
        return "-" + hashlib.sha256(repr((parts, asdict(self.settings))).encode()).hexdigest()[:16]

    def _stage(self, name: str, make) -> DataFrame:
        return self.store.get(name, make, self.force) if self.store else staged(make(), name)

    def normalize(self, records: DataFrame, name: str = "normalized") -> DataFrame:
        return self._stage(name, lambda: text.normalize(records))

    def fit_idf(self, normal: DataFrame) -> DataFrame:
        """Document frequencies over all records of all sources."""
        return tfidf.fit_idf(normal.where("source is not null").select("embed_text"), "embed_text")

    def candidates(self, normal: DataFrame, idf: DataFrame, name: str = "union") -> DataFrame:
        """The scored union of all blockers."""
        s = self.settings
        vectors = neighbours.hashed_embedding(normal, "embed_text")
        if s.native_embedding:
            other = neighbours.hashed_embedding(normal.where("embed_text_native <> ''"), "embed_text_native")
            vectors = vectors.unionByName(other)
        found = blocking.union_candidates([
            blocking.nearest(staged(vectors.select("entity_id", "source", "country", "vec"), "vectors"), k=s.k_ann, reverse_k=s.k_ann_reverse, search=neighbours.inverted, forms=2 if s.native_embedding else 1),
            blocking.phonetic(normal, k=s.k_phonetic, cap=s.bucket_cap),
            blocking.house_number(normal, k=s.k_housenum, cap=s.bucket_cap),
            blocking.sorted_neighbourhood(normal, "sn_key_a", s.window),
            blocking.sorted_neighbourhood(normal, "sn_key_b", s.window),
        ])
        return self._stage(name, lambda: tfidf.cosines(found, normal, "entity_id", "embed_text", idf))

    def featurize(self, union: DataFrame, normal: DataFrame, k: int, name: str = "features") -> DataFrame:
        """Features of the k best candidates; competition is counted among those that are kept."""
        return self._stage(name, lambda: features.compute(blocking.with_competition(blocking.truncate(union, k)), normal))

    def train(self, rows: DataFrame, truth: DataFrame, pools: DataFrame):
        s = self.settings
        labelled = model.label(rows, truth).join(pools, "s1_entity_id", "left").withColumn("pool", F.coalesce("pool", F.lit("train_unused")))
        labelled = staged(labelled, "labelled")
        trees = model.fit(model.hard_negatives(labelled.where("pool = 'train'"), s.hard_negatives), s.rounds, s.depth, s.rate, seed=s.seed)
        return trees, model.fit_calibration(model.raw_scores(trees, labelled.where("pool = 'calib'")))

    def assign(self, rows: DataFrame, trees, calibration, name: str = "assigned") -> DataFrame:
        return self._stage(name, lambda: decide.one_owner(model.calibrated(calibration, model.raw_scores(trees, rows)).select("s1_entity_id", "cand_entity_id", "source", "country", "calib_proba", "ann_sim", "tfidf_sim")))

    def fit(self, records: DataFrame, keys: DataFrame, truth: DataFrame) -> dict:
        """Run all training stages. Returns idf, k, trees, calibration, decision, and the tables of this run."""
        s, run = self.settings, self._run(records, keys, truth)
        normal = self.normalize(records, f"normalized{run}")
        idf = staged(self.fit_idf(normal), "idf")
        union = self.candidates(normal, idf, f"union{run}")
        pools = staged(split.assign_pools(keys, seed=s.seed, val=s.val_fraction, calib=s.calib_fraction, most_train=s.train_ids), "pools")
        val = pools.where("pool = 'val'").select("s1_entity_id")
        known = truth.join(val, "s1_entity_id", "left_semi")
        sweep = self._stage(f"recall-sweep{run}", lambda: blocking.recall_sweep(union, val, known))
        if self.store:
            sweep.coalesce(1).write.mode("overwrite").csv(f"{self.store.folder}/recall_sweep_csv", header=True)
        k = s.k_final or blocking.choose_k(sweep)
        rows = self.featurize(union, normal, k, f"features{run}")
        trees, calibration = self.train(rows, truth, pools)
        assigned = self.assign(rows, trees, calibration, f"assigned{run}")
        decision = decide.choose(assigned, val, known, floor=s.floor)
        return {"idf": idf, "k": k, "trees": trees, "calibration": calibration, "decision": decision, "assigned": assigned, "features": rows, "val": val, "known": known, "run": run}

    def predict(self, fitted: dict, records: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(matches, candidates) of new records with everything learned held fixed."""
        run = self._run(records, f"{fitted['run']} {fitted['k']}")
        normal = self.normalize(records, f"normalized-new{run}")
        union = self.candidates(normal, fitted["idf"], f"union-new{run}")
        rows = self.featurize(union, normal, fitted["k"], f"features-new{run}")
        assigned = self.assign(rows, fitted["trees"], fitted["calibration"], f"assigned-new{run}")
        return decide.apply(assigned, fitted["decision"]), rows.select("s1_entity_id", "cand_entity_id")

    def write(self, keys: DataFrame, matches: DataFrame, candidates: DataFrame, folder: str) -> None:
        tables.write_matches(keys, matches, f"{folder}/matching_results")
        tables.write_candidates(keys, candidates, f"{folder}/candidate_pairs")

    def save(self, fitted: dict, folder: str) -> None:
        """Models, frequencies, k and the decision, for a later predict()."""
        model.save(fitted["trees"], fitted["calibration"], folder)
        fitted["idf"].write.mode("overwrite").parquet(f"{folder}/idf")
        state = json.dumps({"k": fitted["k"], "decision": fitted["decision"], "run": fitted["run"], "settings": asdict(self.settings)})
        self.spark.createDataFrame([(state,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/state")

    def load(self, folder: str) -> dict:
        trees, calibration = model.load(folder)
        state = json.loads(self.spark.read.text(f"{folder}/state").first()[0])
        return {"idf": self.spark.read.parquet(f"{folder}/idf"), "k": state["k"], "decision": state["decision"], "run": state["run"], "trees": trees, "calibration": calibration}

    def report(self, records: DataFrame, keys: DataFrame, truth: DataFrame) -> DataFrame:
        """Measures of the chosen decision and of the baseline score on the validation pool."""
        return self.measures(self.fit(records, keys, truth))

    def measures(self, fitted: dict) -> DataFrame:
        """What report() returns, of a run of fit()."""
        val, known = fitted["val"], fitted["known"]
        own = decide.apply(fitted["assigned"], fitted["decision"]).join(val, "s1_entity_id", "left_semi")
        base = decide.one_owner(features.baseline_score(fitted["features"]), "baseline_score")
        threshold, _ = decide.best_threshold(decide.threshold_sweep(base, val, known, "baseline_score"))
        weak = decide.at_threshold(base, threshold, "baseline_score").join(val, "s1_entity_id", "left_semi")
        parts = [metrics.evaluate(val, links, known).withColumn("rule", F.lit(name)) for name, links in ((fitted["decision"]["mode"], own), ("baseline", weak))]
        return parts[0].union(parts[1])


def default_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/linkage"
