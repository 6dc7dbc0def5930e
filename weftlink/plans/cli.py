"""Command line: fit, predict, validate, score, subset and bench over folders of TSV files."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.functions import text
from weftlink.operators import blocking, scorer, split, validate
from weftlink.plans import projection
from weftlink.plans.pipeline import Linkage, Settings
from weftlink.sources import tables


def _records(spark: SparkSession, folder: str, part: str) -> DataFrame:
    sources = [tables.read_source(spark, folder, part, n).select(*tables.RECORD_COLUMNS, "source") for n in (1, 2, 3)]
    return sources[0].unionByName(sources[1]).unionByName(sources[2])


def _keys(records: DataFrame) -> DataFrame:
    return records.where("source = 'S1'").select(F.col("entity_id").alias("s1_entity_id"))


def _fit(spark: SparkSession, a: argparse.Namespace) -> int:
    linkage = Linkage(spark, replace(Settings.from_environment(), seed=a.seed), a.work, a.force)
    keys, truth = tables.read_truth(spark, a.data)
    fitted = linkage.fit(_records(spark, a.data, "train"), keys, truth)
    linkage.save(fitted, f"{a.work}/model")
    fitted["val"].select("s1_entity_id").coalesce(1).write.mode("overwrite").text(f"{a.work}/val_ids")
    linkage.measures(fitted).coalesce(1).write.mode("overwrite").json(f"{a.work}/val_report")
    print(f"k = {fitted['k']}, decision = {fitted['decision']}")
    return 0


def _predict(spark: SparkSession, a: argparse.Namespace) -> int:
    linkage = Linkage(spark, replace(Settings.from_environment(), seed=a.seed), a.work, a.force)
    records = _records(spark, a.data, a.split)
    matches, candidates = linkage.predict(linkage.load(f"{a.work}/model"), records)
    linkage.write(_keys(records), matches, candidates, a.out)
    known = records.where("source <> 'S1'").select("entity_id")
    return _told(validate.check(spark, f"{a.out}/matching_results", f"{a.out}/candidate_pairs", _keys(records), known))


def _told(report: validate.Report) -> int:
    """Print a report; 1 if it has errors."""
    for kind, found in (("ERROR", report.errors), ("WARNING", report.warnings)):
        for message, number, examples in found:
            print(f"{kind}: {message}: {number} ({', '.join(examples)})")
    return 0 if report.ok else 1


def _validate(spark: SparkSession, a: argparse.Namespace) -> int:
    records = _records(spark, a.data, a.split)
    known = records.where("source <> 'S1'").select("entity_id") if a.check_ids else None
    return _told(validate.check(spark, a.matches, a.candidates, _keys(records), known))


def _score(spark: SparkSession, a: argparse.Namespace) -> int:
    keys, truth = tables.read_truth(spark, a.data)
    found = scorer.score_files(spark, a.matches, keys, truth, a.ids, a.candidates)
    if found.missing:
        print(f"WARNING: {found.missing} ids have no row")
    print(found.measures.first().asDict() | ({"ceiling_f05": found.ceiling} if found.ceiling is not None else {}))
    return 0


def _subset(spark: SparkSession, a: argparse.Namespace) -> int:
    keys, truth = tables.read_truth(spark, a.data)
    records = _records(spark, a.data, "train")
    chosen, rest = split.sample_with_matches(keys, truth, records.where("source <> 'S1'"), a.share, a.seed)
    ids = chosen.select(F.col("s1_entity_id").alias("entity_id")).union(rest)
    kept = truth.join(chosen, "s1_entity_id", "left_semi")
    if not kept.join(ids.select(F.col("entity_id").alias("cand_entity_id")), "cand_entity_id", "left_anti").isEmpty():
        raise AssertionError("a true match was lost")
    for n in (1, 2, 3):
        own = records.where(F.col("source") == f"S{n}").join(ids, "entity_id", "left_semi").select(*tables.RECORD_COLUMNS)
        tables.write_tsv(own, f"{a.out}/train/train_source{n}.tsv")
    tables.write_matches(chosen, kept, f"{a.out}/train/train_ground_truth.tsv")
    return 0


def _bench(spark: SparkSession, a: argparse.Namespace) -> int:
    records = _records(spark, a.data, a.split)
    n = records.count()
    sample = records.where(split.fraction("entity_id", a.seed) < a.share)
    linkage = Linkage(spark, replace(Settings.from_environment(), seed=a.seed))
    normal = linkage.normalize(sample)
    idf = linkage.fit_idf(normal)
    union = linkage.candidates(normal, idf)
    pairs = int(n * union.count() / max(1, normal.count()))
    times = [
        projection.timed("normalize", lambda: text.normalize(sample), n),
        projection.timed("house numbers", lambda: blocking.house_number(normal), pairs),
        projection.timed("sounds", lambda: blocking.phonetic(normal), pairs),
        projection.timed("neighbourhood", lambda: blocking.sorted_neighbourhood(normal, "sn_key_a"), pairs),
        projection.timed("features", lambda: linkage.featurize(union, normal, 20), pairs),
    ]
    print(projection.table(times))
    return 0


COMMANDS = {"fit": _fit, "predict": _predict, "validate": _validate, "score": _score, "subset": _subset, "bench": _bench}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="weftlink", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--data", required=True, help="folder with train/ and test/")
    parser.add_argument("--split", default="test")
    parser.add_argument("--work", default="weftlink-work", help="folder of stage tables and models")
    parser.add_argument("--out", default="weftlink-out")
    parser.add_argument("--matches")
    parser.add_argument("--candidates")
    parser.add_argument("--ids")
    parser.add_argument("--check-ids", action="store_true")
    parser.add_argument("--share", type=float, default=0.05)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--force", action="store_true")
    a = parser.parse_args(argv)
    return COMMANDS[a.command](spark or SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    sys.exit(main())
