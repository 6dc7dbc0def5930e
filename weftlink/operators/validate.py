"""Checks of id-list files: every S1 once, no repeated, foreign or unknown ids."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHOWN = 5


@dataclass
class Report:
    """Errors and warnings as (text, number, first examples)."""

    errors: list[tuple[str, int, list[str]]] = field(default_factory=list)
    warnings: list[tuple[str, int, list[str]]] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.errors

    def add(self, text: str, ids: DataFrame, warn: bool = False) -> None:
        """Note the distinct ids (first column), if there are any: their number and the first of them."""
        named = ids.select(F.col(ids.columns[0]).cast("string").alias("id")).distinct()
        n = named.count()
        if n:
            (self.warnings if warn else self.errors).append((text, n, [r[0] for r in named.orderBy("id").limit(SHOWN).collect()]))


def repeated_rows(rows: DataFrame) -> DataFrame:
    """S1 ids that have more than one row."""
    return rows.groupBy("s1_entity_id").count().where("count > 1").select("s1_entity_id")


def repeated_ids(rows: DataFrame) -> DataFrame:
    """S1 ids whose list holds an id twice; ids are compared as they are."""
    return rows.where("size(ids) <> size(array_distinct(ids))").select("s1_entity_id")


def classed_ids(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Listed ids with problem: self (an S1 id), prefix (neither S2 nor S3), unknown (if known ids are given)."""
    ids = rows.select("s1_entity_id", F.explode("ids").alias("id"))
    problem = F.when(F.col("id").startswith("S1-"), "self").when(~F.col("id").startswith("S2-") & ~F.col("id").startswith("S3-"), "prefix")
    if known is None:
        return ids.withColumn("problem", problem).where("problem is not null")
    there = known.select(F.col("entity_id").alias("id")).distinct().withColumn("_k", F.lit(True))
    return ids.join(there, "id", "left").select("s1_entity_id", "id", problem.otherwise(F.when(F.col("_k").isNull(), "unknown")).alias("problem")).where("problem is not null")


def missing_and_extra(rows: DataFrame, required: DataFrame) -> tuple[DataFrame, DataFrame]:
    need, have = required.select("s1_entity_id").distinct(), rows.select("s1_entity_id").distinct()
    return need.join(have, "s1_entity_id", "left_anti"), have.join(need, "s1_entity_id", "left_anti")


def outside(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """S1 ids with a matched id that is no candidate of theirs."""
    ours = matches.select("s1_entity_id", F.explode("ids").alias("id"))
    theirs = candidates.select("s1_entity_id", F.explode("ids").alias("id"))
    return ours.join(theirs, ["s1_entity_id", "id"], "left_anti").select("s1_entity_id").distinct()


def parse_lines(lines: DataFrame) -> DataFrame:
    """s1_entity_id and ids of raw non-blank lines (value); malformed where there is no tab."""
    rows = lines.where("trim(value) <> ''")
    parts = F.split(F.regexp_replace("value", "\r$", ""), "\t", 2)
    tail = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    empty = F.array().cast("array<string>")
    return rows.select(F.get(parts, F.lit(0)).alias("s1_entity_id"), F.when(tail == "", empty).otherwise(F.split(tail, ",")).alias("ids"), (F.size(parts) < 2).alias("malformed"))


def check_lists(spark: SparkSession, path: str, list_column: str, required: DataFrame, report: Report, known: DataFrame | None = None) -> DataFrame | None:
    """Check one file; its rows, or None where the header already fails."""
    try:
        lines = spark.read.text(path)
        header = lines.first()
    except Exception as missing:  # the reader's error names the path
        report.errors.append((f"cannot read {path}: {type(missing).__name__}", 1, []))
        return None
    if header is None:
        report.errors.append((f"{path} is empty", 1, []))
        return None
    names = [c.strip().lower() for c in header[0].rstrip("\r").split("\t")]
    if names != ["source1_entity_id", list_column]:
        text = "is separated by commas" if "," in header[0] and "\t" not in header[0] else "has a wrong header"
        report.errors.append((f"{path} {text}", 1, [header[0]]))
        return None
    rows = parse_lines(lines.where(F.col("value") != header[0]))
    report.add("rows without a tab", rows.where("malformed"))
    rows = rows.where("not malformed").drop("malformed")
    report.add("S1 ids with several rows", repeated_rows(rows))
    report.add("S1 ids with repeated ids", repeated_ids(rows))
    wrong = classed_ids(rows, known)
    for problem, text in (("self", "S1 ids in lists"), ("prefix", "ids of no source"), ("unknown", "unknown ids")):
        report.add(text, wrong.where(F.col("problem") == problem).select("id"))
    gone, extra = missing_and_extra(rows, required)
    report.add("missing S1 ids", gone)
    report.add("S1 ids that were not asked for", extra)
    return rows


def check(spark: SparkSession, matches: str, candidates: str, required: DataFrame, known: DataFrame | None = None) -> Report:
    """Check both files; matches outside the candidates are a warning."""
    report = Report()
    ours = check_lists(spark, matches, "matched_entity_ids", required, report, known)
    theirs = check_lists(spark, candidates, "candidate_entity_ids", required, report, known)
    if ours is not None and theirs is not None:
        report.add("matches that are no candidates", outside(ours, theirs), warn=True)
    return report
