"""Corpus preparation from raw documents to token digests, stage by stage.

Every stage takes all documents that the stage before it kept and returns those that it
keeps, with the columns of documents; the last one returns token digests. Each stage's
result is written and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.llm import bpe, langid, minhash, mixing, toxicity
from weftlink.llm.common import Workspace, table

#: Posterior probability below which no language is certain enough.
LEAST_CERTAIN = 0.5
#: Cached arcs of the tokenizer: fewer than by itself, because executors keep heap from the stages before.
TOKEN_CACHE = 80_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without letters or with an uncertain one go."""
    model = langid.train(docs, "crc32(cast(doc_id as string)) % 3 <> 1")
    found = langid.identify(docs, model, names=("_lang", "_certain"))
    kept = (F.col("_lang") != langid.UNDETERMINED) & (F.col("_certain") >= LEAST_CERTAIN)
    return found.where(kept).select(*docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar does not predict to be toxic."""
    grammar = toxicity.train(docs, table(spark, sf_dir, "labels"), "crc32(cast(doc_id as string)) % 4 <> 2")
    return toxicity.score(docs, grammar, names=("_score", "_toxic")).where("_toxic = 0").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return minhash.keep_one(docs).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that sources come near their target weights."""
    return mixing.resample(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every document of the mix."""
    return bpe.digest_table(docs, most_pieces=TOKEN_CACHE // 2, most_arcs=TOKEN_CACHE)


STAGES = [
    ("language ID", language),
    ("toxicity", toxic),
    ("near-duplicates", near_duplicates),
    ("source mix", mix),
    ("byte-level BPE", tokenize),
]
#: Learned models and pseudorandom draws cannot be stated in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    work = Workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = work.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
