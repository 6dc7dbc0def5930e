"""The corpus queries: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.llm import bpe, chroma, langid, minhash, mixing, sharding, topk, toxicity, urlfilter, warc
from weftlink.llm.common import Workspace, crc_mod, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    grammar = toxicity.train(docs, table(spark, sf_dir, "labels"), "crc32(cast(doc_id as string)) % 4 <> 2")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    return toxicity.score(docs, grammar).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "warc")
    manifest = warc.write_pages(table(spark, sf_dir, "pages"), f"{work.root}/archives", work=work)
    read = warc.read_archives(manifest, payloads=False).where("kind <> 'gap'")
    return read.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op5_chroma_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no audio, so every vector of embeddings is rendered as a melody first."""
    prints = chroma.fingerprint(table(spark, sf_dir, "embeddings"), "embedding", "vec_id", chroma.render)
    return chroma.cluster(prints).withColumnRenamed("id", "vec_id")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).taken()


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_table(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, "crc32(cast(doc_id as string)) % 3 <> 1")
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "block_probability")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_warc_salvage": op2_warc_salvage,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_extendible_sharding": op4_extendible_sharding,
    "op5_chroma_fingerprints": op5_chroma_fingerprints,
    "op6_mix_sources": op6_mix_sources,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_language_id": op8_language_id,
    "op9_ball_tree_top_k": op9_ball_tree_top_k,
    "op10_url_filter": op10_url_filter,
}
ORACLES: dict[str, str] = {
    "op2_warc_salvage": warc.ORACLE,
    "op3_minhash_near_dedup": minhash.ORACLE,
    "op4_extendible_sharding": sharding.ORACLE,
    "op9_ball_tree_top_k": topk.ORACLE,
}
