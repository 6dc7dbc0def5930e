"""Byte-limited shards by extendible hashing, with DataFrame operations only.

The directory is indexed by the leading bits of a row's key hash. A bucket over its byte
limit splits on one more bit and no other bucket does, so the depth follows the data. The
bytes of all buckets of up to DEPTH_AHEAD bits more than an even split needs come from one
pre-aggregated histogram; rows of cells that are still too large go on with further bits.

Contract of assign(): bytes is the octet length of the text (null: 0). The hash is the first
HASH_BITS bits of the MD5 of the key's text (a null key counts as an empty one). One row per
input row: doc_id, bytes, shard (the bits of its bucket; empty for the only one), depth,
shard_bytes and shard_rows. Rows whose whole hashes agree cannot be told apart by bits:
where they exceed the limit their bucket becomes a chain of overflow shards, named by
input partition and number, each within the limit. A single row larger than the limit is a
shard by itself. An empty table has no shard. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftlink.llm.common import Workspace, small_enough

SHARD_BYTES = 1 << 20
HASH_BITS = 60
DEPTH_AHEAD = 5


def key_hash(key: str) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _bits(prefix: str, depth: str) -> Column:
    return F.expr(f"case when {depth} = 0 then '' else lpad(bin({prefix}), {depth}, '0') end")


def _split(rows: DataFrame, above: int, depth: int, limit: int, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(cell, prefix, depth, shard_bytes, shard_rows) of the cells that fit into a bucket, and the cells that do not.

    Cells have `depth` bits; buckets are sought at above..depth bits.
    """
    cells = work.save(rows.groupBy("cell").agg(F.sum("bytes").alias("b"), F.count("*").alias("n")), "cells")
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(above), F.lit(depth)))).withColumn("prefix", F.expr(f"shiftright(cell, {depth} - depth)"))
    nodes = levels.groupBy("depth", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows")).where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
    fitting = levels.select("cell", "depth", "prefix").join(nodes, ["depth", "prefix"])
    # The bucket of a cell is the shortest prefix that fits.
    found = fitting.groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("x")).select("cell", "x.*")
    found = work.save(found, "directory")
    return found, cells.join(found.select("cell"), "cell", "left_anti").select("cell")


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """Every row's shard."""
    work = Workspace(docs.sparkSession, "sharding")
    rows = work.save(docs.select(F.col(key).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"), key_hash(key).alias("h")), "sized")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    above, depth = 0, min(HASH_BITS, max(1, math.ceil(math.log2(max(1, total / limit)))) + DEPTH_AHEAD)
    active, out = rows, None
    columns = ["doc_id", "bytes", _bits("prefix", "depth").alias("shard"), F.col("depth").cast("int").alias("depth"), "shard_bytes", "shard_rows"]
    while True:
        placed = active.withColumn("cell", F.expr(f"shiftright(h, {HASH_BITS - depth})"))
        found, over = _split(placed, above, depth, limit, work)
        near, _ = small_enough(found)
        part = placed.join(near, "cell").select(*columns)
        out = part if out is None else out.unionByName(part)
        over, _ = small_enough(work.save(over, "over"))
        if over.isEmpty():
            return out
        active = work.save(placed.join(over, "cell").select("doc_id", "bytes", "h"), "active")
        if depth == HASH_BITS:
            return out.unionByName(_chain(active, limit, work))
        above, depth = depth + 1, min(HASH_BITS, depth + DEPTH_AHEAD)


def _chain(rows: DataFrame, limit: int, work: Workspace) -> DataFrame:
    """Overflow shards of rows whose hashes agree in all bits."""
    numbered = rows.withColumn("part", F.spark_partition_id()).withColumn("alone", F.col("bytes") * 2 > limit)
    line = Window.partitionBy("h", "part", "alone").orderBy("doc_id", "bytes")
    before = F.sum("bytes").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("bytes")
    number = F.when(F.col("alone"), F.row_number().over(line)).otherwise(F.floor(before * 2 / limit)).cast("long")
    named = numbered.withColumn("number", number).withColumn(
        "shard", F.concat(F.lpad(F.bin("h"), HASH_BITS, "0"), F.lit("."), F.col("part"), F.when(F.col("alone"), F.lit("r")).otherwise(F.lit("c")), F.col("number"))
    )
    named = work.save(named.select("doc_id", "bytes", "shard"), "chain")
    sizes = named.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    return named.join(sizes, "shard").select("doc_id", "bytes", "shard", F.lit(HASH_BITS).alias("depth"), "shard_bytes", "shard_rows")


def write_shards(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """Write docs, one folder per shard, and return the assignment. Keys must be unique."""
    assigned = Workspace(docs.sparkSession, "shards").save(assign(docs, key, text, limit), "assignment")
    labelled = docs.join(assigned.select(F.col("doc_id").alias("_key"), F.concat(F.lit("b"), "shard").alias("shard")), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    labelled.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(folder)
    return assigned


ORACLE = f"""
with sized as (
    select doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT as bytes, ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[:{HASH_BITS // 4}])::BIGINT as h from documents
), levels as (
    select s.*, d.depth, h >> ({HASH_BITS} - d.depth) as prefix from sized s cross join (select unnest(range(0, 33)) as depth) d
), nodes as (
    select depth, prefix, sum(bytes)::BIGINT as shard_bytes, count(*) as shard_rows from levels group by all having sum(bytes) <= {SHARD_BYTES} or count(*) = 1
), placed as (
    select l.doc_id, l.bytes, l.prefix, l.depth::INT as depth, n.shard_bytes, n.shard_rows,
           row_number() over (partition by l.doc_id order by l.depth) as k
    from levels l join nodes n on l.depth = n.depth and l.prefix = n.prefix
)
select doc_id, bytes, case when depth = 0 then '' else lpad(bin(prefix), depth, '0') end as shard, depth, shard_bytes, shard_rows from placed where k = 1
"""
