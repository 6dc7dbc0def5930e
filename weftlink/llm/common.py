"""Shared storage, lineage cuts and size-checked broadcasts for the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows a broadcast side may have; above it the same join runs as a shuffle join.
BROADCAST_ROWS = 500_000
#: Rows of an Arrow batch, which both the JVM and Python hold in full.
BATCH_ROWS = 1000
#: Rows of an Arrow batch that are worked on at a time, so that their texts exist only once in Python.
SLICE_ROWS = 512

WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor and the driver can reach.

    The cluster names it in spark.checkpoint.dir. Where that is unset, a local master
    gets a temporary folder and any other master the (shared) warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
            named = f"file://{tempfile.gettempdir()}/weftlink-checkpoints"
        else:
            named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/weftlink-checkpoints"
    return named.rstrip("/")


def light_batches(spark: SparkSession) -> None:
    """Let the session send at most BATCH_ROWS rows to Python at a time: texts and sets are wide."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


#: Share of the driver's heap from which its garbage is collected between two tables.
HEAP_SHARE = 0.4


def collect_garbage(spark: SparkSession, share: float = HEAP_SHARE) -> bool:
    """Collect the driver's garbage if its heap has grown over `share`; whether it had.

    Plans of tables that were written are garbage, and so are their shuffles and broadcasts, which Spark frees only
    when the heap is collected. Left alone, the heap grows to its limit over the many plans of one operator.
    """
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() <= share * runtime.maxMemory():
        return False
    gc.collect()  # Python's handles keep the plans alive
    spark._jvm.System.gc()
    return True


class Workspace:
    """Intermediate tables of one operator call, written to the shared folder.

    A written table cuts lineage and outlives any executor. drop() frees one that is
    no longer read, finish() all that a result does not read.
    """

    def __init__(self, spark: SparkSession, name: str):
        light_batches(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.serial, self.tables = 0, []

    def path(self, name: str) -> str:
        self.serial += 1
        return f"{self.root}/{self.serial:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        where = self.path(name)
        df.write.mode("overwrite").parquet(where)
        out = self.spark.read.schema(df.schema).parquet(where)
        out._weft_path = where
        self.tables.append(out)
        collect_garbage(self.spark)
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            where = jvm.org.apache.hadoop.fs.Path(table._weft_path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
            self.tables = [t for t in self.tables if t is not table]

    def finish(self, result: DataFrame) -> DataFrame:
        """result, with every table deleted that it does not read."""
        files = result.inputFiles()
        own = f"/{self.root.rpartition('/')[2]}/"
        read = {f.partition(own)[2].partition("/")[0] for f in files if own in f}
        self.drop(*(t for t in self.tables if t._weft_path.rpartition("/")[2] not in read))
        return result


def small_enough(df: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """df with a broadcast hint if it has at most `limit` (narrow) rows, else df as it is."""
    fits = df.limit(limit + 1).count() <= limit
    return (F.broadcast(df) if fits else df), fits


#: Rows of one key that go to one task in join_spread().
PIECE = 512


def join_spread(rows: DataFrame, table: DataFrame, key: str, by: str, work: Workspace) -> DataFrame:
    """rows joined with table by key. A key that more than PIECE rows hold is dealt over several tasks by a hash of `by`,
    and its row of the table goes to each of them, so no key gathers a large part of the rows in one."""
    heavy = rows.groupBy(key).agg(F.count("*").alias("__c")).where(F.col("__c") > PIECE).select(F.col(key).alias("__hot"), F.expr(f"bigint(ceil(__c / {PIECE}))").alias("__pieces"))
    heavy, _ = small_enough(work.save(heavy, "heavy"))
    spread = rows.join(heavy, F.col(key) == F.col("__hot"), "left").withColumn("__piece", F.coalesce(F.pmod(F.xxhash64(by), F.col("__pieces")), F.lit(0).cast("long")))
    every = table.join(heavy, F.col(key) == F.col("__hot"), "left").withColumn("__piece", F.explode(F.expr("sequence(0L, coalesce(__pieces, 1L) - 1)")))
    return spread.drop("__hot", "__pieces").join(every.drop("__hot", "__pieces"), [key, "__piece"]).drop("__piece")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that df has not."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def crc_mod(key: str | Column, modulus: int) -> Column:
    """crc32 of the key's decimal text, modulo `modulus`."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % modulus


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_held: dict[Any, Any] = {}


def give_back() -> None:
    """Return freed memory of this process to the system; allocators would keep it otherwise."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def worker_state(key: Any, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps between tasks: the caches of the operator it served last.

    Workers outlive stages, so another operator's caches go, and their memory is given
    back, before new ones are made.
    """
    if key not in _held:
        _held.clear()
        gc.collect()
        give_back()
        _held[key] = make()
    return _held[key]


def tidy(run, key: Any = None, make: Callable[[], Any] = object):
    """The batch function `run`, in a worker without other operators' caches, which gives memory back at its end."""

    def tidied(batches):
        if key is not None:
            worker_state(key, make)
        yield from run(batches)
        give_back()

    return tidied


def append_columns(df: DataFrame, inputs: list[str], ddl: str, compute) -> DataFrame:
    """df with further columns that compute makes, an Arrow batch at a time.

    compute takes one Arrow array per input column and returns one per field of `ddl`.
    Columns of df that are named like a new one give way to it.
    """
    light_batches(df.sparkSession)
    new = T.StructType.fromDDL(ddl)
    taken = {f.name.lower() for f in new}
    keep = [c for c in df.columns if c.lower() not in taken]
    extra = [c for c in inputs if c not in keep]
    at = [keep.index(c) if c in keep else len(keep) + extra.index(c) for c in inputs]
    fields = [df.schema[c] for c in keep]

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for begin in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(begin, SLICE_ROWS)
                made = compute(*(batch.column(i) for i in at))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=[*keep, *new.fieldNames()])

    chosen = [F.col(f"`{c}`") for c in keep] + [F.col(f"`{c}`").alias(f"__input_{i}") for i, c in enumerate(extra)]
    return df.select(*chosen).mapInArrow(tidy(run), T.StructType([*fields, *new.fields]))


def chunks(texts: list, most: int = 1_000_000):
    """Ranges of a list of texts that hold about `most` characters each, one text at least."""
    begin = size = 0
    for at, text in enumerate(texts):
        size += len(text or "") + 16
        if size >= most:
            yield begin, at + 1
            begin, size = at + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
