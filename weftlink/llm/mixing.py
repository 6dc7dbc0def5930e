"""Mixing sources to target weights, by blocks of tokens.

Every source's documents, in a fixed order, are one stream of words, packed into blocks of
BLOCK words. Each source's target in words becomes a number of slots. Output shards of
SHARD_SLOTS slots draw how many slots each source gets: multinomial draws given the whole
mix's totals, which makes them multivariate hypergeometric, drawn down a binary tree of
shards so that each shard finds its own draw alone and again. A source's k-th slot is pass k // blocks over the source and goes through that
pass's own pseudorandom permutation of block indices (a Feistel network with cycle
walking), so no block comes a third time before all came twice. The slot that reaches the
target is cut to the words still wanted. Blocks and documents then meet by block index.

Contract of mix(): size is the number of runs of other than ASCII white space (null text:
0). Sources go by code point with null last and take weights 5, 2, 1 in turn; targets share
the sum of all sizes by weight, are held at CAP times their source's size, and the excess
goes to the others by weight. One row per input row: doc_id, source, size, source_size,
target, taken. Rows of size 0 take nothing. Repeated rows lie one after the other in the
stream and may take differently many words. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftlink.llm.common import WORD, Workspace, free_names, small_enough, tidy

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 256
SHARD_SLOTS = 4096
#: Documents of a chunk, within which a source's stream is laid out in one task.
CHUNK_ROWS = 2000
_U = np.uint64


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> list[float]:
    """Shares of the sum of sizes by weight, none above cap times its size."""
    total, weight = float(sum(sizes)), [float(weights[i % len(weights)]) for i in range(len(sizes))]
    out, held = [0.0] * len(sizes), set()
    while len(held) < len(sizes):
        free = [i for i in range(len(sizes)) if i not in held]
        rest = total - sum(cap * sizes[i] for i in held)
        share = sum(weight[i] for i in free)
        for i in free:
            out[i] = rest * weight[i] / share
        above = [i for i in free if out[i] > cap * sizes[i]]
        if not above:
            break
        for i in above:
            out[i] = float(cap * sizes[i])
        held.update(above)
    return out


def _round_keys(seed: int, source: int, lap: int) -> list[int]:
    return [int(x) for x in np.random.SeedSequence([seed, source, lap]).generate_state(4, np.uint32)]


def _network(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    low = _U((1 << half) - 1)
    left, right = x >> _U(half), x & low
    for key in keys:
        f = (right + _U(key)) * _U(0x9E3779B97F4A7C15)
        f = (f ^ (f >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        left, right = right, left ^ ((f >> _U(32)) & low)
    return (left << _U(half)) | right


def _network_back(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    low = _U((1 << half) - 1)
    left, right = x >> _U(half), x & low
    for key in reversed(keys):
        f = (left + _U(key)) * _U(0x9E3779B97F4A7C15)
        f = (f ^ (f >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        left, right = right ^ ((f >> _U(32)) & low), left
    return (left << _U(half)) | right


def permute(index: np.ndarray, n: int, keys: list[int], back: bool = False) -> np.ndarray:
    """A permutation of range(n), or its inverse, at some indices."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    step = _network_back if back else _network
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        out[todo] = step(out[todo], half, keys)
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


@dataclass
class SourcePlan:
    """How often and how far a source's blocks are gone through."""

    source: int
    words: int
    target: int
    seed: int
    block: int

    def __post_init__(self):
        self.blocks = -(-self.words // self.block)
        self.tail = self.words - (self.blocks - 1) * self.block if self.blocks else 0
        laps, rest = divmod(self.target, self.words) if self.words else (0, 0)
        self.slots, self.cut = laps * self.blocks, 0
        if rest:
            keys = _round_keys(self.seed, self.source, laps)
            tail_at = int(permute(np.array([self.blocks - 1]), self.blocks, keys, back=True)[0])
            k = -(-rest // self.block)
            if tail_at < k:
                k = -(-(rest + self.block - self.tail) // self.block)
                k = max(k, tail_at + 1)
            self.slots += k
            self.cut = k * self.block - (self.block - self.tail) * (tail_at < k) - rest

    def at(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block and number of words of some of the source's slots."""
        lap, index = np.divmod(slots, self.blocks)
        block = np.empty_like(slots)
        for one in np.unique(lap):
            mask = lap == one
            block[mask] = permute(index[mask], self.blocks, _round_keys(self.seed, self.source, int(one)))
        words = np.where(block == self.blocks - 1, self.tail, self.block)
        words[slots == self.slots - 1] -= self.cut
        return block, words


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, take: int) -> int:
    """How many of `take` drawn without putting back are good. Both ways are exact: the library's below its limit of
    10^9, above it inversion of the distribution within 12 deviations of its mode (beyond lies less than 1e-30)."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, take))
    low, high = max(0, take - bad), min(good, take)
    mode = min(max((take + 1) * (good + 1) // (good + bad + 2), low), high)
    share = good / (good + bad)
    reach = int(12 * (take * share * (1 - share) * (good + bad - take) / (good + bad)) ** 0.5) + 50
    up, down = np.arange(mode, min(high, mode + reach), dtype=float), np.arange(mode, max(low, mode - reach), -1, dtype=float)
    above = np.cumsum(np.log((good - up) * (take - up)) - np.log((up + 1) * (bad - take + up + 1)))
    below = np.cumsum(np.log(down * (bad - take + down)) - np.log((good - down + 1) * (take - down + 1)))
    odds = np.exp(np.concatenate([below[::-1], [0.0], above]))
    at = int(np.searchsorted(np.cumsum(odds), rng.random() * odds.sum(), "right"))
    return mode - len(below) + min(at, len(odds) - 1)


def _draw(rng: np.random.Generator, counts: tuple[int, ...], take: int) -> tuple[int, ...]:
    """How many of each kind are among `take` drawn from counts without putting back."""
    out, left = [], sum(counts)
    for n in counts:
        rest = left - n
        out.append(n if not rest else _hypergeometric(rng, n, rest, take) if take and n else 0)
        if not rest:
            out[-1] = take
        take, left = take - out[-1], rest
    return tuple(out)


@lru_cache(maxsize=4096)
def _left_half(low: int, high: int, counts: tuple[int, ...], per_shard: int, seed: int) -> tuple[int, ...]:
    """What the left half of the shards low..high draws of their counts."""
    return _draw(np.random.default_rng([seed, low, high]), counts, ((low + high) // 2 - low) * per_shard)


def shard_draw(shard: int, shards: int, slots: np.ndarray, per_shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """First slot of each source in a shard, and how many the shard has."""
    low, high, first, counts = 0, shards, [0] * len(slots), tuple(int(n) for n in slots)
    while high - low > 1:
        middle, left = (low + high) // 2, _left_half(low, high, counts, per_shard, seed)
        if shard < middle:
            high, counts = middle, left
        else:
            low, first, counts = middle, [a + b for a, b in zip(first, left, strict=True)], tuple(a - b for a, b in zip(counts, left, strict=True))
    return np.array(first, np.int64), np.array(counts, np.int64)


@dataclass
class Mix:
    """A planned mix: sources, slots (shard, slot, sid, block, words), rows, and spans of documents in blocks."""

    sources: DataFrame
    slots: DataFrame
    rows: DataFrame
    spans: DataFrame

    def taken(self, *further: str) -> DataFrame:
        """Every document with the words that the mix takes of it (and its digest, if `further` names that)."""
        drawn = self.slots.groupBy("sid", "block", "words").agg(F.count("*").alias("times"))
        met = self.spans.join(drawn, ["sid", "block"]).withColumn("hit", F.greatest(F.lit(0), F.least("stop", "words") - F.col("start")) * F.col("times"))
        sums = met.groupBy("sid", "place").agg(F.sum("hit").alias("hit"))
        full = self.rows.where("size > 0").join(sums, ["sid", "place"], "left").withColumn("taken", F.coalesce("hit", F.lit(0)))
        none = self.rows.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
        own, _ = small_enough(self.sources)
        own_columns = ["doc_id", "sid", "size", "taken", *further]
        both = full.select(*own_columns).union(none.select(*own_columns))
        return both.join(own, "sid").select("doc_id", "source", "size", "source_size", "target", "taken", *further)

    def texts(self, docs: DataFrame) -> DataFrame:
        """The mix itself: shard, slot, source and text of every slot, with the doc_ids it is made of."""
        words = docs.select("doc_id", F.regexp_extract_all("text", F.lit(f"({WORD})")).alias("all"))
        parts = self.spans.join(words, "doc_id").select("sid", "block", "start", "stop", "doc_id", F.expr("slice(all, int(first + 1), int(stop - start))").alias("part"))
        met = self.slots.join(parts, ["sid", "block"]).where("start < words")
        cut = met.withColumn("part", F.expr("slice(part, 1, int(least(stop, words) - start))"))
        grouped = cut.groupBy("shard", "slot", "sid").agg(F.sort_array(F.collect_list(F.struct("start", "doc_id", "part"))).alias("parts"))
        return grouped.join(self.sources.select("sid", "source"), "sid").select(
            "shard", "slot", "source", F.expr("transform(parts, x -> x.doc_id)").alias("doc_ids"), F.expr("array_join(flatten(transform(parts, x -> x.part)), ' ')").alias("text")
        )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block: int = BLOCK, per_shard: int = SHARD_SLOTS, seed: int = 11) -> Mix:
    """Plan the mix of docs(doc_id, source, text)."""
    spark = docs.sparkSession
    work = Workspace(spark, "mixing")
    sized = work.save(docs.select("doc_id", "source", _digest().alias("digest"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sized")
    totals = sorted(sized.groupBy("source").agg(F.sum("size")).collect(), key=lambda r: (r[0] is None, r[0] or ""))
    goal = targets([r[1] for r in totals], weights, cap)
    plans = [SourcePlan(i, r[1], min(round(t), cap * r[1]), seed, block) for i, (r, t) in enumerate(zip(totals, goal, strict=True))]
    rows = [(i, r[0], r[1], t) for i, (r, t) in enumerate(zip(totals, goal, strict=True))]
    sources = spark.createDataFrame(rows, "sid int, source string, source_size long, target double")
    # Where each document lies in its source's stream: first within a chunk, then the chunks in turn.
    chunks = max(1, sized.count() // CHUNK_ROWS)
    own, _ = small_enough(sources.select("sid", F.col("source").alias("_s")))
    laid = sized.join(own, F.col("source").eqNullSafe(F.col("_s"))).select("doc_id", "sid", "size", "digest", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(chunks)).alias("chunk"))
    line = Window.partitionBy("sid", "chunk").orderBy("doc_id", "digest")
    laid = work.save(laid.withColumn("inner", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")), "laid")
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = laid.groupBy("sid", "chunk").agg(F.sum("size").alias("all")).withColumn("offset", F.sum("all").over(before) - F.col("all")).select("sid", "chunk", "offset")
    offsets, _ = small_enough(work.save(offsets, "offsets"))
    placed = work.save(laid.join(offsets, ["sid", "chunk"]).select("doc_id", "sid", "size", "digest", (F.col("offset") + F.col("inner")).alias("place")), "placed")
    spans = (
        placed.where("size > 0")
        .withColumn("block", F.explode(F.expr(f"sequence(place div {block}, (place + size - 1) div {block})")))
        .select("doc_id", "sid", "place", "block", F.expr(f"greatest(place - block * {block}, 0L)").alias("start"), F.expr(f"least(place + size - block * {block}, {block}L)").alias("stop"), F.expr(f"greatest(block * {block} - place, 0L)").alias("first"))
    )
    slots = np.array([p.slots for p in plans] or [0], dtype=np.int64)
    shards = -(-int(slots.sum()) // per_shard)

    def fill(batches):
        import pyarrow as pa

        for batch in batches:
            for shard in batch.column(0).to_pylist():
                first, counts = shard_draw(shard, shards, slots, per_shard, seed)
                order = np.random.default_rng([seed, shard]).permutation(int(counts.sum()))
                kinds, blocks, words = [], [], []
                for plan in plans:
                    n = int(counts[plan.source])
                    if n:
                        where, size = plan.at(np.arange(first[plan.source], first[plan.source] + n))
                        kinds.append(np.full(n, plan.source, np.int32))
                        blocks.append(where)
                        words.append(size)
                if kinds:
                    columns = [np.full(len(order), shard), order, np.concatenate(kinds), np.concatenate(blocks), np.concatenate(words)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["shard", "slot", "sid", "block", "words"])

    filled = spark.range(0, shards, numPartitions=max(1, min(shards, 4 * spark.sparkContext.defaultParallelism))).mapInArrow(tidy(fill, "mixing"), "shard long, slot long, sid int, block long, words long")
    return Mix(sources, filled, placed, spans)


def _digest() -> Column:
    return F.coalesce(F.unhex(F.md5("text")), F.lit(b""))


def resample(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block: int = BLOCK, per_shard: int = SHARD_SLOTS, seed: int = 11) -> DataFrame:
    """docs repeated or left out so that each source's words come near its target.

    A document comes taken / size times; a fraction is settled by a hash of its doc_id and
    text. Rows are told apart by doc_id, source and text, so null or shared doc_ids each
    have their own count; rows alike in all three share the mean of theirs. Texts without a
    word bring none to the mix and go. All columns come through.
    """
    share = mix(docs, weights, cap, block, per_shard, seed).taken("digest").where("size > 0")
    identity, origin, digest, ratio, copy = free_names(docs, "id", "origin", "digest", "ratio", "copy")
    share = share.groupBy("doc_id", "source", "digest").agg((F.sum("taken") / F.sum("size")).alias("ratio")).where("ratio > 0")
    share = share.select(F.col("doc_id").alias(identity), F.col("source").alias(origin), F.col("digest").alias(digest), F.col("ratio").alias(ratio))
    share, _ = small_enough(Workspace(docs.sparkSession, "shares").save(share, "shares"))
    row = F.col("doc_id").eqNullSafe(F.col(identity)) & F.col("source").eqNullSafe(F.col(origin)) & (_digest() == F.col(digest))
    part = F.pmod(F.xxhash64("doc_id", digest), F.lit(1000003)) / 1000003
    times = F.floor(F.col(ratio) + part).cast("int")
    met = docs.join(share, row).where(times > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), times)))
    return met.select(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns))
