"""Exact top-k inner products: a ball tree per shard, searched by branch and bound.

Vectors are cut into shards and queries into blocks. Each shard's task builds a ball tree
over its vectors. A query visits the tree's nodes by the upper bound of its inner product
with anything in their ball, q . c + |q| r, and stops at the first bound below its k-th
score so far. First every query searches its home shard, then the others in waves, each of
WAVE times as many shards as all before it. The k-th score of all found so far goes with a
query into every wave, so it rises as more is seen, and only the k best found so far are
kept between waves. A vector belongs to one wave and to its home pass, so waves move no
vector twice; their number grows with the logarithm of the shards.

Contract of top_k(): components become floor(256 * x), x as double. Vectors that are null or
hold null or non-finite components, and rows without a vec_id, take no part. A query is
compared with every row whose vec_id differs from its own and whose vector is as long;
repeated rows of a candidate each count, repeated rows of a query are one. Scores are exact
integers (an inner product must stay below 2^53 in size; a larger one raises an error).
Ties go to the smaller vec_id. A query with no candidate has no row. Other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftlink.llm.common import Workspace

SCALE = 256
LEAF = 64
SHARD_ROWS = 4096
QUERY_ROWS = 2048
WAVE = 3
_EXACT = float(1 << 53)


class BallTree:
    """Centres and radii of nested groups of vectors; leaves hold up to `leaf` of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.leaf = ids[order], vectors[order].astype(np.float64), leaf
        self.largest = float(np.sqrt((self.vectors**2).sum(axis=1)).max()) if len(ids) else 0.0
        centres, radii, self.children, self.members = [], [], [], []
        todo = [np.arange(len(ids))]
        while todo:
            rows = todo.pop()
            own = self.vectors[rows]
            centre = own.mean(axis=0)
            apart = np.sqrt(((own - centre) ** 2).sum(axis=1))
            centres.append(centre)
            radii.append(apart.max())
            self.members.append(rows)
            self.children.append(())
            if len(rows) > leaf and apart.max() > 0:
                far = own[apart.argmax()]
                other = own[((own - far) ** 2).sum(axis=1).argmax()]
                side = own @ (other - far)
                cut = np.argpartition(side, len(rows) // 2)
                todo += [rows[np.sort(cut[: len(rows) // 2])], rows[np.sort(cut[len(rows) // 2 :])]]
                self.children[-1] = (len(self.children), len(self.children) + len(todo) - 1)
        self._link()
        self.centres, self.radii = np.array(centres), np.array(radii)

    def _link(self) -> None:
        """Nodes are numbered as the stack takes them: the last half pushed comes next, the other after its whole subtree."""
        inner = [i for i, c in enumerate(self.children) if c]
        size = [1] * len(self.children)
        for i in reversed(inner):
            right = i + 1
            left = right + size[right]
            self.children[i] = (left, right)
            size[i] = 1 + size[left] + size[right]

    def search(self, query: np.ndarray, own: int, k: int, floor: float, bounds: np.ndarray) -> list[tuple[int, int]]:
        """(score, vec_id) of the best k candidates that reach floor; bounds are the nodes' upper bounds for the query."""
        best: list[tuple[float, int]] = []  # a heap of (score, -id): its first is the worst
        ahead = [(-bounds[0], 0)]
        while ahead:
            bound, node = heapq.heappop(ahead)
            if -bound < (best[0][0] if len(best) == k else floor):
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(ahead, (-bounds[child], child))
                continue
            rows = self.members[node]
            scores = self.vectors[rows] @ query
            least = max(floor, best[0][0]) if len(best) == k else floor
            for at in np.flatnonzero(scores >= least).tolist():
                found = (scores[at], -int(self.ids[rows[at]]))
                if found[1] == -own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return [(int(score), -negative) for score, negative in sorted(best, reverse=True)]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds of every query (row) in every node, with room for rounding."""
        size = np.sqrt((queries**2).sum(axis=1))[:, None]
        if len(queries) and float(size.max()) * self.largest >= _EXACT:
            raise OverflowError("an inner product may exceed 2^53")
        bound = queries @ self.centres.T + size * self.radii
        return bound + 1e-9 * (np.abs(bound) + size * self.largest) + 1e-6


def quantised(vector: str) -> Column:
    """floor(256 * x) of every component, or null where the vector takes no part."""
    sound = F.expr(f"{vector} is not null and not exists({vector}, x -> x is null or isnan(double(x)) or abs(double(x)) = double('Infinity'))")
    return F.when(sound, F.expr(f"transform({vector}, x -> bigint(floor({SCALE}D * double(x))))"))


def top_k(rows: DataFrame, is_query: str, k: int = 5, vector: str = "embedding", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every row of rows(vec_id, vector) that is a query."""
    work = Workspace(rows.sparkSession, "topk")
    sound = rows.where("vec_id is not null").select("vec_id", quantised(vector).alias("v")).where("v is not null")
    sound = work.save(sound.withColumn("query", F.expr(is_query)), "vectors")
    n, asked = sound.count(), sound.where("query").count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asked // query_rows))
    place = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    vectors = sound.select("vec_id", "v", place.alias("shard"))
    block = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)).cast("int")
    queries = work.save(sound.where("query").select("vec_id", "v").distinct().select(F.col("vec_id").alias("query_id"), "v", block.alias("block"), place.alias("home")), "queries")

    def search(asked: DataFrame, candidates: DataFrame) -> DataFrame:
        def run(key, left, right):
            import pandas as pd

            out = []
            if len(left) and len(right):
                lengths = right["v"].map(len).to_numpy()
                for length in np.unique(left["v"].map(len)):
                    mine, theirs = left[left["v"].map(len) == length], right[lengths == length]
                    if not len(theirs):
                        continue
                    tree = BallTree(theirs["vec_id"].to_numpy(), np.stack(theirs["v"].to_numpy()) if length else np.zeros((len(theirs), 0)))
                    wanted = np.stack(mine["v"].to_numpy()).astype(np.float64) if length else np.zeros((len(mine), 0))
                    bounds = tree.bounds(wanted)
                    for at, (name, floor) in enumerate(zip(mine["query_id"], mine["floor"], strict=True)):
                        out += [(name, i, s) for s, i in tree.search(wanted[at], name, k, floor, bounds[at])]
            return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

        return asked.groupBy("shard", "block").cogroup(candidates.groupBy("shard", "block")).applyInPandas(run, "query_id long, vec_id long, score long")

    nowhere = F.lit(float("-inf"))
    home = queries.select("query_id", "v", F.col("home").alias("shard"), "block", nowhere.alias("floor"))
    every = vectors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    found = work.save(best(search(home, every)), "best")
    begin = 0
    while shards > 1 and begin < shards:
        end = min(shards, max(1, begin) * (WAVE + 1))
        floors = found.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("kth"))
        known = queries.join(floors, "query_id", "left").withColumn("floor", F.coalesce("kth", nowhere))
        away = known.withColumn("shard", F.explode(F.sequence(F.lit(begin), F.lit(end - 1)))).where("shard <> home").select("query_id", "v", "shard", "block", "floor")
        more = search(away, every.where(F.col("shard").between(begin, end - 1)))
        found = work.save(best(found.drop("rank").unionByName(more)), "best")
        begin = end
    return work.finish(found.select("query_id", "rank", "vec_id", "score"))


ORACLE = f"""
with v as (
    select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) as v from embeddings
    where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT as score
    from (select distinct vec_id, v from v where vec_id % 50 = 0) q join v c on c.vec_id <> q.vec_id and len(c.v) = len(q.v)
)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::INT as rank, vec_id, score
from pairs qualify rank <= 5
"""
