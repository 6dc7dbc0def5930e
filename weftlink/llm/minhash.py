"""Near-duplicate documents by MinHash with tensored banding, every link verified.

A document has two small collections of half keys, each made of a few minhashes. A table
is a pair of one half key from each collection, so m + m half keys serve m * m tables and
the minhashes to compute are about the square root of what independent tables need. With
ROWS minhashes in a half key, each collection has as many half keys as make two sets at the
threshold miss each other with a probability of at most MISS (8 and 8 at 0.85).

Half keys that only one distinct set holds cannot meet anything and are dropped before the
tables are formed. Equal sets are one node from the start. Each table bucket names its most
central node as its pivot, and buckets of one pivot become one group, so that a family of
near copies, which shares most of its buckets, is one group with one row a node and not one
row a node and bucket. Every node is compared with the pivots of its groups; whatever one
component joins needs no further test. Of groups that still hold several components, small
ones compare all pairs across components, and large ones go through _across_large(), whose
bounds are exact. So no link that shares a bucket is lost, and neither thousands of near
copies nor a passage shared by many documents lead to all pairs.

Contract of near_duplicates(): words are runs of other than ASCII white space, A-Z lower-
cased; a set holds the distinct shingles of SHINGLE words, or the whole sequence if there
are fewer words. Null texts and texts without a word have an empty set and no link. One row
per input row with doc_id, n_shingles, component_id (least doc_id of the component, null
only if all its doc_ids are) and kept (doc_id = component_id, null-safe). Repeated rows are
copies of each other; when a doc_id repeats within a component all its rows say the same.
Other columns are not read.

Contract of keep_one(): one row of each component stays, the one with the least doc_id
(nulls last; among different texts under that id the one with the least digest; among
repeated rows any). Rows with an empty set all stay. Rows are told apart by doc_id and text,
so a doc_id that several texts share, or null, costs no row. All columns come through.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftlink.llm.common import Workspace, free_names, join_spread, small_enough, tidy, worker_state
from weftlink.llm.graph import components

SHINGLE = 5
PERCENT = 80
ROWS = 2
MISS = 1e-4
#: Members up to which a bucket's pairs are all compared.
SMALL = 12
#: Groups whose bins of the bound may be broadcast (BINS small rows each).
STEP_ROWS = 5000
#: Bins of the bound in _partnered().
BINS = 64
#: Words of 64 bits in the parity sketch of what a node shares.
PARITY = 8
#: Bytes of a text whose words exist at a time, and words whose hashes a worker keeps.
_SEGMENT = 1 << 20
_KNOWN = 200_000
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_edge = re.compile(rb"[\x20\x09-\x0D]")


def halves_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Half keys of a collection, so that sets at the threshold meet but for a share `miss`."""
    apart = 1 - (percent / 100) ** rows
    return 1 if apart <= 0 else max(1, math.ceil(math.log(miss / 2) / math.log(apart)))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHashes(dict):
    """Hash of a word, kept for words that are not long."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= _KNOWN:
                self.clear()
            self[word] = found
        return found


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word; long texts go by segments that end at white space."""
    raw, get = text.encode("utf-8", "surrogatepass"), worker_state("minhash", _WordHashes).__getitem__
    parts, at = [np.zeros(0, np.uint64)], 0
    while at < len(raw):
        edge = _edge.search(raw, at + _SEGMENT)
        cut = edge.start() if edge else len(raw)
        parts.append(np.array(list(map(get, raw[at:cut].lower().split())), np.uint64))
        at = cut
    return np.concatenate(parts)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(words):
        return words
    take = min(size, len(words))
    whole = np.full(len(words) - take + 1, take, np.uint64)
    for k in range(take):
        whole = mix(whole + words[k : len(words) - take + 1 + k])
    return np.unique(whole)


def _seeds(halves: int, rows: int) -> np.ndarray:
    return mix(np.arange(1, 2 * halves * rows + 1, dtype=np.uint64) * _U(_BASE)) | _U(1)


def half_keys(shingles: np.ndarray, halves: int, rows: int) -> np.ndarray:
    """The half keys of both collections, one after the other, as signed numbers."""
    least = np.array([((shingles ^ (seed >> _U(7))) * seed).min() for seed in _seeds(halves, rows)])
    key = np.arange(2 * halves, dtype=np.uint64) + _U(1)
    for k in range(rows):
        key = mix(key * _U(_BASE) + least[k::rows])
    return key.view(np.int64)


def node_of(shingles: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes())


def sketch(docs: DataFrame, shingle: int, halves: int, rows: int) -> DataFrame:
    """doc_id, digest (of the text), n_shingles, node (digest of the set) and halves (array of half keys)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n, node, keys = [], [], []
            for text in batch.column(2):
                own = shingle_set(text.as_py(), shingle)
                n.append(len(own))
                node.append(node_of(own) if len(own) else None)
                keys.append(half_keys(own, halves, rows) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "digest", "n_shingles", "node", "halves"]
            )

    return docs.select("doc_id", _text_digest().alias("digest"), "text").mapInArrow(tidy(run, "minhash", _WordHashes), "doc_id long, digest binary, n_shingles long, node binary, halves array<long>")


def _text_digest() -> Column:
    return F.unhex(F.md5("text"))


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """node and its shingles, read from the texts again."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column(0)]
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "shingles"]
            )

    return docs.select("text").mapInArrow(tidy(run, "minhash", _WordHashes), "node binary, shingles array<long>")


def _with_sets(pairs: DataFrame, sets: DataFrame, work: Workspace) -> DataFrame:
    """pairs(a, b, ...) with both sets; many pairs may have the same a."""
    ours = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    theirs = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    return join_spread(pairs.join(theirs, "b"), ours, "a", "b", work)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """The pairs(a, b) whose sets are similar enough."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                joint = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * joint >= percent * (len(x) + len(y) - joint))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = _with_sets(pairs.select("a", "b"), sets, work).select("a", "b", "set_a", "set_b")
    return both.mapInArrow(tidy(run, "minhash", _WordHashes), "a binary, b binary")


def _marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows(node, ...) with the mark of each node's component."""
    return rows.join(labels, "node", "left").withColumn("mark", F.xxhash64(F.coalesce("label", "node"))).drop("label")


def links(docs: DataFrame, work: Workspace, shingle: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(sketches, labels): every row's node, and the component label of every node that has a link."""
    halves = halves_for(percent, rows)
    base = work.save(sketch(docs, shingle, halves, rows), "sketches")
    groups = work.save(_groups(base, halves, work), "groups")
    sets = work.save(_member_sets(docs, base, groups, shingle, work), "shingles")
    # Every node against the pivots of its groups.
    fits = f"least({{0}}, {{1}}) * 100 >= greatest({{0}}, {{1}}) * {percent}"
    star = groups.where(F.expr("node <> pivot") & F.expr(fits.format("n", "pivot_n"))).select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    star = work.save(star, "star")
    edges = work.save(_verify(star, sets, percent, work), "edges")
    labels = components(edges, work)
    # Groups that still hold several components.
    marked = work.save(_marked(groups, labels), "marked")
    still = marked.groupBy("pivot").agg(F.min("mark").alias("m0"), F.max("mark").alias("m1"), F.count("*").alias("c")).where("m0 <> m1").select("pivot", (F.col("c") <= SMALL).alias("small"))
    rest = work.save(marked.join(work.save(still, "open"), "pivot"), "rest")
    x, y = rest.where("small").alias("x"), rest.where("small").alias("y")
    across = x.join(y, F.expr(f"x.pivot = y.pivot and x.mark <> y.mark and x.node < y.node and {fits.format('x.n', 'y.n')}")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    found, more = _across_large(rest.where("not small and node <> pivot").drop("small", "mark"), sets, labels, edges, percent, work)
    tested = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = work.save(across.union(more).distinct().join(tested, ["a", "b"], "left_anti"), "more")
    last = work.save(_verify(more, sets, percent, work), "found")
    found = found.union(last)
    if not found.isEmpty():
        labels = components(edges.union(found), work)
    return base, labels


def _groups(base: DataFrame, halves: int, work: Workspace) -> DataFrame:
    """pivot, pivot_n, node, n: the nodes that share a table bucket whose most central node is the pivot, and the pivot.

    A node is the more central the more other sets hold its half keys.
    """
    reps = work.save(base.where("node is not null").dropDuplicates(["node"]).select("node", F.col("n_shingles").alias("n"), "halves"), "sets")
    shared = work.save(reps.select(F.explode("halves").alias("half")).groupBy("half").agg(F.count("*").alias("c")).where("c > 1"), "shared")
    shared, _ = small_enough(shared)
    held = reps.select("node", "n", F.posexplode("halves").alias("at", "half")).join(shared, "half")
    sides = held.groupBy("node", "n").agg(
        F.sum("c").alias("central"), *(F.collect_list(F.when(F.expr(f"at {test} {halves}"), F.col("half"))).alias(name) for test, name in (("<", "ours"), (">=", "theirs")))
    )
    pairs = sides.select("node", "n", "central", F.explode("ours").alias("x"), "theirs").select("node", "n", "central", "x", F.explode("theirs").alias("y"))
    keys = work.save(pairs.select(F.xxhash64("x", "y").alias("key"), "central", "node", "n"), "keys")
    buckets = keys.groupBy("key").agg(F.count("*").alias("c"), F.max(F.struct("central", "node", "n")).alias("top")).where("c > 1")
    buckets, _ = small_enough(work.save(buckets.select("key", F.col("top.node").alias("pivot"), F.col("top.n").alias("pivot_n")), "buckets"))
    return keys.select("key", "node", "n").join(buckets, "key").select("pivot", "pivot_n", "node", "n").distinct()


def _member_sets(docs: DataFrame, base: DataFrame, groups: DataFrame, shingle: int, work: Workspace) -> DataFrame:
    """The set of every node in groups, read from one text each (texts without a doc_id all)."""
    ids = groups.select("node").distinct().join(base.select("node", "doc_id"), "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    ids = work.save(ids.select(F.col("doc_id").alias("wanted")).distinct(), "wanted")
    wanted, _ = small_enough(ids.where("wanted is not null"))
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("wanted")).select("text")
    if not ids.where("wanted is null").isEmpty():
        texts = texts.union(docs.where("doc_id is null").select("text"))
    return _sets(texts, shingle).dropDuplicates(["node"])


def _merged(members: DataFrame, work: Workspace) -> DataFrame:
    """members(pivot, pivot_n, node, n) with each group joined to the largest one that its pivot is a member of.

    Nodes that share a group still share one, and a family whose buckets have many pivots
    becomes few groups instead of one for each pivot.
    """
    size = work.save(members.groupBy("pivot", "pivot_n").agg(F.count("*").alias("c")), "group-sizes")
    sizes, _ = small_enough(size.select("pivot", "c"))
    best = members.join(sizes, "pivot").groupBy("node").agg(F.max(F.struct("c", "pivot")).alias("best"))
    root = size.join(best, F.col("pivot") == F.col("node"), "left").select("pivot", F.when(F.col("best.c") > F.col("c"), F.col("best.pivot")).otherwise(F.col("pivot")).alias("root"))
    root, _ = small_enough(work.save(root, "roots"))
    names, _ = small_enough(size.select("pivot", "pivot_n"))
    rows = members.join(root, "pivot").select(F.col("root").alias("pivot"), "node", "n").where("pivot <> node").distinct()
    return rows.join(names, "pivot").select("pivot", "pivot_n", "node", "n")


def _differences(members: DataFrame, sets: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """members(pivot, pivot_n, node, n) with what the node has and the pivot has not (more), the other way round (less),
    and whether they are linked."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            more, less, linked = [], [], []
            for p, v in zip(batch.column(4), batch.column(5), strict=True):
                p, v = p.values.to_numpy(), v.values.to_numpy()
                more.append(np.setdiff1d(v, p, assume_unique=True))
                less.append(np.setdiff1d(p, v, assume_unique=True))
                joint = len(v) - len(more[-1])
                linked.append(100 * joint >= percent * (len(p) + len(v) - joint))
            made = [pa.array(linked, pa.bool_()), pa.array(more, pa.list_(pa.int64())), pa.array(less, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *made], names=["pivot", "pivot_n", "node", "n", "linked", "more", "less"])

    both = _with_sets(members.select(F.col("pivot").alias("a"), F.col("node").alias("b"), "pivot_n", "n"), sets, work)
    ddl = "pivot binary, pivot_n long, node binary, n long, linked boolean, more array<long>, less array<long>"
    return both.select("a", "pivot_n", "b", "n", "set_a", "set_b").mapInArrow(tidy(run, "minhash", _WordHashes), ddl)


def _partnered(diffs: DataFrame, labels: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """The rows of diffs that may have a link to another component of their group, with what they share.

    The difference of a node to the pivot is what it has more and what it has less. Adds
    mark, size (of the difference), shared (its elements that another component's
    difference may hold), a = S size - P n and t = 2 S |shared| - a, where
    S = 100 + percent and P = 100 - percent. Two sets are linked if S times what they
    differ in is at most P times the sum of their sizes, and they differ in what their
    differences differ in. So linked u and v of different components have
    2 S |shared u & shared v| >= a(u) + a(v), which no more than min(|shared|) elements can
    give: a(u) <= t(v) and a(v) <= t(u). Nodes that are linked with the pivot are in one
    component, so they need a partner that is not. The test is made by bins of a, which
    only lets more through.

    Which elements others share is looked up for what a node has more. What it has less is a
    part of the pivot's set that others often lack too: all of it counts as shared, and
    comes after the rest in an order that is the same for all nodes.
    """
    marked = _marked(diffs, labels)
    each = marked.select("pivot", "node", "mark", F.explode("more").alias("e"))
    common = each.groupBy("pivot", "e").agg(F.min("mark").alias("m0"), F.max("mark").alias("m1"), F.count("*").alias("c")).where("m0 <> m1").select("pivot", "e", "c")
    common = work.save(common, "common")
    held = each.join(common, ["pivot", "e"]).groupBy("pivot", "node").agg(F.sort_array(F.collect_list(F.struct("c", "e"))).alias("found"))
    both = marked.join(held, ["pivot", "node"], "left")
    both = both.withColumn("shared", F.expr("concat(coalesce(transform(found, x -> x.e), array()), less)")).drop("found")
    both = both.withColumn("size", F.expr("size(more) + size(less)"))
    both = both.withColumn("a", F.expr(f"{100 + percent} * size - {100 - percent} * n")).withColumn("t", F.expr(f"{2 * (100 + percent)} * size(shared) - a"))
    rows = work.save(both, "shared-diffs")

    def may_meet(asking: DataFrame, others: DataFrame) -> DataFrame:
        span = others.groupBy("pivot").agg(F.min("a").alias("a0"), F.greatest(F.lit(1), (F.max("a") - F.min("a")) / BINS).alias("step"))
        span, _ = small_enough(work.save(span, "spans"))
        steps = others.join(span, "pivot").groupBy("pivot", "a0", "step", F.floor((F.col("a") - F.col("a0")) / F.col("step")).alias("bin")).agg(F.max("t").alias("most"))
        steps = work.save(steps.groupBy("pivot", "a0", "step").agg(F.collect_list(F.struct("bin", "most")).alias("steps")), "steps")
        steps, _ = small_enough(steps, STEP_ROWS)
        return asking.join(steps, "pivot").where("exists(steps, s -> s.bin <= floor((t - a0) / step) and s.most >= a)").drop("a0", "step", "steps")

    apart = work.save(may_meet(rows.where("not linked"), rows), "apart")
    near = may_meet(rows.where("linked"), apart)
    return work.save(apart.unionByName(near), "partnered")


def _with_parity(rows: DataFrame) -> DataFrame:
    """rows with own (elements of the difference that no other component has) and PARITY bit sets of the parity of shared by bit.

    Every element that only one of two nodes shares flips one bit, so they differ in at
    least as many elements as bits, besides their own.
    """
    bits = (
        F.expr(f"aggregate(shared, 0L, (x, e) -> if(pmod(e, {PARITY}) = {i}, x ^ shiftleft(1L, int(pmod(e div {PARITY}, 64))), x))").alias(f"p{i}") for i in range(PARITY)
    )
    return rows.select("*", F.expr("size - size(shared)").alias("own"), *bits)


def _across_large(members: DataFrame, sets: DataFrame, labels: DataFrame, edges: DataFrame, percent: int, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(verified pairs, pairs to verify) across components among members(pivot, pivot_n, node, n) of large groups.

    Groups are merged, and every node is compared with its group's pivot. Nodes that cannot
    have a link by _partnered() go. Those that are not linked with the pivot then meet in
    buckets by minhashes of what they share, each against one node of the bucket, which
    joins families other than the pivot's. With the components of that, _partnered() looks
    again, twice, as with each node that goes others share less; the remaining ones are
    looked up by the first of what they share, and tested by parity. For u not linked with
    the pivot and v any node, linked u and v have more than half of v's difference in common
    (less a term for the sizes), so that by the usual prefix argument a few of its elements
    will do.
    """
    diffs = work.save(_differences(_merged(members, work), sets, percent, work), "differences")
    direct = diffs.where("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    edges = edges.union(direct)
    if not direct.isEmpty():
        labels = components(edges, work)
    left = _partnered(diffs, labels, percent, work)
    fits = f"least({{0}}, {{1}}) * 100 >= greatest({{0}}, {{1}}) * {percent}"
    bits = " + ".join(f"bit_count({{0}}.p{i} ^ {{1}}.p{i})" for i in range(PARITY))
    few = f"{100 + percent} * ({{0}}.own + {{1}}.own + {bits}) <= {100 - percent} * ({{0}}.n + {{1}}.n)"
    meet = "{0}.a <= {1}.t and {1}.a <= {0}.t and {0}.mark <> {1}.mark and " + fits.format("{0}.n", "{1}.n") + " and " + few
    narrow = ["node", "n", "mark", "a", "t", "own", *(f"p{i}" for i in range(PARITY))]
    least = F.array(*(F.struct(F.lit(i).alias("i"), F.expr(f"array_min(transform(shared, e -> xxhash64(e, {i})))").alias("h")) for i in range(4)))
    met = work.save(_with_parity(left.where("not linked")).select("pivot", *narrow, F.size("shared").alias("held"), F.explode(least).alias("key")), "met")
    hubs = met.groupBy("pivot", "key").agg(F.max(F.struct("held", *narrow)).alias("hub")).select("pivot", "key", "hub.*")
    hubs, _ = small_enough(work.save(hubs, "hubs"))
    again = met.alias("v").join(hubs.alias("u"), F.expr("v.pivot = u.pivot and v.key = u.key and v.node <> u.node and " + meet.format("u", "v")))
    again = work.save(again.select(F.col("u.node").alias("a"), F.col("v.node").alias("b")).distinct(), "again")
    found = work.save(_verify(again, sets, percent, work), "found")
    if not found.isEmpty():
        labels = components(edges.union(found), work)
    for _ in range(2):
        left = _partnered(left.select(*diffs.columns), labels, percent, work)
    need = f"int(({100 + percent} * size + {100 - percent} * (pivot_n - n)) div {2 * (100 + percent)}) + 1"
    left = work.save(_with_parity(left), "left")
    front = left.withColumn("front", F.expr(f"slice(shared, 1, greatest(0, size(shared) - greatest(1, {need}) + 1))"))
    v, w = (work.save(front.where(test).select("pivot", *narrow, F.explode("front").alias("e")), "front") for test in ("linked", "not linked"))
    u = left.where("not linked").select("pivot", *narrow, F.explode("shared").alias("e"))
    one = v.alias("v").join(u.alias("u"), F.expr("v.pivot = u.pivot and v.e = u.e and " + meet.format("u", "v"))).select(F.least("v.node", "u.node").alias("a"), F.greatest("v.node", "u.node").alias("b"))
    two = w.alias("v").join(w.alias("u"), F.expr("v.pivot = u.pivot and v.e = u.e and v.node < u.node and " + meet.format("u", "v"))).select(F.col("v.node").alias("a"), F.col("u.node").alias("b"))
    done = again.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return direct.union(found), one.union(two).distinct().join(done, ["a", "b"], "left_anti")


def _with_components(docs: DataFrame, work: Workspace, *options: int) -> tuple[DataFrame, DataFrame]:
    """(sketches, node and label of every node): nodes of one component have one label."""
    base, labels = links(docs, work, *options)
    nodes = base.where("node is not null").select("node").distinct().join(labels, "node", "left")
    return base, work.save(nodes.select("node", F.coalesce("label", "node").alias("label")), "labelled")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    work = Workspace(docs.sparkSession, "minhash")
    base, label = _with_components(docs, work, shingle, percent, rows)
    first = base.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    label = work.save(first.join(label, "node"), "first")
    least = work.save(label.groupBy("label").agg(F.min("first").alias("component_id")), "components")
    nodes = work.save(label.join(least, "label").select("node", "component_id"), "by-node")
    own = base.select("doc_id", "n_shingles", "node")
    out = join_spread(own.where("node is not null"), nodes, "node", "doc_id", work).select("doc_id", "n_shingles", "component_id")
    out = out.union(own.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return work.finish(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS) -> DataFrame:
    """docs without the rows that another row of their component stands for."""
    work = Workspace(docs.sparkSession, "kept")
    base, label = _with_components(docs, work, shingle, percent, rows)
    rows = base.where("node is not null").groupBy("node", "doc_id", "digest").agg(F.count("*").alias("times"))
    rows = work.save(join_spread(work.save(rows, "rows"), label, "node", "doc_id", work).select("label", "doc_id", "digest", "times"), "labelled-rows")
    best = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("without"), F.col("doc_id"), F.col("digest"))).alias("best"))
    best = work.save(best.select("label", F.col("best.doc_id").alias("best_id"), F.col("best.digest").alias("best_digest")), "best")
    same = F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("digest") == F.col("best_digest"))
    told = join_spread(rows, best, "label", "doc_id", work).where(~same | (F.col("times") > 1))
    key, print_, repeated = free_names(docs, "key", "digest", "repeated")
    told = work.save(told.select(F.col("doc_id").alias(key), F.col("digest").alias(print_), same.alias(repeated)), "told")
    told, _ = small_enough(told)
    row = F.col("doc_id").eqNullSafe(F.col(key)) & (_text_digest() == F.col(print_))
    left = docs.join(told, row, "left").where(F.col(repeated).isNull() | F.col(repeated))
    if told.where(F.col(repeated)).isEmpty():
        return work.finish(left.select(*map(_quoted, docs.columns)))
    once = left.where(F.col(repeated)).dropDuplicates([key, print_])
    return work.finish(left.where(F.col(repeated).isNull()).unionByName(once).select(*map(_quoted, docs.columns)))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


#: All pairs by their common shingles, and their transitive closure (three words, 85 percent).
ORACLE = """
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents
), sets as (
    select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) end) as g from words
), sizes as (
    select doc_id, count(*) as n from sets group by doc_id
), pairs as (
    select a.doc_id as a, b.doc_id as b, count(*) as i from sets a join sets b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2
), links as (
    select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * i >= 85 * (x.n + y.n - i)
), reached(doc_id, other) as (
    select doc_id, doc_id from documents union select links.b, reached.other from reached join links on links.a = reached.doc_id
), least as (
    select doc_id, min(other) as component_id from reached group by doc_id
)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept from least left join sizes using (doc_id)
"""
