"""Chroma fingerprints of recordings, and clusters of recordings that align.

Audio becomes frames of energy by pitch class. Sixteen rectangular filters, evaluated on
an integral image of the frames, are each quantised to two bits, so that every position
gives one packed 32-bit integer. Two recordings are aligned at the offset that most of
their equal integers vote for, and match if enough integers voted and few enough bits
differ where they overlap.

Contract of cluster(): one row per recording with n_codes, copy_of (least id with the same
codes) and component_id (least id among all that alignments connect). Null or too short
audio has no codes and is a component of its own, as are null ids. Every pair that matches()
accepts is in one component: recordings that share one of KEYS bigrams of codes are compared
with the least of them first, which only saves work; then all pairs still in different
components that can have MIN_VOTES votes at one offset, by every code of every recording,
are aligned. Repeated rows are copies. Other columns are not read.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.common import BATCH_ROWS, Workspace, collect_garbage
from weftlink.llm.graph import components

RATE = 4000
FRAME = 1024
HOP = 256
BANDS = 12
SPAN = 16
KEYS = 24
MIN_VOTES = 6
MAX_ERROR = 0.2
MIN_OVERLAP = 24
#: Codes from which a recording is long. Only its common codes have vote keys, and with more places than that of them it meets others by its codes.
LONG = 1024
#: Occurrences up to which a code is rare, and classes of common codes: MIN_VOTES votes hold 2 of rare codes or CLASSES + 1 of common ones.
RARE = 4
CLASSES = MIN_VOTES - 2
#: Vote keys that are looked at together.
BUCKET = 1 << 18
#: Recordings with a code or key from which its join is salted, and votes counted at a time.
HOT_CODE = 1000
SALTS = 16
VOTES = 1 << 22
_U = np.uint64


def filters() -> list[tuple[int, int, int, int]]:
    """(kind, first band, bands, frames) of the sixteen filters: every kind at four widths, over bands that rotate."""
    out = []
    for i in range(16):
        width, height = SPAN // (1 << (i // 4 % 3)), 2 + 2 * (i % 5)
        out.append((i % 4, (5 * i) % (BANDS - height + 1), height, width))
    return out


FILTERS = filters()
LEVELS = (-0.05, 0.0, 0.05)
_GRAY = np.array([0, 1, 3, 2], np.uint64)


def _pitch_matrix() -> np.ndarray:
    frequency = np.fft.rfftfreq(FRAME, 1 / RATE)
    out = np.zeros((len(frequency), BANDS))
    for k, f in enumerate(frequency):
        if 80 <= f <= 1800:
            out[k, int(round(12 * np.log2(f / 440))) % BANDS] = 1
    return out


_PITCH = _pitch_matrix()
_WINDOW = np.hanning(FRAME)


def chroma(samples: np.ndarray) -> np.ndarray:
    """Frames by pitch class, each scaled to length 1 and smoothed over its neighbours."""
    if len(samples) < FRAME:
        return np.zeros((0, BANDS))
    frames = np.lib.stride_tricks.sliding_window_view(samples.astype(np.float64), FRAME)[::HOP]
    energy = (np.abs(np.fft.rfft(frames * _WINDOW, axis=1)) ** 2) @ _PITCH
    size = np.sqrt((energy**2).sum(axis=1, keepdims=True))
    energy = np.where(size > 1e-6, energy / np.maximum(size, 1e-6), 0)
    padded = np.pad(energy, ((2, 2), (0, 0)), mode="edge")
    weights = (0.1, 0.2, 0.4, 0.2, 0.1)
    return sum(w * padded[i : i + len(energy)] for i, w in enumerate(weights))


def codes(frames: np.ndarray) -> np.ndarray:
    """One packed integer for each place where the widest filter fits."""
    n = len(frames) - SPAN + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    image = np.zeros((len(frames) + 1, BANDS + 1))
    image[1:, 1:] = frames.cumsum(axis=0).cumsum(axis=1)
    at = np.arange(n)

    def mean(t0, t1, b0, b1):
        """Mean over frames t0..t1 (from every place) and bands b0..b1."""
        box = image[at + t1, b1] - image[at + t0, b1] - image[at + t1, b0] + image[at + t0, b0]
        return box / ((t1 - t0) * (b1 - b0))

    packed = np.zeros(n, np.uint64)
    for k, (kind, low, height, width) in enumerate(FILTERS):
        high, middle, half = low + height, low + height // 2, width // 2
        if kind == 0:
            a, b = mean(0, width, low, high), mean(0, width, 0, BANDS)
        elif kind == 1:
            a, b = mean(0, half, low, high), mean(half, width, low, high)
        elif kind == 2:
            a, b = mean(0, width, low, middle), mean(0, width, middle, high)
        else:
            a = (mean(0, half, low, middle) + mean(half, width, middle, high)) / 2
            b = (mean(0, half, middle, high) + mean(half, width, low, middle)) / 2
        packed |= _GRAY[np.searchsorted(LEVELS, np.log((1 + a) / (1 + b)).round(9))] << _U(2 * k)
    return packed.astype(np.int64)


def _votes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Equal integers at each offset of y in x, from 1 - len(y) on."""
    n = len(x) + len(y) - 1
    votes = np.zeros(n, np.int64)
    order = np.argsort(y, kind="stable")
    left, right = np.searchsorted(y[order], x, "left"), np.searchsorted(y[order], x, "right")
    counts = right - left
    if counts.sum() > VOTES:  # of a code that is frequent in both, as silence is, a convolution counts the votes
        values, at, own = np.unique(x, return_index=True, return_counts=True)
        for v in values[own * counts[at] > 32 * n]:
            size = 1 << n.bit_length()
            votes += np.rint(np.fft.irfft(np.fft.rfft(x == v, size) * np.fft.rfft((y == v)[::-1], size), size)[:n]).astype(np.int64)
            counts[x == v] = 0
    ends = np.cumsum(counts)
    begin = 0
    while begin < len(x):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + VOTES, "right")))
        part = counts[begin:end]
        own = np.repeat(np.arange(begin, end), part)
        inner = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
        votes += np.bincount(own - order[np.repeat(left[begin:end], part) + inner] + len(y) - 1, minlength=n)
        begin = end
    return votes


def align(x: np.ndarray, y: np.ndarray) -> tuple[int, int, float, int]:
    """(offset of y in x, votes, share of differing bits, overlap) at the offset most voted for; ties to the smallest."""
    if not len(x) or not len(y):
        return 0, 0, 1.0, 0
    votes = _votes(x, y)
    if not votes.any():
        return 0, 0, 1.0, 0
    best = int(votes.argmax()) - len(y) + 1
    a, b = (x[best:], y) if best >= 0 else (x, y[-best:])
    n = min(len(a), len(b))
    return best, int(votes.max()), float(np.bitwise_count((a[:n] ^ b[:n]).astype(np.uint64)).sum() / (32 * n)), n


def matches(x: np.ndarray, y: np.ndarray) -> bool:
    _, votes, error, overlap = align(x, y)
    return votes >= MIN_VOTES and error <= MAX_ERROR and overlap >= min(MIN_OVERLAP, len(x), len(y))


def bigram_keys(own: np.ndarray, keys: int = KEYS) -> np.ndarray:
    """The bigrams of least hash."""
    if len(own) < 2:
        return own.astype(np.int64)
    pair = own[:-1].astype(np.uint64) * _U(0x9E3779B97F4A7C15) ^ own[1:].astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F)
    pair = (pair ^ (pair >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return np.unique(pair ^ (pair >> _U(32)))[:keys].view(np.int64)


def render(vector: list[float] | None) -> np.ndarray | None:
    """A vector as a melody in 16-bit PCM: each component is a note of two frames' hop."""
    if not vector or any(v is None or not np.isfinite(v) for v in vector):
        return None
    note = np.arange(2 * HOP) / RATE
    tone = np.floor(64 * (np.array(vector, float) + 1)) % 36
    wave = np.sin(2 * np.pi * (110 * 2 ** (tone / 12))[:, None] * note).ravel()
    return (12000 * wave).astype(np.int16)


def fingerprint(rows: DataFrame, audio: str, key: str, decode=None) -> DataFrame:
    """key as id, codes and keys of every row. decode turns a value of the column into samples; the default reads 16-bit PCM."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = []
            for value in batch.column(1):
                value = value.as_py()
                samples = decode(value) if decode else None if value is None else np.frombuffer(value[: len(value) // 2 * 2], "<i2")
                found.append(np.zeros(0, np.int64) if samples is None else codes(chroma(samples)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64())), pa.array([bigram_keys(c) if len(c) else None for c in found], pa.list_(pa.int64()))], names=["id", "codes", "keys"]
            )

    return rows.select(F.col(key).cast("long").alias("id"), audio).mapInArrow(run, "id long, codes array<long>, keys array<long>")


def _aligned(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """pairs(a, b) that match, with offset, votes and error."""
    x = prints.select(F.col("node").alias("a"), F.col("codes").alias("x"))
    y = prints.select(F.col("node").alias("b"), F.col("codes").alias("y"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for a, b, left, right in zip(*(batch.column(i) for i in range(4)), strict=True):
                left, right = left.values.to_numpy(), right.values.to_numpy()
                offset, votes, error, overlap = align(left, right)
                if votes >= MIN_VOTES and error <= MAX_ERROR and overlap >= min(MIN_OVERLAP, len(left), len(right)):
                    out.append((a.as_py(), b.as_py(), offset, votes, error))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["a", "b", "offset", "votes", "error"])

    return pairs.select("a", "b").join(y, "b").join(x, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, offset int, votes int, error double")


def _postings(reps: DataFrame) -> DataFrame:
    """Every code of every recording, with its place there."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [c.values.to_numpy() for c in batch.column(1)]
            node = np.repeat(batch.column(0).to_numpy(), [len(c) for c in found])
            code, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found, [np.arange(len(c)) for c in found]))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(code, pa.int64()), pa.array(place, pa.int32())], names=["node", "code", "place"])

    return reps.select("node", "codes").mapInArrow(run, "node long, code long, place int")


@functools.lru_cache(256)
def _two_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def vote_keys(code: np.ndarray, place: np.ndarray, classes: int = CLASSES, only: int | None = None) -> np.ndarray:
    """Distinct hashes of (code, later code, gap) of all two places whose codes are of one class, or of the class `only`.

    Of classes + 1 places where two recordings agree at one offset, two are of one class, so both have their hash.
    """
    mixed = code.astype(np.uint64) * _U(0x9E3779B97F4A7C15)
    mixed ^= mixed >> _U(29)
    kind, out = mixed % _U(classes), []
    for k in range(classes) if only is None else (only,):
        at = np.flatnonzero(kind == k)
        i, j = (at[x] for x in _two_of(len(at)))
        key = (mixed[i] * _U(0xC2B2AE3D27D4EB4F) + mixed[j]) * _U(0xBF58476D1CE4E5B9) + (place[j] - place[i]).astype(np.uint64)
        out.append(np.unique((key ^ (key >> _U(32))) * _U(0x94D049BB133111EB)))
    return np.unique(np.concatenate(out) if len(out) > 1 else out[0]).view(np.int64)


def _keyed(held: DataFrame) -> DataFrame:
    """vote_keys() of every (node, comp, found), found being an array of (place, code) in order."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            nodes, comps, made = [], [], []
            for row in range(batch.num_rows):
                found = batch.column(2)[row].values
                made.append(vote_keys(found.field(1).to_numpy(), found.field(0).to_numpy().astype(np.int64)))
                nodes.append(batch.column(0)[row].as_py())
                comps.append(batch.column(1)[row].as_py())
                if row + 1 == batch.num_rows or sum(map(len, made)) > VOTES // 8:
                    size = [len(m) for m in made]
                    columns = [np.repeat(np.array(nodes, np.int64), size), np.repeat(np.array(comps, np.int64), size), np.concatenate(made)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "comp", "key"])
                    nodes, comps, made = [], [], []

    return held.select("node", "comp", "found").mapInArrow(run, "node long, comp long, key long")


def _meet(left: DataFrame, right: DataFrame, key: str, on: str) -> DataFrame:
    """Rows x of left and y of right with one key that hold `on`; a key marked hot is dealt over SALTS tasks."""
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).otherwise(0)
    every = F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    x, y = left.withColumn("salt", salt).alias("x"), right.withColumn("salt", every).alias("y")
    return x.join(y, F.expr(f"x.{key} = y.{key} and x.salt = y.salt and x.comp <> y.comp and {on}"))


def _packed(held: DataFrame, classes: int, only: int, buckets: int) -> DataFrame:
    """vote_keys() of a class of every (node, comp, codes), many to a row: each row holds, of some recordings, the keys
    of one range (bucket) as their low 32 bits, and for each key the place of its recording in nodes and comps."""

    def pack(made, nodes, comps):
        key = np.concatenate(made).view(np.uint64)
        owner = np.repeat(np.arange(len(made)), [len(m) for m in made])
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        found, begin = np.unique((key >> _U(32)) * _U(buckets) >> _U(32), return_index=True)
        for bucket, start, end in zip(found.tolist(), begin, [*begin[1:], len(key)], strict=True):
            who, index = np.unique(owner[start:end], return_inverse=True)
            yield bucket, key[start:end].astype(np.uint32).tobytes(), index.astype(np.uint16).tobytes(), nodes[who], comps[who]

    def run(batches):
        import pyarrow as pa

        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        names = ["bucket", "low", "owner", "nodes", "comps"]
        for batch in batches:
            nodes, comps = (batch.column(i).to_numpy() for i in range(2))
            made, begin = [], 0
            for row in range(batch.num_rows):
                own = batch.column(2)[row].values.to_numpy()
                made.append(vote_keys(own, np.arange(len(own)), classes, only))
                if row + 1 == batch.num_rows or len(made) == BATCH_ROWS or sum(map(len, made)) > VOTES // 8:
                    rows = list(pack(made, nodes[begin : row + 1], comps[begin : row + 1]))
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    made, begin = [], row + 1

    return held.select("node", "comp", "codes").mapInArrow(run, "bucket long, low binary, owner binary, nodes array<long>, comps array<long>")


def _met(packed: DataFrame, classes: int, only: int) -> DataFrame:
    """(key, node, comp, hot) of the keys of _packed() that recordings of different components hold."""

    def run(table):
        import pyarrow as pa

        table = table.combine_chunks()
        bucket, low, owner, nodes, comps = ([v for chunk in table.column(c).chunks for v in chunk] for c in ("bucket", "low", "owner", "nodes", "comps"))
        owner = [np.frombuffer(v.as_py(), np.uint16) for v in owner]
        key = np.concatenate([np.frombuffer(v.as_py(), np.uint32) for v in low])
        node, comp = (np.concatenate([v.values.to_numpy()[o] for v, o in zip(x, owner, strict=True)]) for x in (nodes, comps))
        order = np.argsort(key, kind="stable")
        key, node, comp = key[order], node[order], comp[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(begin, append=len(key))
        keep = np.repeat(np.minimum.reduceat(comp, begin) != np.maximum.reduceat(comp, begin), size)
        hot = np.repeat(size > HOT_CODE, size)[keep]
        whole = (bucket[0].as_py() * classes + only) << 32 | key[keep].astype(np.int64)
        return pa.table([pa.array(whole), pa.array(node[keep]), pa.array(comp[keep]), pa.array(hot)], names=["key", "node", "comp", "hot"])

    return packed.groupBy("bucket").applyInArrow(run, "key long, node long, comp long, hot boolean")


def _sharing(reps: DataFrame, labels: DataFrame, work: Workspace) -> DataFrame:
    """Pairs (a, b) of different components that may have MIN_VOTES votes at one offset; no pair that has them is left out.

    Of MIN_VOTES votes in MIN_VOTES - 1 classes of codes two are of one class, so two recordings that have them share one of
    their vote_keys(), which, unlike the codes, unrelated recordings hardly ever do. A recording has the same keys
    however many others there are, n² / (2 * MIN_VOTES - 2) for n places, so all grows with the recordings. Keys are packed
    by ranges, one class at a time, and become rows only where components share them. Pairs with a long recording are
    found by _with_long().
    """
    held = reps.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("comp"), "codes", (F.size("codes") > LONG).alias("long"))
    held = work.save(held, "held")
    short, classes = held.where("not long"), MIN_VOTES - 1
    places = short.agg(F.sum(F.pow(F.size("codes"), F.lit(2)))).first()[0] or 0
    buckets = 1 + int(places / (2 * classes**2) / BUCKET)
    met = []
    for k in range(classes):
        met.append(work.save(_met(_packed(short, classes, k, buckets), classes, k), "shared-keys"))
        collect_garbage(work.spark, 0)  # frees the class's shuffle, of all keys, before the next
    met = functools.reduce(DataFrame.union, met)
    pairs = work.save(_meet(met, met, "key", "x.node < y.node").select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "by-keys")
    if not held.where("long").isEmpty():
        pairs = pairs.union(_with_long(held, work))
    return pairs.distinct()


def _with_long(held: DataFrame, work: Workspace) -> DataFrame:
    """Pairs of _sharing() of which one is long at least.

    A rare code occurs at most RARE times in all recordings. A pair with two votes of rare
    codes at one offset meets by these. Any other pair with MIN_VOTES votes has at least
    CLASSES + 1 of common codes, hence one of the vote_keys() of its common codes. Recordings
    with more than LONG places of common codes, whose keys would grow with the square of that,
    meet others by the codes: at one offset a code has no more votes than the rarer of its
    two counts. Only codes that a long recording shares with others are looked at.
    """
    posts = _postings(held).join(held.select("node", "comp", "long"), "node")
    posts = work.save(posts, "postings")
    shared = posts.groupBy("code").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("c"), F.max("long").alias("long")).where("c0 <> c1 and long")
    shared = work.save(shared.select("code", (F.col("c") <= RARE).alias("rare")), "shared")
    rest = work.save(posts.join(shared, "code"), "rest")
    work.drop(posts)
    on = "x.node < y.node and (x.long or y.long)"
    rare = rest.where("rare").withColumn("hot", F.lit(False))
    votes = _meet(rare, rare, "code", on).groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.expr("x.place - y.place").alias("offset")).agg(F.count("*").alias("c"))
    pairs = work.save(votes.where("c >= 2").select("a", "b"), "by-rare-codes")

    common = rest.where("not rare")
    found = common.groupBy("node", "comp").agg(F.sort_array(F.collect_list(F.struct("place", "code"))).alias("found")).where(F.size("found") > CLASSES)
    found = work.save(found, "common")
    keys = work.save(_keyed(found.where(F.size("found") <= LONG)).join(held.select("node", "long"), "node"), "vote-keys")
    both = keys.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("c"), F.max("long").alias("long")).where("c0 <> c1 and long")
    met = work.save(keys.join(both.select("key", (F.col("c") > HOT_CODE).alias("hot")), "key"), "shared-keys")
    by_keys = _meet(met, met, "key", on).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    pairs = pairs.union(work.save(by_keys.distinct(), "by-keys"))

    many = found.where(F.size("found") > LONG).select("node")
    if not many.isEmpty():
        times = common.groupBy("node", "comp", "code").agg(F.count("*").alias("times"))
        hot = times.groupBy("code").agg((F.count("*") > HOT_CODE).alias("hot"))
        times = work.save(times.join(hot, "code"), "times")
        votes = _meet(times, times.join(many, "node", "left_semi"), "code", "true").groupBy(F.col("x.node").alias("x"), F.col("y.node").alias("y")).agg(F.sum(F.least("x.times", "y.times")).alias("votes"))
        votes = votes.where(F.col("votes") > CLASSES).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        pairs = pairs.union(work.save(votes.distinct(), "by-codes"))
    return pairs


def cluster(prints: DataFrame) -> DataFrame:
    """id, n_codes, copy_of and component_id of every row of fingerprint()."""
    work = Workspace(prints.sparkSession, "chroma")
    prints = prints.withColumn("name", F.when(F.size("codes") > 0, F.sha2(F.expr("array_join(codes, ',')"), 256)))
    prints = work.save(prints, "prints")
    first = work.save(prints.where("name is not null").groupBy("name").agg(F.min("id").alias("copy_of")), "first")
    reps = prints.where("name is not null").dropDuplicates(["name"]).select("name", F.monotonically_increasing_id().alias("node"), "codes", "keys")
    reps = work.save(reps, "reps")
    names = work.save(prints.select("id", F.size("codes").alias("n_codes"), "name"), "names")
    work.drop(prints)
    held = reps.select("node", F.explode("keys").alias("key"))
    sizes = work.save(held.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("c")).where("c > 1"), "buckets")
    star = work.save(held.join(sizes, "key").where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "star")
    edges = work.save(_aligned(star, reps), "edges")
    labels = components(edges, work)
    pairs = _sharing(reps, labels, work)
    more = work.save(_aligned(pairs.join(star, ["a", "b"], "left_anti"), reps), "more")
    if not more.isEmpty():
        labels = components(edges.union(more), work)
    label = first.join(reps.select("name", "node"), "name").join(labels, "node", "left").select("name", "copy_of", F.coalesce("label", "node").alias("label"))
    label = work.save(label, "labelled")
    least = work.save(label.groupBy("label").agg(F.min("copy_of").alias("component_id")), "components")
    nodes = work.save(label.join(least, "label").select("name", "copy_of", "component_id"), "by-name")
    out = names.join(nodes, "name", "left")
    alone = F.col("name").isNull()
    return work.finish(out.select("id", "n_codes", F.when(alone, F.col("id")).otherwise(F.col("copy_of")).alias("copy_of"), F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id")))
