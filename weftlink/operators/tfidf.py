"""Character n-gram TF-IDF within word borders, and cosine similarity of pairs."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftlink.sources.staging import shared_folder, staged

SIZES = (3, 4)
#: Distinct grams up to which every task holds them all, and records of a file that meet another file's.
VOCABULARY = 500_000
FILE_ROWS = 32768
PAIRS_AT_ONCE = 4096


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def grams(text: Column) -> Column:
    """All n-grams of each word with a space at either end; a short word gives itself once."""
    return _grams(_words(text))


def _grams(words: Column) -> Column:
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def of(word: Column, n: int) -> Column:
        spread = F.transform(F.sequence(F.lit(1), F.length(word) - (n - 1)), lambda i: F.substring(word, i, F.lit(n)))
        return F.when(F.length(word) >= n, spread).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(padded, lambda w: F.concat(*(of(w, n) for n in SIZES))))


def term_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, gram and tf."""
    return texts.select(key, F.explode(grams(F.coalesce(F.col(text), F.lit("")))).alias("gram")).groupBy(key, "gram").agg(F.count("*").alias("tf"))


def fit_idf(texts: DataFrame, text: str) -> DataFrame:
    """gram, df and idf = ln((1 + N) / (1 + df)) + 1 over all rows of texts."""
    n = texts.count()
    found = texts.select(F.explode(F.array_distinct(grams(F.coalesce(F.col(text), F.lit(""))))).alias("gram"))
    return found.groupBy("gram").agg(F.count("*").alias("df")).withColumn("idf", F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1)


def weights(texts: DataFrame, key: str, text: str, idf: DataFrame) -> DataFrame:
    """key, gram and w: (1 + ln tf) idf, scaled to length 1 by key. Grams that idf lacks have df = 0: ln(1 + N) + 1."""
    unseen = idf.agg(F.coalesce(F.max(F.col("idf") + F.log(F.lit(1.0) + F.col("df"))), F.lit(1.0)).alias("_unseen"))
    known = term_counts(texts, key, text).join(idf.select("gram", "idf"), "gram", "left").crossJoin(F.broadcast(unseen))
    raw = known.select(key, "gram", ((1 + F.log("tf")) * F.coalesce("idf", "_unseen")).alias("w"))
    size = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_size"))
    return raw.join(size, key).select(key, "gram", (F.col("w") / F.col("_size")).alias("w"))


def _dots(batches):
    """Both ids and the inner product of every row (s1_entity_id, cand_entity_id, grams, weights, grams, weights); grams are in order."""
    import pyarrow as pa

    for batch in batches:
        keys, values, rows = [], [], []
        for side in (2, 4):
            grams, weights = batch.column(side), batch.column(side + 1)
            row = np.repeat(np.arange(batch.num_rows), grams.value_lengths().to_numpy())
            rows.append(row)
            keys.append((row << 40) + grams.flatten().to_numpy())
            values.append(weights.flatten().to_numpy())
        at = np.searchsorted(keys[0], keys[1])
        hit = np.flatnonzero(np.append(keys[0], -1)[at] == keys[1])
        sums = np.bincount(rows[1][hit], values[0][at[hit]] * values[1][hit], batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sums, pa.float64())], names=["s1_entity_id", "cand_entity_id", "tfidf_sim"])


def pair_cosine(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """pairs(s1_entity_id, cand_entity_id) with tfidf_sim; weights are keyed by entity_id.

    A pair brings each record's grams, by number, as one array, not as rows.
    """
    grams = left.select("gram").union(right.select("gram")).distinct().repartition(8)
    numbers = staged(grams.withColumn("_n", F.monotonically_increasing_id()), "grams")  # below 2**36

    def packed(weights: DataFrame, side: str) -> DataFrame:
        held = weights.join(numbers, "gram").groupBy("entity_id").agg(F.sort_array(F.collect_list(F.struct("_n", "w"))).alias("_v"))
        return held.select(F.col("entity_id").alias(f"{side}_entity_id"), F.col("_v._n").alias(f"_{side}_n"), F.col("_v.w").alias(f"_{side}_w"))

    kinds = dict(pairs.dtypes)
    keys = pairs.select("s1_entity_id", "cand_entity_id").distinct()
    met = keys.join(packed(left, "s1"), "s1_entity_id").join(packed(right, "cand"), "cand_entity_id")
    met = met.select("s1_entity_id", "cand_entity_id", "_s1_n", "_s1_w", "_cand_n", "_cand_w")
    dots = met.mapInArrow(_dots, f"s1_entity_id {kinds['s1_entity_id']}, cand_entity_id {kinds['cand_entity_id']}, tfidf_sim double")
    return pairs.join(dots, ["s1_entity_id", "cand_entity_id"], "left").withColumn("tfidf_sim", F.coalesce("tfidf_sim", F.lit(0.0)))


def _packer(known, weights):
    """Words of records to their grams' numbers, in order, and weights of length 1; both arguments are broadcast."""

    def run(batches):
        import pyarrow as pa

        gram, idf = known.value, np.array(weights.value)
        spelled: dict[str, np.ndarray] = {}
        for batch in batches:
            words = batch.column(3)
            found = words.flatten().dictionary_encode()
            own = []
            for w in found.dictionary.to_pylist():
                if w not in spelled:
                    padded = f" {w} "
                    spelled[w] = np.array([gram[padded[i : i + n]] for n in SIZES for i in range(len(padded) - n + 1)], np.int64)
                own.append(spelled[w])
            if len(spelled) > 200_000:
                spelled.clear()
            sizes = np.array([len(g) for g in own], np.int64)
            flat, at = np.concatenate([*own, np.zeros(0, np.int64)]), found.indices.to_numpy()
            row = np.repeat(np.arange(batch.num_rows), words.value_lengths().to_numpy())
            key, tf = np.unique((np.repeat(row, sizes[at]) << 32) + flat[_spans((np.cumsum(sizes) - sizes)[at], sizes[at])], return_counts=True)
            row, n = key >> 32, key & 0xFFFFFFFF
            w = (1 + np.log(tf)) * idf[n]
            w /= np.sqrt(np.bincount(row, w * w, batch.num_rows))[row]
            ends = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            packed = [pa.ListArray.from_arrays(ends, pa.array(values)) for values in (n.astype(np.int32), w)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *packed], names=["_side", "_b", "id", "n", "w"])

    return run


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, …, sizes[i] of them, for every i."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _block(files: list[str]):
    """ids, first places, sizes, numbers and weights of a block's records."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs
    from urllib.parse import unquote, urlparse

    tables = []
    for file in files:
        at = urlparse(file)
        system, path = (fs.LocalFileSystem(), unquote(at.path)) if at.scheme in ("", "file") else fs.FileSystem.from_uri(file)
        tables.append(pq.read_table(path, filesystem=system, columns=["id", "n", "w"], partitioning=None))
    table = pa.concat_tables(tables).combine_chunks()
    n, w = (table[c].chunk(0) if table[c].num_chunks else table[c].combine_chunks() for c in "nw")
    sizes = n.value_lengths().to_numpy().astype(np.int64)
    return table["id"], np.cumsum(sizes) - sizes, sizes, n.flatten().to_numpy().astype(np.int64), w.flatten().to_numpy()


def _products(left, right, a, b) -> np.ndarray:
    """The inner product of each pair of ids of two blocks; 0 where an id is in none."""
    import pyarrow.compute as pc

    out = np.zeros(len(a))
    i, j = (pc.fill_null(pc.index_in(ids, value_set=block[0]), -1).to_numpy() for ids, block in ((a, left), (b, right)))
    known = np.flatnonzero((i >= 0) & (j >= 0))
    for begin in range(0, len(known), PAIRS_AT_ONCE):
        at = known[begin : begin + PAIRS_AT_ONCE]
        keys, values = [], []
        for (_, starts, sizes, n, w), rows in ((left, i[at]), (right, j[at])):
            spans = _spans(starts[rows], sizes[rows])
            keys.append((np.repeat(np.arange(len(at)), sizes[rows]) << 32) + n[spans])
            values.append(w[spans])
        place = np.searchsorted(keys[0], keys[1])
        hit = np.flatnonzero(np.append(keys[0], -1)[place] == keys[1])
        out[at] = np.bincount(keys[1][hit] >> 32, values[0][place[hit]] * values[1][hit], len(at))
    return out


def cosines(pairs: DataFrame, records: DataFrame, key: str, text: str, idf: DataFrame) -> DataFrame:
    """pairs(s1_entity_id, cand_entity_id, …) with tfidf_sim, as pair_cosine() gives with weights().

    Records' weights are written once, in files by blocks; a task reads the blocks of its pairs, so
    no weight is copied to a pair.
    """
    spark = pairs.sparkSession
    words = _words(F.coalesce(F.col(text), F.lit("")))
    held = records.select(F.explode(words).alias("word")).distinct().select(F.explode(_grams(F.array("word"))).alias("gram")).distinct()
    unseen = idf.agg(F.coalesce(F.max(F.col("idf") + F.log(F.lit(1.0) + F.col("df"))), F.lit(1.0)).alias("_unseen"))
    every = staged(held.join(idf.select("gram", "idf"), "gram", "left").crossJoin(F.broadcast(unseen)).select("gram", F.coalesce("idf", "_unseen").alias("idf")), "grams")
    if every.count() > VOCABULARY:
        known = staged(weights(records, key, text, idf).withColumnRenamed(key, "entity_id"), "weights")
        return pair_cosine(pairs, known, known)
    table = every.toArrow()
    context = spark.sparkContext
    gram, weight = context.broadcast({g: n for n, g in enumerate(table["gram"].to_pylist())}), context.broadcast(table["idf"].to_pylist())
    owns = F.col("source") == "S1"
    blocks = max(1, -(-max(records.agg(F.count_if(owns), F.count_if(~owns)).first()) // FILE_ROWS))
    place = lambda name: F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int")
    rows = records.select(place(key).alias("_b"), F.col(key).alias("id"), words.alias("words"), F.when(owns, 0).otherwise(1).alias("_side"))
    rows = rows.repartition(max(8, blocks), "_b").groupBy("_b", "id").agg(F.flatten(F.collect_list("words")).alias("words"), F.collect_set("_side").alias("_sides"))
    rows = rows.select(F.explode("_sides").alias("_side"), "_b", "id", "words")
    packed = rows.mapInArrow(_packer(gram, weight), f"_side int, _b int, id {dict(rows.dtypes)['id']}, n array<int>, w array<double>")
    path = f"{shared_folder(spark)}/packed-{uuid.uuid4().hex[:12]}"
    packed.write.partitionBy("_side", "_b").parquet(path)
    files: dict = {}
    for r in spark.read.parquet(path).select("_side", "_b", F.input_file_name().alias("file")).distinct().collect():
        files.setdefault((r["_side"], r["_b"]), []).append(r["file"])
    files = context.broadcast(files)

    def run(batches):
        import pyarrow as pa

        at, left, right = (-1, -1), None, None
        for batch in batches:
            s1, cand = (batch.column(batch.schema.get_field_index(c)) for c in ("s1_entity_id", "cand_entity_id"))
            a, b = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("_l", "_r"))
            out = np.zeros(batch.num_rows)
            steps = np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0)) + 1
            for begin, end in zip([0, *steps], [*steps, batch.num_rows], strict=True):
                if begin == end:
                    continue
                now = int(a[begin]), int(b[begin])
                if now[0] != at[0]:
                    left = _block(files.value[0, now[0]]) if (0, now[0]) in files.value else None
                if now[1] != at[1]:
                    right = _block(files.value[1, now[1]]) if (1, now[1]) in files.value else None
                at = now
                if left and right:
                    out[begin:end] = _products(left, right, s1[begin:end], cand[begin:end])
            kept = batch.drop_columns(["_l", "_r"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(out)], names=[*kept.schema.names, "tfidf_sim"])

    met = pairs.withColumns({"_l": place("s1_entity_id"), "_r": place("cand_entity_id")})
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(blocks * blocks, 1000))
    met = met.repartition(tasks, "_l", "_r").sortWithinPartitions("_l", "_r")
    return met.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in pairs.dtypes) + ", tfidf_sim double")
