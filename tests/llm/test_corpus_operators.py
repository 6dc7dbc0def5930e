import random
import re

import numpy as np

import corpus_pipeline
from tests.llm.helpers import edge_docs, edge_rows, empty_docs
from weftlink.llm import bpe, minhash, mixing
from weftlink.llm.common import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _set(text, size):
    words = WORD.findall(_lower(text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def _brute(rows, size, percent):
    sets = [_set(t, size) for _, t in rows]
    owner = list(range(len(rows)))

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                owner[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((doc is None, doc or 0, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)), key=repr)


def _found(frame):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in frame.collect()), key=repr)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(8)
    vocabulary = ["w%d" % i for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(90)]
    rows, doc = [], 100
    for _ in range(60):  # a large group of near copies around the threshold, in chains
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((doc, " ".join(words)))
        doc += 1
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    for _ in range(40):  # a passage that unrelated documents share
        rows.append((doc, passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(30, 60)))))
        doc += 1
    rows += [(5, rows[0][1].upper()), (900, rows[0][1])] + [(r[0], r[1]) for r in edge_rows()]
    table = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string")
    assert _found(minhash.near_duplicates(table, 3, 85)) == _brute(rows, 3, 85)
    kept = minhash.near_duplicates(table, 3, 85).where("kept").count()
    assert kept == sum((d or 0) == (c or 0) for _, d, _, c in _brute(rows, 3, 85))


def _family(rng, base, n, first, edits):
    """n near copies of a text: words replaced, cut and put in."""
    out = []
    for k in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            at, what = rng.randrange(len(words)), rng.random()
            words[at : at + 1] = [] if what < 0.2 else [f"x{rng.randrange(3000)}"] if what < 0.9 else [words[at], f"x{rng.randrange(3000)}"]
        out.append((first + k, " ".join(words)))
    return out


def _components_by_matrix(rows, size, percent):
    """The least doc_id of every row's component, by counts of common shingles of all pairs."""
    sets = [_set(t, size) for _, t in rows]
    place = {g: i for i, g in enumerate(set().union(*sets))}
    grid = np.zeros((len(rows), len(place)), np.float32)
    for i, own in enumerate(sets):
        grid[i, [place[g] for g in own]] = 1
    joint, n = grid @ grid.T, grid.sum(axis=1)
    linked = 100 * joint >= percent * (n[:, None] + n[None, :] - joint)
    label = np.array([d for d, _ in rows])
    while True:
        least = np.where(linked, label[None, :], label.max()).min(axis=1)
        if (least == label).all():
            return dict(zip((d for d, _ in rows), label.tolist(), strict=True))
        label = least


def test_large_families_stay_linear(spark, monkeypatch):
    """Groups of 2000 near copies around the threshold, in one and in four families: whole links from few pairs."""
    verified, old = [], minhash._verify
    monkeypatch.setattr(minhash, "_verify", lambda pairs, *rest: verified.append(pairs.count()) or old(pairs, *rest))
    for families, size, percent in ((1, 5, 80), (4, 3, 85)):
        pairs = []
        for n in (500, 2000):
            rng = random.Random(3)
            passage = [f"p{i}" for i in range(70)]
            rows = []
            for f in range(families):
                base = passage + [f"f{f}-{i}" for i in range(60)]
                rows += _family(rng, base, n // families, 10_000 * (f + 1), 7)
            verified.clear()
            found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=size, percent=percent)
            assert {r.doc_id: r.component_id for r in found.collect()} == _components_by_matrix(rows, size, percent)
            pairs.append(sum(verified))
        assert pairs[1] <= 10 * 2000 and pairs[1] <= 6 * pairs[0], pairs


def test_near_duplicates_without_rows_or_links(spark):
    assert minhash.near_duplicates(empty_docs(spark)).count() == 0
    assert _found(minhash.near_duplicates(edge_docs(spark).select("doc_id", "text"))) == _brute([(r[0], r[1]) for r in edge_rows()], 5, 80)
    left = minhash.keep_one(edge_docs(spark))
    assert left.where("doc_id = 7").count() == 1 and left.columns == edge_docs(spark).columns


def test_null_and_repeated_ids_cost_no_text(spark):
    rng = random.Random(1)
    one, two, three, four = (" ".join(f"{c}{rng.randrange(500)}" for _ in range(80)) for c in "abcd")
    near = lambda text: " ".join(text.split()[:-2])
    rows = [(None, one, 1), (None, two, 2), (None, near(one), 3), (9, three, 4), (9, four, 5), (1, "x " + three, 6), (5, two, 7), (5, four + " y", 8), (None, None, 9), (None, "", 10), (None, "", 11), (4, three, 12)]
    table = spark.createDataFrame(rows, "doc_id long, text string, _id int").select("_id", "doc_id", "text", "_id").toDF("_id", "doc_id", "text", "key")
    kept = minhash.keep_one(table)
    assert kept.columns == table.columns
    found = sorted(r["_id"] for r in kept.collect())
    assert found[0] in (1, 3) and found[1:] == [6, 7, 8, 9, 10, 11]
    parts = {r.doc_id: r.component_id for r in minhash.near_duplicates(table).where("doc_id is not null").collect()}
    assert parts[4] == parts[1] == 1
    chain = [(None, one, 0), (3, "q r " + one, 0), (7, near(one) + " s t", 0)]  # 3 and 7 are linked through the text without an id
    parts = minhash.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string, node int"), shingle=5, percent=92)
    assert {r.component_id for r in parts.collect()} == {3}


def test_word_hashes_do_not_depend_on_segments(monkeypatch):
    text = " ".join(["Some", "wörds", "AND", "x" * 50] * 40)
    whole = minhash.word_hashes(text)
    assert len(whole) == 160 and (minhash.word_hashes("a\tb\x0bc") == minhash.word_hashes(" A  B\nC ")).all()
    monkeypatch.setattr(minhash, "_SEGMENT", 128)
    assert (minhash.word_hashes(text) == whole).all()
    assert len(minhash.word_hashes("y" * 300 + " z")) == 2 and not len(minhash.word_hashes(" \n"))
    thue = "a"
    for _ in range(10):
        thue += thue.translate(str.maketrans("ab", "ba"))
    assert len(set(minhash.word_hashes(f"{thue} {thue.translate(str.maketrans('ab', 'ba'))}").tolist())) == 2


def test_half_keys_meet_at_the_threshold():
    rng = np.random.default_rng(1)
    halves, met = minhash.halves_for(85), 0
    for _ in range(150):
        common = rng.integers(0, 2**63, 184, dtype=np.int64).view(np.uint64)
        x, y = (np.unique(np.concatenate([common, rng.integers(0, 2**63, 16, dtype=np.int64).view(np.uint64)])) for _ in range(2))
        same = minhash.half_keys(x, halves, 2) == minhash.half_keys(y, halves, 2)
        met += same[:halves].any() and same[halves:].any()
    assert met >= 149


def test_permutations_and_draws():
    for n in (1, 2, 3, 17, 1000):
        keys = mixing._round_keys(1, 2, 3)
        there = mixing.permute(np.arange(n), n, keys)
        assert sorted(there) == list(range(n)) and (mixing.permute(there, n, keys, back=True) == np.arange(n)).all()
    slots, total = np.array([70, 0, 25, 5]), np.zeros(4, int)
    for shard in range(10):
        first, counts = mixing.shard_draw(shard, 10, slots, 10, 3)
        assert (first == total).all() and counts.sum() == 10
        total += counts
    assert (total == slots).all()
    rng = np.random.default_rng(0)
    big = np.array([mixing._draw(rng, (2 * 10**9, 10**9), 9000) for _ in range(400)])
    assert (big.sum(axis=1) == 9000).all() and abs(big[:, 0].mean() - 6000) < 10 and 38 < big[:, 0].std() < 52
    assert mixing._draw(rng, (10**9, 0, 5), 10**9 + 5) == (10**9, 0, 5) and mixing._hypergeometric(rng, 1, 10**9, 1) in (0, 1)


def test_targets_are_held_and_reshared():
    assert mixing.targets([100, 100, 100]) == [187.5, 75.0, 37.5]
    found = mixing.targets([10, 1000, 1000])
    assert found[0] == 30 and abs(sum(found) - 2010) < 1e-9 and found[1] == 2 * found[2]
    assert mixing.targets([0, 0]) == [0.0, 0.0] and mixing.targets([]) == []


def _targets_by_filling(sizes, cap=3):
    """Targets by pouring the total in small steps by weight into sources that still have room."""
    weight = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    out, left = [0.0] * len(sizes), float(sum(sizes))
    while left > 1e-9:
        room = [i for i in range(len(sizes)) if out[i] < cap * sizes[i] - 1e-9]
        if not room:
            break
        all_weight = sum(weight[i] for i in room)
        step = min([left] + [(cap * sizes[i] - out[i]) * all_weight / weight[i] for i in room])
        for i in room:
            out[i] += step * weight[i] / all_weight
        left -= step
    return out


def _check_mix(rows, table):
    found = mixing.mix(table).taken().collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, _targets_by_filling([sizes[s] for s in order]), strict=True))
    taken = dict.fromkeys(order, 0)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in order)
    return found


def test_mix_meets_its_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 700)), rng.choice(["a", "a", "a", "a", "b", "c", "Z", "é", None])) for i in range(500)] + [(500, "tiny", "q"), (501, None, "void")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    one, two = (sorted((r.doc_id, r.taken) for r in _check_mix(rows, table)) for _ in range(2))
    assert one == two
    mixed = mixing.mix(table)
    texts = mixed.texts(table).collect()
    assert sum(len(t.text.split()) for t in texts) == sum(t for _, t in one) and len(texts) == mixed.slots.count()


def test_mix_of_edge_rows(spark):
    rows = [(r[0], r[1], r[3]) for r in edge_rows()]
    _check_mix(rows, edge_docs(spark))
    assert mixing.mix(empty_docs(spark)).taken().count() == 0
    assert mixing.resample(empty_docs(spark)).count() == 0
    assert mixing.resample(edge_docs(spark)).columns == edge_docs(spark).columns


def test_resample_keeps_rows_apart(spark):
    rng = random.Random(2)
    rows = [(None if i % 3 else i % 7, " ".join(f"w{rng.randrange(90)}" for _ in range(rng.randint(1, 90))), rng.choice("abc"), i, i) for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, _id int, _copy int")
    out = mixing.resample(table)
    assert out.columns == table.columns
    size = {r[3]: len(r[1].split()) for r in rows}
    words, total = {}, {}
    for r in out.collect():
        words[r.source] = words.get(r.source, 0) + size[r["_id"]]
    for r in rows:
        total[r[2]] = total.get(r[2], 0) + size[r[3]]
    want = dict(zip("abc", _targets_by_filling([total[s] for s in "abc"]), strict=True))
    assert all(abs(words[s] - want[s]) < 0.1 * want[s] for s in "abc")


def test_pipeline_stages(spark):
    """Each stage against what it must keep of its own input, brute-forced."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    work = Workspace(spark, "test")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(work.save(stage(spark, tables[-1], folder), name.replace(" ", "-")))
    for table in tables[1:-1]:
        assert table.columns == docs.columns
    rows = [{r.doc_id: r.text for r in t.collect()} for t in tables[:-1]]
    assert set(rows[1]) == {k for k, t in rows[0].items() if any(map(str.isalpha, t))}
    assert set(rows[2]) <= set(rows[1]) and len(rows[2]) >= 0.8 * len(rows[1])
    keep = {d for _, d, _, c in _brute(sorted(rows[2].items()), 5, 80) if d == c}
    assert set(rows[3]) == keep
    taken = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix(tables[3]).taken().collect()}
    counts = {r.doc_id: r["count"] for r in tables[4].groupBy("doc_id").count().collect()}
    assert all(taken[k][0] // taken[k][1] <= counts.get(k, 0) <= taken[k][0] // taken[k][1] + 1 for k in taken)
    path, pattern = bpe.default_vocabulary()
    codec = bpe.codec(path, pattern)
    assert sorted((r.doc_id, r.ids_sha256) for r in tables[5].collect()) == sorted((r.doc_id, codec.digest(r.text)[1]) for r in tables[4].collect())
    assert corpus_pipeline.run(spark, folder).count() == tables[5].count()


def test_saving_a_table_collects_the_drivers_garbage(spark, monkeypatch):
    from weftlink.llm import common

    garbage = spark._jvm.java.lang.ref.WeakReference(spark._jvm.java.util.ArrayList())
    monkeypatch.setattr(common, "HEAP_SHARE", 0)
    assert common.Workspace(spark, "tidy").save(spark.range(3), "rows").count() == 3
    assert garbage.get() is None
    monkeypatch.setattr(common, "HEAP_SHARE", 2)
    assert not common.collect_garbage(spark)
