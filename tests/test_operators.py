import math

import pytest
from pyspark.sql import functions as F

from weftlink.functions import similarity as sim
from weftlink.operators import blocking, decide, metrics, model, neighbours, split, tfidf, validate
from weftlink.plans import pipeline, surrogate
from weftlink.sources import tables

SF = "/root/testdata/sf0.001"


def _links(spark, *pairs):
    return spark.createDataFrame(list(pairs), "s1_entity_id string, cand_entity_id string")


def _keys(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "s1_entity_id string")


def test_worked_measure(spark):
    row = metrics.evaluate(_keys(spark, "a"), _links(spark, ("a", "x"), ("a", "y"), ("a", "z")), _links(spark, ("a", "x"), ("a", "y"))).first()
    assert row.f05 == pytest.approx(0.7142857, abs=1e-4)


def test_entities_without_matches(spark):
    keys, truth = _keys(spark, "a", "b"), _links(spark, ("a", "x"))
    assert metrics.evaluate(keys, _links(spark, ("a", "x")), truth).first().f05 == 1
    assert metrics.evaluate(keys, _links(spark, ("a", "x"), ("b", "y")), truth).first().f05 == 0.5
    row = metrics.evaluate(keys, truth.limit(0), truth.limit(0)).first()
    assert tuple(row) == (1, 1, 1, 1, 1)


def test_pools_cover_all_and_cap_train(spark):
    keys = spark.range(2000).select(F.concat(F.lit("S1-"), "id").alias("s1_entity_id"))
    pools = {r.pool: r["count"] for r in split.assign_pools(keys, most_train=700).groupBy("pool").count().collect()}
    assert sum(pools.values()) == 2000 and pools["train"] == 700 and 0.1 < pools["val"] / 2000 < 0.2 and 0.02 < pools["calib"] / 2000 < 0.08


def _scored(spark, *rows):
    return spark.createDataFrame([(*r, "S2", "US") for r in rows], "s1_entity_id string, cand_entity_id string, calib_proba double, ann_sim double, tfidf_sim double, source string, country string")


def test_one_owner_ties(spark):
    rows = _scored(spark, ("b", "x", 0.5, None, 0.1), ("a", "x", 0.5, 0.2, 0.1), ("b", "y", 0.5, 0.2, 0.1), ("a", "y", 0.5, 0.2, 0.1), ("c", "y", 0.5, 0.2, 0.0))
    assert {(r.s1_entity_id, r.cand_entity_id) for r in decide.one_owner(rows).collect()} == {("a", "x"), ("a", "y")}


def test_sweep_equals_evaluation_at_each_point(spark):
    rows = surrogate.scored(spark, SF)
    owned, keys, truth = decide.one_owner(rows), surrogate.keys(spark, SF), surrogate.truth(spark, SF)
    sweep = {round(r.threshold, 6): r.f05 for r in decide.threshold_sweep(owned, keys, truth).collect()}
    assert len(sweep) == 189
    for i in (10, 57, 120, 198):
        want = metrics.evaluate(keys, decide.at_threshold(owned, i / 200), truth).first().f05
        assert sweep[round(i / 200, 6)] == pytest.approx(want)
    best, f05 = decide.best_threshold(decide.threshold_sweep(owned, keys, truth))
    assert f05 == pytest.approx(max(sweep.values())) and best == min(t for t, f in sweep.items() if f >= f05 - 1e-12)
    empty = decide.best_threshold(decide.threshold_sweep(owned, keys.limit(0), truth))
    assert empty[0] == 0.05 and math.isnan(empty[1])


def test_expected_measure_rule(spark):
    rows = _scored(spark, ("sure", "a", 1.0, 0.0, 0.0), ("sure", "b", 0.9, 0.0, 0.0), ("low", "c", 0.01, 0.0, 0.0), ("doubt", "d", 0.3, 0.0, 0.0), ("tie", "f", 0.9, 0.0, 0.0), ("tie", "e", 0.9, 0.0, 0.0))
    found = {}
    for r in decide.expected_f05(rows).collect():
        found.setdefault(r.s1_entity_id, set()).add(r.cand_entity_id)
    assert found == {"sure": {"a", "b"}, "tie": {"e", "f"}}  # for "doubt" no match has the chance 0.7


def test_union_of_blockers(spark):
    base = spark.createDataFrame([("a", "x", "S2", "US")], "s1_entity_id string, cand_entity_id string, source string, country string")
    ann = base.withColumn("from_ann", F.lit(True)).withColumn("ann_sim", F.lit(0.9)).withColumn("ann_rank", F.lit(4))
    back = base.withColumn("from_ann", F.lit(True)).withColumn("ann_sim", F.lit(0.8)).withColumn("ann_rank", F.lit(999))
    sound = base.withColumn("from_phonetic", F.lit(True))
    assert (row := blocking.union_candidates([ann, sound]).first()).ann_rank == -1 and row.ann_sim == 0.9 and row.from_phonetic and not row.from_sn
    assert blocking.union_candidates([ann, back]).first().ann_rank == 4 and blocking.union_candidates([back]).first().ann_rank == 999


def test_sorted_neighbourhood_equals_loop(spark):
    rows = [(f"S{1 + i % 3}-{i:03d}", f"S{1 + i % 3}", "US" if i % 4 else "India", f"k{(i * 37) % 20:02d}") for i in range(90)]
    frame = spark.createDataFrame(rows, "entity_id string, source string, country string, name_core string")
    want = set()
    for country in ("US", "India"):
        for source in ("S2", "S3"):
            line = sorted((k, s != "S1", e, s) for e, s, c, k in rows if c == country and s in ("S1", source))
            for i, a in enumerate(line):
                want |= {(a[2], b[2]) for b in line[max(0, i - 2) : i + 3] if a[3] == "S1" and b[3] != "S1"}
    got = blocking.sorted_neighbourhood(frame, "name_core", window=2, partitions=7)
    assert {(r.s1_entity_id, r.cand_entity_id) for r in got.collect()} == want


def test_buckets_cap_and_keep_the_best(spark):
    rows = [("S1-1", "S1", "US", "TX", "1", "oak road")] + [(f"S2-{i}", "S2", "US", "TX", "1", "oak road" if i == 5 else f"street {i}") for i in range(20)] + [("S2-x", "S2", "US", "TX", "", "oak road")]
    frame = spark.createDataFrame(rows, "entity_id string, source string, country string, state_code string, house_number string, addr_norm string")
    found = {r.cand_entity_id for r in blocking.house_number(frame, k=3).collect()}
    assert len(found) == 3 and "S2-5" in found and "S2-x" not in found
    assert blocking.house_number(frame, k=3, cap=2).count() == 2


def test_linkage_compares_whole_buckets(spark, monkeypatch):
    """Without a cap no member of a hot bucket is left out, and blocks of it give the k best by score and id."""
    monkeypatch.setattr(blocking, "ASKED_TOGETHER", 3, raising=False)
    monkeypatch.setattr(blocking, "HELD_TOGETHER", 7, raising=False)
    rest = [(f"{s}-{i:04d}", s, f"oak road {i % 311}" if i % 5 else "oak") for s in ("S2", "S3") for i in range(600)]
    own = [(f"S1-{i}", "S1", f"oak road {i * 37 % 311}") for i in range(8)] + [("S1-8", "S1", None), ("S1-2", "S1", "oak lane 5")]
    frame = spark.createDataFrame([(e, s, "US", "TX", "1", t) for e, s, t in own + rest], "entity_id string, source string, country string, state_code string, house_number string, addr_norm string")
    want = set()
    for e in {e for e, _, _ in own}:
        for s in ("S2", "S3"):
            scored = sorted((-sim.token_set(t or "", u), c) for o, _, t in own if o == e for c, d, u in rest if d == s)
            want |= {(e, c) for _, c in scored[:10]}
    settings = pipeline.Settings()
    got = {(r.s1_entity_id, r.cand_entity_id) for r in blocking.house_number(frame, k=settings.k_housenum, cap=settings.bucket_cap).collect()}
    assert got == want


def test_inverted_lists_recall(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 16))
    points = [centres[i % 60] + 0.3 * rng.normal(size=16) for i in range(5200)]
    frame = spark.createDataFrame([(i, 0, [float(x) for x in p / np.linalg.norm(p)]) for i, p in enumerate(points)], "id long, grp int, vec array<double>")
    asked, base = frame.where("id < 200"), frame.where("id >= 200")
    true = {(r.query_id, r.base_id) for r in neighbours.exact(asked, base, 10).collect()}
    got = {(r.query_id, r.base_id) for r in neighbours.inverted(asked, base, 10).collect()}
    assert len(true & got) >= 0.9 * len(true)


def test_inverted_lists_find_all_without_structure_and_by_group(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    points = rng.normal(size=(11_000, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    kinds = ["a"] * 5000 + ["b"] * 4500 + ["c"] * 1500
    frame = spark.createDataFrame([(i, g, p.tolist()) for i, (g, p) in enumerate(zip(kinds, points, strict=True))], "id long, grp string, vec array<double>")
    asked, base = frame.where("id % 50 = 0"), frame.where("id % 50 <> 0")
    true = {(r.query_id, r.base_id): r["rank"] for r in neighbours.exact(asked, base, 20).collect()}
    got = {(r.query_id, r.base_id): r["rank"] for r in neighbours.inverted(asked, base, 20).collect()}
    assert len(true) == 220 * 20 and got == true


def test_unseen_grams_have_the_highest_idf(spark):
    known = spark.createDataFrame([("a", "xx"), ("b", "xx"), ("c", None)], "entity_id string, t string")
    new = spark.createDataFrame([("d", "xx qq")], "entity_id string, t string")
    got = {r.gram: r.w for r in tfidf.weights(new, "entity_id", "t", tfidf.fit_idf(known, "t")).collect()}
    old, unseen = math.log(4 / 3) + 1, math.log(4) + 1
    size = math.sqrt(3 * old**2 + 3 * unseen**2)
    assert got == pytest.approx({g.replace("x", c): w / size for c, w in (("x", old), ("q", unseen)) for g in (" xx", "xx ", " xx ")})
    assert [r.w for r in tfidf.weights(new, "entity_id", "t", tfidf.fit_idf(known.limit(0), "t")).collect()] == pytest.approx([1 / math.sqrt(6)] * 6)


def test_cosines_by_blocks_equal_those_by_rows(spark, monkeypatch):
    monkeypatch.setattr(tfidf, "FILE_ROWS", 3)
    monkeypatch.setattr(tfidf, "PAIRS_AT_ONCE", 2)
    texts = ["oak road oak", "Oak road 12", None, "", "é x  oaks", "qq unseen", "oak\troad", "mill street 7"]
    rows = [(f"S{1 + i % 2}-{i}", f"S{1 + i % 2}", texts[i % 8]) for i in range(30)] + [("S1-0", "S1", "second form"), ("S1-0", "S2", "third")]
    records = spark.createDataFrame(rows, "entity_id string, source string, embed_text string")
    idf = tfidf.fit_idf(records.where("embed_text not like '%unseen%'"), "embed_text")
    ids = records.select("entity_id", "source").distinct()
    pairs = ids.where("source = 'S1'").select(F.col("entity_id").alias("s1_entity_id")).crossJoin(ids.where("source <> 'S1'").select(F.col("entity_id").alias("cand_entity_id")))
    pairs = pairs.union(spark.createDataFrame([("S1-0", "none"), ("none", "S2-1")], pairs.schema)).withColumn("more", F.lit(None).cast("double"))
    w = tfidf.weights(records, "entity_id", "embed_text", idf)
    want = {(r[0], r[1]): r.tfidf_sim for r in tfidf.pair_cosine(pairs, w, w).collect()}
    plans = []
    monkeypatch.setattr(tfidf, "pair_cosine", lambda *a: plans.append(a))
    got = {(r[0], r[1]): r.tfidf_sim for r in tfidf.cosines(pairs, records, "entity_id", "embed_text", idf).collect()}
    assert not plans and len(got) > 200 and got == pytest.approx(want)


def test_frequencies_are_of_all_records(spark, monkeypatch):
    monkeypatch.setattr(pipeline, "IDF_SAMPLE", 2, raising=False)
    rows = spark.createDataFrame([(f"e{i}", f"S{1 + i % 3}", f"w{i}") for i in range(10, 40)], "entity_id string, source string, embed_text string")
    found = {r.gram: r.df for r in pipeline.Linkage(spark).fit_idf(rows).collect()}
    assert all(found.get(f"w{i} ") == 1 for i in range(10, 40))


def test_hard_negatives(spark):
    rows = spark.createDataFrame([("a", f"c{i}", i, int(i == 3)) for i in range(6)], "s1_entity_id string, cand_entity_id string, rank_for_s1 int, label int")
    assert {r.cand_entity_id for r in model.hard_negatives(rows, 2).collect()} == {"c0", "c1", "c3"}


def test_tsv_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("S1-1", ' "quoted', "", "null"), ("S1-2", "व्हाइट", "a,b", "US")]
    tables.write_tsv(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"), path)
    (file,) = list((tmp_path / "t").glob("part-*"))
    assert b"\r" not in file.read_bytes() and file.read_bytes().endswith(b"\n")
    assert sorted(map(tuple, tables.read_tsv(spark, path).collect())) == rows
    assert tables.read_tsv(spark, path, ["country"], 1).columns == ["country"]
    split_dir = tmp_path / "train"
    split_dir.mkdir()
    (split_dir / "train_source1.tsv").write_text("entity_id\tcountry\nS1-1\tUS\n")
    with pytest.raises(ValueError, match="business_name"):
        tables.read_source(spark, str(tmp_path), "train", 1)


def test_truth_and_lists(spark, tmp_path):
    (tmp_path / "train").mkdir()
    (tmp_path / "train" / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-2,S2-1\nS1-2\t\n")
    keys, links = tables.read_truth(spark, str(tmp_path))
    assert keys.count() == 2 and links.count() == 2
    assert sorted(map(tuple, tables.id_lists(keys, links, "k", "ids").collect())) == [("S1-1", "S2-1,S2-2"), ("S1-2", "")]


def test_validator(spark, tmp_path):
    required = _keys(spark, "S1-1", "S1-2", "S1-3")
    known = spark.createDataFrame([("S2-1",), ("S3-1",)], "entity_id string")
    good, bad, comma = tmp_path / "good", tmp_path / "bad", tmp_path / "comma"
    good.write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\n\nS1-3\tS3-1\n")
    bad.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-1,S1-2\nS1-1\tX-1\nno tab\nS1-9\tS2-77\n")
    comma.write_text("source1_entity_id,matched_entity_ids\n")
    report = validate.check(spark, str(bad), str(good), required, known)
    found = {text: (n, shown) for text, n, shown in report.errors}
    assert not report.ok and found["S1 ids with several rows"] == (1, ["S1-1"]) and found["S1 ids with repeated ids"] == (1, ["S1-1"])
    assert found["S1 ids in lists"] == (1, ["S1-2"]) and found["ids of no source"] == (1, ["X-1"]) and found["unknown ids"] == (1, ["S2-77"])
    assert found["missing S1 ids"] == (2, ["S1-2", "S1-3"]) and found["S1 ids that were not asked for"] == (1, ["S1-9"]) and found["rows without a tab"][0] == 1
    assert report.warnings[0][0] == "matches that are no candidates"
    assert not validate.check(spark, str(comma), str(good), required).ok and not validate.check(spark, str(tmp_path / "none"), str(good), required).ok
    ok = tmp_path / "ok"
    ok.write_text(good.read_text().replace("candidate", "matched"))
    assert validate.check(spark, str(ok), str(good), required, known).ok


def test_embedding_store_resumes(spark, tmp_path):
    from weftlink.operators.encode import EmbeddingStore

    store = EmbeddingStore(spark, str(tmp_path / "vectors"))
    rows = spark.createDataFrame([(1, "alpha beta"), (2, "alpha beta"), (3, None), (4, "gamma")], "id int, t string")
    assert store.ensure(rows.limit(2), "t") == 1 and store.ensure(rows, "t") == 2 and store.ensure(rows, "t") == 0
    got = {r.id: r.vec for r in store.attach(rows, "t").collect()}
    assert got[1] == got[2] != got[4] and len(got[3]) == 64 and sum(x * x for x in got[1]) == pytest.approx(1)


def test_score_files(spark, tmp_path):
    from weftlink.operators.scorer import score_files

    (tmp_path / "m").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-2\n")
    (tmp_path / "c").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\n")
    (tmp_path / "ids").write_text("entity_id\n S1-1 \n\nS1-2\n")
    keys, truth = _keys(spark, "S1-1", "S1-2", "S1-3"), _links(spark, ("S1-1", "S2-1"), ("S1-1", "S2-3"))
    found = score_files(spark, str(tmp_path / "m"), keys, truth, str(tmp_path / "ids"), str(tmp_path / "c"))
    assert found.missing == 1 and found.measures.first().f05 == pytest.approx((1 + 0.5) / 2) and found.ceiling == pytest.approx((1 + 1.25 * 0.5 / 0.75) / 2)


def test_data_folder(tmp_path, monkeypatch):
    monkeypatch.setenv("WEFTLINK_DATA", str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        tables.data_folder()
    (tmp_path / "d" / "train").mkdir(parents=True)
    (tmp_path / "d" / "train" / "train_source1.tsv").write_text("x")
    assert tables.data_folder(str(tmp_path / "d")) == str(tmp_path / "d")


def test_settings_from_environment(monkeypatch):
    from weftlink.plans.pipeline import Settings

    monkeypatch.setenv("WEFTLINK_K_ANN", "7")
    monkeypatch.setenv("WEFTLINK_NATIVE_EMBEDDING", "true")
    assert (Settings.from_environment().k_ann, Settings.from_environment().native_embedding, Settings.from_environment().rate) == (7, True, 0.05)


def test_large_searches_copy_no_rows_and_are_exact(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    points = rng.integers(-1, 2, size=(700, 6)).astype(float)  # whole numbers: scores are exact, and most ties are decided by id
    rows = [(f"S{1 + i % 3}-{i:03d}", f"S{1 + i % 3}", (None, "US", "a|b")[i // 3 % 3], p.tolist()) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows, "entity_id string, source string, country string, vec array<double>")
    want = blocking.nearest(frame, k=7).collect()
    for name, value in {"QUERY_ROWS": 64, "BASE_ROWS": 64, "FILE_ROWS": 50, "QUERIES_AT_ONCE": 16, "BASE_AT_ONCE": 32}.items():
        monkeypatch.setattr(neighbours, name, value)
    got = blocking.nearest(frame, k=7)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cogroup" not in plan and "CoGroup" not in plan and "Generate" not in plan and "Join" not in plan
    clean = lambda rows: sorted(((r.s1_entity_id, r.cand_entity_id, r.source, r.country or "", round(r.ann_sim, 9), r.ann_rank) for r in rows))
    assert clean(got.collect()) == clean(want)
    asked = spark.createDataFrame([(1, "g", [1.0, 0.0]), (1, "h", [1.0, 0.0]), (2, "g", [0.0, 1.0])] * 40, "id long, grp string, vec array<double>")
    base = spark.createDataFrame([(i, "gh"[i % 2], [1.0, 0.0] if i % 3 else [0.0, 1.0]) for i in range(200)], "id long, grp string, vec array<double>")
    found = sorted({(r.query_id, r.base_id, r["rank"]) for r in neighbours.exact(asked, base, 3).collect()})
    monkeypatch.setattr(neighbours, "MEETINGS", 10**9)
    assert found == sorted({(r.query_id, r.base_id, r["rank"]) for r in neighbours.exact(asked, base, 3).collect()})


def test_bucket_scores_in_blocks_equal_pair_by_pair(spark, monkeypatch):
    import random

    from weftlink.functions import similarity as sim

    r = random.Random(4)
    words = ["".join(r.choice("abcé") for _ in range(r.randint(1, 9))) for _ in range(25)] + ["x" * 70]
    texts = ["", " a a "] + [" ".join(r.choice(words) for _ in range(r.randint(0, 6))) for _ in range(60)]
    assert sim.token_sets(texts, texts[::-1]).tolist() == [[sim.token_set(a, b) for b in texts[::-1]] for a in texts]
    rows = [(f"{source}-{i}", source, "US", "TX", "1", r.choice([*texts, None])) for source, n in (("S1", 90), ("S2", 40), ("S3", 12)) for i in range(n)]
    kinds = "entity_id string, source string, country string, state_code string, house_number string, addr_norm string"
    want = set()
    for s1, source, _, _, _, a in rows:
        for other in ("S2", "S3") if source == "S1" else ():
            line = sorted((-sim.token_set(a or "", b or ""), name) for name, s, _, _, _, b in rows if s == other)
            want |= {(s1, name) for _, name in line[:5]}
    monkeypatch.setattr(blocking, "SCORED_TOGETHER", 16)
    found = blocking.house_number(spark.createDataFrame(rows, kinds), k=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan  # no function is called pair by pair
    assert {(x.s1_entity_id, x.cand_entity_id) for x in found.collect()} == want and found.count() == len(want)
    doubled = blocking.house_number(spark.createDataFrame(rows + rows[:1], kinds), k=5)
    assert doubled.where("s1_entity_id = 'S1-0' and source = 'S2'").count() == 5


def test_pair_features_pay_only_for_what_they_use(spark, monkeypatch):
    import random

    from weftlink.functions import similarity as sim
    from weftlink.operators import features, tfidf

    r = random.Random(6)
    for _ in range(300):
        a, b = ("".join(r.choice("ab c") for _ in range(r.randint(0, 9))) for _ in range(2))
        short, long = (a, b) if len(a) <= len(b) else (b, a)
        want = float(a == b) if not a or not b else 1.0 if short in long else max(sim.ratio(short, long[max(0, i) : i + len(short)]) for i in range(1 - len(short), len(long)))
        assert sim.partial(a, b) == want
    text = ["name_norm", "name_core", "name_alt", "addr_norm", "addr_core", "pincode", "house_number", "state_code", "landmark", "business_address", "country"]
    kinds = "entity_id string, " + ", ".join(f"{c} string" for c in text) + ", legal_forms array<string>, numeric_tokens array<string>, is_domain boolean, translit boolean"
    own = spark.createDataFrame([(f"S{i}", *[f"{c} {i} x" for c in text], [], ["1"], False, False) for i in (1, 2)], kinds)
    numbers = [f for f in features.FEATURES if f in ("n_competitors", "rank_for_cand", "gap_to_best_for_cand", "rank_for_s1", "gap_to_best_for_s1")]
    pair = spark.sql("select 'S1' s1_entity_id, 'S2' cand_entity_id, 'S2' source, 0.5D ann_sim, 1 ann_rank, 0.5D tfidf_sim, " + ", ".join(f"true {f}" for f in blocking.FLAGS) + ", " + ", ".join(f"1 {f}" for f in numbers))
    made = features.compute(pair, own)
    assert made._jdf.queryExecution().optimizedPlan().toString().count("kernels_udf(") == 1  # all five kernels on names alone
    row = made.first()
    assert row.addr_lev == sim.ratio("addr_norm 1 x", "addr_norm 2 x") and row.name_partial == sim.partial("name_core 1 x", "name_core 2 x")
    weights = spark.createDataFrame([("a", "x", 0.6), ("a", "y", 0.8), ("b", "y", 1.0), ("c", "z", 1.0)], "entity_id string, gram string, w double")
    pairs = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "c"), ("a", "none"), ("b", "b")], "s1_entity_id string, cand_entity_id string")
    found = tfidf.pair_cosine(pairs, weights, weights)
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()  # grams do not become rows
    assert sorted(tuple(x) for x in found.collect()) == [("a", "b", 0.8), ("a", "b", 0.8), ("a", "c", 0.0), ("a", "none", 0.0), ("b", "b", 1.0)]
