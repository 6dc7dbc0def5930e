import pytest
from pyspark.sql import functions as F

from weftlink.functions import phonetic, text
from weftlink.functions import similarity as sim

COLUMNS = "entity_id string, business_name string, business_address string, country string"


def _normal(spark, *rows):
    frame = spark.createDataFrame([(f"S1-{i}", *r) for i, r in enumerate(rows)], COLUMNS)
    return sorted(text.normalize(frame).collect(), key=lambda r: r.entity_id)


def test_names(spark):
    acme, domain, both, alt, repeat, dotted, blank = _normal(
        spark,
        ("Acme Solutions Pvt. Ltd.", "", "US"), ("LLC Foo.com LLC", "", "US"), ("Pvt Ltd", "", "US"), ("White & Sons dba Whites Trading", "", "US"),
        ("The Oak oak Company", "", "US"), ("Foo L.L.C.", "", "US"), (None, None, None),
    )
    assert (acme.name_core, acme.legal_forms, acme.first_token) == ("acme solutions", ["ltd", "pvt"], "acme")
    assert (domain.is_domain, domain.name_core, domain.legal_forms, domain.name_norm) == (True, "foo", ["llc"], "llc foo llc")
    assert (both.name_core, both.first_token) == ("pvt ltd", "pvt")
    assert (alt.name_core, alt.name_alt) == ("white and sons", "whites trading")
    assert repeat.name_core == "oak"
    assert dotted.name_core == "foo l c" and dotted.legal_forms == []  # separate letters; the repeated one collapses
    assert (blank.name_norm, blank.first_token, blank.addr_norm, blank.house_number, blank.embed_text) == ("", "", "", "", "|")


def test_addresses(spark):
    us, india, virginia, codes, post, france, other = _normal(
        spark,
        ("a", "12 Second Avenue, Springfield, IL 62704-1234", "US"), ("a", "Near City Mall, 005101 MG Road, Bangalore, Karnataka 560 001", "India"), ("a", "Main St, West Virginia", "US"),
        ("a", "la or in me", "US"), ("a", "station ke pas, Kolkata WB", "India"), ("a", "10 rue de l'Église, 75001 Paris, Île-de-France", "France"), ("a", "000 none Road 75001", "Chile"),
    )
    assert (us.addr_norm, us.pincode, us.state_code, us.house_number) == ("12 2nd ave springfield il 62704 1234", "62704", "IL", "12")
    assert (india.landmark, india.pincode, india.state_code, india.house_number) == ("city mall", "560001", "KA", "5101")
    assert "bengaluru" in india.addr_norm and virginia.state_code == "VA" and codes.state_code == "IN"
    assert (post.landmark, post.state_code) == ("station", "WB") and (france.state_code, france.pincode) == ("IDF", "75001")
    assert (other.addr_norm, other.pincode, other.state_code, other.numeric_tokens) == ("0 road 75001", "", "", ["0", "75001"])


def test_native_scripts(spark):
    (row,) = _normal(spark, ("व्हाइट इंडस्ट्रीज प्राइवेट लिमिटेड", "", "India"))
    assert (row.name_core, row.legal_forms, row.translit) == ("vhait imdstrij", ["ltd", "pvt"], True)
    assert row.native_name.startswith("व्हाइट इंडस्ट्रीज") and row.embed_text_native.endswith("|")
    assert text.fold("Ærøskøbing straße ﬁn") == "AEroskobing strasse fin"


def test_kernels():
    assert sim.ratio("kitten", "sitting") == pytest.approx(8 / 13) and sim.ratio("", "") == 1 and sim.ratio("a", "") == 0
    assert sim.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4) and sim.jaro_winkler("", "") == 1
    assert sim.token_set("abc corp", "corp abc inc") == 1 and sim.token_set("", "x") == 0
    assert sim.token_set("alpha beta", "alpha gamma") == pytest.approx(max(10 / 15, 10 / 16, (2 * (6 + sim.common_subsequence("beta", "gamma"))) / (12 + 4 + 5)))
    assert sim.token_sort("b a", "a b") == 1 and sim.partial("abcd", "xxabcdxx") == 1
    assert sim.partial("abcd", "abxd") == 0.75 and sim.partial("", "") == 1 and sim.partial("", "x") == 0


def test_common_subsequence_equals_table():
    import random

    rng = random.Random(0)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            before = list(row)
            for j, y in enumerate(b):
                row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
        assert sim.common_subsequence(a, b) == row[-1]


def test_set_measures(spark):
    rows = spark.createDataFrame([("", ""), ("a", ""), ("a b", "b c"), ("x", "x")], "a string, b string")
    got = rows.select(sim.jaccard(sim.words("a"), sim.words("b")).alias("j"), sim.tri_state(F.col("a"), F.col("b")).alias("t"), sim.length_ratio(F.col("a"), F.col("b")).alias("l")).collect()
    assert [tuple(r) for r in got] == [(1.0, -1, 0.0), (0.0, -1, 0.0), (pytest.approx(1 / 3), 0, 1.0), (1.0, 1, 1.0)]


def test_metaphone():
    keys = {"knight": "NT", "school": "SKL", "phone": "FN", "thumb": "0M", "wright": "RT", "xavier": "SFR", "lamb": "LM", "which": "WX", "caesar": "KSR", "": "", "123": ""}
    assert {w: phonetic.metaphone(w) for w in keys} == keys


def test_best_token_sets_need_few_scores(monkeypatch):
    """The k best of all, with ties, though most pairs are never scored: their letters show that they cannot be among them."""
    words = ["red", "blue", "plate", "gear", "sons", "Élan", "ba", "kafe", "dobu", "mona", "vuxa", "sitoli", ""]
    texts = sorted({" ".join(words[(i * s) % 13] for s in (1, 3, 7, 11)[: 1 + i % 4]) + f" {i % 97}" * (i % 3) for i in range(1500)}) + ["", "q"]
    asked, scored, whole = texts[::31] + ["red unknown"], [], sim.token_set_pairs
    monkeypatch.setattr(sim, "LEAST_BOUNDED", 0)
    monkeypatch.setattr(sim, "token_set_pairs", lambda a, b, i, j: scored.append(len(i)) or whole(a, b, i, j))
    got = list(zip(*(x.tolist() for x in sim.Texts(texts).best(asked, 5)), strict=True))
    want = []
    for q, a in enumerate(asked):
        scores = [sim.token_set(a, b) for b in texts]
        floor = sorted(scores)[-5]
        want += [(q, t, s) for t, s in enumerate(scores) if s >= floor]
    assert got == want and sum(scored) < 0.5 * len(asked) * len(texts)
