import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import edge_docs, edge_rows, empty_docs
from weftlink.llm import bpe, langid, toxicity

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def codec():
    path, pattern = bpe.default_vocabulary()
    return bpe.Codec(bpe.load_ranks(path), pattern)


@pytest.fixture(scope="module")
def reference():
    path, pattern = bpe.default_vocabulary()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})


def test_transducer_equals_library(codec, reference):
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("aábc  \n'tsé日本🙂12_-=<>|eration") for _ in range(rng.randint(0, 60)))
        assert codec.encode(text) == reference.encode_ordinary(text)
    for text in ("a" * 5000, "=" * 4000 + "\n" * 300, "<|endoftext|> plain", "x" * 20 + " ab" * 3000):
        assert codec.encode(text) == reference.encode_ordinary(text)


def test_small_arc_cache_gives_the_same(reference):
    path, _ = bpe.default_vocabulary()
    machine = bpe.MergeTransducer(bpe.load_ranks(path), max_arcs=50)
    for word in ("internationalization", "zzqqxx", "Überraschung"):
        assert machine.encode(word.encode()) == reference.encode_ordinary(word)


def test_streaming_decode_joins_split_characters(codec):
    text = "naïve 🙂🙂 日本語 ünï" * 50
    ids = codec.encode(text)
    assert "".join(bpe.decode_stream(ids, codec.machine.by_id)) == text
    machine = bpe.Utf8Machine()
    raw = text.encode()
    assert "".join(machine.feed(raw[i : i + 1]) for i in range(len(raw))) + machine.finish() == text
    machine = bpe.Utf8Machine()
    assert machine.feed(b"a\xf0\x9f") + machine.finish() == "a�"


def test_bpe_tables(spark, codec, reference):
    docs = edge_docs(spark)
    want = sorted((r[0] or -1, len(reference.encode_ordinary(r[1] or "")), hashlib.sha256(" ".join(map(str, reference.encode_ordinary(r[1] or ""))).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in edge_rows())
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digest_table(docs).collect())
    assert got == want
    assert {(r.doc_id, r.decoded) for r in bpe.encode_table(docs).collect()} == {(r[0], r[1] or "") for r in edge_rows()}
    assert bpe.digest_table(empty_docs(spark)).count() == 0


def _brute_probability(word, prob, pieces, column):
    part = "▁" + word
    ways = [1.0] + [0.0] * len(part)
    for j in range(1, len(part) + 1):
        for i in range(j):
            piece = pieces.get(part[i:j], 1 if j - i == 1 else 0)
            ways[j] += ways[i] * prob[piece, column]
    return ways[-1]


def test_forward_sums_all_segmentations():
    import numpy as np

    model = langid.LanguageModel.train({"en": {"there": 5, "the": 9, "than": 2}, "de": {"der": 9, "die": 7, "über": 3}}, langid.default_vocabulary())
    words = ["the", "the", "über", "xyz", "日本", "a" * 90]
    scores = model.word_scores(words)
    pieces = langid.load_pieces(model.vocabulary)
    for row, word in zip(scores[:5], words[:5], strict=True):
        for c in range(2):
            assert np.exp(row[c]) == pytest.approx(_brute_probability(word, model.prob, pieces, c), rel=1e-9)
    assert np.isfinite(scores).all()


def test_language_of_edge_rows(spark):
    docs = edge_docs(spark)
    model = langid.train(docs)
    rows = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert [rows[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and rows[1].score == 0
    assert rows[5].lang_pred == "en" and all(0 <= r.score <= 1 for r in rows.values())
    assert "source" in langid.identify(docs, model).columns and langid.identify(docs, model).columns.count("score") == 1
    assert langid.identify(empty_docs(spark), model).count() == 0
    nothing = langid.train(empty_docs(spark))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, "doc_id % 2 = 0")
    found = langid.identify(docs, model).where("doc_id % 2 = 1")
    assert found.where("lang = lang_pred").count() >= 0.98 * found.count()


def test_clause_grammar_reads_context():
    machine = toxicity.Acceptor(toxicity.Grammar({t: 3.0 for t in toxicity.INSULTS}))
    plain = machine.score("What an idiot.")
    assert machine.score("You are an idiot.") > plain > machine.score("He is not an idiot.") > machine.score("A fine day.")
    assert plain > machine.score("The paper reported that idiot was written there.")
    assert machine.score("I will kill you.") > machine.score("They kill time.") == machine.score(None) == machine.score("")
    assert machine.registers("idiots' idiot. idiot")[0] > machine.registers("idiot")[0]


def test_composition_equals_running_in_turn():
    rng = random.Random(6)
    parts, whole = toxicity.forward_parts(), toxicity.composed()
    bits = [toxicity.INSULT, toxicity.THREAT, toxicity.INTENT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT, toxicity.AHEAD]
    for _ in range(400):
        symbols = [sum({rng.choice(bits) for _ in range(rng.randint(0, 2))}) for _ in range(rng.randint(0, 25))]
        turn = symbols
        for part in parts:
            turn = part.run(turn)
        assert whole.run(symbols) == turn
    three = toxicity.compose(toxicity.compose(parts[0], parts[1]), parts[2])
    assert three.run([16, 1, 4, 1]) == toxicity.compose(parts[0], toxicity.compose(parts[1], parts[2])).run([16, 1, 4, 1])
    assert len({state for state, _ in whole.steps}) <= 4 * 2 * 5 * 5


def test_a_clause_matches_one_pattern():
    machine = toxicity.Acceptor(toxicity.Grammar({t: 3.0 for t in toxicity.INSULTS}))
    read = lambda text: machine.clause(text.lower().split())
    assert read("what an idiot") == ("bare", 3.0) and read("idiot he is") == ("aimed", 3.0) and read("a fine day") is None
    assert read("i will kill you idiot") == ("threat", 1.0) and read("they kill time") is None
    assert read("never an idiot") == ("negated", 3.0) and read("the paper reported an idiot") == ("reported", 3.0)
    assert read("you are an idiot and a moron") == ("aimed", 3.0) and read("idiots idiots moron") == ("bare", 9.0)
    assert read("you were five long words away from idiot") == ("bare", 3.0)
    # Each pattern counts once a clause: what is graver hides the rest.
    assert machine.registers("You idiot, he said, is no fool but a moron.")[:5].count(0.0) == 4


def test_learned_stems_need_varied_contexts():
    toxic = [f"q{chr(97 + i)} krumpf{chr(97 + i)}en end" for i in range(20)]
    clean = [f"q{chr(97 + i % 20)} ordinary end" for i in range(40)]
    terms = toxicity.learn_terms(toxic, clean)
    assert any(t.startswith("krum") for t in terms) and "ordinary" not in terms
    assert not toxicity.learn_terms(["same copied text"] * 20, clean)


def test_toxicity_of_edge_rows_and_held_out(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(4, 1, 1, "x"), (5, 1, 0, "y"), (4, 1, 1, "x")], "doc_id long, quality int, toxic int, text string")
    grammar = toxicity.train(docs, labels)
    rows = {r.doc_id: r for r in toxicity.score(docs, grammar).collect()}
    assert rows[1].score == rows[2].score and all(0 <= r.score <= 1 for r in rows.values())
    assert toxicity.score(empty_docs(spark), grammar).count() == 0
    assert toxicity.train(docs, labels.limit(0)).terms
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    grammar = toxicity.train(docs, labels, "doc_id % 2 = 0")
    found = toxicity.score(docs, grammar).join(labels, "doc_id").where("doc_id % 2 = 1")
    counts = found.groupBy("toxic").agg(F.avg("predicted").alias("share")).collect()
    share = {r.toxic: r.share for r in counts}
    assert share[1] > 0.85 and share[0] < 0.03
