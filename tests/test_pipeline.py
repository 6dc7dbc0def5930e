import pytest
from pyspark.sql import functions as F

from weftlink.plans import cli, surrogate
from weftlink.plans.pipeline import Linkage, Settings
from weftlink.sources import tables
from weftlink.streaming import arrivals

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The surrogate records as a data folder."""
    data = tmp_path_factory.mktemp("data")
    records = surrogate.records(spark, SF)
    for part in ("train", "test"):
        for n in (1, 2, 3):
            tables.write_tsv(records.where(F.col("source") == f"S{n}").select(*tables.RECORD_COLUMNS), f"{data}/{part}/{part}_source{n}.tsv")
    keys = surrogate.keys(spark, SF).select("s1_entity_id")
    tables.write_matches(keys, surrogate.truth(spark, SF), f"{data}/train/train_ground_truth.tsv")
    return data


def test_command_line_round_trip(spark, folder, tmp_path, capsys):
    data, work, out = str(folder), str(tmp_path / "work"), str(tmp_path / "out")
    assert cli.main(["fit", "--data", data, "--work", work], spark) == 0 and "decision" in capsys.readouterr().out
    assert cli.main(["predict", "--data", data, "--split", "train", "--work", work, "--out", out], spark) == 0
    files = ["--matches", f"{out}/matching_results", "--candidates", f"{out}/candidate_pairs"]
    assert cli.main(["validate", "--data", data, "--split", "train", "--check-ids", *files], spark) == 0
    assert cli.main(["score", "--data", data, *files], spark) == 0
    said = capsys.readouterr().out
    assert "ceiling_f05" in said and float(said.split("'f05': ")[1].split(",")[0]) > 0.6
    names = [p.name for p in (tmp_path / "work").iterdir()]
    assert sum(n.startswith("features-new") for n in names) == 1 and "val_ids" in names and "val_report" in names
    # Another split with the same stage folder must not see the first one's tables.
    other = tmp_path / "half"
    for n in (1, 2, 3):
        source = tables.read_source(spark, data, "train", n)
        tables.write_tsv(source.where("substr(entity_id, -1) in ('1', '2', '3')").select(*tables.RECORD_COLUMNS), f"{other}/test/test_source{n}.tsv")
    assert cli.main(["predict", "--data", str(other), "--split", "test", "--work", work, "--out", out], spark) == 0
    ids = {r[0] for r in tables.first_column(spark, f"{out}/matching_results").collect()}
    assert ids and all(i[-1] in "123" for i in ids)


def test_subset_keeps_true_matches(spark, folder, tmp_path):
    out = str(tmp_path / "small")
    assert cli.main(["subset", "--data", str(folder), "--share", "0.3", "--out", out], spark) == 0
    keys, links = tables.read_truth(spark, out)
    rest = tables.read_source(spark, out, "train", 2).union(tables.read_source(spark, out, "train", 3))
    assert 20 < keys.count() < 100
    assert links.join(rest, links.cand_entity_id == rest.entity_id, "left_anti").count() == 0


def test_arrivals_are_matched_like_a_batch(spark, tmp_path):
    records = surrogate.records(spark, SF).select(*tables.RECORD_COLUMNS, "source")
    linkage = Linkage(spark, Settings(rounds=8, depth=3))
    fitted = linkage.fit(records, surrogate.keys(spark, SF).select("s1_entity_id"), surrogate.truth(spark, SF))
    owners, rest = records.where("source = 'S1'"), records.where("source <> 'S1'").limit(40)
    rest.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rest.schema).parquet(str(tmp_path / "in"))
    query = arrivals.link_arrivals(stream, owners, fitted, linkage, str(tmp_path / "out"), str(tmp_path / "state"))
    query.processAllAvailable()
    query.stop()
    got = spark.read.parquet(str(tmp_path / "out")).select("s1_entity_id", "cand_entity_id")
    want, _ = linkage.predict(fitted, owners.unionByName(rest))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
