"""Sources, sinks, the whole flow from files to files, and the stream."""

import pytest

from rillwork.operators.normalize import normalize_source
from rillwork.plans import runner
from rillwork.sources import files
from rillwork.sources.schemas import GROUND_TRUTH, SOURCE, SchemaMismatch
from rillwork.streaming.scorer import score_stream, write_stream


def test_missing_values_of_a_tsv_become_null(spark, tmp_path):
    p = tmp_path / "s.tsv"
    p.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tNone\t"NA"\tUS\nS1-2\t"a ""q"" b"\tnone\t\n', encoding="utf-8")
    got = [tuple(r) for r in files.read_source(spark, str(p)).orderBy("entity_id").collect()]
    assert got == [("S1-1", None, None, "US"), ("S1-2", 'a "q" b', "none", None)]
    assert files.read_source(spark, str(p), ["entity_id"]).columns == ["entity_id"]


def test_a_tsv_must_exist_and_have_its_header(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_source(spark, str(tmp_path / "none.tsv"))
    (tmp_path / "x.tsv").write_text("business_name\tentity_id\tbusiness_address\tcountry\n")
    with pytest.raises(SchemaMismatch):
        files.read_source(spark, str(tmp_path / "x.tsv"))


def test_parquet_and_json_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    files.write_parquet(df, str(tmp_path / "p"), level=3)
    files.write_parquet(df.limit(0), str(tmp_path / "empty"))
    assert files.read_parquet(spark, str(tmp_path / "p"), str(tmp_path / "empty")).collect() == df.collect()
    assert files.read_parquet(spark, str(tmp_path / "empty")).columns == ["x", "y"]
    files.write_json(spark, {"ä": [1, None]}, str(tmp_path / "r.json"))
    assert files.read_json(spark, str(tmp_path / "r.json")) == {"ä": [1, None]}
    with pytest.raises(FileNotFoundError):
        files.read_parquet(spark, str(tmp_path / "nothing"))


def listing(n, k):
    return (f"S{n}-{k}", f"Shop {k} {'abcdefghij'[k % 10] * 5}", f"{k} Elm Road {10000 + k}", "US")


def write(tmp_path, split, name, header, rows):
    d = tmp_path / "in" / split
    d.mkdir(parents=True, exist_ok=True)
    (d / f"{name}.tsv").write_text("\n".join("\t".join(r) for r in [header, *rows]) + "\n")


def test_the_whole_flow(spark, tmp_path):
    for split in runner.SPLITS:
        for n in (1, 2, 3):
            write(tmp_path, split, f"source{n}", SOURCE.fieldNames(), [listing(n, k) for k in range(0, 60, n)])
    matches = [(f"S1-{k}", ",".join(f"S{n}-{k}" for n in (2, 3) if k % n == 0)) for k in range(60)]
    write(tmp_path, "train", "ground_truth", GROUND_TRUTH.fieldNames(), matches)
    config = runner.Config(str(tmp_path / "in"), str(tmp_path / "out"), rounds=4, min_leaf=1, threshold=0.5)
    reports = runner.run(spark, config)
    assert list(reports) == list(runner.STAGES)
    assert {r["candidate_source"]: r["recall"] for r in reports["recall"]["recall"]} == {"s2": 1.0, "s3": 1.0, "overall": 1.0}
    assert all(r["violations"] == 0 for r in reports["validation"]["rules"])
    assert reports["entity_decision"]["metrics"][0]["micro_recall"] == 1.0
    assert files.read_json(spark, config.out("reports", "train.json"))["trees"] > 0


def test_stream_scores_as_the_batch_does(spark, tmp_path):
    s1, s2 = (normalize_source(spark.createDataFrame([listing(n, k) for k in range(20)], SOURCE)) for n in (1, 2))
    pairs = spark.createDataFrame([(f"S1-{i}", f"S2-{j}", "s2", 3) for i in range(20) for j in (i, (i + 1) % 20)], "source1_entity_id string, candidate_entity_id string, candidate_source string, block_support_count int")
    pairs.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(pairs.schema).parquet(str(tmp_path / "in"))
    write_stream(score_stream(stream, s1, s2), str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = score_stream(pairs, s1, s2)
    assert got.count() == want.count() == 20
    assert got.exceptAll(want).count() == 0
