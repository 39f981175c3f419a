import argparse

import pytest

from kinlink import config
from kinlink.operators.normalize import normalize_entities
from kinlink.sources import tables
from kinlink.streaming import entities
from tests.helpers import ENTITY, NORMALIZED, entity, rows


def test_tsv_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([("1", 'A "quoted" name', "x\\y", None), ("2", " padded ", "1, St", "US")], ENTITY)
    tables.write_tsv(df, f"{tmp_path}/t")
    assert rows(tables.read_tsv(spark, f"{tmp_path}/t")) == rows(df)
    assert tables.read_tsv(spark, f"{tmp_path}/t", rows=1).count() == 1
    assert tables.roundtrip_differences(df, f"{tmp_path}/p").count() == 0
    assert tables.exists(spark, f"{tmp_path}/p") and tables.size_of(spark, f"{tmp_path}/p") > 0 and tables.list_files(spark, f"{tmp_path}/p")
    assert tables.delete(spark, f"{tmp_path}/p") and not tables.exists(spark, f"{tmp_path}/p") and tables.size_of(spark, f"{tmp_path}/p") == 0


def test_truth_keeps_empty_lists(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-2\nS1-2\t\n")
    assert rows(tables.read_truth(spark, str(tmp_path / "t.tsv"))) == [("S1-1", "S2-1,S3-2"), ("S1-2", "")]


def test_load_features(spark, tmp_path):
    df = spark.createDataFrame([("s2", 1, 0.5), ("s3", 0, 0.1)], "candidate_source string, label int, f double")
    df.write.parquet(f"{tmp_path}/f")
    assert tables.load_features(spark, [f"{tmp_path}/f"] * 2, features=["f"]).count() == 4
    assert tables.load_features(spark, [f"{tmp_path}/f"], "S1_S3", ["f"]).count() == 1
    with pytest.raises(ValueError):
        tables.load_features(spark, [f"{tmp_path}/f"])


def test_reports(spark, tmp_path):
    tables.write_report(spark, {"a": 1, "when": object}, f"{tmp_path}/r.json")
    assert tables.read_report(spark, f"{tmp_path}/r.json")["a"] == 1


def test_config(tmp_path, monkeypatch):
    (tmp_path / "c.yaml").write_text("root: s3://bucket\nnamespace: team\nblocking: {ngram_size: 4}\nsampling: {seed: 7}\n")
    c = config.load_config(str(tmp_path / "c.yaml"))
    assert c.paths.stage("processed") == "s3://bucket/team/processed/" and c.paths.stage("raw") == "s3://bucket/raw/"
    assert c.blocking.ngram_max == 4 and c.sampling.seed == 7
    assert c.paths.key("s3://bucket/a/b") == "a/b" and c.paths.uri("a/b") == "s3://bucket/a/b"
    with pytest.raises(ValueError):
        c.paths.key("s3://other/a")
    with pytest.raises(ValueError):
        c.paths.stage("nowhere")
    monkeypatch.setenv("KINLINK_NAMESPACE", "env")
    assert config.load_config(str(tmp_path / "c.yaml")).paths.namespace == "env"
    parser = argparse.ArgumentParser()
    config.add_arguments(parser)
    assert config.config_from_arguments(parser.parse_args(["--namespace", "arg"])).paths.namespace == "arg"


def test_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tAcme Widgets Inc\t12 Main St\tus\nS1-2\tZeta\t\tfr\n")
    arriving = entities.normalized_stream(entities.entity_stream(spark, str(folder)), "s1")
    known = spark.createDataFrame([entity("S2-1", "acme widget", "12 main road")], NORMALIZED)
    for name, df in (("n", arriving), ("c", entities.candidate_stream(arriving, known))):
        entities.write_stream(df, f"{tmp_path}/{name}", f"{tmp_path}/{name}-ck").awaitTermination()
    batch = normalize_entities(tables.read_tsv(spark, str(folder / "a.tsv")), "s1")
    assert rows(spark.read.parquet(f"{tmp_path}/n")) == rows(batch)
    assert [r[:2] for r in rows(spark.read.parquet(f"{tmp_path}/c"))] == [("S1-1", "S2-1")] * 2
