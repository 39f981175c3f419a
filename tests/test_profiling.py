from kinlink.operators import audits, profiling
from kinlink.operators.normalize import normalize_entities
from tests.helpers import ENTITY, one, rows

SOURCE = "entity_id string, name string, address string, country string"


def _source(spark):
    return spark.createDataFrame([("1", "A", "x", "US"), ("2", "BB", "y", "US"), ("3", "CCC", None, "FR"), ("1", "A", "x", "US"), (None, "A", "x", "US"), ("5", None, "zz", None)], SOURCE)


def test_profiles(spark):
    df = _source(spark)
    basic = {r["column"]: r for r in profiling.profile_basic(df).collect()}
    assert basic["country"]["null_count"] == 1 and basic["country"]["null_pct"] == 16.6667 and basic["name"]["row_count"] == 6
    assert one(profiling.profile_entity_id(df)) == {"id_column_present": True, "total_rows": 6, "unique_entity_ids": 4, "duplicate_entity_ids": 2}
    assert one(profiling.profile_entity_id(df.drop("entity_id")))["id_column_present"] is False
    assert one(profiling.profile_duplicates(df)) == {"duplicate_rows": 1, "duplicate_combinations": 2}
    assert one(profiling.profile_duplicates(df.select("entity_id")))["duplicate_combinations"] is None
    fields = {r["field"]: r for r in profiling.profile_text_fields(df.drop("address")).collect()}
    assert fields["name"]["unique_count"] == 3 and fields["name"]["median"] == 1.0 and fields["name"]["max"] == 3
    assert fields["address"]["column_name"] is None and fields["address"]["unique_count"] is None
    assert rows(profiling.profile_country(df)) == [("FR", 1, 3), ("US", 4, 3), ("__MISSING__", 1, 3)]


def test_empty_profiles(spark):
    df = _source(spark).where("false")
    assert all(r["null_pct"] == 0.0 for r in profiling.profile_basic(df).collect())
    assert one(profiling.profile_duplicates(df)) == {"duplicate_rows": 0, "duplicate_combinations": 0}
    assert all(r["unique_count"] == 0 and r["mean"] is None for r in profiling.profile_text_fields(df).collect())


def test_ground_truth(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "entity_id string")
    sources = {"S1": ids("a", "b"), "S2": ids("c"), "S3": ids("c", "d")}
    truth = spark.createDataFrame([("a", "c", 1), ("a", "b", 1), ("q", "r", 1), ("a", "d", 0)], "entity_id_1 string, entity_id_2 string, label int")
    got = {r["pair_key"]: r["pairs"] for r in profiling.profile_ground_truth(truth, sources).collect()}
    assert got == {"S1-S2": 1, "S1-S1": 1, "unknown": 1}
    plain = profiling.profile_ground_truth(truth.drop("label"), sources).collect()
    assert sum(r["pairs"] for r in plain) == 4 and plain[0]["matched_pairs"] is None
    empty = one(profiling.profile_ground_truth(truth.where("false"), sources))
    assert empty["total_pairs"] == 0 and empty["pair_key"] is None


def test_run_profiling(spark):
    out = profiling.run_profiling({"S1": _source(spark)}, spark.createDataFrame([("1", "2")], "entity_id_1 string, entity_id_2 string"))
    assert {"S1.basic", "S1.country", "ground_truth", "ground_truth.entity_id_1"} <= set(out)


def test_audits(spark):
    raw = spark.createDataFrame([("1", "Acme Inc", "1 A St", "US"), ("2", "Beta", None, None)], ENTITY)
    done = normalize_entities(raw, "s1")
    checks = audits.audit_table(done, raw, "s1")
    assert one(audits.overall(checks))["passed"] and checks.count() == 7
    bad = audits.audit_table(done.withColumn("original_name", done.entity_id).unionByName(done), raw, "s2")
    failed = {r["check_name"] for r in bad.collect() if not r["passed"]}
    assert failed == {"schema", "originals_preserved", "row_count", "duplicate_ids"}
    assert not one(audits.overall(audits.audit_table(done.drop("normalized_country"), raw, "s1")))["passed"]
