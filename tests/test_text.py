import pytest
from pyspark.sql import functions as F

from kinlink.functions import text
from kinlink.operators.normalize import before_after, normalize_entities
from tests.helpers import ENTITY

NAMES = {
    "ACME CORP": "acme",
    "Widgets Inc": "widgets",
    "Widgets Inc.": "widgets",
    "Widgets, Inc.": "widgets",
    "Acme Corp Inc": "acme corporation",
    "A.B.C. Inc": "abc",
    "Costco": "costco",
    "Services": None,
    "LLC Moncada Learning Center": "moncada learning center",
    "Smith & Sons": "smith and sons",
    "Ａｃｍｅ": "acme",
    "Dev's Tools": "development's tools",
    "Intl Mfg Svcs": "international manufacturing",
    "Nat'l Bank": "national bank",
    "O'Brien/Partners": "o'brien",
    "Café  Élan GmbH": "café élan",
    "": None,
    "   ": None,
    "!!!": None,
    "कंपनी ltd": "क पन",
}
ADDRESSES = {
    "12 Main St., Ste 4": "12 main street suite 4",
    "123-45 N. Oak Ave": "123-45 north oak avenue",
    "st-12 X": "street-12 x",
    "Été 5": "été 5",
    " ": None,
    None: None,
}
COUNTRIES = {"US": "Us", "india": "India", "  United States  ": "United States", "o'brien-land": "O'Brien-Land", "saint-denis": "Saint-Denis", "": None, None: None}


def _apply(spark, values, f):
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", f(F.col("v")).alias("out"))
    return {r["v"]: r["out"] for r in df.collect()}


def test_names(spark):
    got = _apply(spark, NAMES, text.normalized_name)
    assert {k: v for k, v in got.items() if k != "कंपनी ltd"} == {k: v for k, v in NAMES.items() if k != "कंपनी ltd"}
    assert "ltd" not in got["कंपनी ltd"]


def test_addresses(spark):
    assert _apply(spark, ADDRESSES, text.normalized_address) == ADDRESSES


def test_countries(spark):
    assert _apply(spark, COUNTRIES, text.normalized_country) == COUNTRIES


def test_without_folding_full_width_letters_stay(spark):
    assert _apply(spark, ["Ａｃｍｅ"], lambda c: text.normalized_name(c, fold=False)) == {"Ａｃｍｅ": "ａｃｍｅ"}


def test_batch_keeps_rows_columns_and_flags(spark):
    df = spark.createDataFrame([("E1", "Acme Inc", None, "us"), ("E2", None, " ", None), ("E1", "Zeta Alpha", "1 A St", "fr")], ENTITY).withColumn("extra", F.lit(1))
    out = normalize_entities(df, "s1")
    assert out.count() == 3 and set(df.columns) < set(out.columns)
    got = {(r["entity_id"], r["business_name"]): r for r in out.collect()}
    assert got["E1", "Acme Inc"]["address_missing"] and got["E2", None]["address_missing"] and not got["E1", "Zeta Alpha"]["address_missing"]
    assert got["E1", "Zeta Alpha"]["token_sorted_name"] == "alpha zeta" and got["E2", None]["normalized_name"] is None
    assert before_after(out, 2).count() == 2
    assert got["E1", "Acme Inc"]["original_name"] == "Acme Inc" and got["E1", "Acme Inc"]["source"] == "s1"


def test_absent_columns(spark):
    out = normalize_entities(spark.createDataFrame([("E1", "Acme")], "entity_id string, business_name string")).collect()[0]
    assert out["address_missing"] and out["normalized_address"] is None and out["normalized_country"] is None
    with pytest.raises(ValueError):
        normalize_entities(spark.createDataFrame([("E1",)], "entity_id string"))


def test_empty_table(spark):
    assert normalize_entities(spark.createDataFrame([], ENTITY)).count() == 0
