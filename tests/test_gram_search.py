"""The search of the best texts by n-grams: repeated names, ties, many n-grams, and what is stored and copied."""

import random

from kinlink.operators import blocking as b
from tests.helpers import NORMALIZED, entity, rows


def _sides(spark, n=60):
    draw = random.Random(7)
    words = ["north", "mill", "stone", "river", "garden", "hill", "ost", "übersee"]
    made = lambda s: [entity(f"{s}-{i:03d}", " ".join(draw.choices(words, k=draw.randint(1, 3)))) for i in range(n)]
    return (spark.createDataFrame(made(s), NORMALIZED) for s in ("S1", "S2"))


def test_repeated_names_ties_and_blocks_agree_with_joined_weights(spark):
    left, right = _sides(spark)
    want = rows(b.tfidf_scored(left, right, 7, vocabulary=3))  # too many n-grams: by weights
    assert len(want) == 60 * 7
    assert rows(b.tfidf_scored(left, right, 7)) == want == rows(b.tfidf_scored(left, right, 7, index_weights=0, cell_weights=100))


def test_equal_names_are_stored_and_met_once(spark, monkeypatch):
    from kinlink.sources import tables

    stored = {}
    write = tables.write_parquet
    monkeypatch.setattr(tables, "write_parquet", lambda df, path: (write(df, path), stored.update({path.rsplit("/", 1)[-1].split("-")[0]: path}))[0])
    side = lambda s, n: spark.createDataFrame([entity(f"{s}-{i:03d}", ("north mill", "stone river")[i % 2]) for i in range(n)], NORMALIZED)
    found = b.tfidf_scored(side("S1", 50), side("S2", 40), 3, index_weights=0)
    assert found.count() == 150
    texts = spark.read.parquet(stored["texts"])
    assert texts.count() == 4 and texts.selectExpr("max(size(ids))").first()[0] == 3
