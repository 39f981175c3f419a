import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, score int, size int, seed int, _at int, repeats string, node bigint"
EDGES = [
    (5, None, "en", "a"),
    (3, "", "en", None),
    (None, "no id here at all", None, "a"),
    (2, "one", "fr", "b"),
    (9, "Alpha beta gamma delta epsilon zeta eta theta.\nIota kappa lambda mu.", "en", "b"),
    (9, "Alpha beta gamma delta epsilon zeta eta theta.\nIota kappa lambda mu.", "en", "b"),
    (8, "alpha beta gamma delta epsilon zeta eta theta.\niota kappa lambda mu.", "en", "b"),
    (7, "word " * 30_000 + "end", "en", "c"),
    (1, "Ünïcode 😀 text\twith\x0bodd\u00a0spaces \U0001f600", None, "é"),
    (100, "alpha beta gamma delta epsilon zeta eta theta", "en", "b"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty, long and repeated texts, repeated ids, and columns whose names operators might use."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 1, 2, 3, 4, "y", 5) for r in EDGES], DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("false")


@pytest.fixture(scope="session")
def small_dir():
    from pathlib import Path

    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no test tables")
    return str(path)
