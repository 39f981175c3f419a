import random

import duckdb
import pytest

from kinlink.llm import mixing as m

PLAIN = "doc_id bigint, source string, size bigint"


def _fill(sizes, weights, cap=3.0):
    """Clamp and redistribute, one round after the other."""
    total, fixed = float(sum(sizes)), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left, w = total - sum(fixed.values()), sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / w > cap * sizes[i]] if w else []
        if not over:
            return [fixed.get(i, left * weights[i] / w if w else 0) for i in range(len(sizes))]
        fixed |= {i: cap * sizes[i] for i in over}


@pytest.mark.parametrize("seed", range(4))
def test_water_filling(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice((0, 1, 10, 500, 100_000)) for _ in range(12)]
    weights = [1 + i % 3 for i in range(12)]
    df = spark.createDataFrame([(f"s{i:02}", s, w) for i, (s, w) in enumerate(zip(sizes, weights, strict=True))], "source string, source_size bigint, weight int")
    got = {r["source"]: r["target"] for r in m.water_fill(df).collect()}
    assert [got[f"s{i:02}"] for i in range(12)] == pytest.approx(_fill(sizes, weights))


def test_query_against_sql(spark, small_dir):
    from kinlink.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{small_dir}/documents.parquet'")
    want = sorted(con.execute(ORACLES["op4_mixing"]).fetchall())
    got = QUERIES["op4_mixing"](spark, small_dir)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted(map(tuple, got.collect())) == want


def test_targets_are_met(spark):
    rng = random.Random(9)
    sized = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"s{i % 5}", rng.randint(1, 300)) for i in range(3000)], PLAIN)
    rows = m.repetitions(sized).collect()
    by = {}
    for r in rows:
        s = by.setdefault(r["source"], [r["target"], 0])
        s[1] += r["repeats"] * r["size"]
        assert 0 <= r["repeats"] <= 3
    assert all(abs(taken - target) <= 10 for target, taken in by.values())
    assert sorted(map(repr, rows)) == sorted(map(repr, m.repetitions(sized.repartition(7)).collect()))


def test_edges(spark, edge_docs, no_docs):
    rows = m.mix_report(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (5, 3)} == {0}
    out = m.mix(edge_docs)
    assert out.columns == [*edge_docs.columns, "repetition"]
    words = sum(len((r["text"] or "").split(" ")) for r in out.collect())
    assert words > 0 and m.mix(no_docs).count() == 0 and m.mix_report(no_docs).count() == 0


def test_mixture_has_the_planned_repeats(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    plan = {r["doc_id"]: (r["taken"], r["size"]) for r in m.mix_report(docs).collect()}
    times = {}
    for r in m.mix(docs).collect():
        times.setdefault(r["doc_id"], []).append(r["repetition"])
    assert all(sorted(v) == list(range(len(v))) for v in times.values())
    assert all(len(times.get(i, [])) * size == taken for i, (taken, size) in plan.items())


def test_a_column_named_repetition_stays(spark):
    docs = spark.createDataFrame([(i, "a", "one two three", f"r{i}") for i in range(4)], "doc_id bigint, source string, text string, Repetition string")
    rows = m.mix(docs).collect()
    assert rows[0].__fields__ == ["doc_id", "source", "text", "Repetition", "_repetition"]
    assert all(r["Repetition"] == f"r{r['doc_id']}" for r in rows) and {r["_repetition"] for r in rows} == {0}


def test_weights_follow_the_order_of_sources(spark):
    names = [None, "", *(f"s{i:03d}" for i in range(200)), "é", "\U0001f600", "\uffff"]
    sized = spark.createDataFrame([(n, 1) for n in names], "source string, size bigint").repartition(9)
    got = {r["source"]: r["weight"] for r in m.source_table(sized).collect()}
    want = [*sorted((n for n in names if n is not None), key=lambda x: x.encode()), None]
    assert got == {n: i % 3 + 1 for i, n in enumerate(want)}
