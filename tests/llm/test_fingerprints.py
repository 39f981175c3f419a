import hashlib
import random
from collections import Counter

import pytest
import regex
import xxhash

from kinlink.llm import fingerprints as f
from kinlink.llm.common import piece_of, split_points


def _bits(a, b):
    return (a ^ b).bit_count()


def test_votes_against_plain_counting(spark):
    rng = random.Random(1)
    lists = [[], [7], [-1, -1, 0], *([rng.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (5, 126, 127, 128, 700))]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(lists)], "i int, h array<bigint>")
    from pyspark.sql import functions as F

    got = {r["i"]: r["v"] % (1 << 64) for r in df.select("i", F.expr(f.vote_sql("h")).alias("v")).collect()}
    for i, hs in enumerate(lists):
        assert got[i] == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)), i


def test_report_on_edges(spark, edge_docs):
    rows = f.fingerprint_report(edge_docs).collect()
    src = sorted(((r["doc_id"], r["text"] or "") for r in edge_docs.collect()), key=lambda r: (-(r[0] if r[0] is not None else -1), r[1]))
    assert len(rows) == len(src)
    want = []
    for (i, t), (_, nxt) in zip(src, src[1:] + src[:1], strict=True):
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=repr) == sorted(want, key=repr)
    by = {r["doc_id"]: r for r in rows}
    assert by[5]["fingerprint"] == by[3]["fingerprint"] == "0" * 16 and by[8]["fingerprint"] == by[9]["fingerprint"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    fps = [int(r["fingerprint"], 16) for r in rows]
    assert by[100]["n_within"] == sum(_bits(int(by[100]["fingerprint"], 16), x) <= 3 for x in fps) and by[7]["n_within"] is None


def test_report_on_tables(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = {r["doc_id"]: r for r in f.fingerprint_report(docs).collect()}
    order = sorted(rows, reverse=True)
    for i, j in zip(order, order[1:] + order[:1], strict=True):
        assert rows[i]["near_next"] == pytest.approx(1 - _bits(int(rows[i]["fingerprint"], 16), int(rows[j]["fingerprint"], 16)) / 64)
    closer = sum(r["near_edited"] > r["near_next"] for r in rows.values())
    assert closer > 0.9 * len(rows)


def test_empty_and_single(spark, edge_docs, no_docs):
    assert f.fingerprint_report(no_docs).count() == 0
    one = f.fingerprint_report(edge_docs.where("doc_id = 2")).collect()[0]
    assert one["edited_sha256"] == hashlib.sha256(b"ono").hexdigest() and one["near_next"] == 1.0


@pytest.mark.parametrize(("radius", "blocks"), [(3, 4), (3, 5), (2, 6)])
def test_block_tables_find_all(spark, radius, blocks):
    rng = random.Random(radius * blocks)
    centre = [rng.getrandbits(64) for _ in range(8)]
    near = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centre for _ in range(30)})
    signed = [x - (1 << 64) if x >> 63 else x for x in near]
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    got = sorted((r[0] % (1 << 64), r[1] % (1 << 64)) for r in f.within_radius(df, df, radius, blocks).collect())
    assert got == sorted((a, b) for a in near for b in near if _bits(a, b) <= radius)


def test_blocks_grow_with_the_table():
    assert f.blocks_for(10**6, 3) == 5 and f.blocks_for(10**9, 3) == 6 and f.blocks_for(10**11, 3) > 6 and f.blocks_for(0, 0) == 2


def _plain(text):
    """The fingerprint of a text, term by term and bit by bit."""
    words = [xxhash.xxh64_intdigest(w, 42) for w in regex.findall(r"[\p{L}\p{N}]+", text.lower())]
    raw = lambda h: h.to_bytes(8, "little")
    terms = words if len(words) < 2 else [xxhash.xxh64_intdigest(raw(b), xxhash.xxh64_intdigest(raw(a), 42)) for a, b in zip(words, words[1:], strict=False)]
    votes = [0] * 64
    for h, weight in Counter(terms).items():
        for b in range(64):
            votes[b] += weight if h >> b & 1 else -weight
    return sum(1 << b for b in range(64) if votes[b] > 0)


def test_fingerprints_of_whole_texts_against_plain(spark, small_dir, edge_docs):
    """Both fingerprints of every document of the query's table, and of the edges."""
    for docs in (spark.read.parquet(f"{small_dir}/documents.parquet"), edge_docs.where("doc_id is not null and text not like '%Ünïcode%'").dropDuplicates(["doc_id"])):
        src = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), reverse=True)
        got = {r["doc_id"]: (r["fingerprint"], r["edited_fingerprint"]) for r in f.fingerprint_report(docs).collect()}
        for (i, t), (_, after) in zip(src, src[1:] + src[:1], strict=True):
            edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
            assert got[i] == (f"{_plain(t):016x}", f"{_plain(edited):016x}"), i


def test_native_plan(spark, edge_docs):
    plan = f.edited_documents(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan


def test_pieces(spark):
    ids = spark.createDataFrame([(i * i,) for i in range(1000)], "i bigint")
    points = split_points(ids, "i", 16)
    got = ids.select("i", piece_of("i", points).alias("p")).collect()
    assert all(r["p"] == sum(x <= r["i"] for x in points) for r in got)
