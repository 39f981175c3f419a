import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from kinlink.llm import simhash_dedup as s


def _plain(text, width=4):
    words = text.encode().lower().split()
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _classes(fps, radius=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    for t in ("", " \t", "One", "a b c", "a b c d", "A B c d e f\x0bg\u00a0h", "x " * 40_000):
        assert s.simhash(t.encode()) == _plain(t)


def _check_groups(docs):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    fps = [_plain(t) for _, t in rows]
    lowest = {}
    classes = _classes(fps)
    for (i, _), c in zip(rows, classes, strict=True):
        if i is not None:
            lowest[c] = min(lowest.get(c, i), i)
    want = sorted(((i, f"{f:016x}", lowest.get(c)) for (i, _), f, c in zip(rows, fps, classes, strict=True)), key=repr)
    assert sorted((tuple(r) for r in s.groups(docs).collect()), key=repr) == want


def test_groups_against_all_pairs(spark, edge_docs, small_dir):
    _check_groups(edge_docs)
    _check_groups(spark.read.parquet(f"{small_dir}/documents.parquet"))


@pytest.mark.parametrize(("limit", "subtree"), [(4096, 512), (16, 512), (4096, 20), (16, 20), (4, 1)])
def test_trie_join_against_all_pairs(spark, monkeypatch, limit, subtree):
    monkeypatch.setattr(s.tries_of, "__defaults__", (4, subtree))
    rng = random.Random(limit)
    centre = [rng.getrandbits(64) for _ in range(12)]
    fps = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for c in centre for _ in range(25)})
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(0, f, i) for i, f in enumerate(signed)], "seed int, fp bigint, node bigint")
    root = {r["node"]: r["root"] for r in s.components(s.trie_links(nodes, 4, limit)).collect()}
    assert [root.get(i, i) for i in range(len(fps))] == _classes(fps)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (100, 100)], "u bigint, v bigint")
    root = {r["node"]: r["root"] for r in s.components(links).collect()}
    assert all(root[i] == 0 for i in range(61)) and root[101] == 100


def test_tries_grow_with_the_table():
    assert len(s.tries_of(500)) == 1 and len(s.tries_of(10**6)) == 5 and len(s.tries_of(10**8)) == 15 and len(s.tries_of(10**10)) == 35
    for n in (500, 10**4, 10**6, 10**8, 10**10):
        for lead, after in s.tries_of(n):
            assert n >> lead.bit_count() <= s.SUBTREE and not lead & after


def _units(spark, path):
    prints = s.fingerprint_documents(spark.read.parquet(path)).select("fp").distinct()
    units, tries, _ = s.trie_units(prints.selectExpr("0 as seed", "fp", "fp as node"), 4, s.LEAF_LIMIT, [])
    got = units.toPandas().sort_values(["trie", "key", "i", "j"], kind="stable")
    new = (got[["trie", "key", "i", "j"]] != got[["trie", "key", "i", "j"]].shift()).any(axis=1)
    rows = {c: got[c].to_numpy() for c in ("trie", "fp", "node")} | {"unit": new.cumsum().to_numpy(), "side": got["side"].to_numpy().astype(np.int64)}
    return rows | {"check": np.zeros((len(got), 0), dtype=np.uint64)}, tries


def test_the_walk_decides(spark):
    """On the query's own table: node pairs are dropped by their bits far above the leaves, few leaf pairs are met, and the links are those of all pairs."""
    rows, tries = _units(spark, "/root/testdata/sf0.01/documents.parquet")
    counts = {}
    u, v = s._unit_links(rows, tries, 4, 0, counts)
    sizes = np.bincount(rows["unit"])[1:]
    leaf_pairs = int((sizes * (sizes - 1) // 2).sum())
    assert counts["visited"] > len(sizes) * 100 and counts["pruned"] > 50 * counts["leaves"]
    assert counts["leaves"] < leaf_pairs / 50
    fps = sorted(set(rows["fp"].tolist()))
    root = {x: s.forest(len(fps), np.searchsorted(fps, u), np.searchsorted(fps, v))[i] for i, x in enumerate(fps)}
    classes = _classes([f & (2**64 - 1) for f in fps])
    assert [root[f] for f in fps] == classes


def _near(rng, text, edits):
    words = text.split()
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"other{at}"
    return " ".join(words)


def test_stage_keeps_one_of_each(spark, edge_docs, no_docs):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    docs = []
    for g in range(40):
        base = " ".join(rng.choice(vocabulary) for _ in range(300))
        docs += [(g * 10, base), (g * 10 + 1, base), (g * 10 + 2, _near(rng, base, 3)), (g * 10 + 3, " ".join(rng.choice(vocabulary) for _ in range(300)))]
    kept = {r["doc_id"] for r in s.keep_one_of_each(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert kept == {g * 10 for g in range(40)} | {g * 10 + 3 for g in range(40)}
    out = s.keep_one_of_each(edge_docs)
    assert out.columns == edge_docs.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == sorted([None, 3, 2, 8, 7, 1, 100], key=repr)
    assert s.keep_one_of_each(no_docs).count() == 0 and s.groups(no_docs).count() == 0


def _jaccard(a, b):
    a, b = s.shingles_of(a.encode()), s.shingles_of(b.encode())
    return len(a & b) / len(a | b)


def test_stage_finds_block_edits(spark):
    """Copies that are cut, continued, or have a block replaced, by brute-force Jaccard similarity."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    docs, near = [], 0
    for g in range(100):
        base = text(300)
        copies = [base[:250], [*base, *text(55)], [*base[:150], *text(25), *base[175:]], base[60:-10]]
        docs += [(g * 10 + i, " ".join(t)) for i, t in enumerate([base, *copies])]
        pairs = [(g * 10 + i, _jaccard(docs[-5][1], docs[-5 + i][1])) for i in range(1, 5)]
        near += sum(j >= 0.8 for _, j in pairs)
    kept = {r["doc_id"] for r in s.keep_one_of_each(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    alike = {i for i, t in docs if i % 10 and _jaccard(docs[i // 10 * 5][1], t) >= 0.8}
    assert len(alike) == near == 300 and {g * 10 for g in range(100)} <= kept
    assert len(alike & kept) <= 3  # 99 % are found


def test_stage_against_all_pairs_of_the_table(spark):
    """By brute force over the table: copies of a similarity of 0.8 or more that stay together, and documents that go without one."""
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    sets = {i: s.shingles_of(t.encode()) for i, t in docs.items()}
    having = {}
    for i, grams in sets.items():
        for g in grams:
            having.setdefault(g, []).append(i)
    shared = Counter(pair for ids in having.values() for pair in combinations(sorted(ids), 2))
    alike = {(a, b): n / (len(sets[a]) + len(sets[b]) - n) for (a, b), n in shared.items()}
    kept = {r["doc_id"] for r in s.keep_one_of_each(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    near = [p for p, j in alike.items() if j >= 0.8]
    assert len(near) > 50 and sum(a in kept and b in kept for a, b in near) <= 0.02 * len(near)
    most = Counter()
    for (a, b), j in alike.items():
        most[a], most[b] = max(most[a], j), max(most[b], j)
    gone = [most[i] for i in docs.keys() - kept]
    assert min(gone) > 0.6 and sum(j < 0.75 for j in gone) <= 0.05 * len(gone)


@pytest.mark.parametrize("limit", [4096, 100])
def test_many_equal_prints(spark, limit):
    rng = random.Random(6)
    checks = [rng.getrandbits(63) for _ in range(3)]
    nodes = [(0, 7, i, checks[i % 3]) for i in range(1500)]
    links = s.trie_links(spark.createDataFrame(nodes, "seed int, fp bigint, node bigint, check bigint"), 0, leaf_limit=limit, checks=["check"])
    root = {r["node"]: r["root"] for r in s.components(links).collect()}
    assert [root.get(i, i) for i in range(1500)] == [i % 3 for i in range(1500)]


def test_texts_under_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(100)) for x in "abc")
    rows = [(2, a), (1, a), (1, b), (3, b), (3, c), (3, c), (4, None), (4, ""), (5, c + " more")]
    kept = s.keep_one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == [(1, a), (1, b), (3, c), (4, "")]


def test_stage_walks_the_tries(spark, monkeypatch):
    """The stage's own joins, on its own table: node pairs are dropped by their bits, few leaf pairs are met, and prints link that aren't equal."""
    calls, real = [], s.trie_links
    monkeypatch.setattr(s, "trie_links", lambda prints, radius, *a, **k: calls.append((prints.toPandas(), radius, k.get("checks"))) or real(prints, radius, *a, **k))
    s.keep_one_of_each(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows, radius, _ = calls[0]
    rows = rows.sort_values("seed", kind="stable")
    tries, seed = s.tries_of(int(rows["seed"].value_counts().max()), radius), rows["seed"].to_numpy()
    # a unit for each print and subtree
    dealt = [(t, seed, rows["fp"].to_numpy(), rows["fp"].to_numpy() & np.uint64(m).view(np.int64)) for t, (m, _) in enumerate(tries)]
    table = np.concatenate([np.stack([np.full(len(k), t), sd, k, fp], axis=1) for t, sd, fp, k in dealt])
    table = table[np.lexsort((table[:, 2], table[:, 1], table[:, 0]))]
    unit = np.cumsum(np.r_[True, (table[1:, :3] != table[:-1, :3]).any(axis=1)])
    counts, fps = {}, table[:, 3].copy()
    units = {"trie": table[:, 0], "unit": unit, "side": np.zeros(len(unit), dtype=np.int64), "fp": fps, "node": np.arange(len(unit)), "check": np.zeros((len(unit), 0), dtype=np.uint64)}
    u, v = s._unit_links(units, tries, radius, 0, counts)
    sizes = np.bincount(unit)
    assert counts["pruned"] > 20 * counts["leaves"] and counts["leaves"] < (sizes * (sizes - 1) // 2).sum() / 50
    assert (fps[u] != fps[v]).sum() > 100


@pytest.mark.parametrize("limit", [4096, 30])
def test_checked_links_against_all_pairs(spark, monkeypatch, limit):
    """Prints that are shared, near or far, with sketches that pass or don't; subtrees that are dealt out in parts."""
    monkeypatch.setattr(s.trie_links, "__defaults__", (4, limit, None, 0))
    rng = random.Random(limit)
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    centres, nodes = [[rng.getrandbits(64) for _ in range(3)] for _ in range(60)], []
    for i in range(900):
        f0, f1, c = centres[min(rng.randrange(60), rng.randrange(60))]
        nodes.append((i, flip(f0, rng.choice([0, 0, 1, 3, 6])), flip(f1, rng.choice([0, 2, 20])), flip(c, rng.choice([0, 1, 4]))))
    signed = [(i, *np.array(x, dtype=np.uint64).view(np.int64).tolist()) for i, *x in nodes]
    links = s.checked_links(spark.createDataFrame(signed, "node bigint, f0 bigint, f1 bigint, c bigint"), ["f0", "f1"], ["c"], 4, 3)
    near = [(a[0], b[0]) for a, b in combinations(nodes, 2) if min((a[k] ^ b[k]).bit_count() for k in (1, 2)) <= 4 and (a[3] ^ b[3]).bit_count() <= 3]
    want = s.forest(len(nodes), *np.array(near).T)
    root = {r["node"]: r["root"] for r in s.components(links).collect()}
    assert len(set(want.tolist())) > 60 and [root.get(i, i) for i in range(len(nodes))] == want.tolist()
