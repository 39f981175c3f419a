import itertools
import math
import zlib

import numpy as np

from kinlink.llm import line_crf as q

LABELS = "doc_id bigint, quality int, toxic int"


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(2)
    model = q.LineCrf(np.zeros(1), np.ones(1), np.zeros(2), rng.normal(size=(2, 2)))
    sizes = [1, 4, 6]
    e, mask = model.padded([rng.normal(size=n) for n in sizes])
    good, counts, log_z = model.marginals(e, mask)
    total = np.zeros((2, 2))
    for d, n in enumerate(sizes):
        weights = {p: np.exp(sum(e[d, t] * y for t, y in enumerate(p)) + sum(model.pairs[a, b] for a, b in zip(p, p[1:], strict=False))) for p in itertools.product((0, 1), repeat=n)}
        z = sum(weights.values())
        assert np.isclose(np.log(z), log_z[d])
        for t in range(n):
            assert np.isclose(good[d, t], sum(w for p, w in weights.items() if p[t]) / z)
        for p, w in weights.items():
            for a, b in zip(p, p[1:], strict=False):
                total[a, b] += w / z
    assert np.allclose(counts, total)


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(3)
    docs = [q.document_features("\n".join("some words here and there" if rng.random() < 0.5 else "LOUD!! NOISE!!" for _ in range(n))) for n in (1, 3, 50, 2)]
    model = q.LineCrf(np.zeros(36), np.ones(36), rng.normal(size=37), rng.normal(size=(2, 2)))
    assert np.allclose(model.score(docs), [model.score([d])[0] for d in docs])


def _plain_features(line):
    words = line.split()
    if not words:
        return [0.0] * 11 + [1.0]
    n, c = len(words), len(line)
    upper = sum("A" <= x <= "Z" or "À" <= x <= "Ö" or "Ø" <= x <= "Þ" for x in line)
    symbols = sum(not (x.isalnum() or x == "_" or x.isspace() or x in ".,;:'\"()-") for x in line)
    return [
        math.log(1 + c) / 5, sum(x.isalnum() and not x.isdecimal() for x in line) / c, upper / c, sum(x.isdecimal() for x in line) / c, symbols / c, c / n / 10, len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, sum(w[-1] in "!#$%&*|+=~^@<>" for w in words) / n, sum(len(w) <= 3 for w in words) / n, sum(x in ".!?" for x in line) / n, 0.0,
    ]


def _plain_score(model, text):
    """A document's score by all labellings of its lines."""
    lines = text.split("\n")
    own = [_plain_features(x) for x in lines]
    none = [0.0] * 12
    x = [[*own[i], *(own[i - 1] if i else none), *(own[i + 1] if i + 1 < len(own) else none)] for i in range(len(own))]
    e = [sum(w * (v - m) / s for w, v, m, s in zip(model.weights, row, model.mean, model.scale, strict=False)) + model.weights[-1] for row in x]
    good, z = [0.0] * len(lines), 0.0
    for path in itertools.product((0, 1), repeat=len(lines)):
        weight = math.exp(sum(e[t] for t in range(len(path)) if path[t]) + sum(model.pairs[a, b] for a, b in zip(path, path[1:], strict=False)))
        z += weight
        for t, y in enumerate(path):
            good[t] += weight * y
    sizes = [len(x) + 1 for x in lines]
    p = min(max(sum(g / z * n for g, n in zip(good, sizes, strict=True)) / sum(sizes), 1e-6), 1 - 1e-6)
    return 1 / (1 + math.exp(-(model.slope * math.log(p / (1 - p)) + model.offset)))


def test_scores_against_all_labellings(spark, small_dir, edge_docs, monkeypatch):
    """Features, marginals, weighting and curve of a trained model, for every text of up to eight lines."""
    docs, labels = spark.read.parquet(f"{small_dir}/documents.parquet"), spark.read.parquet(f"{small_dir}/labels.parquet")
    model = q.train(docs, labels)
    texts = [r["text"] or "" for r in docs.collect() + edge_docs.collect()]
    texts = [t for t in texts if t.count("\n") < 8] + ["A LOUD!! line\n\nand then words. 12 of them", "\n", "x_y À ²③"]
    assert len(texts) > 50
    got = model.score([q.document_features(t) for t in texts])
    assert np.allclose(got, [_plain_score(model, t) for t in texts], atol=1e-4)
    monkeypatch.setattr(q, "LINES", 2)  # features made two lines at a time
    assert np.allclose(got, model.score([q.document_features(t) for t in texts]))


def _held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r["doc_id"]: r for r in q.quality_report(docs, labels).collect()}
    assert len(got) == docs.count() and all(r["held_out"] == _held(i) and r["predicted"] == (r["score"] >= 0.5) for i, r in got.items())
    held = [(r["quality"], got[r["doc_id"]]["predicted"]) for r in labels.collect() if _held(r["doc_id"])]
    assert sum(a == b for a, b in held) > 0.95 * len(held)


def test_labels_outside_the_training_part_do_not_matter(spark, small_dir):
    docs, labels = spark.read.parquet(f"{small_dir}/documents.parquet"), spark.read.parquet(f"{small_dir}/labels.parquet")
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(q._held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, q.quality_report(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(9, 1, 0), (7, 0, 0), (None, 1, 0), (8, None, 0), (2, 1, 0), (3, 1, 0), (3, 0, 1)], LABELS)
    got = q.quality_report(edge_docs, labels).collect()
    assert len(got) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert q.quality_report(no_docs, labels).count() == 0
    kept = q.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns
    unlabelled = q.quality_report(edge_docs, labels.where("false")).collect()
    assert {r["score"] for r in unlabelled} == {0.5}


def test_line_labels(spark, edge_docs):
    rng = np.random.default_rng(1)
    model = q.LineCrf(np.zeros(36), np.ones(36), rng.normal(size=37), rng.normal(size=(2, 2)))
    got = q.label_lines(edge_docs, model).collect()
    assert len(got) == sum((r["text"] or "").count("\n") + 1 for r in edge_docs.collect())
    assert all(r["good"] == (r["p_good"] >= 0.5) for r in got)
