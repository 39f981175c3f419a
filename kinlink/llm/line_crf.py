"""Quality classifier: a linear-chain conditional random field over a document's lines.

Every line is good or bad. A line's features describe its own words and characters and those of the lines before and after
it; a 2 x 2 transition table ties neighbours. Forward-backward gives each line's marginal of being good; a
document's quality is the mean of its lines' marginals, weighted by length, put through a logistic curve that was fitted
on the training documents (so that 0.5 parts the classes at their natural rates). Only a text's characters are looked at.
A document is scored whole, as forward-backward needs all its lines: that takes about 200 bytes of memory a line besides its text.

Training takes at most ``SAMPLE`` labelled documents of each class, of ``SAMPLE_BYTES`` and ``SAMPLE_LINES`` at most (a bounded, documented
sample, drawn by digest over all labels; its features take 74 MB at most); each line bears its document's label. Scoring reads every line of every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.common import free_name, materialize, small_batches

SAMPLE = 1500
SAMPLE_BYTES = 1 << 15
SAMPLE_LINES = 512
EPOCHS, RATE, PENALTY, BATCH = 40, 0.05, 1e-4, 128
PADDED = 1 << 18  # lines, padding included, that are scored at once
_SYMBOL = re.compile(r"[^\w\s.,;:'\"()-]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTER = re.compile(r"[^\W\d_]")
_DIGIT = re.compile(r"\d")
_STOP = re.compile(r"[.!?]")
OWN = 12
LINES = 1 << 14  # lines of a document whose features are made at once


def line_features(line: str) -> list[float]:
    """Twelve numbers about one line."""
    words = line.split()
    n, chars = len(words), len(line)
    if not n:
        return [0.0] * (OWN - 1) + [1.0]
    c = 1.0 / chars
    w = 1.0 / n
    again = sum(map(str.__eq__, words, words[1:])) * w
    return [
        np.log1p(chars) * 0.2,
        len(_LETTER.findall(line)) * c,
        len(_UPPER.findall(line)) * c,
        len(_DIGIT.findall(line)) * c,
        len(_SYMBOL.findall(line)) * c,
        chars * w * 0.1,
        len(set(words)) * w,
        again,
        sum(x[-1] in "!#$%&*|+=~^@<>" for x in words) * w,
        sum(len(x) <= 3 for x in words) * w,
        len(_STOP.findall(line)) * w,
        0.0,
    ]


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines x 3 * OWN: its own, the previous and the next line's) and lengths of a text's lines; an empty text has one empty line."""
    lines = text.split("\n")
    own = np.concatenate([np.array([line_features(x) for x in lines[at : at + LINES]], dtype=np.float32) for at in range(0, len(lines), LINES)])
    return own, np.fromiter((len(x) + 1 for x in lines), dtype=np.float32, count=len(lines))


def with_neighbours(own: np.ndarray) -> np.ndarray:
    none = np.zeros((1, own.shape[1]), dtype=own.dtype)
    return np.concatenate([own, np.concatenate([none, own[:-1]]), np.concatenate([own[1:], none])], axis=1)


@dataclass
class LineCrf:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # features + 1 (bias), for good against bad
    pairs: np.ndarray  # 2 x 2
    slope: float = 1.0
    offset: float = 0.0

    def emissions(self, features: np.ndarray) -> np.ndarray:
        """Log potential of good (that of bad is 0) for each line."""
        x = (features - self.mean) / self.scale
        return x @ self.weights[:-1] + self.weights[-1]

    def emissions_of(self, own: np.ndarray) -> np.ndarray:
        """The same from a document's own features, ``LINES`` lines at a time."""
        none = np.zeros((1, own.shape[1]), dtype=own.dtype)
        parts = []
        for at in range(0, len(own), LINES):
            to = min(at + LINES, len(own))
            around = np.concatenate([own[at - 1 : at] if at else none, own[at:to], own[to : to + 1] if to < len(own) else none])
            parts.append(self.emissions(with_neighbours(around)[1:-1]))
        return np.concatenate(parts)

    def marginals(self, e: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(good) of each line, expected pair counts and log partition of padded documents (docs x lines)."""
        docs, lines = e.shape
        score = np.stack([np.zeros_like(e), e], axis=2)
        alpha = np.empty_like(score)
        beta = np.zeros_like(score)
        alpha[:, 0] = score[:, 0]
        for t in range(1, lines):
            step = np.logaddexp(alpha[:, t - 1, 0, None] + self.pairs[0], alpha[:, t - 1, 1, None] + self.pairs[1]) + score[:, t]
            alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
        for t in range(lines - 2, -1, -1):
            ahead = beta[:, t + 1] + score[:, t + 1]
            step = np.logaddexp(ahead[:, 0, None] + self.pairs[:, 0], ahead[:, 1, None] + self.pairs[:, 1])
            beta[:, t] = np.where(mask[:, t + 1, None], step, 0)
        log_z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        good = np.exp(np.minimum(alpha[:, :, 1] + beta[:, :, 1] - log_z[:, None], 0))
        counts = np.zeros((2, 2))
        if lines > 1:
            joint = alpha[:, :-1, :, None] + self.pairs + (beta + score)[:, 1:, None, :] - log_z[:, None, None, None]
            counts = (np.exp(np.minimum(joint, 0)) * mask[:, 1:, None, None]).sum(axis=(0, 1))
        return good, counts, log_z

    def raw(self, documents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Length-weighted mean marginal of each document."""
        out = np.zeros(len(documents))
        order = sorted(range(len(documents)), key=lambda i: len(documents[i][1]))
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and len(documents[order[to]][1]) * (to + 1 - at) <= PADDED:
                to += 1
            pick = order[at:to]
            e, mask = self.padded([self.emissions_of(documents[i][0]) for i in pick])
            length, _ = self.padded([documents[i][1] for i in pick])
            good, _, _ = self.marginals(e, mask)
            out[pick] = (good * length * mask).sum(axis=1) / length.sum(axis=1)
            at = to
        return out

    @staticmethod
    def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(r) for r in rows])
        mask = np.arange(sizes.max())[None, :] < sizes[:, None]
        out = np.zeros(mask.shape)
        out[mask] = np.concatenate(rows)
        return out, mask

    def score(self, documents: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        p = np.clip(self.raw(documents), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(p / (1 - p)) + self.offset)))


def fit(documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rates: tuple[float, float], seed: int = 7) -> LineCrf:
    """A model of documents' features and 0/1 labels. ``rates``: how often the labels 0 and 1 occur in nature.

    Without both labels every document scores the rate of label 1.
    """
    features = 3 * OWN
    if len(set(labels.tolist())) < 2:
        rate = min(max(rates[1] / max(sum(rates), 1e-9), 0.01), 0.99) if len(labels) else 0.5
        return LineCrf(np.zeros(features), np.ones(features), np.zeros(features + 1), np.zeros((2, 2)), 0.0, float(np.log(rate / (1 - rate))))
    full = [with_neighbours(d[0]) for d in documents]
    stacked = np.concatenate(full)
    model = LineCrf(stacked.mean(axis=0), stacked.std(axis=0) + 1e-3, np.zeros(features + 1), np.zeros((2, 2)))
    full = [(f - model.mean) / model.scale for f in full]
    rng = np.random.default_rng(seed)
    sizes = np.array([len(f) for f in full])
    order = np.argsort(sizes, kind="stable")
    batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
    theta = np.zeros(features + 5)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    step = 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(batches)):
            pick = batches[k]
            model.weights, model.pairs = theta[: features + 1], theta[features + 1 :].reshape(2, 2)
            e, mask = model.padded([full[i] @ model.weights[:-1] + model.weights[-1] for i in pick])
            good, counts, _ = model.marginals(e, mask)
            y = labels[pick]
            gap = np.concatenate([np.full(sizes[i], labels[i]) - good[j, : sizes[i]] for j, i in enumerate(pick)])
            x = np.concatenate([full[i] for i in pick])
            seen = np.zeros((2, 2))
            seen[0, 0], seen[1, 1] = ((sizes[pick] - 1) * (y == 0)).sum(), ((sizes[pick] - 1) * (y == 1)).sum()
            grad = np.concatenate([x.T @ gap, [gap.sum()], (seen - counts).ravel()]) / len(gap) - PENALTY * theta
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.weights, model.pairs = theta[: features + 1], theta[features + 1 :].reshape(2, 2)
    p = np.clip(model.raw(documents), 1e-6, 1 - 1e-6)
    z = np.log(p / (1 - p))
    share = np.where(labels == 1, rates[1] / (labels == 1).sum(), rates[0] / (labels == 0).sum())
    share = share / share.sum()
    a, b = 1.0, 0.0
    for _ in range(200):  # Newton steps of a weighted logistic curve with a small penalty
        q = 1 / (1 + np.exp(-(a * z + b)))
        g = np.array([(share * (labels - q) * z).sum() - 1e-3 * a, (share * (labels - q)).sum() - 1e-3 * b])
        r = share * q * (1 - q)
        h = np.array([[(r * z * z).sum() + 1e-3, (r * z).sum()], [(r * z).sum(), r.sum() + 1e-3]])
        d = np.linalg.solve(h, g)
        d *= min(1.0, 2.0 / max(abs(d).max(), 1e-9))
        a, b = a + d[0], b + d[1]
        if abs(d).max() < 1e-8:
            break
    model.slope, model.offset = max(float(a), 1e-3), float(b)
    return model


def _held_out(id_col: str) -> F.Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, label_col: str = "quality") -> LineCrf:
    """A model of the labelled documents outside the held-out third (crc32 of the id as text, modulo 3, is 1).

    Labels count once for each id (the lowest, should they differ); null ids and labels are ignored. The drawn ids are at most four times
    ``sample`` for each class, and of their documents of at most ``sample_bytes`` and ``SAMPLE_LINES`` lines the first ``sample`` of each class by digest are used.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label_col).cast("int").alias("y"))
    known = known.where(~_held_out("doc_id"))
    rates = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    draw = F.xxhash64("doc_id")
    drawn = [known.where(F.col("y") == y).orderBy(draw, "doc_id").limit(4 * sample) for y in (0, 1)]
    ids = materialize(drawn[0].unionByName(drawn[1]), "sample", 8 * sample)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where((F.octet_length("text") <= sample_bytes) & (F.regexp_count("text", F.lit("\n")) < SAMPLE_LINES))
    # the ids are at most 8 * sample, so they are sent to the texts
    rows = texts.join(F.broadcast(ids), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [document_features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([m[0].tobytes() for m in made], pa.binary()), pa.array([m[1].tobytes() for m in made], pa.binary())], names=["doc_id", "y", "own", "length"])

    made = materialize(rows.select("doc_id", "text", "y").mapInArrow(run, "doc_id bigint, y int, own binary, length binary"), "line-features")
    first = [made.where(F.col("y") == y).orderBy(draw, "doc_id", "length").limit(sample) for y in (0, 1)]
    got = first[0].unionByName(first[1]).select("y", "own", "length").collect()
    documents = [(np.frombuffer(r["own"], dtype=np.float32).reshape(-1, OWN), np.frombuffer(r["length"], dtype=np.float32)) for r in got]
    return fit(documents, np.array([r["y"] for r in got], dtype=np.int64), (rates.get(0, 0), rates.get(1, 0)))


def score_texts(docs: DataFrame, model: LineCrf, keep: list[str], score_col: str, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and the score, as ``score_col``, of every row; null text counts as empty."""
    small_batches(docs.sparkSession)
    schema = docs.select(*(f"`{c}`" for c in keep)).schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), f"`{score_col}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = model.score([document_features(t) for t in b.column(b.num_columns - 1).to_pylist()]) if b.num_rows else []
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())], names=[*b.schema.names[:-1], score_col])

    text = F.coalesce(F.col(text_col), F.lit("")).alias(score_col)
    return docs.select(*(f"`{c}`" for c in keep), text).mapInArrow(run, schema)


def label_lines(docs: DataFrame, model: LineCrf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, line, p_good, good)``: every line's marginal and label; an empty or null text has one empty line."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("line", pa.int64()), ("p_good", pa.float64()), ("good", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                e, mask = model.padded([model.emissions_of(document_features(text)[0])])
                good = model.marginals(e, mask)[0][0]
                yield pa.RecordBatch.from_arrays([pa.array([doc] * len(good), pa.int64()), pa.array(range(len(good)), pa.int64()), pa.array(good), pa.array(good >= 0.5)], schema=schema)

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return slim.mapInArrow(run, "doc_id bigint, line bigint, p_good double, good boolean")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row; repeated rows are kept, an empty table gives an empty result."""
    model = train(docs, labels)
    scored = score_texts(docs, model, ["doc_id"], "score")
    held = F.coalesce(_held_out("doc_id"), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents that the classifier rejects; all columns as they are."""
    model = train(docs, labels)
    score = free_name(docs, "score")
    return score_texts(docs, model, docs.columns, score).where(F.col(f"`{score}`") >= threshold).drop(score)
