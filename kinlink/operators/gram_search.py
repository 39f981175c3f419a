"""The best right texts of each left text by cosine of weighted n-grams, exact, for one task.

Texts come packed: their n-grams' numbers, sorted, a number as often as its n-gram stands in the text. Right texts are met in blocks. In a block, n-grams
of many texts are a dense matrix and the others lists of rows; both together give all scores in single precision, and those that can be
among the best are summed again in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: N-grams of more than this share of a block's texts, and so many of them at most, are a dense matrix. The result doesn't depend on them.
DENSE_SHARE, DENSE_MOST = 0.03, 384
#: Scores made at once, about.
AT_ONCE = 2_000_000
#: More than single precision can err by: scores are sums of products of rows of length 1.
MARGIN = 1e-4
LEAST = 1e-10


def numbers_of(words: str, low: int, high: int, vocabulary: dict[str, int], group: str = "") -> list[int]:
    """Sorted numbers of the n-grams inside words, as ``blocking.ngrams`` makes them."""
    out = []
    for word in words.split(" "):
        if word:
            w = f" {word} "
            grams = [w] if len(w) < low else [w[i : i + n] for n in range(low, high + 1) for i in range(len(w) - n + 1)]
            out += [vocabulary[group + g] for g in grams]
    return sorted(out)


def weighted(texts: Sequence[bytes], kind: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, n-gram and weight (sublinear tf times idf, rows of length 1) of packed texts, by row and n-gram."""
    size = np.dtype(kind).itemsize
    col = np.frombuffer(b"".join(texts), kind).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) // size for t in texts])
    at = np.flatnonzero(np.r_[True, (col[1:] != col[:-1]) | (row[1:] != row[:-1])][: len(col)])
    n, row, col = np.diff(np.r_[at, len(col)]), row[at], col[at]
    w = (1 + np.log(n)) * idf[col]
    return row, col, w / np.sqrt(np.bincount(row, w * w, len(texts)))[row]


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the spans, one span after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Block:
    """Right texts."""

    def __init__(self, texts: Sequence[bytes], kind: str, idf: np.ndarray) -> None:
        row, col, w = weighted(texts, kind, idf)
        self.n = len(texts)
        used = np.zeros(len(idf), dtype=bool)
        used[col] = True
        self.own = np.where(used, np.cumsum(used) - 1, -1)  # the block's own numbers
        col, m = self.own[col], int(used.sum())
        count = np.bincount(col, minlength=m)
        common = np.argsort(-count, kind="stable")[:DENSE_MOST]
        common = common[count[common] > DENSE_SHARE * self.n]
        self.place = np.full(m, -1)
        self.place[common] = np.arange(len(common))
        at = self.place[col]
        self.dense = np.zeros((len(common), self.n), dtype=np.float32)
        self.dense[at[at >= 0], row[at >= 0]] = w[at >= 0]
        rare = np.flatnonzero(at < 0)
        rare = rare[np.argsort(col[rare], kind="stable")]
        self.rows, self.weights, self.starts = row[rare], w[rare], np.searchsorted(col[rare], np.arange(m + 1))
        self.ptr, self.col, self.w, self.m = np.searchsorted(row, np.arange(self.n + 1)), col, w, m

    def step(self) -> int:
        return int(np.clip(AT_ONCE // max(self.n, self.m, 1), 1, 512))

    def search(self, row: np.ndarray, col: np.ndarray, w: np.ndarray, n_left: int, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Left row, right row and score, to 9 places, of all pairs of at least ``floor`` that can be among the ``k`` best of a left row."""
        known = self.own[col] >= 0
        row, col, w = row[known], self.own[col[known]], w[known]
        at = self.place[col]
        query = np.zeros((n_left, len(self.dense)), dtype=np.float32)
        query[row[at >= 0], at[at >= 0]] = w[at >= 0]
        score = query @ self.dense
        sizes = self.starts[col + 1] - self.starts[col]
        met = _spans(self.starts[col], sizes)
        score += np.bincount(np.repeat(row * self.n, sizes) + self.rows[met], np.repeat(w, sizes) * self.weights[met], n_left * self.n).reshape(n_left, self.n)
        least = floor - MARGIN
        if self.n > k:
            # k groups of right rows have a best of at least this, so k rows have
            groups = max(4 * k, 512)
            best = score if self.n < 2 * groups else score[:, : self.n // groups * groups].reshape(n_left, -1, groups).max(axis=1)
            least = np.maximum(least, np.partition(best, -k, axis=1)[:, -k] - MARGIN)
        left, right = np.nonzero(score >= np.maximum(least, LEAST).astype(np.float32)[:, None])
        full = np.zeros((n_left, self.m))
        full[row, col] = w
        exact = np.zeros(len(left))
        for i in range(0, len(left), 20_000):
            x, y = left[i : i + 20_000], right[i : i + 20_000]
            sizes = self.ptr[y + 1] - self.ptr[y]
            at = _spans(self.ptr[y], sizes)
            exact[i : i + 20_000] = np.add.reduceat(full[np.repeat(x, sizes), self.col[at]] * self.w[at], np.cumsum(sizes) - sizes)
        exact = np.round(exact, 9)
        good = (exact > 0) & (exact >= floor[left])
        return left[good], right[good], exact[good]


class Part:
    """Left texts, and the best right ids of each so far."""

    def __init__(self, keys: Sequence[str], texts: Sequence[bytes], kind: str, idf: np.ndarray, k: int) -> None:
        self.keys, self.k, self.n = keys, k, len(keys)
        self.row, self.col, self.w = weighted(texts, kind, idf)
        self.ends = np.searchsorted(self.row, np.arange(self.n + 1))
        self.floor = np.zeros(self.n)
        self.left, self.text, self.score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        self.ids: dict[int, list[str]] = {}
        self.seen = 0

    def meet(self, block: Block, ids: Sequence[list[str]]) -> None:
        """``ids``: of each right text, in order; the first ``k`` are enough."""
        found = [(self.left, self.text, self.score)]
        for i in range(0, self.n, step := block.step()):
            j = min(i + step, self.n)
            at = slice(self.ends[i], self.ends[j])
            left, right, score = block.search(self.row[at] - i, self.col[at], self.w[at], j - i, self.k, self.floor[i:j])
            found.append((left + i, right + self.seen, score))
        left, text, score = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((-score, left))
        left, text, score = left[order], text[order], score[order]
        starts = np.searchsorted(left, np.arange(self.n + 1))
        enough = np.flatnonzero(np.diff(starts) >= self.k)
        self.floor[enough] = score[starts[enough] + self.k - 1]
        good = score >= self.floor[left]  # equals of the k-th stay: ids decide
        self.left, self.text, self.score = left[good], text[good], score[good]
        kept = {int(t): t - self.seen for t in np.unique(self.text[self.text >= self.seen])}
        self.ids |= {t: ids[i] for t, i in kept.items()}
        self.seen += block.n
        self._trim()
        self.ids = {int(t): self.ids[int(t)] for t in np.unique(self.text)}

    def _trim(self) -> None:
        """Of many equals the ``k`` of the smallest first ids are enough."""
        starts = np.searchsorted(self.left, np.arange(self.n + 1))
        keep = np.ones(len(self.left), dtype=bool)
        for i in np.flatnonzero(np.diff(starts) > 2 * self.k):
            a, b = starts[i], starts[i + 1]
            keep[a:b] = False
            keep[sorted(range(a, b), key=lambda x: (-self.score[x], self.ids[int(self.text[x])][0]))[: self.k]] = True
        self.left, self.text, self.score = self.left[keep], self.text[keep], self.score[keep]

    def best(self) -> Iterator[tuple[str, str, float]]:
        """Left key, right id and score; equal scores by id."""
        ends, texts, scores = np.searchsorted(self.left, np.arange(self.n + 1)).tolist(), self.text.tolist(), self.score.tolist()
        for i, key in enumerate(self.keys):
            for s, r in sorted((-scores[x], r) for x in range(ends[i], ends[i + 1]) for r in self.ids[texts[x]])[: self.k]:
                yield key, r, -s
