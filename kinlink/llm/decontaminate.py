"""Benchmark decontamination by template canonicalisation.

A text's words become a template: numbers, units after numbers, and names (runs of capitalised words, also those that begin
a sentence, as where sentences begin differs between texts) turn into typed placeholders, all else is lower-cased. A second
template leaves names as lower-case words, so that a copy in other case is found as well. Windows of ``WINDOW`` template tokens are
hashed and joined with the benchmark's windows. For each document and item, the placeholders' values must then be consistent: a
value of the item stands for one value in the document and the other way round; windows that contradict the majority don't
count. That holds for each occurrence by itself (windows that lie as in the item, give or take half its length), as a document may
have several variants of an item, and for all windows together. A document contains an item if, in either template, consistent
windows make up ``COVERAGE`` of the item's windows or so much of a long item that ``RUN`` of them follow each other, whatever numbers, names and units it has put in.

Windows of mostly placeholders would be met everywhere. Items with such windows are also looked for in two more ways: word by word, with their own
numbers and the signs of arithmetic; and, if words and signs are half of them, by a template that keeps the signs, all of whose windows must be there, consistently
(so a sum with other numbers is found, but not one with other signs). Items of fewer than ``LEAST_WORDS`` words and numbers are looked for as whole lines.

The join has two forms with one result. A benchmark of at most ``BLOCK_BYTES`` of text (its size is summed first) is sent to all machines as an
index, and documents aren't shuffled. A larger one is joined by hash: its windows and those of the documents are shuffled by their hashes
(of an item only its rarest windows, so many that one of them must be in any document that contains it), and each
pair that meets is checked with both whole texts; nothing of the benchmark is collected.

With an index, most documents share too few words with the benchmark to be tokenised at all: of an item's windows, so many that one of them must be in
any document that contains it give two neighbouring words as anchor, and a text without any anchor has no item.
"""

from __future__ import annotations

import logging
import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinlink.llm.common import free_name, materialize, small_batches

WINDOW = 8
LEAST_WORDS = 4  # shorter items are looked for as whole lines
LITERALS = 0.5  # of a window's tokens at least
COVERAGE = 0.4
RUN = 50  # so many windows in a row are enough, however long the item
MEMO = 1 << 18
ANY = ""
BLOCK_BYTES = 16 << 20
NUM, UNIT, NAME = "<num>", "<unit>", "<name>"
#: Unit words and signs that count as units after a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons s sec second seconds"
    " min minute minutes h hr hour hours day days week weeks month months year years % percent $ € £ dollar dollars euro euros cent cents usd eur mph c f k hz khz mhz ghz kb mb gb tb w kw mw v a j kj pa".split()
)
_TOKEN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|\d(?:[\d.,:/]*\d)?|\S|\n")
_REAL = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|\d|[%$€£]")
_P = 6364136223846793005
_NUMBER, _WORD, _CAPITAL, _OTHER = range(4)
#: The template that leaves names as words, the one that replaces them, the one that replaces nothing, the one that leaves names and signs, and whole lines.
WORDS, NAMES, EXACT, SIGNED, LINE = range(5)
SIGNS = frozenset("+-*/=<>^×÷·−±≤≥≠√∑∫")  # count in the last three
_RULE = re.compile("([" + re.escape("".join(sorted(SIGNS))) + r"])\1{2,}")
_log = logging.getLogger(__name__)


def _hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token, 9)


_H_NUM, _H_UNIT, _H_NAME = _hash(NUM), _hash(UNIT) >> 4, _hash(NAME) >> 4


def _classify(token: str) -> tuple[int, str, int, bool]:
    """Kind, lower-case form, its hash, and whether it is a unit."""
    low = token.lower()
    if token[0].isdecimal():
        return _NUMBER, low, _H_NUM, False
    if token[0].isalpha() or token in "%$€£":
        return _CAPITAL if token[0].isupper() and not token.isupper() else _WORD, low, _hash(low), low in UNITS
    return _OTHER, low, 0, False


def canonical(text: str, names: bool = True) -> tuple[list[str], list[str]]:
    """Template tokens and, for each, the value it stands for ('' for literal words)."""
    tokens, values = [], []
    unit_next = in_name = False
    for token in _TOKEN.findall(text):
        kind, low, _, unit = _classify(token)
        if kind == _OTHER:
            unit_next = in_name = False
            continue
        if kind == _CAPITAL and names and not (unit and unit_next) and in_name:
            values[-1] += " " + low
            continue
        name = kind == _CAPITAL and names and not (unit and unit_next)
        tokens.append(NUM if kind == _NUMBER else UNIT if unit and unit_next else NAME if name else low)
        values.append("" if tokens[-1] == low and not kind == _NUMBER else low)
        unit_next, in_name = kind == _NUMBER, name
    return tokens, values


def signed(text: str) -> tuple[list[str], list[str]]:
    """Template tokens with names as words and with signs, and the values they stand for."""
    tokens, values, unit_next = [], [], False
    for token in _TOKEN.findall(_RULE.sub(" ", text)):
        kind, low, _, unit = _classify(token)
        if kind != _OTHER or token in SIGNS:
            tokens.append(NUM if kind == _NUMBER else UNIT if unit and unit_next else low)
            values.append(low if tokens[-1] in (NUM, UNIT) else "")
        unit_next = kind == _NUMBER
    return tokens, values


def exact(text: str) -> list[str]:
    """Lower-case words, numbers and signs, none replaced; three or more equal signs in a row are a rule on the page, not arithmetic."""
    return [t.lower() for t in _TOKEN.findall(_RULE.sub(" ", text)) if t in SIGNS or _classify(t)[0] != _OTHER]


class Memo(dict):
    """Tokens met so far: 60 bits of hash, two of kind, and one that tells units, in one number.

    With ``known`` words, others get no hash, as no window with them can be met.
    """

    def __init__(self, known: frozenset[str] | None = None) -> None:
        self.known = known

    def __missing__(self, token: str) -> int:
        low = token.lower()
        if token[0].isalpha() and self.known is not None and low not in self.known:
            code = (_CAPITAL if token[0].isupper() and not token.isupper() else _WORD) << 1 | (low in UNITS)
        else:
            kind, _, h, unit = _classify(token)
            code = h >> 4 << 4 | kind << 1 | unit
        if len(self) < MEMO:
            self[token] = code
        return code


def template_hashes(text: str, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the tokens of both templates, as ``canonical`` gives them; all tokens of a text at once."""
    tokens = _TOKEN.findall(text)
    codes = np.fromiter(map(memo.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    low = codes.astype(np.uint8)
    kind = low >> 1 & 3

    def after(flag: np.ndarray) -> np.ndarray:
        out = np.zeros_like(flag)
        out[1:] = flag[:-1]
        return out

    unit = (low & 1).astype(bool) & after(kind == _NUMBER)
    name = (kind == _CAPITAL) & ~unit
    words = np.where(unit, np.uint64(_H_UNIT), codes >> np.uint64(4))
    names = np.where(name, np.uint64(_H_NAME), words)
    real = kind != _OTHER
    return words[real], names[real & ~(name & after(name))]


def window_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each window of ``length`` tokens, from the tokens' hashes."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        out = out * np.uint64(_P) + (h[k : k + n] ^ (h[k : k + n] >> np.uint64(29)))
    return out


def longest_known(h: np.ndarray) -> int:
    """The length of the longest run of tokens with a hash."""
    gaps = np.flatnonzero(h == 0)
    if not len(gaps):
        return len(h)
    return int(max(gaps[0], len(h) - 1 - gaps[-1], np.diff(gaps).max(initial=1) - 1))


def _literal(tokens: list[str], at: int, length: int) -> bool:
    return sum(t[0] != "<" for t in tokens[at : at + length]) >= LITERALS * length


def _exact_anchor(window: list[str]) -> tuple[str, str]:
    """The same for a window of the third template, where numbers stand for words if there are none."""
    if any(t[0].isalpha() for t in window):
        return _anchor([t if t[0].isalpha() else NUM for t in window])
    return max((t for t in window if t not in SIGNS), key=lambda t: (len(t), t)), ANY


@dataclass
class Index:
    """Benchmark windows, for each template: sorted hashes with item number and position, by window length."""

    items: list[tuple[int | None, list[str], list[str], int, list[int]]]  # id, tokens, values, length, windows' positions
    rows: list[int]  # each item's row of the benchmark
    ids: list[int | None]  # and each row's item id
    lines: dict[tuple[str, ...], list[int]]  # rows of the items that are looked for as whole lines
    known: frozenset[str]  # all words of their templates
    anchors: dict[str, set[str]]  # words, case-folded, and words that follow them; any text that contains an item has such a pair
    coverage: float
    unseen: list[int | None]  # items without any word, number or sign, which aren't looked for
    words: dict[str, int]  # the tokens of the templates with signs and their hashes
    tables: tuple[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], ...]


def _anchor(window: list[str]) -> tuple[str, str]:
    """A window's longest word that another word follows, and that word; else its longest word and ``ANY``."""
    literal = [t[0] != "<" for t in window]
    starts = [i for i in range(len(window) - 1) if literal[i] and literal[i + 1]]
    if starts:
        at = max(starts, key=lambda i: (len(window[i]), window[i], -i))
        return window[at].casefold(), window[at + 1].casefold()
    return max((t for t, ok in zip(window, literal, strict=True) if ok), key=lambda t: (len(t), t)).casefold(), ANY


def build_index(rows: list[tuple[int | None, str]], coverage: float = COVERAGE) -> Index:
    anchors: dict[str, set[str]] = defaultdict(set)
    items, row_of, found = [], [], tuple(defaultdict(list) for _ in range(4))
    lines: dict[tuple[str, ...], list[int]] = defaultdict(list)
    memo, words = Memo(), {}

    def add(kind: int, row: int, tokens: list[str], values: list[str], length: int, windows: np.ndarray, places: list[int]) -> None:
        found[kind][length] += [(windows[p], len(items), p) for p in places]
        items.append((rows[row][0], tokens, values, length, places))
        row_of.append(row)
        anchor = _anchor if kind in (WORDS, NAMES) else _exact_anchor
        cover = coverage_of(kind, coverage)
        worded = [p for p in places if kind != SIGNED or any(t[0].isalpha() for t in tokens[p : p + length])]
        pairs = sorted((anchor(tokens[p : p + length]) for p in worded), key=lambda a: (a[1] == ANY, -len(a[0]), a))
        pairs = pairs[: max(1, len(pairs) - max(1, math.ceil(cover * len(places))) + 1)]
        if RUN < coverage * len(places):  # and one of any so many in a row
            pairs += [anchor(tokens[p : p + length]) for p in worded[RUN - 1 :: RUN]] if kind != SIGNED else [anchor(tokens[p : p + length]) for p in worded]
        for word, follower in pairs:
            anchors[word].add(follower)

    for row, (_, text) in enumerate(rows):
        hashes = template_hashes(text or "", memo)
        for kind in (WORDS, NAMES):
            tokens, values = canonical(text or "", kind == NAMES)
            length = min(WINDOW, len(tokens))
            if length < LEAST_WORDS:
                if kind == WORDS and (line := tuple(exact(text or ""))):
                    lines[line].append(row)
                    for word in line:
                        if word not in SIGNS:
                            anchors[word.casefold()].add(ANY)
                    if all(t in SIGNS for t in line):
                        anchors[line[0]].add(ANY)
                continue
            windows = window_hashes(hashes[kind], length)
            places = [p for p in range(len(windows)) if _literal(tokens, p, length)]
            if places:
                add(kind, row, tokens, values, length, windows, places)
            if kind == NAMES or len(places) == len(windows):
                continue
            for other, (tokens, values) in ((EXACT, (exact(text), None)), (SIGNED, signed(text))):
                length = min(WINDOW, len(tokens))
                places = [p for p in range(len(tokens) - length + 1) if other == SIGNED or any(t not in SIGNS for t in tokens[p : p + length])]
                if not places or other == SIGNED and not (any(t[0].isalpha() for t in tokens) and sum(t not in (NUM, UNIT) for t in tokens) >= LITERALS * len(tokens)):
                    continue
                words.update((t, _hash(t) >> 4) for t in tokens)
                windows = window_hashes(np.array([words[t] for t in tokens], dtype=np.uint64), length)
                add(other, row, tokens, values or [""] * len(tokens), length, windows, places)
    looked_for = {*row_of, *(row for found_in in lines.values() for row in found_in)}
    unseen = [item_id for row, (item_id, _) in enumerate(rows) if row not in looked_for]
    tables: tuple[dict, ...] = ({}, {}, {}, {})
    for kind in (WORDS, NAMES, EXACT, SIGNED):
        for length, entries in found[kind].items():
            entries.sort()
            tables[kind][length] = (np.array([e[0] for e in entries], dtype=np.uint64), np.array([e[1] for e in entries]), np.array([e[2] for e in entries]))
    return Index(items, row_of, [r[0] for r in rows], dict(lines), frozenset(t for i in items for t in i[1]), dict(anchors), coverage, unseen, words, tables)


def coverage_of(kind: int, coverage: float) -> float:
    """The share of an item's windows that must be there."""
    return 1.0 if kind == SIGNED else coverage


def least_of(kind: int, coverage: float, windows: int) -> float:
    return min(coverage_of(kind, coverage) * windows, RUN)


class Anchors:
    """Finds out whether a text has any of an index's anchors."""

    def __init__(self, index: Index) -> None:
        self.finder = ahocorasick.Automaton()
        for word, followers in index.anchors.items():
            self.finder.add_word(word, (len(word), None if ANY in followers else followers))
        self.finder.make_automaton()
        self.some = bool(index.anchors)

    def any_in(self, text: str) -> bool:
        if not self.some:
            return False
        text = text.casefold()
        for end, (n, followers) in self.finder.iter(text):
            inside = text[end].isalpha() and (end >= n and text[end - n].isalpha() or end + 1 < len(text) and text[end + 1].isalpha())
            if not inside:
                follower = followers and _REAL.search(text, end + 1)
                if followers is None or follower and follower[0] in followers:
                    return True
        return False


def _consistent(pairs: list[tuple[int, int]], length: int, mine: list[str], theirs: list[str], tokens: list[str]) -> tuple[set[int], bool]:
    """Item positions of the windows whose placeholders agree with the majority, and whether any value was replaced."""
    slots = [[(k, mine[d + k], theirs[p + k]) for k in range(length) if tokens[p + k][0] == "<"] for d, p in pairs]
    to, back = defaultdict(Counter), defaultdict(Counter)
    for (_, p), found in zip(pairs, slots, strict=True):
        for k, a, b in found:
            kind = tokens[p + k]
            to[kind, b][a] += 1
            back[kind, a][b] += 1
    best = lambda c: min(c, key=lambda x: (-c[x], x))
    to_best, back_best = {k: best(c) for k, c in to.items()}, {k: best(c) for k, c in back.items()}
    kept, changed = set(), False
    for (_, p), found in zip(pairs, slots, strict=True):
        if all(to_best[tokens[p + k], b] == a and back_best[tokens[p + k], a] == b for k, a, b in found):
            kept.add(p)
            changed |= any(a != b for _, a, b in found)
    return kept, changed


def _occurrences(pairs: list[tuple[int, int]], length: int, least: float) -> Iterator[list[tuple[int, int]]]:
    """Groups of hits that may be one occurrence of an item of ``length`` tokens, of ``least`` hits at least: all, those of one alignment, those of near alignments."""
    yield pairs
    pairs = sorted(pairs, key=lambda x: (x[0] - x[1], x[1]))
    shifts = [d - p for d, p in pairs]
    if shifts[0] == shifts[-1]:
        return
    done = 0
    for i, shift in enumerate(shifts):
        if i and shifts[i - 1] == shift:
            continue
        same, near = bisect_right(shifts, shift), bisect_right(shifts, shift + length // 2)
        if same - i >= least:
            yield pairs[i:same]
        if near > max(same, done) and near - i >= least:
            yield pairs[i:near]
        done = max(done, near)


def _longest_run(kept: set[int], places: list[int]) -> int:
    """How many of an item's windows, at most, are kept one after the other."""
    longest = run = 0
    for p in places:
        run = run + 1 if p in kept else 0
        longest = max(longest, run)
    return longest


def matches(text: str, index: Index, memo: Memo, anchors: Anchors | None = None) -> list[tuple[int | None, int, float, bool]]:
    """``(item id, consistent windows, their share, re-parameterised)`` of the items that a text contains; the template of the larger share counts."""
    if anchors is not None and not anchors.any_in(text):
        return []
    hashes = [*template_hashes(text, memo), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)]
    own = {}  # tokens and values of the templates with signs
    for kind in (EXACT, SIGNED):
        if index.tables[kind]:
            own[kind] = signed(text) if kind == SIGNED else ((t := exact(text)), [""] * len(t))
            hashes[kind] = np.array([index.words.get(t, 0) for t in own[kind][0]], dtype=np.uint64)
    best: dict[int, tuple] = {}
    for line in text.split("\n") if index.lines else ():
        for row in index.lines.get(tuple(exact(line)), ()):
            best[row] = (index.ids[row], 1, 1.0, False)
    for kind in (WORDS, NAMES, EXACT, SIGNED):
        coverage = coverage_of(kind, index.coverage)
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        run = longest_known(hashes[kind])
        for length, (keys, item, place) in index.tables[kind].items():
            if run < length:  # every window has a word that the benchmark lacks
                continue
            h = window_hashes(hashes[kind], length)
            lo = np.searchsorted(keys, h)
            for d in np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == h):
                k = lo[d]
                while k < len(keys) and keys[k] == h[d]:
                    hits[int(item[k])].append((int(d), int(place[k])))
                    k += 1
        hits = {i: pairs for i, pairs in hits.items() if len({p for _, p in pairs}) >= least_of(kind, index.coverage, len(index.items[i][4]))}
        if not hits:
            continue
        tokens, values = own[kind] if kind in own else canonical(text, kind == NAMES)
        for i, pairs in sorted(hits.items()):
            item_id, their_tokens, their_values, length, places = index.items[i]
            windows = len(places)
            least = least_of(kind, index.coverage, windows)
            pairs = [(d, p) for d, p in pairs if their_tokens[p : p + length] == tokens[d : d + length]]
            row = index.rows[i]
            for group in _occurrences(pairs, len(their_tokens), least) if pairs else ():
                kept, changed = ({p for _, p in group}, False) if kind == EXACT else _consistent(group, length, values, their_values, their_tokens)
                enough = len(kept) >= coverage * windows or len(kept) >= RUN and len({d - p for d, p in group}) == 1 and _longest_run(kept, places) >= RUN
                if enough and (row not in best or len(kept) / windows > best[row][2]):
                    best[row] = (item_id, len(kept), len(kept) / windows, changed)
                if len(kept) == windows:
                    break
    return [best[row] for row in sorted(best)]


def _rows_of(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def small_index(benchmark: DataFrame, coverage: float, block_bytes: int) -> Index | None:
    """The index of a benchmark of at most ``block_bytes`` of text, null for a larger one."""
    rows = _rows_of(benchmark)
    if (rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0) > block_bytes:
        return None
    index = build_index([tuple(r) for r in rows.collect()], coverage)
    if index.unseen:
        _log.warning("%d benchmark items have nothing to look for, the first of them: %s", len(index.unseen), index.unseen[:20])
    return index


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Rows as batches of ``size``; one empty batch if there are none."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*held, strict=True)) or [()] * len(schema), schema.types, strict=True)], schema=schema)


def _line_hash(tokens: tuple[str, ...]) -> int:
    return xxhash.xxh64_intdigest("\n".join(tokens), 10)


ITEM_WINDOWS = pa.schema([("item", pa.int64()), ("kind", pa.int32()), ("length", pa.int32()), ("hash", pa.int64()), ("places", pa.int64()), ("spare", pa.int64())])
TEXT_WINDOWS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("kind", pa.int32()), ("length", pa.int32()), ("hash", pa.int64())])
PAIRS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("item_id", pa.int64()), ("n_windows", pa.int64()), ("coverage", pa.float64()), ("changed", pa.bool_())])
_ddl = lambda schema: ", ".join(f"{f.name} { {'int64': 'bigint', 'int32': 'int', 'double': 'double', 'bool': 'boolean'}[str(f.type)] }" for f in schema)


def item_windows(items: DataFrame, coverage: float) -> DataFrame:
    """``(item, kind, length, hash, places, spare)``: the windows of ``items (item, text)`` and how often each stands in its item.

    ``spare``: windows of so many places can be left out, as one of the others must be met wherever the item is found.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for item, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                index = build_index([(item, text)], coverage)
                for line in index.lines:
                    yield item, LINE, len(line), int(np.uint64(_line_hash(line)).view(np.int64)), 1, 0
                for kind, tables in enumerate(index.tables):
                    for length, (keys, _, _) in tables.items():
                        spare = math.ceil(least_of(kind, coverage, len(keys))) - 1
                        own, places = np.unique(keys, return_counts=True)
                        for h, n in zip(own.view(np.int64).tolist(), places.tolist(), strict=True):
                            yield item, kind, length, h, n, spare

    return items.select("item", "text").mapInArrow(lambda batches: _batches(rows(batches), ITEM_WINDOWS), _ddl(ITEM_WINDOWS))


def text_windows(texts: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """``(k1, k2, kind, length, hash)``: the distinct windows of ``texts (k1, k2, text)`` in the kinds and lengths that the benchmark has."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, other = Memo(), {}
        for b in batches:
            for k1, k2, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                hashes: dict[int, np.ndarray] = dict(enumerate(template_hashes(text, memo)))
                for kind, of in ((EXACT, exact), (SIGNED, lambda t: signed(t)[0])):
                    if any(k == kind for k, _ in shapes):
                        tokens = of(text)
                        if len(other) > MEMO:
                            other.clear()
                        other.update((t, _hash(t) >> 4) for t in set(tokens) - other.keys())
                        hashes[kind] = np.array([other[t] for t in tokens], dtype=np.uint64)
                for kind, length in shapes:
                    if kind == LINE:
                        found = np.array(sorted({_line_hash(t) for line in text.split("\n") if len(t := tuple(exact(line))) == length}), dtype=np.uint64)
                    else:
                        found = np.unique(window_hashes(hashes[kind], length))
                    for at in range(0, len(found), 1 << 16):
                        part = found[at : at + (1 << 16)].view(np.int64)
                        n = len(part)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, k1)), pa.array(np.full(n, k2)), pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, length, np.int32)), pa.array(part)], schema=TEXT_WINDOWS)

    return texts.select("k1", "k2", "text").mapInArrow(rows, _ddl(TEXT_WINDOWS))


def _keyed(docs: DataFrame) -> tuple[list, list[str]]:
    """Two 64-bit hashes of id and text, and names for them that ``docs`` doesn't have; rows that agree in them are alike in all that counts here."""
    at = [F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit(""))]
    names = [free_name(docs, n) for n in ("k1", "k2")]
    return [F.xxhash64(*at).alias(names[0]), F.xxhash64(F.lit("2"), *reversed(at)).alias(names[1])], names


def pairs_by_hash(docs: DataFrame, benchmark: DataFrame, coverage: float) -> DataFrame:
    """``(k1, k2, item_id, n_windows, coverage, changed)``: documents, by their keys, and the items in them; a benchmark row that is repeated gives repeated rows.

    Windows of both sides are joined by hash, and each pair of a text and an item that share one is checked once with both whole texts.
    """
    small_batches(docs.sparkSession)
    items = materialize(_rows_of(benchmark).withColumn("item", F.monotonically_increasing_id()), "items")
    windows = materialize(item_windows(items, coverage), "item-windows")
    # an item's rarest windows by the number of items that have them
    common = windows.groupBy("kind", "length", "hash").agg(F.count("*").alias("n"))
    order = Window.partitionBy("item", "kind", "length").orderBy(F.desc("n"), "hash").rowsBetween(Window.unboundedPreceding, 0)
    ranked = windows.join(common, ["kind", "length", "hash"]).withColumn("before", F.sum("places").over(order))
    keys = materialize(ranked.where("before > spare").select("item", "kind", "length", "hash"), "item-keys")
    shapes = sorted((r["kind"], r["length"]) for r in keys.select("kind", "length").distinct().collect())  # a few lengths of each of five kinds
    texts = docs.select(*_keyed(docs)[0], F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).toDF("k1", "k2", "text")
    met = text_windows(texts, shapes).join(keys, ["kind", "length", "hash"]).select("k1", "k2", "item").distinct()
    met = materialize(met, "met")
    once = texts.join(met, ["k1", "k2"]).groupBy("k1", "k2", "item").agg(F.first("text").alias("text"))
    both = once.join(items.withColumnRenamed("text", "item_text"), "item")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for k1, k2, text, item_id, item_text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                index = build_index([(item_id, item_text)], coverage)
                for found in matches(text, index, Memo(index.known)):
                    yield k1, k2, *found

    return both.select("k1", "k2", "text", "item_id", "item_text").mapInArrow(lambda batches: _batches(check(batches), PAIRS), _ddl(PAIRS))


def not_looked_for(benchmark: DataFrame) -> DataFrame:
    """``(item_id)``: the benchmark's rows without any word, number or sign to look for."""
    schema = pa.schema([("item_id", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for item_id in build_index([row]).unseen:
                    yield (item_id,)

    return _rows_of(benchmark).mapInArrow(lambda batches: _batches(rows(batches), schema), _ddl(schema))


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, item_id, n_windows, coverage, changed)``: one row for each document row and item it contains.

    Null texts count as empty, repeated rows (of either side) give repeated results, an empty table gives an empty result, other columns are
    ignored. ``changed``: some number, name or unit differs from the item's.
    """
    small_batches(docs.sparkSession)
    index = small_index(benchmark, coverage, block_bytes)
    if index is None:
        found = materialize(pairs_by_hash(docs, benchmark, coverage), "contaminated")
        rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *_keyed(docs)[0]).toDF("doc_id", "k1", "k2")
        return rows.join(found, ["k1", "k2"]).drop("k1", "k2")
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), *((PAIRS.field(i).name, PAIRS.field(i).type) for i in range(2, len(PAIRS)))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        memo, anchors = Memo(index.known), Anchors(index)
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for m in matches(text, index, memo, anchors):
                    yield doc, *m

    return slim.mapInArrow(lambda batches: _batches(rows(batches), schema), _ddl(schema))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that contain a benchmark item; all columns as they are; with a small benchmark nothing is shuffled."""
    small_batches(docs.sparkSession)
    index = small_index(benchmark, coverage, block_bytes)
    if index is None:
        found = materialize(pairs_by_hash(docs, benchmark, coverage).select("k1", "k2").distinct(), "contaminated")
        keys, names = _keyed(docs)
        return docs.select("*", *keys).join(found.toDF(*names), names, "left_anti").drop(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, anchors = Memo(index.known), Anchors(index)
        for b in batches:
            clean = [not matches(t or "", index, memo, anchors) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, schema)
