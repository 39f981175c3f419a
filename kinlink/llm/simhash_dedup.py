"""SimHash near-dedup: links by a self-join of binary tries, groups by connected components.

Fingerprints. A-Z are lower-cased, words are the runs of bytes other than space and 0x09-0x0D, and
each occurrence of a shingle of ``width`` words (the whole sequence where there are fewer) votes with
the bits of its XXH64. A bit is set if it is set in over half of the hashes. No words: fingerprint 0,
which links like any other.

Trie join. A binary trie of the fingerprints is joined with itself: pairs of nodes are walked down together, a pair
has the differing bits of all it has read so far, and it is dropped once they exceed the radius, with all the leaves below.
Edges are compressed: a node reads, at once, the bits that all its leaves share. One trie serves up to ``SUBTREE`` fingerprints.
More are dealt to many tasks: two fingerprints that differ in at most ``radius`` bits agree on at least ``blocks - radius`` of
``blocks`` blocks, so they share a subtree in one of the tries that read so many blocks, or the first bits of these, before all others;
no more bits are read first than it takes for subtrees of ``SUBTREE`` fingerprints. A
subtree of more than ``leaf_limit`` fingerprints is dealt out by its next bits, in pairs of parts whose bits differ
within the radius (and a part that still is too large, by hash), which loses no link.
A unit returns a spanning forest of its links, never all pairs of a group.

Copies with edits move more bits of a SimHash than its radius allows, so the corpus stage (``keep_one_of_each``) takes
``BANDS`` prints over five-word shingles, each a byte of ``ROWS`` MinHashes, and joins each of them by the same tries
and radius: a MinHash that two texts don't share costs four bits on average, so a pair of Jaccard similarity j is met by a
print with a probability of j^8 + 8 j^7 (1 - j) 163/256 + 28 j^6 (1 - j)^2 0.038 and by one of all with 0.9999 at 0.8,
wherever the texts differ. A pair is accepted only if their sketches of ``CHECK_BITS`` one-bit MinHashes differ in at most
``CHECK_RADIUS`` bits (a similarity of j gives CHECK_BITS * (1 - j) / 2 on average, so a pair passes with a probability of
0.98 at 0.8, 0.3 at 0.75 and 0.003 at 0.7). The tries are walked twice (``checked_links``): with the distinct prints alone,
then with the sketches of the texts whose prints met another.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.llm.common import free_name, materialize, release, sized, small_batches

SEED = 42
WIDTH = 4
RADIUS = 4
SUBTREE = 512
LEAF_LIMIT = 4096
NEXT_BITS = 8
SLICE = 1 << 18
FRONTIER = 1 << 14
PIECE = 250_000  # rows of units for each task, about
BANDS, ROWS = 18, 8  # together 144 of the MinHashes, a byte of each
SHINGLE = 5
CHECK_BITS = 1024
CHECK_RADIUS = 122
CHECKS = [f"c{i}" for i in range(CHECK_BITS // 64)]


def simhash(raw: bytes, width: int = WIDTH) -> int:
    """The unsigned 64-bit fingerprint of a text in UTF-8."""
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))
    return _majority(_hash_all(shingles))


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """Another 64-bit hash of each hash (multiply and xor-shift)."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _majority(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = np.ascontiguousarray(hashes[at : at + (1 << 14)])
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0])


def _hash_all(items: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in items), dtype=np.uint64, count=len(items))


_FACTORS = _mixed(np.arange(CHECK_BITS, dtype=np.uint64), 1) | np.uint64(1)


def shingles_of(raw: bytes) -> set[bytes]:
    """The distinct five-word shingles; the whole sequence where there are fewer words."""
    words = raw.lower().split()
    if len(words) < SHINGLE:
        return {b" ".join(words)}
    return set(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False)))


def sketches(raw: bytes) -> list[int]:
    """``BANDS`` prints, each the high bytes of ``ROWS`` MinHashes of the five-word shingles, and a sketch of one bit of each of ``CHECK_BITS`` MinHashes."""
    g = _hash_all(list(shingles_of(raw)))
    low = np.full(CHECK_BITS, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(g), 1 << 8):
        low = np.minimum(low, (g[at : at + (1 << 8), None] * _FACTORS[None, :]).min(axis=0))
    low = _mixed(low, 2)
    prints = (low[: BANDS * ROWS] >> np.uint64(56)).astype(np.uint8).view(np.uint64)
    return [*prints.tolist(), *np.packbits((low & np.uint64(1)).astype(bool), bitorder="little").view(np.uint64).tolist()]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint of every whole text as a signed 64-bit integer; null text counts as empty."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([simhash(t or b"", width) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


def blocks_for(n: int, radius: int = RADIUS, subtree: int = SUBTREE) -> int:
    """The fewest blocks whose subtrees can be as small as ``subtree`` of ``n`` spread fingerprints."""
    for blocks in range(radius + 1, 64):
        if n >> ((64 // blocks) * (blocks - radius)) <= subtree:
            return blocks
    return 64


def spans_of(blocks: int) -> list[tuple[int, int]]:
    """Lowest bit and width of each block."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(blocks)]


def tries_of(n: int, radius: int = RADIUS, subtree: int = SUBTREE) -> list[tuple[int, int]]:
    """For each trie the mask of the bits that it reads first and that of up to ``NEXT_BITS`` bits that it reads next, for ``n`` fingerprints.

    Radius 0: all bits come first. Else subtrees of about ``subtree`` spread fingerprints; one trie without lead bits where that's enough.
    """
    if radius == 0:
        return [((1 << 64) - 1, 0)]
    blocks = blocks_for(n, radius, subtree)
    lead = max(0, (max(n, 1) - 1) // subtree).bit_length()
    if not lead:
        return [(0, ((1 << NEXT_BITS) - 1) << (64 - NEXT_BITS))]
    top = lambda span, width: ((1 << min(width, span[1])) - 1) << (span[0] + span[1] - min(width, span[1]))
    spans, out = spans_of(blocks), []
    for chosen in combinations(range(blocks), blocks - radius):
        mask, left = 0, lead
        for k, i in enumerate(chosen):
            take = min(spans[i][1], -(-left // (len(chosen) - k)))
            mask |= top(spans[i], take)
            left -= take
        first = next(i for i in range(blocks) if i not in chosen)
        out.append((mask, top(spans[first], NEXT_BITS)))
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def remaining_bits(fps: np.ndarray, mask: int) -> tuple[np.ndarray, int]:
    """The bits outside a mask, packed, and how many they are."""
    out, at, bit = np.zeros(len(fps), dtype=np.uint64), 0, 0
    while bit < 64:
        width = 0
        while bit + width < 64 and not mask >> (bit + width) & 1:
            width += 1
        if width:
            out |= ((fps >> np.uint64(bit)) & np.uint64((1 << width) - 1)) << np.uint64(at)
            at += width
        bit += width + 1
    return out, at


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [lo, lo + n), one after the other."""
    ends = np.cumsum(n)
    return np.repeat(lo - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


def join_tries(
    keys: np.ndarray, starts: np.ndarray, middles: np.ndarray, ends: np.ndarray, radius: int, check: np.ndarray, check_radius: int, counts: dict[str, int] | None = None
) -> np.ndarray:
    """A label for each index, equal for the indices that links within a unit connect, from the tries of many units at once.

    ``keys`` ascend within [start, middle) and within [middle, end) of a unit; ``check`` has a row for each. If
    middle == end the unit joins one trie with itself, else its two tries. The walk takes ``FRONTIER`` node pairs at a time and
    drops pairs whose leaves are connected already, so a dense group costs neither memory nor all its pairs.
    ``counts``, if given, gets the numbers of node pairs ``visited``, ``pruned`` for their bits, ``tied`` already, and ``leaves`` met.
    """
    label = np.arange(len(keys))
    selfs = middles == ends
    lo, hi, bit, child = trie_nodes(keys, np.r_[starts, middles[~selfs]], np.r_[middles, ends[~selfs]])
    second = np.arange(len(starts))
    second[~selfs] = len(starts) + np.arange((~selfs).sum())
    head, leaf = keys[lo], bit == 0
    read = ~np.where(leaf, np.uint64(0), (bit << np.uint64(1)) - np.uint64(1))  # the bits that all leaves of a node share
    whole = np.where(hi - lo == 1, lo, -1)  # the label of a node whose leaves are all connected, else -1
    todo = [(np.arange(len(starts)), second)]
    count = counts if counts is not None else {}
    while todo:
        a, b = todo.pop()
        if len(a) > FRONTIER:
            todo += [(a[i : i + FRONTIER], b[i : i + FRONTIER]) for i in range(0, len(a), FRONTIER)]
            continue
        # all that both nodes have read: the bits above the first one where either branches
        near = np.flatnonzero(np.bitwise_count((head[a] ^ head[b]) & read[a] & read[b]) <= radius)
        visited, a, b = len(a), a[near], b[near]
        tied = (whole[a] == whole[b]) & (whole[a] >= 0)
        met = ~tied & leaf[a] & leaf[b]
        for name, n in (("visited", visited), ("pruned", visited - len(near)), ("tied", tied.sum()), ("leaves", met.sum())):
            count[name] = count.get(name, 0) + int(n)
        if met.any():
            first, last = a[met], b[met]
            flip = lo[first] > lo[last]
            first[flip], last[flip] = last[flip], first[flip]
            fresh = _leaf_links(keys, lo[first], hi[first], lo[last], hi[last], radius, check, check_radius, label)
            if fresh is not label:
                label = fresh
                runs = np.r_[0, np.cumsum(label[1:] != label[:-1])]
                whole = np.where(runs[lo] == runs[hi - 1], label[lo], -1)
        deep = ~tied & ~met
        a, b = a[deep], b[deep]
        if not len(a):
            continue
        same = a == b
        one, two = child[a[same]], ~same
        split_a = bit[a[two]] >= bit[b[two]]
        split, other = child[np.where(split_a, a[two], b[two])], np.where(split_a, b[two], a[two])
        # two nodes: the children of the one that branches first with the other; a node with itself: its children with each other and, walked first, with themselves
        pairs = ((split, other), (split + 1, other), (one, one + 1), (one, one), (one + 1, one + 1))
        todo.append(tuple(np.concatenate(x) for x in zip(*pairs, strict=True)))
    return label


def trie_nodes(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(lo, hi, bit, child)`` of all nodes of the tries over ranges of ascending keys, whose roots come first.

    ``bit``: the highest one in which a node's leaves differ, 0 for a leaf (of equal keys). ``child``: its 0-child; the 1-child is the next node.
    """
    levels, made = [], 0
    while len(lo):
        bit = _highest(keys[lo] ^ keys[hi - 1])
        inner = bit != 0
        made += len(lo)
        child = np.where(inner, made + 2 * (np.cumsum(inner) - 1), -1)
        levels.append((lo, hi, bit, child))
        lo, hi = lo[inner], hi[inner]
        mid = _child(keys, lo, hi, bit[inner])
        lo, hi = np.stack([lo, mid], axis=1).ravel(), np.stack([mid, hi], axis=1).ravel()
    return tuple(np.concatenate(x) for x in zip(*levels, strict=True)) if levels else (lo, hi, keys[:0], lo)


def _highest(x: np.ndarray) -> np.ndarray:
    """The highest set bit of each number, alone; 0 for 0."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x | (x >> np.uint64(shift))
    return x ^ (x >> np.uint64(1))


def _child(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Where the 1-child of each node begins, whose leaves first differ in ``bit``: a binary search in all nodes at once."""
    lo, hi = lo.copy(), hi.copy()
    while (lo < hi).any():
        m = (lo + hi) >> 1
        up = (lo < hi) & ((keys[np.minimum(m, len(keys) - 1)] & bit) == 0)
        lo, hi = np.where(up, m + 1, lo), np.where(up | (lo >= hi), hi, m)
    return lo


def _leaf_links(keys: np.ndarray, a_lo: np.ndarray, a_hi: np.ndarray, b_lo: np.ndarray, b_hi: np.ndarray, radius: int, check: np.ndarray, check_radius: int, label: np.ndarray) -> np.ndarray:
    """``label`` after comparing all leaves of each node pair, about ``SLICE`` comparisons at a time."""
    step = np.maximum(1, SLICE // (b_hi - b_lo))
    stripes = -(-(a_hi - a_lo) // step)
    if (stripes > 1).any():  # nodes of many equal keys
        first = np.repeat(a_lo, stripes) + _ranges(np.zeros(len(stripes), dtype=np.int64), stripes) * np.repeat(step, stripes)
        a_lo, a_hi, b_lo, b_hi = first, np.minimum(first + np.repeat(step, stripes), np.repeat(a_hi, stripes)), np.repeat(b_lo, stripes), np.repeat(b_hi, stripes)
    na, nb = a_hi - a_lo, b_hi - b_lo
    total = np.cumsum(na * nb)
    at = 0
    while at < len(na):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE, side="right")))
        n, m = na[at:to], nb[at:to]
        if to == at + 1 and (label[a_lo[at] : a_hi[at]] == label[a_lo[at]]).all() and (label[b_lo[at] : b_hi[at]] == label[a_lo[at]]).all():
            at = to
            continue
        left = np.repeat(_ranges(a_lo[at:to], n), np.repeat(m, n))
        right = np.repeat(b_lo[at:to], n * m) + _ranges(np.zeros(len(n), dtype=np.int64), n * m) % np.repeat(m, n * m)
        near = (left < right) & (np.bitwise_count(keys[left] ^ keys[right]) <= radius)
        left, right = left[near], right[near]
        if check.shape[1]:
            near = np.bitwise_count(check[left] ^ check[right]).sum(axis=1) <= check_radius
            left, right = left[near], right[near]
        if len(left):
            label = forest(len(keys), left, right, label)
        at = to
    return label


def forest(n: int, left: np.ndarray, right: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest index of each index's component, by hooking and pointer jumping."""
    label = np.arange(n) if label is None else label.copy()
    while len(left):
        a, b = label[left], label[right]
        open_ = a != b
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def _unit_links(rows: dict[str, np.ndarray], tries: list[tuple[int, int]], radius: int, check_radius: int, counts: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the units in ``rows`` (columns trie, unit, side, fp, node, and check with a row for each; units are contiguous)."""
    fps = rows["fp"].view(np.uint64)
    rest = np.zeros(len(fps), dtype=np.uint64)
    for t in np.unique(rows["trie"]):
        pick = rows["trie"] == t
        rest[pick] = remaining_bits(fps[pick], tries[t % len(tries)][0])[0]
    order = np.lexsort((rest, rows["side"], rows["unit"]))
    keys, unit, side, node, check = rest[order], rows["unit"][order], rows["side"][order], rows["node"][order], rows["check"][order]
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    ends = np.r_[starts[1:], len(unit)]
    two = np.add.reduceat(side, starts)
    middles = np.where(two == 0, ends, ends - two)
    both = middles > starts  # a unit of two parts may lack one of them
    label = join_tries(keys, starts[both], middles[both], ends[both], radius, check, check_radius, counts)
    tied = np.flatnonzero(label != np.arange(len(node)))
    return node[tied], node[label[tied]]


def trie_units(prints: DataFrame, radius: int, leaf_limit: int, checks: list[str]) -> tuple[DataFrame, list[tuple[int, int]], int]:
    """``(trie, key, i, j, side, fp, node, *checks)``: the rows of each unit of work; the tries that were made; and about how many rows they take.

    A unit is a subtree (``trie``, ``key``) or, in a large one, a pair of its parts ``i <= j``, the rows of ``j`` on side 1.
    """
    most, rows = prints.groupBy("seed").count().agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
    tries = tries_of(most, radius)
    mask = lambda m: F.lit(m - (1 << 64) if m >> 63 else m)
    # the next bits, brought to the low end of the word
    after = lambda m: F.shiftrightunsigned(F.col("fp").bitwiseAND(mask(m)), (m & -m).bit_length() - 1).cast("int") if m else F.lit(0)
    lead = F.array(*(F.struct((F.col("seed") * len(tries) + t).cast("int").alias("trie"), F.col("fp").bitwiseAND(mask(m)).alias("key"), after(a).alias("next")) for t, (m, a) in enumerate(tries)))
    keyed = prints.where("fp is not null").select("fp", "node", *checks, F.explode(lead).alias("s")).select("fp", "node", *checks, "s.*")
    # a subtree of more than leaf_limit has a part for each value of its next bits, and several by hash for a value that has more than leaf_limit
    sizes = materialize(keyed.groupBy("trie", "key").agg(F.count("*").alias("n")).where("n > 1"), "subtree-sizes", rows * len(tries) // 2)
    large = keyed.join(sizes.where(f"n > {leaf_limit}").select("trie", "key"), ["trie", "key"], "left_semi").groupBy("trie", "key", "next").agg(F.count("*").alias("n"))
    large = large.groupBy("trie", "key").agg(F.collect_list(F.struct("next", F.ceil(F.col("n") / leaf_limit).cast("int").alias("parts"))).alias("parts"))
    parts = sizes.select("trie", "key").join(large, ["trie", "key"], "left")
    # written before they are joined, so that the rows of a giant subtree can be split
    parts = materialize(parts, "subtrees", rows * len(tries) // 2)
    met = keyed.join(parts, ["trie", "key"]).withColumn("own", F.pmod(F.xxhash64("node"), F.lit(1 << 20)).cast("int"))
    # the parts, as next * 2^20 + number, that a row's part meets
    own = "next * 1048576L + own % filter(parts, x -> x.next = next)[0].parts"
    theirs = f"flatten(transform(filter(parts, x -> bit_count(x.next ^ next) <= {radius}), x -> transform(sequence(0, x.parts - 1), p -> x.next * 1048576L + p)))"
    seats = f"if(parts is null, array(struct(0L as i, 0L as j, 0 as side)), transform({theirs}, p -> struct(least(p, {own}) as i, greatest(p, {own}) as j, if(p < {own}, 1, 0) as side)))"
    return met.withColumn("s", F.explode(F.expr(seats))).select("trie", "key", "s.i", "s.j", "s.side", "fp", "node", *checks), tries, rows * len(tries)


def trie_links(prints: DataFrame, radius: int = RADIUS, leaf_limit: int = LEAF_LIMIT, checks: list[str] | None = None, check_radius: int = 0) -> DataFrame:
    """``(u, v)``: links between nodes whose components are those of all linked pairs.

    ``prints`` has ``(seed int, fp bigint, node bigint)`` and the bigint columns ``checks``; two nodes are linked if for one seed their ``fp`` differ in at most
    ``radius`` bits and their ``checks`` in at most ``check_radius`` altogether. A node has one row for each seed at most. Null ``fp`` link nothing.
    """
    spark, checks = prints.sparkSession, checks or []
    dealt, tries, rows = trie_units(prints, radius, leaf_limit, checks)
    unit = ["trie", "key", "i", "j"]
    rows_limit = 1 << 14

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def links(table: pa.Table) -> pa.RecordBatch:
            c = {n: table.column(n).to_numpy() for n in table.schema.names}
            new = np.r_[False, np.logical_or.reduce([c[k][1:] != c[k][:-1] for k in unit])]
            check = np.stack([c[k].view(np.uint64) for k in checks], axis=1) if checks else np.zeros((table.num_rows, 0), dtype=np.uint64)
            u, v = _unit_links({"trie": c["trie"], "fp": c["fp"], "node": c["node"], "unit": np.cumsum(new), "side": c["side"].astype(np.int64), "check": check}, tries, radius, check_radius)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for b in batches:
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if held.num_rows < rows_limit:
                continue
            changes = np.logical_or.reduce([(x := held.column(k).to_numpy())[1:] != x[:-1] for k in unit])
            last = np.flatnonzero(changes)
            if len(last):
                yield links(held.slice(0, last[-1] + 1))
                held = held.slice(last[-1] + 1).combine_chunks()
        if held is not None and held.num_rows:
            yield links(held)

    small_batches(spark)
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // PIECE)
    return dealt.repartition(pieces, *unit).sortWithinPartitions(*unit).mapInArrow(run, "u bigint, v bigint")


def checked_links(nodes: DataFrame, prints: list[str], checks: list[str], radius: int, check_radius: int) -> DataFrame:
    """``(u, v)`` as ``trie_links`` gives them, for ``nodes (node, *prints, *checks)``, each print a seed of its own.

    Sketches are many times as wide as a print, so the tries are walked with the distinct prints alone first, and only
    prints that met another one or that several nodes share are walked again, with the sketches: no link is lost.
    """
    seeds = F.explode(F.array(*(F.struct(F.lit(i).alias("seed"), F.col(f).alias("fp")) for i, f in enumerate(prints))))
    slim = nodes.select("node", seeds.alias("s")).select("s.seed", "s.fp", "node")
    distinct = materialize(slim.groupBy("seed", "fp").agg(F.count("*").alias("n")), "distinct-prints")
    met = materialize(trie_links(distinct.select("seed", "fp", F.col("fp").alias("node")), radius), "met-prints")
    # a value that met another one under a second seed only costs a few rows
    shared = met.select(F.col("u").alias("fp")).union(met.select("v")).union(distinct.where("n > 1").select("fp")).distinct()
    # both sides are written before they are joined, so that the rows of a print that many nodes share can be split
    shared = materialize(shared, "shared-prints")
    again = materialize(slim.join(shared, "fp", "left_semi").select("seed", "fp", "node"), "prints-to-check")
    release(distinct, met, shared)
    return trie_links(again.join(nodes.select("node", *checks), "node"), radius, checks=checks, check_radius=check_radius)


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``links (u, v)``: alternating large and small stars until nothing changes.

    Only minima are aggregated, never lists, so a hub's many links are joined, not collected; each round is written to the shared folder.
    """
    pairs = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v"), label)
    now = materialize(pairs.distinct(), label, pairs.count())
    release(pairs)
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (seen["n"], seen["x"]) == mark or not seen["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
        mark = (seen["n"], seen["x"])
        both = now.union(now.select(F.col("v"), F.col("u")))
        # minima are written before they are joined, so that the join's sides are plain exchanges and a hub's links can be split
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), label, 2 * seen["n"])
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, label, 2 * seen["n"])
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), label, seen["n"])
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least).distinct()
        before, now = now, materialize(small, label, 2 * seen["n"])
        release(before, low, large, least)


def _hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def groups(docs: DataFrame, radius: int = RADIUS, width: int = WIDTH) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest non-null doc_id that links reach, itself included. Null text counts as empty, repeated rows are
    kept and share their group, an empty table gives an empty result, other columns are ignored.
    """
    prints = materialize(fingerprint_documents(docs, width=width), "simhash")
    n = prints.count()
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints", n)
    nodes = distinct.select(F.lit(0).alias("seed"), "fp", F.col("fp").alias("node"))
    roots = components(trie_links(nodes, radius), "stars")
    rooted = materialize(distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted", n)
    # written before it is joined, so that the rows of a giant component can be split
    lowest = materialize(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "lowest", n)
    classes = materialize(rooted.join(lowest, "root").select("fp", "component_id"), "classes", n)
    return sized(prints.join(classes, "fp").select("doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id"), n)


def sketch_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, f0 .. f17, c0 .. c15, digest)``: the sketches of every whole text, and its XXH64 as Spark has it; null text counts as empty."""
    small_batches(docs.sparkSession)
    names = ["doc_id", *(f"f{i}" for i in range(BANDS)), *CHECKS, "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            made = np.array([[*sketches(t), xxhash.xxh64_intdigest(t, SEED)] for t in texts], dtype=np.uint64).reshape(-1, len(names) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.ascontiguousarray(made[:, i]).view(np.int64)) for i in range(len(names) - 1))], names=names)

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def keep_one_of_each(docs: DataFrame, radius: int = RADIUS, check_radius: int = CHECK_RADIUS) -> DataFrame:
    """``docs`` without near copies: of each group of linked documents, that of the smallest doc_id stays, once.

    All columns are kept as they are. Rows with a null doc_id are kept. Null texts count as empty, and empty texts are copies of each other.
    Different texts under one doc_id are documents of their own. An empty table gives an empty table.
    """
    made = materialize(sketch_documents(docs), "sketches")
    own = [f"f{i}" for i in range(BANDS)]
    known = made.where("doc_id is not null")
    twice = known.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0
    first = known.groupBy(*own, *CHECKS).agg(F.min(F.struct("doc_id", "digest")).alias("first"))
    classes = materialize(first.withColumn("node", F.xxhash64(*own, *CHECKS) if twice else F.col("first.doc_id")), "copies", made.count())
    roots = components(checked_links(classes.select("node", *own, *CHECKS), own, CHECKS, radius, check_radius), "near-copies")
    # one plan at every size: texts are dealt out by id, and ids are never sent whole to all machines
    if twice:
        rooted = classes.join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "first")
        kept = rooted.groupBy("root").agg(F.min("first").alias("first"))
        kept = materialize(kept.select(F.col("first.doc_id").alias("doc_id"), F.col("first.digest").alias("digest")), "kept", classes.count())
        digest = free_name(docs, "digest")
        marked = docs.withColumn(digest, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
        stay = marked.join(kept.withColumnRenamed("digest", digest).hint("merge"), ["doc_id", digest], "left_semi").dropDuplicates(["doc_id", digest]).drop(digest)
    else:
        kept = classes.select("node").join(roots.where("node <> root"), "node", "left_anti")
        kept = materialize(kept.select(F.col("node").alias("doc_id")), "kept", classes.count())
        stay = docs.join(kept.hint("merge"), "doc_id", "left_semi")
    return stay.unionByName(docs.where("doc_id is null"))
