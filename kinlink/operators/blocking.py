"""Candidate generation: pairs of a left and a right entity that are worth comparing.

All strategies return ``entity_id_left, entity_id_right, blocking_score, blocking_method``. They are equi-joins on a derived key (a
prefix, a token, a character n-gram), never all pairs; the top of each left entity is taken by ``row_number``,
which Spark limits before it shuffles. Ties go to the smaller right id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.config import BlockingConfig
from kinlink.operators.gram_search import Block, Part, numbers_of
from kinlink.schemas import COUNTRY, ENTITY_ID, LEFT, METHOD, RIGHT, SCORE, column_or_null

#: Right sides of at most so many n-grams (2 or 4 bytes each) may be sent to all machines.
INDEX_WEIGHTS = 1_000_000
#: So many n-grams of each side, about, meet at a time in one task where the right side is larger.
CELL_WEIGHTS = 1_000_000
#: At most so many different n-grams may be sent to all machines, with their idf.
VOCABULARY = 1_000_000
COLUMNS = [LEFT, RIGHT, SCORE, METHOD]


def _pairs(df: DataFrame, score: Column, method: str) -> DataFrame:
    return df.select(LEFT, RIGHT, score.cast("double").alias(SCORE), F.lit(method).alias(METHOD))


def _top(df: DataFrame, k: int, order: list[Column], *group: str) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("_rank") <= k).drop("_rank")


def _shard_join(left: DataFrame, right: DataFrame, key: Column, method: str, most: int | None) -> DataFrame:
    """Pairs of equal keys. ``most``: only the ``most`` smallest right ids of a key (and one, for a pair of an id with itself).

    All pairs have score 1 and ties go to the smaller right id, so where each left id keeps its best ``most``, the others can't be among them.
    A key of n right ids then gives each left id at most ``most`` + 1 pairs, not n.
    """
    side = lambda df, name: df.select(F.col(ENTITY_ID).alias(name), key.alias("_key")).where("_key is not null")
    rights = side(right, RIGHT)
    if most is not None:
        rights = _top(rights, most + 1, [F.col(RIGHT)], "_key")
    met = side(left, LEFT).join(rights, "_key").where(F.col(LEFT) != F.col(RIGHT))
    return _pairs(met, F.lit(1.0), method)


def token_sort_candidates(left: DataFrame, right: DataFrame, prefix_len: int = 5, most: int | None = None) -> DataFrame:
    """Entities whose token-sorted names begin alike; score 1. A table joined with itself gives both directions. ``most``: as many as a later cap can keep."""
    return _shard_join(left, right, F.substring("token_sorted_name", 1, prefix_len), "token_sort", most)


def _present_address(df: DataFrame) -> Column:
    """The normalised address of rows whose address isn't flagged as missing (no flag: all are)."""
    missing = F.coalesce(column_or_null(df, "address_missing", "boolean"), F.lit(True))
    return F.when(~missing & (F.trim("normalized_address") != ""), F.col("normalized_address"))


def address_prefix_candidates(left: DataFrame, right: DataFrame, prefix_len: int = 8, most: int | None = None) -> DataFrame:
    """Entities whose normalised addresses begin alike; score 1; rows without address take no part. ``most``: as many as a later cap can keep."""
    keyed = lambda df: df.withColumn("_address", _present_address(df))
    return _shard_join(keyed(left), keyed(right), F.substring("_address", 1, prefix_len), "addr_prefix", most)


def rare_token_candidates(left: DataFrame, right: DataFrame, rarity: float = 0.005, text_col: str = "normalized_name", max_per_entity: int = 50) -> DataFrame:
    """Entities that share tokens which few right entities have (``rarity`` of them, at least 1); score: shared over the left's rare tokens."""
    words = lambda df, name: df.where(F.col(text_col).isNotNull()).select(F.col(ENTITY_ID).alias(name), F.explode(F.array_distinct(F.split(text_col, " "))).alias("token")).where("token <> ''")
    # the number of right rows is one value, aggregated in the plan, not by a job of its own
    size = right.where(F.col(text_col).isNotNull()).agg(F.greatest(F.floor(F.count("*") * F.lit(rarity)), F.lit(1)).alias("most"))
    rights = words(right, RIGHT)
    rare = rights.groupBy("token").agg(F.count("*").alias("df")).join(F.broadcast(size), F.col("df") <= F.col("most")).select("token")
    lefts = words(left, LEFT).join(rare, "token", "left_semi")
    n_rare = lefts.groupBy(LEFT).agg(F.count("*").alias("n_rare"))
    shared = lefts.join(rights, "token").where(F.col(LEFT) != F.col(RIGHT)).groupBy(LEFT, RIGHT).agg(F.count("*").alias("shared"))
    best = _top(shared, max_per_entity, [F.col("shared").desc(), F.col(RIGHT)], LEFT)
    return _pairs(best.join(n_rare, LEFT), F.col("shared") / F.col("n_rare"), "rare_token")


def ngrams(c: Column, low: int, high: int) -> Column:
    """Character n-grams inside words: each word stands between two spaces, and a word shorter than an n ends the series."""
    words = F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def grams(word: Column) -> Column:
        of = lambda n: F.when(F.length(word) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.length(word) - n + 1, F.lit(1))), lambda i: F.substring(word, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
        return F.when(F.length(word) < low, F.array(word)).otherwise(F.concat(*(of(n) for n in range(low, high + 1))))

    return F.flatten(F.transform(padded, grams))


def tfidf_weights(left: DataFrame, right: DataFrame, low: int, high: int, text_col: str, group_col: str | None = None) -> DataFrame:
    """``side, id, [group,] gram, w``: sublinear tf times smoothed idf over both sides together, rows of length 1.

    With ``group_col`` the number of rows and the document frequencies are counted inside each group.
    """
    group = ["grp"] if group_col else []
    rows = lambda df, side: df.where(F.col(text_col).isNotNull()).select(
        F.lit(side).alias("side"), F.col(ENTITY_ID).alias("id"), *([F.coalesce(F.col(group_col), F.lit("unknown")).alias("grp")] if group_col else []), F.col(text_col).alias("text")
    )
    both = rows(left, "l").unionByName(rows(right, "r"))
    tf = both.select("side", "id", *group, F.explode(ngrams(F.col("text"), low, high)).alias("gram")).groupBy("side", "id", *group, "gram").agg(F.count("*").alias("n"))
    total = both.groupBy(*group).agg(F.count("*").alias("total"))
    df = tf.groupBy(*group, "gram").agg(F.count("*").alias("df"))
    df = (df.join(total, group) if group else df.join(F.broadcast(total))).select(*group, "gram", (F.log((1 + F.col("total")) / (1 + F.col("df"))) + 1).alias("idf"))
    raw = tf.join(df, [*group, "gram"]).withColumn("w", (1 + F.log("n")) * F.col("idf"))
    norm = raw.groupBy("side", "id", *group).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, ["side", "id", *group]).select("side", "id", *group, "gram", (F.col("w") / F.col("norm")).alias("w"))


class _GramIndex:
    """Right rows and weights by gram."""

    def __init__(self, table: pa.Table) -> None:
        self.ids, row = np.unique(np.array(table.column("id").to_pylist(), dtype=object), return_inverse=True)
        gram = np.array(table.column("gram").to_pylist(), dtype=object)
        order = np.argsort(gram, kind="stable")
        names, starts = np.unique(gram[order], return_index=True)
        ends = np.r_[starts[1:], len(order)][: len(starts)]
        self.at = {g: (s, e) for g, s, e in zip(names, starts, ends, strict=True)}
        self.row, self.weight = row[order].astype(np.int32), table.column("w").to_numpy()[order]

    def best(self, grams: list[str], weights: list[float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores, to 9 places, of the ``k`` best right rows; ids ascend, so ties go to the smaller id."""
        found = [(*self.at[g], w) for g, w in zip(grams, weights, strict=True) if g in self.at]
        if not found:
            return self.ids[:0], np.zeros(0)
        at = np.concatenate([self.row[s:e] for s, e, _ in found])
        score = np.bincount(at, np.concatenate([self.weight[s:e] * w for s, e, w in found]), len(self.ids))
        some = np.flatnonzero(score)
        score = np.round(score[some], 9)
        some, score = some[score > 0], score[score > 0]
        if len(some) > k:
            near = score >= np.partition(score, -k)[-k]
            some, score = some[near], score[near]
        order = np.argsort(-score, kind="stable")[:k]
        return self.ids[some[order]], score[order]


_SCORED = pa.schema([(LEFT, pa.string()), (RIGHT, pa.string()), ("score", pa.float64())])
_SCORED_DDL = f"{LEFT} string, {RIGHT} string, score double"


def _scored_rows(index: _GramIndex, lefts: Iterable[tuple[str, list[str], list[float]]], k: int) -> tuple[list, list, list]:
    out: tuple[list, list, list] = ([], [], [])
    for left, grams, weights in lefts:
        ids, scores = index.best(grams, weights, k)
        out[0].extend([left] * len(ids))
        out[1].extend(ids)
        out[2].extend(scores)
    return out


def _grid_top(lefts: DataFrame, rights: DataFrame, k: int, n_left: int, n_right: int, cell: int) -> DataFrame:
    """Top ``k`` of each left by a grid: the right side in blocks, the left side in parts, by id; each block meets each part in a task of its own.

    No task has more than about ``cell`` weights of either side, however common a gram is, and no row is made for each pair that shares a
    gram: a cell returns its own top ``k`` of each left, of which the best are taken.
    """
    blocks = -(-n_right // cell)
    parts = max(-(-n_left // cell), -(-int(lefts.sparkSession.conf.get("spark.sql.shuffle.partitions")) // blocks))
    deal = lambda df, own, n, other, m: df.select("id", "gram", "w", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _SCORED.empty_table()
        left = left.sort_by("id")
        ids, grams, weights = (left.column(c).to_pylist() for c in ("id", "gram", "w"))
        edges = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
        out = _scored_rows(_GramIndex(right), ((ids[a], grams[a:b], weights[a:b]) for a, b in zip(edges, edges[1:], strict=False)), k)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, _SCORED.types, strict=True)], schema=_SCORED)

    cells = deal(lefts, "part", parts, "block", blocks).groupBy("part", "block").cogroup(deal(rights, "block", blocks, "part", parts).groupBy("part", "block"))
    return _top(cells.applyInArrow(run, _SCORED_DDL), k, [F.col("score").desc(), F.col(RIGHT)], LEFT)


_PACKED = "side string, key string, ids array<string>, grams binary, n int"


def _packed(texts: DataFrame, vocabulary: dict[str, int], kind: str, low: int, high: int) -> DataFrame:
    """Texts as their n-grams' numbers (``gram_search``); those without n-grams go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            side, key, ids, grp, words = (b.column(i) for i in range(5))
            of = [numbers_of(w, low, high, vocabulary, g) for g, w in zip(grp.to_pylist(), words.to_pylist(), strict=True)]
            made = [side, key, ids, pa.array([np.array(x, dtype=kind).tobytes() for x in of], pa.binary()), pa.array([len(x) for x in of], pa.int32())]
            yield pa.RecordBatch.from_arrays(made, names=["side", "key", "ids", "grams", "n"])

    return texts.select("side", "key", "ids", "grp", "words").mapInArrow(run, _PACKED).where("n > 0")


def _scored_batches(part: Part) -> Iterator[pa.RecordBatch]:
    rows = part.best()
    while some := list(islice(rows, 100_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), _SCORED.types, strict=True)], schema=_SCORED)


def _met_once(lefts: DataFrame, rights: DataFrame, k: int, kind: str, idf: np.ndarray) -> DataFrame:
    """Top ``k`` of each left text where all right texts, found few enough, are sent to each task."""
    few = rights.select("ids", "grams").toArrow()
    ids, texts = few.column("ids").to_pylist(), few.column("grams").to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for b in batches:
            if b.num_rows and texts:
                block = block or Block(texts, kind, idf)
                part = Part(b.column(0).to_pylist(), b.column(1).to_pylist(), kind, idf, k)
                part.meet(block, ids)
                yield from _scored_batches(part)

    tasks = 3 * lefts.sparkSession.sparkContext.defaultParallelism
    return lefts.select("key", "grams").repartition(tasks).mapInArrow(run, _SCORED_DDL)


def _met_by_blocks(lefts: DataFrame, rights: DataFrame, k: int, kind: str, idf: np.ndarray, n_left: int, n_right: int, cell: int) -> DataFrame:
    """Top ``k`` of each left text: a task has a part of the left texts and meets all right texts, a block after the other.

    No task holds more than about ``cell`` n-grams of either side, however common an n-gram is. The right side is copied once for each part, as
    numbers of n-grams; only the best of each left text leave the task.
    """
    blocks = -(-n_right // cell)
    parts = max(-(-n_left // cell), 3 * lefts.sparkSession.sparkContext.defaultParallelism)
    of = lambda n: F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    left = lefts.select(of(parts).alias("part"), F.lit(-1).alias("block"), "key", F.lit(None).cast("array<string>").alias("ids"), "grams")
    right = rights.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), of(blocks).alias("block"), F.lit(None).cast("string").alias("key"), "ids", "grams")

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list, list, list]]:
        at, rows = None, ([], [], [])
        for b in batches:
            where = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            edges = [i for i in range(len(where)) if i == 0 or where[i] != where[i - 1]]
            for i, j in zip(edges, [*edges[1:], len(where)], strict=True):
                if where[i] != at:
                    if rows[0]:
                        yield at, *rows
                    at, rows = where[i], ([], [], [])
                for r, c in zip(rows, (2, 3, 4), strict=True):
                    r += b.column(c).slice(i, j - i).to_pylist()
        if rows[0]:
            yield at, *rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = None, None
        for (p, block), keys, ids, texts in groups(batches):
            if block < 0:
                if part:
                    yield from _scored_batches(part)
                part, own = Part(keys, texts, kind, idf, k), p
            elif part and own == p:
                part.meet(Block(texts, kind, idf), ids)
        if part:
            yield from _scored_batches(part)

    return left.unionByName(right).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "block").mapInArrow(run, _SCORED_DDL)


def tfidf_scored(
    left: DataFrame,
    right: DataFrame,
    top_k: int,
    low: int = 2,
    high: int = 3,
    text_col: str = "normalized_name",
    group_col: str | None = None,
    index_weights: int = INDEX_WEIGHTS,
    cell_weights: int = CELL_WEIGHTS,
    vocabulary: int = VOCABULARY,
) -> DataFrame:
    """``(entity_id_left, entity_id_right, score)``: the ``top_k`` right entities of each left one by cosine of TF-IDF n-grams, to 9 places.

    Equal texts of a side are met once, and of equal right texts the ``top_k`` smallest ids are all that can count. Texts are written to the shared folder
    and counted before the right side is sent out; a larger right side is met block by block. With ``group_col``, entities meet in their group only
    and the best are taken inside it. More than ``vocabulary`` n-grams aren't sent to the machines: then weights are joined (``_grid_top``).
    """
    from kinlink.sources import tables

    spark = left.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        tables.write_parquet(df, path := tables.scratch_path(spark, name))
        return spark.read.schema(df.schema).parquet(path)

    words = F.array_join(F.filter(F.split(F.lower(F.col(text_col)), r"(?U)\s+"), lambda w: w != ""), " ")
    grp = F.concat(F.coalesce(F.col(group_col), F.lit("unknown")), F.lit("\x01")) if group_col else F.lit("")
    rows = lambda df, side: df.where(F.col(text_col).isNotNull()).select(F.lit(side).alias("side"), F.col(ENTITY_ID).alias("id"), grp.alias("grp"), words.alias("words"))
    # an id that repeats has all its texts' words
    made = rows(left, "l").unionByName(rows(right, "r")).groupBy("side", "id", "grp").agg(F.array_join(F.array_sort(F.collect_list("words")), " ").alias("words"), F.count("*").alias("n_rows"))
    items = stored(made, "items")
    texts = items.groupBy("side", "grp", "words").agg(F.min("id").alias("key"), F.count("*").alias("n_ids"))
    total = items.groupBy("grp").agg(F.sum("n_rows").alias("total"))
    df = texts.select("grp", "n_ids", F.explode(F.array_distinct(ngrams(F.col("words"), low, high))).alias("gram")).groupBy("grp", "gram").agg(F.sum("n_ids").alias("df"))
    idf = df.join(total, "grp").select(F.concat("grp", "gram").alias("gram"), (F.log((1 + F.col("total")) / (1 + F.col("df"))) + 1).alias("idf"))
    known = idf.limit(vocabulary + 1).toArrow()
    if known.num_rows > vocabulary:
        return _weights_top(left, right, top_k, low, high, text_col, group_col, cell_weights)
    known = known.sort_by("gram")
    numbers, idfs = {g: i for i, g in enumerate(known.column("gram").to_pylist())}, known.column("idf").to_numpy()
    kind = "<u2" if len(numbers) < 1 << 16 else "<u4"
    first = _top(items.where("side = 'r'"), top_k, [F.col("id")], "grp", "words").groupBy("grp", "words").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    both = texts.where("side = 'r'").join(first, ["grp", "words"]).unionByName(texts.where("side = 'l'").withColumn("ids", F.lit(None).cast("array<string>")))
    packed = stored(_packed(both, numbers, kind, low, high), "texts")
    sizes = {r["side"]: r["n"] for r in packed.groupBy("side").agg(F.sum("n").alias("n")).collect()}
    lefts, rights, n_right = packed.where("side = 'l'"), packed.where("side = 'r'"), sizes.get("r", 0)
    if n_right <= index_weights or not n_right:
        best = _met_once(lefts, rights, top_k, kind, idfs)
    else:
        best = _met_by_blocks(lefts, rights, top_k, kind, idfs, sizes.get("l", 0), n_right, cell_weights)
    members = items.where("side = 'l'").join(texts.where("side = 'l'").select("grp", "words", "key"), ["grp", "words"]).select("key", "id")
    return best.withColumnRenamed(LEFT, "key").join(members, "key").select(F.col("id").alias(LEFT), RIGHT, "score")


def _weights_top(left: DataFrame, right: DataFrame, top_k: int, low: int, high: int, text_col: str, group_col: str | None, cell_weights: int) -> DataFrame:
    """The same by joined weights, for any number of n-grams."""
    from kinlink.sources import tables

    made = tfidf_weights(left, right, low, high, text_col, group_col)
    if group_col:
        made = made.select("side", "id", F.concat_ws("\x01", "grp", "gram").alias("gram"), "w")
    path = tables.scratch_path(left.sparkSession, "weights")
    tables.write_parquet(made, path)
    weights = left.sparkSession.read.schema(made.schema).parquet(path)
    sizes = {r["side"]: r["count"] for r in weights.groupBy("side").count().collect()}
    return _grid_top(weights.where("side = 'l'"), weights.where("side = 'r'"), top_k, sizes.get("l", 0), max(sizes.get("r", 0), 1), cell_weights)


def tfidf_candidates(
    left: DataFrame,
    right: DataFrame,
    top_k: int = 50,
    low: int = 2,
    high: int = 3,
    min_similarity: float = 0.05,
    text_col: str = "normalized_name",
    method: str = "tfidf",
    group_col: str | None = None,
    index_weights: int = INDEX_WEIGHTS,
    cell_weights: int = CELL_WEIGHTS,
) -> DataFrame:
    """Top ``top_k`` first, then those of at least ``min_similarity``, then without pairs of an id with itself (which used a place)."""
    scored = tfidf_scored(left, right, top_k, low, high, text_col, group_col, index_weights, cell_weights)
    return _pairs(scored.where((F.col("score") >= min_similarity) & (F.col(LEFT) != F.col(RIGHT))), F.col("score"), method)


def postal_ngram_candidates(left: DataFrame, right: DataFrame, top_k: int = 50, min_similarity: float = 0.05) -> DataFrame:
    """TF-IDF of 2- to 4-grams of the addresses' digit runs; rows without address or digits take no part."""

    def keyed(df: DataFrame) -> DataFrame:
        runs = F.array_join(F.regexp_extract_all(_present_address(df), F.lit(r"(\d+)"), F.lit(1)), " ")
        return df.withColumn("_postal", F.nullif(runs, F.lit("")))

    return tfidf_candidates(keyed(left), keyed(right), top_k, 2, 4, min_similarity, "_postal", "postal_ngram")


def country_tfidf_candidates(left: DataFrame, right: DataFrame, top_k: int = 50, low: int = 2, high: int = 3, min_similarity: float = 0.05, text_col: str = "normalized_name", method: str = "country_tfidf") -> DataFrame:
    """TF-IDF inside each raw country, with its own frequencies; null countries meet only each other; without the column, plain TF-IDF."""
    group = COUNTRY if COUNTRY in left.columns and COUNTRY in right.columns else None
    return tfidf_candidates(left, right, top_k, low, high, min_similarity, text_col, method, group)


def boosted(candidates: DataFrame, factor: float = 2.0) -> DataFrame:
    """Scores times ``factor``, 1 at most."""
    return candidates.withColumn(SCORE, F.least(F.col(SCORE) * factor, F.lit(1.0)))


def merge_candidates(parts: Iterable[DataFrame], max_per_entity: int = 100, canonical: bool = False) -> DataFrame:
    """One row for each pair: its best score and all methods, sorted and joined by ``+``; the best ``max_per_entity`` of each left id stay.

    ``canonical``: (a, b) and (b, a) are one pair, written with the smaller id first.
    """
    rows = reduce(DataFrame.unionByName, parts)
    if canonical:
        rows = rows.select(F.least(LEFT, RIGHT).alias(LEFT), F.greatest(LEFT, RIGHT).alias(RIGHT), SCORE, METHOD)
    merged = rows.groupBy(LEFT, RIGHT).agg(F.max(SCORE).alias(SCORE), F.array_join(F.array_sort(F.collect_set(METHOD)), "+").alias(METHOD))
    return _top(merged, max_per_entity, [F.col(SCORE).desc(), F.col(RIGHT)], LEFT).select(*COLUMNS)


def _apart(left: DataFrame, right: DataFrame) -> bool:
    """Whether all left ids are below all right ids, so that canonical pairs keep their sides."""
    last, first = left.agg(F.max(ENTITY_ID)).first()[0], right.agg(F.min(ENTITY_ID)).first()[0]
    return last is None or first is None or last < first


def block_pair(left: DataFrame, right: DataFrame, config: BlockingConfig | None = None, canonical: bool = True) -> DataFrame:
    """TF-IDF names, token-sort prefixes and address prefixes together."""
    c = config or BlockingConfig()
    most = None if canonical and not _apart(left, right) else c.max_candidates_per_entity
    parts = [
        tfidf_candidates(left, right, c.tfidf_top_k, c.ngram_min, c.ngram_max, c.min_similarity),
        token_sort_candidates(left, right, c.token_sort_prefix_len, most),
        address_prefix_candidates(left, right, c.address_prefix_len, most),
    ]
    return merge_candidates(parts, c.max_candidates_per_entity, canonical)


def method_counts(candidates: DataFrame) -> DataFrame:
    """Rows of each combination of methods."""
    return candidates.groupBy(METHOD).agg(F.count("*").alias("pairs"))
