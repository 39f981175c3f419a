"""Document fingerprints (native): SimHash votes and a Hamming search over permuted block tables.

Everything here is DataFrame and SQL expressions; no Python runs on the executors.

* A term is a pair of neighbouring words (a lone word is its own term); words are the runs of
  letters and digits of the lower-cased text. A term's weight is its number of occurrences, so
  every occurrence votes once, +1 or -1, on each of the 64 bits of its XXH64.
* Votes are counted in eight 64-bit words of eight 8-bit lanes each, 127 terms at a time, so
  a document costs eight additions a term instead of 64.
* ``within_radius`` cuts 64 bits into ``blocks`` blocks. Two fingerprints that differ in at most
  ``radius`` bits agree on at least ``blocks - radius`` whole blocks, so one table for each choice
  of so many blocks, keyed by their bits, meets every such pair; the rest is checked exactly. The number of
  blocks, and so the length of the keys, grows with the number of distinct fingerprints.
  A pair is reported by the first table that holds it, so nothing needs a ``distinct``.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.llm.common import blank_null, materialize, piece_of, split_points

LANES = "72340172838076673"  # 0x0101010101010101
CHUNK = 127  # the top lane stays positive


def vote_sql(hashes: str) -> str:
    """SQL: the majority bit string (bigint) of an array of 64-bit hashes; an empty array gives 0."""
    added = ", ".join(f"a[{i}] + (shiftright(x, {i}) & {LANES})" for i in range(8))
    zeros = ", ".join(["0L"] * 8)
    chunks = f"transform(sequence(0, (size(h) - 1) div {CHUNK}), c -> aggregate(slice(h, c * {CHUNK} + 1, {CHUNK}), array({zeros}), (a, x) -> array({added})))"
    ones = "aggregate(p, 0L, (s, a) -> s + (shiftrightunsigned(a[b & 7], shiftright(b, 3) * 8) & 255L))"
    bits = f"aggregate(sequence(0, 63), 0L, (f, b) -> f | if(2 * {ones} > size(h), shiftleft(1L, b), 0L))"
    return f"transform(array({hashes}), h -> if(size(h) = 0, 0L, transform(array({chunks}), p -> {bits})[0]))[0]"


def term_hashes_sql(text: str) -> str:
    """SQL: the hashes of all term occurrences of a text."""
    words = f"filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w <> '')"
    pairs = "if(size(w) < 2, w, zip_with(slice(w, 1, size(w) - 1), slice(w, 2, size(w) - 1), (a, b) -> xxhash64(a, b)))"
    return f"transform(array(transform({words}, w -> xxhash64(w))), w -> {pairs})[0]"


def fingerprint_sql(text: str) -> str:
    return vote_sql(term_hashes_sql(text))


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """1 - differing bits / 64."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def with_next(docs: DataFrame, order: str, carry: list[str], *, rows_per_piece: int = 256, max_pieces: int = 1 << 17) -> DataFrame:
    """Add ``next_<c>`` for ``c`` in ``carry``: the values of the row that follows by descending ``order``; after the last comes the first.

    The whole order is cut into ranges of ids, so no window sees more than a range: the head of
    each range is also sent, as a guest, to the range that precedes it. Only the cut points and
    one id for each range (``max_pieces`` at most) reach the driver. Rows of equal ``order`` are
    taken by ``carry``, ascending; null ids come last. One shuffle of the rows.
    """
    n = docs.count()
    points = split_points(docs.select(order), order, min(max_pieces, n // rows_per_piece + 1))
    piece = piece_of(order, points)
    heads = {r["piece"]: r["head"] for r in docs.select(order).groupBy(piece.alias("piece")).agg(F.max(order).alias("head")).collect()}
    listed = sorted(heads)
    before = {p: listed[(i + 1) % len(listed)] for i, p in enumerate(listed)}
    size = len(points) + 1
    text = lambda values: "cast(split('" + ",".join("" if v is None else str(v) for v in values) + "', ',') as array<string>)"
    head_of = F.expr(f"cast(nullif(get({text([heads.get(p) for p in range(size)])}, _piece), '') as bigint)")
    goes_to = F.expr(f"cast(nullif(get({text([before.get(p, p) for p in range(size)])}, _piece), '') as int)")
    seats = F.when(
        F.col(order).eqNullSafe(head_of),
        F.array(F.struct(F.col("_piece").alias("at"), F.lit(0).alias("guest")), F.struct(goes_to.alias("at"), F.lit(1).alias("guest"))),
    ).otherwise(F.array(F.struct(F.col("_piece").alias("at"), F.lit(0).alias("guest"))))
    seated = docs.withColumn("_piece", piece).withColumn("_seat", F.explode(seats)).select("*", F.col("_seat.at").alias("_at"), F.col("_seat.guest").alias("_guest")).drop("_seat", "_piece")
    by = "_at"
    over = f"over (partition by {by} order by _guest, `{order}` desc nulls last, {', '.join(f'`{c}` asc' for c in carry)})"
    return seated.select("*", *(F.expr(f"lead(`{c}`) {over}").alias(f"next_{c}") for c in carry)).where("_guest = 0").drop("_at", "_guest")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, fp)`` with ``fp`` the 64-bit SimHash of the whole text.

    Null text counts as empty; an empty text has fingerprint 0; repeated rows are kept; other
    columns are ignored, whatever their names.
    """
    return docs.select(F.col(id_col).alias("doc_id"), blank_null(text_col).alias("text")).withColumn("fp", F.expr(fingerprint_sql("text")))


def edited_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last half is the beginning of the next document."""
    pairs = with_next(fingerprint_documents(docs), "doc_id", ["fp", "text"])
    edited = pairs.select(
        "doc_id",
        "fp",
        "next_fp",
        F.expr("cast(char_length(text) as bigint)").alias("n_chars"),
        F.expr("concat(left(text, char_length(text) - char_length(text) div 2), left(next_text, char_length(text) div 2))").alias("edited"),
    )
    return edited.select("doc_id", "n_chars", "fp", "next_fp", F.sha2(F.col("edited"), 256).alias("edited_sha256"), F.expr(fingerprint_sql("edited")).alias("edited_fp"))


def blocks_for(n: int, radius: int, per_key: int = 32) -> int:
    """The fewest blocks (two more than ``radius`` at least) whose keys hold about ``per_key`` of ``n`` spread fingerprints at most."""
    return next((b for b in range(radius + 2, 64) if n >> ((64 // b) * (b - radius)) <= per_key), 64)


def block_choices(blocks: int, radius: int) -> tuple[list[tuple[int, int]], list[tuple[int, ...]]]:
    """The (start, width) of each block and the blocks that key each table."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(blocks)], list(combinations(range(blocks), blocks - radius))


def _mask(spans: list[tuple[int, int]], chosen: tuple[int, ...]) -> int:
    m = sum(((1 << w) - 1) << s for s, w in (spans[i] for i in chosen))
    return m - (1 << 64) if m >> 63 else m


def within_radius(asked: DataFrame, table: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """All ``(fp, other_fp)`` with ``fp`` of ``asked``, ``other_fp`` of ``table`` and at most ``radius`` differing bits.

    Both hold distinct fingerprints (column ``fp``); a fingerprint that is in both meets itself. Null fingerprints meet nothing.
    """
    spans, choices = block_choices(blocks, radius)
    masks = [_mask(spans, c) for c in choices]
    slots = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)))
    keyed = lambda df, name: df.where("fp is not null").select(F.col("fp").alias(name), F.explode(slots).alias("s")).select(name, "s.t", "s.key")
    differ = F.col("fp").bitwiseXOR(F.col("other_fp"))
    earlier = F.array(*(F.lit(m) for m in masks))
    first = ~F.exists(F.slice(earlier, F.lit(1), F.col("t")), lambda m: differ.bitwiseAND(m) == 0)
    met = keyed(asked, "fp").join(keyed(table, "other_fp"), ["t", "key"])
    return met.where((F.bit_count(differ) <= radius) & first).select("fp", "other_fp")


def fingerprint_report(docs: DataFrame, radius: int = 3, blocks: int | None = None, every: int = 100) -> DataFrame:
    """One row per document: both fingerprints, their likeness, and for ids divisible by ``every`` how many documents are within ``radius``.

    ``n_within`` counts all rows whose fingerprint is near, the document itself included; null for documents that aren't asked.
    """
    made = materialize(edited_documents(docs), "fingerprints")
    table = made.groupBy("fp").agg(F.count("*").alias("n"), F.max((F.col("doc_id") % every == 0).cast("int")).alias("asked"))
    blocks = blocks or blocks_for(made.count(), radius)
    near = within_radius(table.where("asked = 1").select("fp"), table.select("fp"), radius, blocks)
    counts = near.join(table.select(F.col("fp").alias("other_fp"), "n"), "other_fp").groupBy("fp").agg(F.sum("n").alias("n_within")).withColumn("q", F.lit(0))
    rows = made.withColumn("q", (F.col("doc_id") % every).cast("int"))
    return rows.join(counts, ["fp", "q"], "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex_digits(F.col("fp")).alias("fingerprint"),
        hex_digits(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "n_within",
    )
