"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Sources, in code-point order with null last, weigh 1, 2, 3, repeating, and share all words. A source's
target stops at ``max_epochs`` times its size; the excess goes to the others by weight, until no target is
above its cap. Each round needs two sums over the table of sources, so only scalars reach the driver.

A source whose target is r times its size repeats every document floor(r) times; the rest is filled with
documents in the order of a seeded digest. Sizes are first summed by (source, leading digits of the digest),
so only the one slice where the target is met is ranked row by row: a source with a third of all rows costs
no more than any other. Then, ``MENDS`` times, each source swaps in or out the one document that brings it
nearest to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.llm.common import blank_null, free_name, materialize

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
CYCLE = 3
SEED = 17
SLICE_DIGITS = 3
MENDS = 2


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def draw(seed: int, id_col: str = "doc_id") -> Column:
    """The seeded order of documents: hex digits that any engine can compute."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to ``(source, source_size, weight)``: the common level times the weight, or the cap if that is less."""
    cap = F.col("source_size") * float(max_epochs)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while True:
        full = F.lit(False) if level is None else cap < F.col("weight") * level
        spent, weight = sources.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        new = (total - spent) / weight if weight else float("inf")
        if new == level or not weight:
            break
        level = new
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level if level is not None else 0.0)))


def source_table(sized: DataFrame) -> DataFrame:
    """``(source, source_size, weight)``: one row per source, null included.

    Sources are sorted by ranges, in many tasks; their ranks are their places in a range and the sizes of the ranges before it.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = materialize(sums.orderBy(F.col("source").asc_nulls_last()).withColumn("place", F.monotonically_increasing_id()), "sorted-sources")
    placed = placed.withColumn("range", F.shiftright("place", 33)).withColumn("place", F.col("place").bitwiseAND((1 << 33) - 1))
    # a row for each shuffle partition at most
    before = placed.groupBy("range").count().withColumn("before", F.coalesce(F.sum("count").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = placed.join(F.broadcast(before), "range")
    return ranked.select("source", "source_size", ((F.col("place") + F.col("before")) % CYCLE + 1).cast("int").alias("weight"))


def repetitions(sized: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``sized (doc_id, source, size, ...)`` with ``source_size, target, repeats``; every row is kept, those not taken with 0 repeats.

    Rows of one doc_id are drawn together by their size; rows that repeat each other may get unequal repeats, which of them is left open.
    """
    sources = water_fill(materialize(source_table(sized), "sources"), max_epochs)
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("bigint")
    plan = sources.withColumn("target", F.round("target", 6)).withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = materialize(plan.drop("weight"), "targets")
    drawn = sized.withColumn("draw", draw(seed)).withColumn("slice", F.substring("draw", 1, SLICE_DIGITS))
    slices = drawn.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    below = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    same = lambda a, b, *names: [a[n].eqNullSafe(b[n]) for n in names]
    cuts = slices.withColumn("below", below).join(plan, same(slices, plan, "source")).drop(plan["source"])
    cuts = cuts.select("source", "slice", "below", "source_size", "target", "whole", "rest", ((F.col("below") < F.col("rest")) & (F.col("below") + F.col("words") > F.col("rest"))).alias("met"))
    cuts = materialize(cuts, "slices")
    rows = drawn.join(cuts, same(drawn, cuts, "source", "slice")).drop(cuts["source"], cuts["slice"])
    order = Window.partitionBy("source", "slice").orderBy("draw", "size", "doc_id")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("below")
    ranked = rows.where("met").withColumn("extra", (before + F.col("size") / 2 <= F.col("rest")).cast("bigint"))
    clear = rows.where("not met").withColumn("extra", (F.col("below") < F.col("rest")).cast("bigint"))
    fields = ["doc_id", "source", "size", "source_size", "target", "whole", "rest", "draw", "extra"]
    taken = materialize(clear.unionByName(ranked).select(*fields), "taken")
    for k in range(MENDS):
        taken = materialize(_mended(taken).select(*fields), f"mended-{k}")
    return taken.select("doc_id", "source", "size", "source_size", "target", (F.col("whole") + F.col("extra")).alias("repeats"))


def _mended(taken: DataFrame) -> DataFrame:
    """Add or take back, in each source, the one document whose size comes nearest to what is missing or too much, if that helps.

    One minimum for each source is aggregated. Rows that repeat an id and a size are added or taken back together.
    """
    source = lambda a, b: a["source"].eqNullSafe(b["source"])
    gaps = materialize(taken.groupBy("source").agg((F.first("rest") - F.sum(F.col("size") * F.col("extra"))).alias("gap")), "gaps")
    rows = taken.join(gaps, source(taken, gaps)).drop(gaps["source"])
    off = F.when((F.col("gap") > 0) & (F.col("extra") == 0), F.abs(F.col("gap") - F.col("size"))).when((F.col("gap") < 0) & (F.col("extra") == 1), F.abs(F.col("gap") + F.col("size")))
    choices = rows.withColumn("off", F.round(off, 6)).where("size > 0 and off < abs(gap)")
    best = choices.groupBy("source").agg(F.min(F.struct("off", "draw", "size", "doc_id")).alias("b"))
    best = materialize(best.select("source", F.col("b.draw").alias("b_draw"), F.col("b.size").alias("b_size")), "best")
    hit = F.coalesce((F.col("draw") == F.col("b_draw")) & (F.col("size") == F.col("b_size")), F.lit(False))
    met = rows.join(best, source(rows, best), "left").drop(best["source"])
    return met.withColumn("extra", F.when(hit, 1 - F.col("extra")).otherwise(F.col("extra")))


def mix_report(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row; null text has size 0; null source is a source of its own; an empty table gives none."""
    sized = materialize(docs.select("doc_id", "source", word_count(blank_null("text")).alias("size")), "sizes")
    return repetitions(sized, max_epochs, seed).select("doc_id", "size", "source_size", "target", (F.col("repeats") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixture itself: every document as often as it is taken, numbered by ``repetition`` from 0, with its columns as they are.

    If ``docs`` has a column ``repetition`` already, the number's name gets underscores before it. Documents without words are taken as often as their source's whole repetitions and draw say; null ids are drawn as one.
    """
    own, number = docs.columns, free_name(docs, "repetition")
    size, place, plan_id, plan_source, plan_size, repeats = (free_name(docs, n) for n in ("mix_size", "mix_place", "mix_id", "mix_source", "mix_words", "mix_repeats"))
    sized = materialize(docs.select("doc_id", "source", word_count(blank_null("text")).alias("size")), "sizes")
    plan = repetitions(sized, max_epochs, seed).groupBy(F.col("doc_id").alias(plan_id), F.col("source").alias(plan_source), F.col("size").alias(plan_size))
    plan = materialize(plan.agg(F.array_sort(F.collect_list("repeats")).alias(repeats)), "repeats")
    numbered = docs.select(*(F.col(f"`{c}`") for c in own), word_count(blank_null("text")).alias(size))
    # rows that share id, source and size take their repeats in the order of their texts
    shared = plan.where(F.size(repeats) > 1).limit(1).count()
    row = F.row_number().over(Window.partitionBy("doc_id", "source", size).orderBy("text")) if shared else F.lit(1)
    numbered = numbered.withColumn(place, row)
    # one plan at every size: texts are dealt out by id, and the plan is never sent whole to all machines
    joined = numbered.join(plan.hint("merge"), F.col("doc_id").eqNullSafe(F.col(plan_id)) & F.col("source").eqNullSafe(F.col(plan_source)) & (F.col(size) == F.col(plan_size)))
    times = F.element_at(repeats, F.col(place)).cast("int")
    kept = joined.where(times > 0).select(*(F.col(f"`{c}`") for c in own), F.explode(F.sequence(F.lit(0), times - 1)).alias(number))
    return kept


_MEND = """
g{n} as (select source, any_value(rest) - sum(size * extra) as gap from d{m} group by source),
c{n} as (
  select d.*, gap, round(case when gap > 0 and extra = 0 then abs(gap - size) when gap < 0 and extra = 1 then abs(gap + size) end, 6) as off
  from d{m} d join g{n} g on d.source is not distinct from g.source),
b{n} as (
  select source, draw as b_draw, size as b_size from c{n} where size > 0 and off < abs(gap)
  qualify row_number() over (partition by source order by off, draw, size, doc_id) = 1),
d{n} as (
  select d.doc_id, d.source, size, source_size, target, whole, rest, draw,
         case when draw = b_draw and size = b_size then 1 - extra else extra end as extra
  from d{m} d left join b{n} b on d.source is not distinct from b.source)"""

MIX_ORACLE = (
    r"""
with s as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         md5('17|' || coalesce(cast(doc_id as varchar), '')) as draw
  from documents),
src as (
  select source, cast(sum(size) as bigint) as source_size, cast(3 * sum(size) as double) as cap,
         (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
  from s group by source),
levels as (
  select cap, weight, row_number() over k as k,
         (sum(source_size) over () - coalesce(sum(cap) over (k rows between unbounded preceding and 1 preceding), 0))
         / sum(weight) over (k rows between current row and unbounded following) as level
  from src window k as (order by cap / weight, source)),
lv as (select cast(level as double) as level from levels where cap >= level * weight order by k limit 1),
t as (
  select source, source_size, least(cap, weight * lv.level) as exact, round(least(cap, weight * lv.level), 6) as target from src, lv),
r as (
  select *, case when source_size = 0 then 0 else cast(floor(exact / source_size) as bigint) end as whole from t),
d as (
  select s.doc_id, s.source, s.size, s.draw, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size as rest,
         coalesce(sum(s.size) over (partition by s.source order by s.draw, s.size, s.doc_id rows between unbounded preceding and 1 preceding), 0) as before
  from s join r on s.source is not distinct from r.source),
d0 as (select *, case when before + size / 2.0 <= rest and before < rest then 1 else 0 end as extra from d),"""
    + ",".join(_MEND.format(n=n, m=n - 1) for n in range(1, MENDS + 1))
    + f"""
select doc_id, size, source_size, target, cast((whole + extra) * size as bigint) as taken from d{MENDS}
"""
)
