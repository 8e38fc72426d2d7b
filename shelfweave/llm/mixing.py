"""Mixing sources to target weights by entropy balancing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import Scratch

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
TOLERANCE = 1e-6
BRACKET = 64.0
NEWTON_ROUNDS = 40
REPAIR_ROUNDS = 3
CELL = 50_000


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _ranked(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """``place`` of each source from 0, by code point, null last; a distributed sort, then one running total over its partitions."""
    row = scratch.table(sources.orderBy("no_source", "src").withColumn("at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("at", 33)
    tops = row.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    tops = tops.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return row.withColumn("part", part).join(tops, "part").withColumn("place", F.col("before") + F.col("at") % F.lit(1 << 33)).drop("at", "part", "before")


def _targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: int, scratch: Scratch) -> DataFrame:
    """Fills the sources by weight up to ``most`` times their size: every target is the least of that and weight x level.

    The level rises until no further source is full; each round is one reduction of the source table.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("double")
    table = scratch.table(_ranked(sources, scratch).withColumn("weight", weight).withColumn("cap", (most * F.col("source_size")).cast("double")), "weighed")
    goal = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    level = 0.0
    while True:
        full = F.col("cap") <= F.col("weight") * level
        capped, open_weight = table.agg(F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        risen = (goal - capped) / open_weight if open_weight > 0 else level
        if risen <= level * (1 + 1e-12):
            break
        level = risen
    return table.withColumn("target", F.least("cap", F.col("weight") * F.lit(level)))


def _rates(hist: DataFrame, sources: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """Copies each document should have on average: the entropy-balanced rates of ``hist`` (source, size, n).

    Of all rates between 0 and ``most`` that give each source its target tokens these keep the largest entropy against one copy for
    every document. They are the exponentially tilted rates most / (1 + exp(-dual x size / mean size)); the dual of each source is
    the root of its token constraint. All duals take a Newton step per round, kept inside a bracket that halves otherwise.
    """
    key = ["no_source", "src"]
    fixed = ["mean", "target", "free", "any"]
    state = sources.select(
        *key, F.greatest(F.col("source_size") / F.col("docs"), F.lit(1e-9)).alias("mean"), "target",
        ((F.col("target") > 0) & (F.col("target") < F.col("cap") * (1 - 1e-12))).alias("free"), (F.col("target") > 0).alias("any"),
        F.lit(0.0).alias("dual"), F.lit(-BRACKET).alias("low"), F.lit(BRACKET).alias("high"), F.lit(1.0).alias("off"))
    state = scratch.table(state, "dual-0")
    share = 1 / (1 + F.exp(-F.col("dual") * F.col("size") / F.col("mean")))
    tokens = most * F.col("n") * F.col("size") * share
    for turn in range(NEWTON_ROUNDS):
        sums = hist.join(state.filter("free"), key).groupBy(*key).agg((F.sum(tokens) - F.first("target")).alias("gap"), F.sum(tokens * (1 - share) * F.col("size") / F.col("mean")).alias("slope"))
        moved = state.join(sums, key, "left").select(
            *key, *fixed, "dual", F.when(F.col("gap") < 0, F.col("dual")).otherwise(F.col("low")).alias("low"),
            F.when(F.col("gap") > 0, F.col("dual")).otherwise(F.col("high")).alias("high"),
            F.coalesce(F.abs(F.col("gap") / F.col("target")), F.lit(0.0)).alias("off"), F.when(F.col("slope") > 0, F.col("dual") - F.col("gap") / F.col("slope")).alias("newton"))
        inside = (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high"))
        dual = F.when(F.col("off") <= TOLERANCE, F.col("dual")).when(inside, F.col("newton")).otherwise((F.col("low") + F.col("high")) / 2)
        state = scratch.table(moved.select(*key, *fixed, dual.alias("dual"), "low", "high", "off"), f"dual-{turn + 1}")
        scratch.drop(f"dual-{turn}")
        if (state.agg(F.max("off")).first()[0] or 0.0) <= TOLERANCE:
            break
    rate = F.when(~F.col("any"), F.lit(0.0)).when(~F.col("free"), F.lit(float(most))).otherwise(most * share)
    return hist.join(state, key).select(*hist.columns, rate.alias("rate"))


def _rounded(rates: DataFrame, sources: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """Whole copies for all documents of one source and size: running sums of the rates, rounded, then a repair of what is left.

    The running sum goes over the distinct sizes of a source, of which there are at most as many as the longest document has words.
    """
    key = ["no_source", "src"]
    run = F.sum(F.col("n") * F.col("rate")).over(Window.partitionBy(*key).orderBy("size").rowsBetween(Window.unboundedPreceding, 0))
    summed = rates.withColumn("run", F.floor(run + 0.5))
    earlier = F.coalesce(F.lag("run").over(Window.partitionBy(*key).orderBy("size")), F.lit(0))
    copies = F.greatest(F.lit(0), F.least(F.col("run") - earlier, most * F.col("n"))).cast("long")
    now = scratch.table(summed.select(*key, "size", "n", copies.alias("copies")), "copies-0")
    for turn in range(REPAIR_ROUNDS):
        left = now.groupBy(*key).agg(F.sum(F.col("copies") * F.col("size")).alias("got")).join(sources.select(*key, "target"), key).select(*key, (F.col("target") - F.col("got")).alias("left"))
        room = F.when(F.col("left") > 0, most * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
        able = now.join(left, key).filter((F.col("size") > 0) & (F.col("size") <= F.abs("left")) & (room > 0))
        best = able.groupBy(*key).agg(F.max(F.struct("size", F.least(room, F.floor(F.abs("left") / F.col("size"))).alias("k"), F.signum("left").alias("sign"))).alias("b"))
        best = scratch.table(best.select(*key, F.col("b.size").alias("size"), (F.col("b.k") * F.col("b.sign")).cast("long").alias("more")), f"repair-{turn}")
        if not best.limit(1).count():
            break
        now = scratch.table(now.join(best, [*key, "size"], "left").select(*key, "size", "n", (F.col("copies") + F.coalesce("more", F.lit(0))).alias("copies")), f"copies-{turn + 1}")
    return now


def _taken(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """A row for each document with its source (no_source, src), a hash of its text, its size and the numbers of the mix."""
    key = ["no_source", "src"]
    rows = scratch.table(docs.select("doc_id", *_row(docs)), "rows")
    hist = scratch.table(rows.groupBy(*key, "size").agg(F.count(F.lit(1)).alias("n")), "hist")
    sources = hist.groupBy(*key).agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs"))
    sources = scratch.table(_targets(sources, weights, share, most, scratch), "targets")
    copies = _rounded(_rates(hist, sources, most, scratch), sources, most, scratch)
    plan = copies.join(sources.select(*key, "source_size", "target"), key).withColumn("cells", F.ceil(F.col("n") / CELL).cast("int"))
    plan = scratch.table(plan, "plan")
    # Copies go to cells of bounded size first, in proportion to their rows, then to the rows of each cell.
    lane = F.pmod(F.xxhash64("doc_id", "mark"), F.col("cells")).cast("int")
    laid = scratch.table(rows.join(plan, [*key, "size"]).withColumn("lane", lane), "laid")
    cell = [*key, "size", "lane"]
    counts = laid.groupBy(*cell).agg(F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"), F.first("copies").alias("copies"))
    up_to = F.sum("rows").over(Window.partitionBy(*key, "size").orderBy("lane"))
    cut = lambda x: F.floor(F.col("copies") * x / F.col("n"))
    counts = scratch.table(counts.select(*cell, "rows", (cut(up_to) - cut(up_to - F.col("rows"))).alias("quota")), "cells")
    place = F.row_number().over(Window.partitionBy(*cell).orderBy(F.xxhash64("doc_id"), "doc_id", "mark"))
    own = F.floor(F.col("quota") * F.col("place") / F.col("rows")) - F.floor(F.col("quota") * (F.col("place") - 1) / F.col("rows"))
    return laid.drop("copies").join(counts, cell).withColumn("place", place).withColumn("copies", own.cast("int"))


def _row(docs: DataFrame) -> list[Column]:
    return [docs["source"].isNull().alias("no_source"), F.coalesce(docs["source"].cast("string"), F.lit("")).alias("src"),
            F.xxhash64(docs["text"]).alias("mark"), word_count(docs["text"]).alias("size")]


def mixture(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document, and the number of ``copies``.

    Sources in the order of their code points, null last, weigh ``weights`` in turn and share ``share`` times all words; a target stops at
    ``most`` times its source's words, the rest is shared anew. A document is taken whole, 0 to ``most`` times, so ``taken`` is a multiple of
    its size. All numbers are functions of the rows, so reruns agree; documents of one source and size are picked by hashed id.

    A null or empty text has size 0, so it takes no words. Null ids and repeated rows are rows like others; among rows that are equal it
    is arbitrary which is taken. An empty table gives no rows. Other columns are ignored.
    """
    out = _taken(docs, scratch, weights, share, most)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """The documents as often as the mix takes them, with all their columns; null ids and repeated rows as in ``mixture``."""
    same = lambda doc_id, row: F.struct(doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0)).alias("id"), *row)
    names = ["no_source", "src", "mark", "size"]
    taken = _taken(docs, scratch, weights, share, most).select(same(F.col("doc_id"), names).alias("same"), "copies")
    nth = lambda order: F.row_number().over(Window.partitionBy("same").orderBy(order))
    taken = scratch.table(taken.withColumn("nth", nth("copies")), "taken")
    wide = docs.select(F.struct(*docs.columns).alias("doc"), same(docs["doc_id"], _row(docs)).alias("same"))
    wide = wide.withColumn("nth", nth(F.lit(0)))
    repeated = wide.join(taken.filter("copies > 0"), ["same", "nth"]).select("doc", F.explode(F.sequence(F.lit(1), "copies")))
    return repeated.select("doc.*")
