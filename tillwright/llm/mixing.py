"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

A document may be taken up to ``MOST`` times. Of all rates between 0 and ``MOST`` whose words sum to a
source's target, entropy balancing takes those nearest to one copy of each document, in relative
entropy of a copy's being taken or not. They are exponentially tilted: the odds of a copy of a
document of x times the mean size are ``exp(tilt * x)``, one tilt a source. The tilt is the
minimum of the convex dual, found by Newton steps that Spark sums over all documents. As the rate
depends on source and size alone, the sums run over cells (source, size, documents), which are
counted once; a cell's copies are then rounded and dealt to its documents.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.llm.ranks import numbered, stored, with_same

#: Copies of a document a mix takes at most; also how far a target may exceed its source.
MOST = 2
#: Weights of the sources in order, repeating, and what share of all words they are to make up.
WEIGHTS, SHARE = (5, 2, 1), Fraction(3, 2)
#: Newton stops once every source's expected words are this near to its target, or after so many steps.
NEAR, STEPS = 1e-9, 80
BLANK = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words: each becomes one letter, then all between them goes."""
    marks = F.translate(F.regexp_replace(text, BLANK, "x"), " \t\n\x0b\f\r", "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) of sources (source, source_size).

    Sources in order of their code points, null last, get ``weights`` in turn and share ``share`` of
    all sizes by them. A target stops at ``most`` times its source's size; the excess is shared anew
    by weight among the others until none is above. Sums are exact; only the target is rounded.
    """
    spark = sizes.sparkSession
    known = stored(sizes.select("source", F.col("source_size").cast("decimal(38,0)").alias("size"),
                                F.col("source").isNull().alias("unnamed")), "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    ranked = stored(numbered(known, [], ["unnamed", "source"]).select("source", "size", weight.cast("decimal(38,0)").alias("weight")), "weighed")
    total = ranked.agg(F.sum("size")).first()[0] or 0
    budget, per_weight = share * int(total), Fraction(0)
    full = None
    while True:
        # Sources that stop at their limit stay there: what one gives up only raises the others.
        over = F.lit(per_weight.numerator).cast("decimal(38,0)") * F.col("weight") > F.lit(most * per_weight.denominator).cast("decimal(38,0)") * F.col("size")
        row = ranked.agg(F.sum(F.when(over, F.col("size"))).alias("stopped"), F.sum(F.when(~over, F.col("weight"))).alias("open"),
                         F.count(F.when(over, 1)).alias("n")).first()
        if row.n == full or not row.open:
            break
        full, per_weight = row.n, (budget - most * int(row.stopped or 0)) / int(row.open)
    target = F.when(over, (most * F.col("size")).cast("double")).otherwise(
        F.col("weight").cast("double") * F.lit(per_weight.numerator).cast("double") / F.lit(per_weight.denominator).cast("double"))
    return ranked.select("source", F.col("size").cast("long").alias("source_size"), target.alias("target"), over.alias("stopped"))


def _rate(most: int = MOST) -> Column:
    return most / (1 + F.exp(-F.col("tilt") * F.col("size") / F.col("mean")))


def tilts(cells: DataFrame, wanted: DataFrame, most: int = MOST) -> DataFrame:
    """(source, mean, tilt): the minimum of the dual of each source that does not stop at its limit.

    ``cells`` holds (source, size, docs), sizes above 0. A Newton step that leaves the interval known
    to hold the minimum is replaced by the middle of it, or by a doubled tilt while it is open.
    """
    means = cells.groupBy("source").agg((F.sum(F.col("docs") * F.col("size")) / F.sum("docs")).cast("double").alias("mean"))
    open_ended = F.lit(None).cast("double")
    state = stored(with_same(wanted.filter("not stopped and target > 0").select("source", "target"), means, ["source"]).withColumns({
        "tilt": F.lit(0.0), "low": open_ended, "high": open_ended}), "tilts")
    names = ["source", "mean", "target", "tilt", "low", "high"]
    for _ in range(STEPS):
        taken = F.col("docs") * F.col("size") * _rate(most)
        bend = taken * (1 - _rate(most) / most) * F.col("size") / F.col("mean")
        slopes = with_same(cells, state, ["source"]).groupBy(*names).agg(
            (F.sum(taken) - F.col("target")).alias("slope"), F.sum(bend).alias("bend"))
        low = F.when(F.col("slope") < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("slope") > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.when(F.col("bend") > 0, F.col("tilt") - F.col("slope") / F.col("bend"))
        inside = F.coalesce(newton > low, low.isNull()) & F.coalesce(newton < high, high.isNull()) & newton.isNotNull()
        outside = F.when(low.isNotNull() & high.isNotNull(), (low + high) / 2).otherwise(
            2 * F.col("tilt") - F.signum("slope"))
        near = F.abs("slope") <= NEAR * F.col("target")
        # A first step from a flat place may be far too long, so a tilt at most doubles, and a bit.
        reach = 2 * F.abs("tilt") + 4
        moved = F.greatest(F.least(F.when(inside, newton).otherwise(outside), F.col("tilt") + reach), F.col("tilt") - reach)
        seen = Observation()
        after = slopes.observe(seen, F.max(F.abs(F.col("slope")) / F.col("target")).alias("off")).select(
            "source", "mean", "target", F.when(near, F.col("tilt")).otherwise(moved).alias("tilt"), low.alias("low"), high.alias("high"))
        state = stored(after, "tilts")
        if (seen.get["off"] or 0.0) <= NEAR:
            break
    return state.select("source", "mean", "tilt")


def copies(cells: DataFrame, wanted: DataFrame, most: int = MOST) -> DataFrame:
    """Cells with ``rate`` and ``copies`` (of all their documents together).

    Expected copies are rounded down; then cells get one more, in order of a fixed number less what
    was cut off, while the source's words stay within its target; then, largest size first, again
    and again, until no cell fits into what is left. Each of these rounds at least halves it.
    """
    with_tilt = with_same(cells, wanted, ["source"]).join(
        tilts(cells, wanted, most).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    rate = F.when(F.col("stopped"), float(most)).otherwise(F.coalesce(_rate(most), F.lit(0.0)))
    expected = F.col("docs") * F.col("rate")
    luck = (F.xxhash64("source", "size", F.lit("luck")).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)).cast("double")
    rounded = with_tilt.withColumn("rate", rate).select(
        "source", "size", "docs", "target", "rate", F.floor(expected).alias("copies"), (luck - (expected - F.floor(expected))).alias("turn"))
    state = stored(rounded, "copies")
    order, by_size = ["turn", "size"], False
    while True:
        gap = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(Window.partitionBy("source"))
        fits = (F.col("copies") < most * F.col("docs")) & (F.col("size") <= F.col("gap"))
        # At most one row a cell size; a window holds as many as its longest document has words.
        upto = F.sum(F.when(F.col("fits"), F.col("size"))).over(Window.partitionBy("source").orderBy(
            *order).rowsBetween(Window.unboundedPreceding, 0))
        more = F.col("fits") & (F.col("upto") <= F.col("gap"))
        seen = Observation()
        marked = state.withColumn("gap", gap).withColumn("fits", fits).withColumn("upto", upto).withColumn("more", more)
        state = stored(marked.observe(seen, F.count(F.when(F.col("more"), 1)).alias("more")).select(
            "source", "size", "docs", "target", "rate", (F.col("copies") + F.col("more").cast("long")).alias("copies"), "turn"), "copies")
        if by_size and not seen.get["more"]:
            return state.select("source", "size", "docs", "rate", "copies")
        order, by_size = [F.desc("size")], True


def mix(documents: DataFrame) -> DataFrame:
    """Documents (doc_id, source) with size, source_size, target, rate, copies and taken (words, repeats counted).

    All documents are returned, those not taken with 0 copies. A null or blank text has size 0 and
    is never taken; a null source is one of its own, the last. Of documents of one source and size
    the copies differ by one at most, and by a hash of doc_id and text it is decided who gets more;
    of rows that are equal any. A source's taken words miss its target by less than the size of its
    smallest document that could be taken once more. Other columns are ignored; no rows give none.
    """
    text_hash = F.xxhash64("doc_id", "text").alias("lot")
    sized = stored(documents.select("doc_id", "source", words(F.col("text")).alias("size"), text_hash), "sizes")
    counted = stored(sized.groupBy("source", "size").agg(F.count("*").alias("docs")), "cells")
    wanted = stored(targets(counted.groupBy("source").agg(F.sum(F.col("docs") * F.col("size")).alias("source_size"))), "targets")
    rounded = copies(counted.filter("size > 0"), wanted)
    nothing = counted.filter("size = 0").select("source", "size", "docs", F.lit(0.0).alias("rate"), F.lit(0).cast("long").alias("copies"))
    dealt = with_same(rounded.unionByName(nothing), wanted, ["source"])
    placed = numbered(sized, ["source", "size"], ["lot", "doc_id"])
    each = F.expr("copies div docs") + (F.col("position") < F.expr("copies % docs")).cast("long")
    return with_same(placed, dealt, ["source", "size"]).withColumn("copies", each).select(
        "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))
