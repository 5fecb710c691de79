"""Mixing sources to target weights by entropy balancing.

Sources share the words of the corpus by weight, none beyond ``cap`` times its own
(the excess is shared anew among the others).  Within these token constraints the
documents' rates stay as close to one as they can in relative entropy: the solution
of that convex programme is an exponential tilt, ``rate = min(cap, exp(t * size /
mean size))`` with one multiplier ``t`` a source, and its dual is solved by Newton
iterations.

1. *Sizes.*  One map over the texts writes a thin row for each document.
2. *Cells.*  Documents of one source and one size have the same rate, so the
   iterations run on the counts of (source, size) and not on documents.  This is exact.
3. *Newton.*  A round is one partial aggregate of the cells (words taken and their
   slope at the present multipliers), then a step for each source.  The constraints of
   different sources touch different documents, so the Hessian is diagonal.  Steps that
   leave the bracket of a source, or shrink too slowly, halve the bracket instead.
   Sums are of fixed-point numbers, so reruns agree to the last bit.
4. *Copies.*  Cells of a source, largest size first, get whole numbers of copies; what
   rounding leaves over goes on to the next, smaller size, so that a source misses its
   target by little more than its smallest documents.  This runs on the cells of a
   source: ``d`` distinct sizes need ``d * d / 2`` words, so a source of 10**13 words
   has fewer than 4.5 million cells.
5. *Documents.*  A cell's copies are dealt out evenly along a hash order of its
   documents.  Cells are split into buckets by the hash, with about ``bucket_rows``
   documents of the corpus to a bucket, so a cell that holds a third of all documents
   is numbered in many tasks.

Edge cases: a null, empty or blank text has size 0 and is never taken; a null source is
a source of its own, ranked last; rows that repeat a doc_id are documents of their own; a corpus
without words has targets of 0; an empty table gives an empty result; other columns
are never read.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stride.llm.common import read_table, stored

UNIT = 10 ** 9  # fixed-point rates


@dataclass(frozen=True)
class MixParams:
    weights: tuple[int, ...] = (5, 2, 1)   # of the sources in code point order, repeating
    cap: int = 3                           # most copies of a document, and most words of a source over its own
    near: float = 0.5                      # words by which a source's tilted rates may miss its target
    rounds: int = 80                       # the bracket is halved when Newton's steps do not converge
    bucket_rows: int = 50_000


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of the whole text."""
    return docs.select("doc_id", "source", F.coalesce(
        F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, p: MixParams) -> DataFrame:
    """(src, source, source_size, n_docs, target), a row for each source.

    With a common level every source gets ``min(cap * size, weight * level)``: sources
    below the level's share are full.  Full ones come first in order of cap over weight,
    so the level follows from running sums over the sources."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                         F.sum((F.col("size") > 0).cast("long")).alias("n_docs"))
    order = Window.orderBy(F.asc_nulls_last("source"))  # a row for each source
    weights = F.array(*map(F.lit, p.weights))
    ranked = totals.withColumn("src", F.row_number().over(order)).withColumn(
        "weight", F.get(weights, (F.col("src") - 1) % len(p.weights)).cast("double"))
    most = (p.cap * F.col("source_size")).cast("double")
    by_level = Window.orderBy(most / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum(F.col("source_size")).over(everything) - F.coalesce(F.sum(most).over(by_level), F.lit(0.0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0))
    # the level if this source and all after it are not full; the first that holds is the right one, and the highest
    level = F.when(left / rest * F.col("weight") <= most, left / rest)
    leveled = ranked.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return leveled.select("src", "source", "source_size", "n_docs",
                          F.least(most, F.col("weight") * F.coalesce("level", most)).alias("target"))


def _fixed(x):
    """Fixed-point number of a rate: sums of these do not depend on their order."""
    return F.floor(x * UNIT).cast("decimal(20,0)")


def _rate(p: MixParams):
    return F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(math.log(p.cap))))


def balanced(cells: DataFrame, goals: DataFrame, p: MixParams) -> DataFrame:
    """(src, mean, tilt, goal): the multiplier of each source, by Newton iterations on the dual."""
    mean = F.col("source_size") / F.col("n_docs")
    full = F.col("target") >= F.col("source_size") * float(p.cap) * (1 - 1e-12)
    more = F.col("target") >= F.col("source_size")
    top = math.log(p.cap) * mean
    low = F.when(more, 0.0).otherwise(F.log(F.col("target") / F.col("source_size")) * mean)
    state = stored(goals.where("source_size > 0").select(
        "src", mean.alias("mean"), F.col("target").alias("goal"), F.when(full, top).otherwise(F.lit(0.0)).alias("tilt"),
        low.alias("lo"), F.when(more, top).otherwise(F.lit(0.0)).alias("hi"), (top - low).alias("step"),
        full.alias("done")), "mix-state")
    words = (F.col("n") * F.col("size")).cast("decimal(18,0)")
    rate = _rate(p)
    free = F.col("tilt") * F.col("size") / F.col("mean") < math.log(p.cap)
    for _ in range(p.rounds):
        if state.where("not done").isEmpty():
            break
        sums = (cells.join(state.where("not done"), "src").groupBy("src").agg(
            (F.sum(words * _fixed(rate)).cast("double") / UNIT).alias("taken"),
            (F.sum(F.when(free, words * _fixed(rate * F.col("size") / F.col("mean"))).otherwise(F.lit(0).cast("decimal(38,0)")))
             .cast("double") / UNIT).alias("slope")))
        gap = F.col("taken") - F.col("goal")
        now = (state.join(sums, "src", "left")
               .withColumn("gap", gap)
               .withColumn("lo", F.when(F.col("gap") < 0, F.col("tilt")).otherwise(F.col("lo")))
               .withColumn("hi", F.when(F.col("gap") > 0, F.col("tilt")).otherwise(F.col("hi")))
               .withColumn("newton", F.when(F.col("slope") > 0, F.col("tilt") - F.col("gap") / F.col("slope"))))
        fits = F.coalesce((F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi"))
                          & (F.abs(F.col("newton") - F.col("tilt")) <= F.abs("step") / 2), F.lit(False))
        there = (F.abs("gap") <= p.near) | (F.col("hi") - F.col("lo") <= 1e-15 * (F.abs("hi") + F.abs("lo")))
        following = F.when(fits, F.col("newton")).otherwise((F.col("lo") + F.col("hi")) / 2)
        state = stored(now.select(
            "src", "mean", "goal", F.when(F.col("done") | there, F.col("tilt")).otherwise(following).alias("tilt"), "lo", "hi",
            F.when(F.col("done") | there, F.col("step")).otherwise(following - F.col("tilt")).alias("step"),
            (F.col("done") | F.coalesce(there, F.lit(True))).alias("done")), "mix-state")
    return state.select("src", "mean", "tilt", "goal")


def copies_of_cells(cells: DataFrame, tilts: DataFrame, p: MixParams) -> DataFrame:
    """(src, size, n, copies, rate): whole copies of each cell, what is left over carried to smaller sizes."""

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ascending=False, kind="stable")
        out, carry = np.zeros(len(pdf), np.int64), 0.0
        for i, (size, n, rate) in enumerate(zip(pdf["size"].tolist(), pdf["n"].tolist(), pdf["rate"].tolist())):
            want = carry + n * size * rate
            out[i] = min(max(round(want / size), 0), p.cap * n)
            carry = want - int(out[i]) * size
        return pdf.assign(copies=out)

    rated = cells.join(tilts, "src").select("src", "size", "n", (_fixed(_rate(p)).cast("double") / UNIT).alias("rate"))
    return rated.groupBy("src").applyInPandas(deal, "src int, size long, n long, rate double, copies long")


def mix(docs: DataFrame, p: MixParams = MixParams()) -> DataFrame:
    """(doc_id, size, source_size, target, rate, copies, taken), a row for each document."""
    sized = stored(sizes(docs), "mix-size")
    goals = stored(targets(sized, p), "mix-goal")
    named = lambda t: t.alias("d").join(goals.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
    by_size = sized.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    cells = stored(named(by_size).select("src", "size", "n"), "mix-cell")
    dealt = stored(copies_of_cells(cells, balanced(cells, goals, p), p), "mix-copies")
    n_rows = sized.count()
    buckets = max(1, math.ceil(n_rows / p.bucket_rows))
    spread = F.xxhash64("doc_id")
    rows = named(sized).select("doc_id", "src", "size", "source_size", "target",
                               spread.alias("spread"), F.pmod(spread, F.lit(buckets)).alias("bucket"))
    counts = stored(rows.where("size > 0").groupBy("src", "size", "bucket").agg(F.count("*").alias("here")), "mix-bucket")
    ahead = Window.partitionBy("src", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (counts.withColumn("before", F.coalesce(F.sum("here").over(ahead), F.lit(0)))
              .join(dealt, ["src", "size"]).select("src", "size", "bucket", "before", "n", "copies", "rate"))
    place = Window.partitionBy("src", "size", "bucket").orderBy("spread", "doc_id")
    numbered = rows.withColumn("place", F.row_number().over(place)).join(before, ["src", "size", "bucket"], "left")
    at = F.col("before") + F.col("place")
    # the copies beyond a whole number each, spread evenly: the i-th of n documents gets one of ``more`` if i * more mod n < more
    wide = lambda c: c.cast("decimal(18,0)")
    more = F.col("copies") % F.col("n")
    one = (wide(at) * wide(more)) % wide(F.col("n")) < wide(more)
    taken = F.floor(F.col("copies") / F.col("n")) + one.cast("long")
    copies = F.coalesce(taken, F.lit(0)).cast("long")
    return numbered.select("doc_id", "size", "source_size", "target", F.coalesce("rate", F.lit(0.0)).alias("rate"),
                           copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op12_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))
