"""Mixing sources to target weights by entropy balancing (operator 1).

Every document gets a rate: how often the mix should hold it.  Among all
rates up to ``cap`` whose words add up to each source's target, the ones
closest to an even mix (in relative entropy) are
``rate = min(cap, even * exp(lambda_s * size / mean_size_s))``; the dual
variables ``lambda_s`` solve a convex problem whose gradient is
``words at these rates - target``.  Newton steps, kept inside a bracket, find
them; each is one distributed aggregation over the counts of documents by
(source, size), to which the sums reduce exactly.  Rates become copies by
carrying the rounding error from the longest size of a source to the
shortest, so a source misses its target by about one of its short documents.
Which documents of a size get the extra copy is decided by the smallest
hashes of (doc_id, text).  Rows that agree in source and both are numbered and
hash with their number, so a text that is half of its source is taken as often
as the target asks for; which of such rows is taken may change from run to run,
how many may not.

Edge cases: a null or empty text has size 0 and takes nothing; a null source
is a source, last in order; an empty table mixes to an empty one; only doc_id,
text and source are read, further columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histlake.llm.common import WORD, Stage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
#: documents of one (source, size) are ranked in parts of about this many
PART = 256


def sized(docs: DataFrame, at: Column | None = None) -> DataFrame:
    """doc_id, source, size (words), u, a hash that orders equal sizes, and at,
    the row's number in a staged table."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    at = F.monotonically_increasing_id() if at is None else at
    return docs.select(at.alias("at"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       F.xxhash64(F.lit(1), F.col("doc_id").cast("long"), text).alias("u"))


def numbered(sizes: DataFrame, stage: Stage) -> DataFrame:
    """``sizes`` with a ``u`` of its own for every row that repeats another: the
    hash of ``u`` and the row's number among its like.  Numbers are given in two
    passes (place within the task that wrote the row, then the tasks' running
    counts), so no group is gathered in one task."""
    key = ["source", "size", "u"]
    many = stage.put(sizes.groupBy(*key).agg(F.count("*").alias("c")).where("c > 1").select(
        *[F.col(c).alias("r_" + c) for c in key]), "repeated")
    if many.isEmpty():
        return sizes
    like = ((F.col("u") == F.col("r_u")) & (F.col("size") == F.col("r_size"))
            & F.col("source").eqNullSafe(F.col("r_source")))
    rows = stage.put(sizes.join(many, like, "left").select(
        *sizes.columns, F.col("r_u").isNotNull().alias("again"), F.shiftright("at", 33).alias("task")), "again")
    again = rows.where("again")
    before = Window.partitionBy(*key).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    starts = stage.put(again.groupBy(*key, "task").agg(F.count("*").alias("c")).withColumn(
        "start", F.coalesce(F.sum("c").over(before), F.lit(0))).select(
        *[F.col(c).alias("r_" + c) for c in [*key, "task"]], "start"), "starts")
    place = F.row_number().over(Window.partitionBy(*key, "task").orderBy("at"))
    again = again.withColumn("place", place).join(starts, like & (F.col("task") == F.col("r_task")))
    no = F.col("start") + F.col("place") - 1
    again = again.withColumn("u", F.when(no > 0, F.xxhash64("u", no)).otherwise(F.col("u")))
    return stage.put(rows.where("not again").select(sizes.columns).union(again.select(sizes.columns)), "numbered")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """One row a source: sid, source, docs, source_size, target.

    Sources in code point order, null last, take the weights in turn.  A
    source full at ``cap`` times its size leaves the excess to the others by
    weight: with the sources in the order in which they fill up, the level
    all others share follows from running sums.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    per = per.withColumn("sid", F.row_number().over(order).cast("long") - 1)
    turn = F.pmod(F.col("sid"), F.lit(len(weights))).cast("int")
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    per = per.withColumn("full", F.lit(cap) * F.col("source_size"))
    fill = Window.orderBy(F.col("full") / F.col("w"), "sid")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * F.lit(share)
    level = ((total - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    # the first source that does not fill up at its level fixes the level of all after it
    per = per.withColumn("level", level)
    per = per.withColumn("free", F.col("w") * F.col("level") < F.col("full"))
    per = per.withColumn("fixed", F.min(F.when(F.col("free"), F.struct(F.col("full") / F.col("w"), "sid", "level")))
                         .over(every)["level"])
    target = F.when(F.col("fixed").isNull(), F.col("full")).otherwise(
        F.least(F.col("full"), F.col("w") * F.col("fixed")))
    return per.select("sid", "source", "docs", "source_size", target.alias("target"))


def solve_rates(cells: DataFrame, targets: DataFrame, stage: Stage, even: float, cap: float = CAP,
                tolerance: float = 1e-9, max_steps: int = 100) -> DataFrame:
    """lambda of every source, by guarded Newton steps on the dual."""
    x = F.col("size") / F.col("mean")
    rate = F.least(F.lit(cap), F.lit(even) * F.exp(F.least(F.col("lam") * x, F.lit(700.0))))
    mass = F.col("n") * F.col("size")
    state = stage.put(targets.where("source_size > 0").select(
        "sid", "target", (F.col("source_size") / F.col("docs")).alias("mean"),
        F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
        (F.col("target") >= F.lit(cap) * F.col("source_size")).alias("done")), "state")
    for _ in range(max_steps):
        if state.where("not done").isEmpty():
            break
        open_ = state.where("not done")
        sums = cells.join(open_, "sid").groupBy("sid").agg(
            F.sum(mass * rate).alias("got"),
            F.sum(F.when(rate < cap, mass * rate * x).otherwise(0.0)).alias("slope"))
        gap = F.col("got") - F.col("target")
        step = state.join(sums, "sid", "left")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        step = step.withColumn("gap", gap).withColumn("lo2", lo).withColumn("hi2", hi)
        newton = F.when(F.col("slope") > 0, F.col("lam") - F.col("gap") / F.col("slope"))
        inside = ((newton > F.coalesce("lo2", F.lit(float("-inf"))))
                  & (newton < F.coalesce("hi2", F.lit(float("inf"))))
                  & (F.abs(newton - F.col("lam")) <= 4 + F.abs("lam")))
        halved = (F.when(F.col("lo2").isNull(), F.col("lam") - 1 - F.abs("lam"))
                  .when(F.col("hi2").isNull(), F.col("lam") + 1 + F.abs("lam"))
                  .otherwise((F.col("lo2") + F.col("hi2")) / 2))
        close = ((F.abs("gap") <= tolerance * F.col("target"))
                 | (F.col("hi2") - F.col("lo2") <= 1e-13 * (1 + F.abs("lam"))))
        done = F.col("done") | F.coalesce(close, F.lit(False))
        state = stage.put(step.select(
            "sid", "target", "mean",
            F.when(done, F.col("lam")).when(inside, newton).otherwise(halved).alias("lam"),
            F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), done.alias("done")), "state")
    # sums in another order may move the last digits; copies must not depend on them
    return state.select("sid", "mean", F.round("lam", 7).alias("lam"))


def _round(cell: pd.DataFrame, cap: float) -> pd.DataFrame:
    """Copies of one source's cells, longest first, carrying the words still owed."""
    cell = cell.sort_values("size", ascending=False)
    owed = 0.0
    take = []
    for size, n, rate in zip(cell["size"], cell["n"], cell["rate"], strict=True):
        want = n * rate
        if size > 0:
            want += owed / size
        m = int(min(max(round(want), 0), int(cap) * n))
        owed += size * (n * rate - m)
        take.append(m)
    out = cell[["sid", "size", "n"]].copy()
    out["base"] = [m // n for m, n in zip(take, cell["n"], strict=True)]
    out["extra"] = [m % n for m, n in zip(take, cell["n"], strict=True)]
    return out


def copy_rules(sizes: DataFrame, targets: DataFrame, stage: Stage, cap: float = CAP) -> DataFrame:
    """source, size, part, parts, base, limit: a document of this source and
    size whose hash falls into this part gets ``base`` copies, and one more
    if its ``u`` is at most ``limit``."""
    keyed = stage.put(sizes.join(targets.select("sid", F.col("source").alias("s")),
                                 F.col("source").eqNullSafe(F.col("s"))).select("sid", "size", "u"), "keyed")
    cells = stage.put(keyed.groupBy("sid", "size").agg(F.count("*").alias("n")), "cells")
    total = targets.agg(F.sum("target"), F.sum("source_size")).first()
    even = total[0] / total[1] if total[1] else 1.0
    lam = solve_rates(cells, targets, stage, even, cap)
    full = targets.select("sid", (F.col("target") >= F.lit(cap) * F.col("source_size")).alias("full"))
    rate = F.when(F.col("full"), F.lit(cap)).otherwise(
        F.least(F.lit(cap), F.lit(even) * F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(700.0)))))
    rated = cells.join(full, "sid").join(lam, "sid", "left").select(
        "sid", "size", "n", F.coalesce(rate, F.lit(1.0)).alias("rate"))
    # one source's distinct sizes: k of them hold at least k * k / 2 words, so they stay few
    copies = stage.put(rated.groupBy("sid").applyInPandas(
        lambda cell: _round(cell, cap), "sid long, size long, n long, base long, extra long"), "copies")
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / PART)).cast("long")
    copies = copies.withColumn("parts", F.when(F.col("extra") > 0, parts).otherwise(F.lit(1)))
    some = keyed.join(copies.where("extra > 0"), ["sid", "size"]).withColumn(
        "part", F.pmod(F.shiftright("u", 20), F.col("parts")))
    some = stage.put(some.select("sid", "size", "u", "n", "extra", "part"), "some")
    # the extra copies of a size are dealt to its parts in proportion, by running sums
    held = some.groupBy("sid", "size", "n", "extra", "part").agg(F.count("*").alias("c"))
    upto = Window.partitionBy("sid", "size").orderBy("part")
    share = F.floor(F.sum("c").over(upto) * F.col("extra") / F.col("n"))
    held = held.withColumn("upto", share).withColumn("k", F.col("upto") - F.lag("upto", 1, 0).over(upto))
    ranked = some.join(held.where("k > 0").select("sid", "size", "part", "k"), ["sid", "size", "part"])
    by_u = Window.partitionBy("sid", "size", "part").orderBy("u")
    limit = ranked.withColumn("r", F.row_number().over(by_u)).where("r = k").select(
        "sid", "size", "part", F.col("u").alias("limit"))
    rules = copies.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rules = rules.join(limit, ["sid", "size", "part"], "left")
    return stage.put(rules.join(targets.select("sid", "source"), "sid").select(
        "source", "size", "part", "parts", "base", "limit"), "rules")


def mix(docs: DataFrame, stage: Stage, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        cap: float = CAP) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken of every row."""
    return _mixed(stage.put(sized(docs), "sizes"), stage, weights, share, cap)


def _mixed(sizes: DataFrame, stage: Stage, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    sizes = numbered(sizes, stage)
    targets = stage.put(source_targets(sizes, weights, share, cap), "targets")
    rules = copy_rules(sizes, targets, stage, cap)
    return _apply(sizes, rules, targets)


def _apply(sizes: DataFrame, rules: DataFrame, targets: DataFrame) -> DataFrame:
    per = rules.groupBy("source", "size").agg(F.max("parts").alias("parts"))
    per = per.join(targets.select(F.col("source").alias("s"), "source_size", "target"),
                   F.col("source").eqNullSafe(F.col("s"))).drop("s")
    key = [F.col("l.source").eqNullSafe(F.col("r.source")), F.col("l.size") == F.col("r.size")]
    rows = sizes.alias("l").join(per.alias("r"), key).select("l.*", "parts", "source_size", "target")
    rows = rows.withColumn("part", F.pmod(F.shiftright("u", 20), F.col("parts")))
    key.append(F.col("l.part") == F.col("r.part"))
    rows = rows.alias("l").join(rules.alias("r"), key).select("l.*", "base", "limit")
    extra = F.coalesce((F.col("u") <= F.col("limit")).cast("long"), F.lit(0))
    rows = rows.withColumn("copies", F.col("base") + extra)
    return rows.withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, stage: Stage, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                    cap: float = CAP) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns unchanged."""
    kept = stage.put(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "rows")
    read = kept.select("row.doc_id", "row.text", "row.source", F.col("at").alias("row_no"))
    sizes = stage.put(sized(read, F.col("row_no")), "sizes")
    rows = _mixed(sizes, stage, weights, share, cap).where("copies > 0").select("at", "copies")
    return kept.join(rows, "at").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
