"""Mixing sources to target weights by entropy balancing.

Rates stay as near 1 as possible (relative entropy) under a token constraint for each source: the sum of rate x tokens is
its share of the total.  The optimum is ``min(cap, exp(lambda x tokens))``, one multiplier for each source, and the
multipliers solve the convex dual.  Newton's steps are distributed: each is one aggregate over the (source, length)
histogram, which gives the gradient and curvature for all sources at once; a bracket keeps a step that overshoots inside.
Rates become copies by systematic rounding: within a source the documents stand in the order of their sizes, their rates
are summed up, and a document gets as many copies as whole numbers (from one random start) fall into its stretch.  That is
unbiased, repeatable and never above the cap, and the rounding errors of documents of like size cancel.  The sums run
within parts of a source (sizes of one magnitude, split by a hash of the key), whose totals are then added up.

The total is ``FILL`` of the largest for which no source needs more than its cap allows; at the limit itself every rate of
the scarcest source would be its cap and its multiplier infinite.  Targets of sources without documents are shared
out in proportion; documents of sources without a target get rate 0 and are reported as such.

Defined cases: empty and null sizes count 0 tokens and, having no say, get rate 1 (0 without a target); a null source has
no target; sources are compared in a plain spelling; repeated keys are drawn alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from postgrove.session import stored

FILL = 0.95
ROUNDS = 60
TOLERANCE = 1e-4
PARTS = 16


def source_name(c: Column) -> Column:
    """Lower case, no outer blanks, words joined by an underscore."""
    return F.regexp_replace(F.lower(F.trim(c)), r"[\s_-]+", "_")


def solve(histogram: DataFrame, targets: dict[str, float], caps: dict[str, float], mean: dict[str, float]) -> dict[str, float]:
    """The multiplier of each source (for tokens divided by the source's mean length)."""
    spark = histogram.sparkSession
    state = {s: 0.0 for s in targets}
    low, high = {s: -math.inf for s in targets}, {s: math.inf for s in targets}
    open_ = set(targets)
    for _ in range(ROUNDS):
        if not open_:
            break
        now = spark.createDataFrame([(s, state[s], float(caps[s]), float(mean[s])) for s in open_], "source string, lam double, cap double, mean double")
        x = F.col("tokens") / F.col("mean")
        rate = F.least(F.col("cap"), F.exp(F.least(F.lit(700.0), F.col("lam") * x)))
        rows = (
            histogram.join(F.broadcast(now), "source").groupBy("source")
            .agg(F.sum(F.col("n") * F.col("tokens") * rate).alias("got"), F.sum(F.when(rate < F.col("cap"), F.col("n") * F.col("tokens") * x * rate).otherwise(0.0)).alias("slope"))
            .collect()  # one row for each source with a target
        )
        for r in rows:
            s, gap = r.source, r.got - targets[r.source]
            if abs(gap) <= TOLERANCE * max(1.0, targets[s]):
                open_.discard(s)
                continue
            if gap > 0:
                high[s] = min(high[s], state[s])
            else:
                low[s] = max(low[s], state[s])
            step = state[s] - gap / r.slope if r.slope > 0 else math.nan
            if not low[s] < step < high[s]:
                step = (low[s] + high[s]) / 2 if math.isfinite(low[s] + high[s]) else (low[s] + 1.0 if gap < 0 else high[s] - 1.0)
            state[s] = step
    return state


def mix(documents: DataFrame, weights: DataFrame, key: str, source: str, size: Column, seed: int = 42) -> DataFrame:
    """(key, source, tokens, rate, copies) of every document; ``weights``: source, target_share, max_repeats."""
    spark = documents.sparkSession
    sized = stored(documents.select(F.col(key), source_name(F.col(source)).alias("source"), F.coalesce(size.cast("bigint"), F.lit(0)).alias("tokens")), "sizes")
    histogram = stored(sized.groupBy("source", "tokens").agg(F.count("*").alias("n")), "size-histogram")
    have = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("tokens")).alias("tokens"), F.sum("n").alias("n"))
    # One row for each target that has documents.
    wanted = weights.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats").join(have, "source").filter("tokens > 0 AND target_share > 0").collect()
    whole = sum(r.target_share for r in wanted)
    shares = {r.source: r.target_share / whole for r in wanted}
    caps = {r.source: float(r.max_repeats) for r in wanted}
    total = FILL * min((caps[r.source] * r.tokens / shares[r.source] for r in wanted), default=0.0)
    means = {r.source: max(1.0, r.tokens / r["n"]) for r in wanted}
    solved = solve(histogram, {s: shares[s] * total for s in shares}, caps, means)
    table = spark.createDataFrame([(s, solved[s], caps[s], means[s]) for s in solved], "source string, lam double, cap double, mean double")
    rate = F.when(F.col("lam").isNull(), 0.0).otherwise(F.least(F.col("cap"), F.exp(F.least(F.lit(700.0), F.col("lam") * F.col("tokens") / F.col("mean")))))
    rated = sized.join(F.broadcast(table), "source", "left").select(F.col(key), "source", "tokens", rate.alias("rate"))
    return systematic(rated, key, seed)


def systematic(rated: DataFrame, key: str, seed: int) -> DataFrame:
    """The rows with ``copies``; the sum of a source's copies is within one of the sum of its rates."""
    rows = rated.withColumn("__m", F.floor(2 * F.log2(F.col("tokens") + 1)).cast("int")).withColumn("__h", F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int"))
    totals = rows.groupBy("source", "__m", "__h").agg(F.sum("rate").alias("__t"))  # sources x magnitudes x PARTS
    before = F.sum("__t").over(Window.partitionBy("source").orderBy("__m", "__h").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(F.col("source").alias("__s"), F.col("__m").alias("__om"), F.col("__h").alias("__oh"), F.coalesce(before, F.lit(0.0)).alias("__before"))
    w = Window.partitionBy("source", "__m", "__h").orderBy("tokens", F.xxhash64(F.lit(seed), F.col(key)), key)
    upto = rows.withColumn("__upto", F.sum("rate").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    held = upto.join(offsets, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__m") == F.col("__om")) & (F.col("__h") == F.col("__oh")))
    start = F.pmod(F.xxhash64(F.lit(seed), F.coalesce("source", F.lit(""))), F.lit(2**40)) / float(2**40)
    end = F.col("__before") + F.col("__upto") + start
    # Sums of floats: a whole rate keeps its whole number of copies.
    copies = F.floor(end + 1e-9) - F.floor(end - F.col("rate") + 1e-9)
    return held.select(key, "source", "tokens", "rate", F.least(copies, F.ceil("rate")).cast("int").alias("copies"))


def mixture_report(mixed: DataFrame, weights: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, documents, copies, most_copies, tokens, actual_share) of every source on either side."""
    got = mixed.groupBy("source").agg(
        F.count("*").alias("documents"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), F.sum(F.col("copies") * F.col("tokens")).alias("tokens")
    )
    total = got.agg(F.sum("tokens").alias("__all"))
    named = weights.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats")
    return (
        named.join(got, "source", "full").join(F.broadcast(total))
        .select(
            "source", "target_share", "max_repeats", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("documents", "copies", "most_copies", "tokens")],
            F.when(F.col("__all") > 0, F.coalesce("tokens", F.lit(0)) / F.col("__all")).otherwise(0.0).alias("actual_share"),
        )
    )
