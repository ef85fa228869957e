"""Mixing sources to target weights (problem 8).

Every document gets an expected number of copies. The whole part is allocated for certain; the fraction is the
document's inclusion probability in a Pareto order sample: documents are ranked by the odds of a random number
divided by the odds of inclusion, and the first ones are taken until the source's budget of tokens is filled.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.session import cut

#: Expected copies grow with this power of a document's tokens: 0 treats all alike, 1 prefers length in full.
SIZE_POWER = 0.25
#: Size classes per doubling, for fitting the scale of a source; parts of the ranking that are summed before sorting.
CLASSES = 16
RANK_PARTS = 4096


def _plan(classes: list, targets: list, total: int | None, power: float) -> dict[str, dict]:
    """Budget and scale of each source. ``classes``: (source, tokens of a typical document, n documents, tokens)."""
    by = defaultdict(list)
    for s, x, n, t in classes:
        by[s].append((x, t))
    size = {s: sum(t for _, t in v) for s, v in by.items()}
    wanted = {s: (share, reps) for s, share, reps in targets}
    used = {s: w for s, w in wanted.items() if w[0] > 0 and w[1] > 0 and size.get(s)}
    shares = sum(share for share, _ in used.values())
    if not used:
        return {}
    if total is None:
        total = min([sum(size[s] for s in used), *(int(reps * size[s] * shares / share) for s, (share, reps) in used.items())])
    plan = {}
    for s, (share, reps) in used.items():
        budget = float(min(total * share / shares, reps * size[s]))
        low, high = 0.0, 1.0
        copies = lambda k: sum(min(reps, k * x**power) * t for x, t in by[s])
        while copies(high) < budget * (1 - 1e-12) and high < 1e12:
            high *= 2
        for _ in range(80):
            mid = (low + high) / 2
            low, high = (mid, high) if copies(mid) < budget else (low, mid)
        plan[s] = {"budget": budget, "scale": high, "reps": int(reps)}
    return plan


def mix_sources(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 7, power: float = SIZE_POWER, rank_parts: int = RANK_PARTS) -> DataFrame:
    """Documents of the mix: doc_id, source, n_tokens, copies (at least 1, at most the source's max_repeats).

    ``sized`` has doc_id, source, n_tokens; ``targets`` (a short list) has source, target_share, max_repeats. The
    total is ``total_tokens``, by default the largest at which every source can reach its share, but not beyond the
    size of the sources. If a given total is too large for a source, it is used max_repeats times and falls short.
    Each source takes the ranked documents that fit its budget, then the one document, if any, that best fills what
    is left; so its size is as close to the budget as its document sizes allow. Documents without source, target or tokens are not used;
    a target whose source has no tokens is spread over the others. The same seed gives the same mix.

    The ranking of a source is never sorted as a whole: its tokens are summed in ``rank_parts`` intervals of the rank
    variable, and only the interval in which the budget ends is put in order.
    """
    spark = sized.sparkSession
    base = sized.where((F.col("n_tokens") > 0) & F.col("source").isNotNull()).select("doc_id", "source", "n_tokens")
    step = F.floor(F.log2(F.col("n_tokens").cast("double")) * CLASSES)
    classes = base.groupBy("source", step.alias("c")).agg(F.avg("n_tokens"), F.count(F.lit(1)), F.sum("n_tokens"))
    wanted = [tuple(r) for r in targets.where(F.col("source").isNotNull()).select("source", "target_share", "max_repeats").collect()]
    names = spark.createDataFrame([(s,) for s, _, _ in wanted], "source string")
    rows = [(r[0], r[2], r[3], r[4]) for r in classes.join(F.broadcast(names), "source", "left_semi").collect()]
    plan = _plan(rows, wanted, total_tokens, power)
    planned = spark.createDataFrame([(s, p["budget"], p["scale"], p["reps"]) for s, p in plan.items()], "source string, budget double, scale double, reps int")

    expected = F.least(F.col("reps").cast("double"), F.col("scale") * F.pow(F.col("n_tokens").cast("double"), F.lit(power)))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11) + F.lit(0.5)) / F.lit(float(2**53))
    drawn = base.join(F.broadcast(planned), "source").withColumn("expected", expected)
    drawn = drawn.withColumn("whole", F.floor(F.col("expected") + 1e-9)).withColumn("p", F.greatest(F.col("expected") - F.col("whole"), F.lit(0.0)))
    odds = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    drawn = drawn.withColumn("q", F.when(F.col("p") > 1e-9, odds))
    drawn = cut(drawn.withColumn("part", F.floor(F.col("q") / (1 + F.col("q")) * rank_parts)).select("doc_id", "source", "n_tokens", "budget", "whole", "q", "part"))

    sums = drawn.groupBy("source", "budget", "part").agg(
        F.sum(F.col("whole") * F.col("n_tokens")).alias("certain"), F.sum(F.when(F.col("q").isNotNull(), F.col("n_tokens"))).alias("tokens")
    )
    of_source = Window.partitionBy("source")
    upto = of_source.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = (
        sums.withColumn("left", F.col("budget") - F.sum("certain").over(of_source))
        .where(F.col("part").isNotNull())
        .withColumn("before", F.sum("tokens").over(upto) - F.col("tokens"))
        .select("source", "part", "left", "before", (F.col("before") + F.col("tokens")).alias("after"))
    )
    ranked = drawn.where(F.col("q").isNotNull()).join(F.broadcast(parts), ["source", "part"])
    in_part = Window.partitionBy("source", "part").orderBy("q", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.col("before") + F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0)) + F.col("n_tokens")
    ends_here = (F.col("before") < F.col("left")) & (F.col("after") > F.col("left"))
    out = ["doc_id", "source", "n_tokens", "budget", "whole"]
    full = ranked.where(F.col("after") <= F.col("left")).select(*out, F.lit(1).alias("more"))
    last = ranked.where(ends_here).withColumn("more", F.when(filled <= F.col("left"), 1).otherwise(0)).select(*out, "more")
    none = ranked.where((F.col("before") >= F.col("left")) & (F.col("after") > F.col("left"))).select(*out, F.lit(0).alias("more"))
    sure = drawn.where(F.col("q").isNull()).select(*out, F.lit(-1).alias("more"))
    taken = cut(full.unionByName(last).unionByName(none).unionByName(sure))

    copies = F.col("whole") + F.greatest(F.col("more"), F.lit(0))
    gaps = taken.groupBy("source", "budget").agg(F.sum(copies * F.col("n_tokens")).alias("tokens"))
    gaps = gaps.select("source", (F.col("budget") - F.col("tokens")).alias("gap"))
    off = F.abs(F.col("gap") - F.col("n_tokens"))
    spare = taken.where(F.col("more") == 0).join(F.broadcast(gaps), "source").where(off < F.col("gap"))
    extra = spare.groupBy("source").agg(F.min_by("doc_id", F.struct(off, F.col("doc_id"))).alias("doc_id")).select("doc_id", F.lit(1).alias("extra"))
    mixed = taken.join(F.broadcast(extra), "doc_id", "left").withColumn("copies", (copies + F.coalesce("extra", F.lit(0))).cast("int"))
    return mixed.where(F.col("copies") > 0).select("doc_id", "source", "n_tokens", "copies")


def mix_report(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: source, target_share, actual_share, tokens, n_docs, most_copies. Unused targets report zeros."""
    got = mix.groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("n_docs"), F.max("copies").alias("most_copies")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    whole = F.sum(F.coalesce(F.col("tokens"), F.lit(0))).over(Window.partitionBy())  # one row per target
    joined = targets.where(F.col("source").isNotNull()).select("source", "target_share").join(got, "source", "left")
    share = F.when(whole > 0, F.coalesce(F.col("tokens"), F.lit(0)) / whole).otherwise(F.lit(0.0))
    return joined.select("source", "target_share", share.alias("actual_share"), zero("tokens"), zero("n_docs"), zero("most_copies"))
