"""Exact quantiles by distributed selection.

Approximate cuts divide the values into ranges; exact counts of these tell in which range each wanted rank lies; only these ranges are looked at again,
until one is small enough to be sorted. A value that is a cut is a range of its own, so that one that is repeated any number of times
ends the search instead of filling a range. No task and no driver sees more than ``MOST`` different values, whatever the table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST, RANGES = 50_000, 128


def exact(df: DataFrame, value: Column, probs: Sequence[float], most: int = MOST, ranges: int = RANGES) -> list[float | None]:
    """Quantiles of ``value`` with linear interpolation; nulls do not count, and of no values each is None."""
    x = df.select(value.cast("double").alias("x")).where("x is not null")
    n = x.count()
    if not n:
        return [None] * len(probs)
    at = [(n - 1) * p for p in probs]
    ranks = {k for h in at for k in (math.floor(h), math.ceil(h))}
    found: dict[int, float] = {}
    todo = [(None, None, 0, n)]  # open ranges: values above, values below, rows before, rows
    while todo:
        inside = lambda lo, hi: (F.lit(True) if lo is None else F.col("x") > lo) & (F.lit(True) if hi is None else F.col("x") < hi)
        wide = [r for r in todo if r[3] > most]
        for lo, hi, before, _ in (r for r in todo if r[3] <= most):
            for r in x.where(inside(lo, hi)).groupBy("x").count().orderBy("x").collect():
                found |= {k: r["x"] for k in ranks if before <= k < before + r["count"]}
                before += r["count"]
        todo = []
        if not wide:
            break
        steps = [i / ranges for i in range(ranges + 1)]
        cuts = x.agg(*(F.percentile_approx(F.when(inside(lo, hi), F.col("x")), steps, 20 * ranges).alias(f"c{i}") for i,
            (lo, hi, _, _) in enumerate(wide))).first()
        slot = None
        for i, (lo, hi, _, _) in enumerate(wide):
            c = F.array(*map(F.lit, sorted(set(cuts[i]))))
            below = F.size(F.filter(c, lambda y: y < F.col("x"))) * 2 + F.array_contains(c, F.col("x")).cast("int")  # even: between cuts, odd: a cut
            own = F.struct(F.lit(i).alias("of"), below.alias("slot"))
            slot = F.when(inside(lo, hi), own) if slot is None else slot.when(inside(lo, hi), own)
        counts = x.withColumn("s", slot).where("s is not null").groupBy("s").count().collect()  # 2 * ranges + 3 rows for each wide range
        counted = {(r["s"]["of"], r["s"]["slot"]): r["count"] for r in counts}
        for i, (lo, hi, before, _) in enumerate(wide):
            edges = sorted(set(cuts[i]))
            for s in range(2 * len(edges) + 1):
                rows = counted.get((i, s), 0)
                wanted = {k for k in ranks if before <= k < before + rows}
                if wanted and s % 2:
                    found |= dict.fromkeys(wanted, edges[s // 2])
                elif wanted:
                    todo.append((edges[s // 2 - 1] if s else lo, edges[s // 2] if s // 2 < len(edges) else hi, before, rows))
                before += rows
    return [found[math.floor(h)] + (found[math.ceil(h)] - found[math.floor(h)]) * (h - math.floor(h)) for h in at]


def terciles(df: DataFrame, value: Column) -> tuple[float, float]:
    """The quantiles 0.33 and 0.66 that bins are cut at; of no values, zeros."""
    a, b = exact(df, value, (0.33, 0.66))
    return a or 0.0, b or 0.0
