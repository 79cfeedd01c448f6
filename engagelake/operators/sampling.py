"""Deterministic stratified sampling and distribution diagnostics."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as c


def stratified(df: DataFrame, strata: list[str], rank: Column, seq: str, target: int) -> DataFrame:
    """``target`` rows, shares of strata kept: floor of each stratum's share, then one more each.

    Extra rows go to strata by largest shortfall (rows less quota), then least quota, then first
    appearance (``seq``). Within a stratum rows go by ``rank``, then ``seq``. With no more rows than
    the target, all stay. Only a row for each stratum meets in one place, and no stratum is sorted beyond the
    target: the literal bound limits it before and after the shuffle.
    """
    sizes = df.groupBy(*strata).agg(F.count("*").alias("n_"), F.min(seq).alias("first_"))
    sizes = sizes.withColumn("total_", F.sum("n_").over(W.partitionBy(F.lit(1))))
    share = F.floor(F.lit(float(target)) * (F.col("n_") / F.col("total_").cast("double")))
    sizes = sizes.withColumn("k_", F.when(F.col("total_") <= target, F.col("n_")).otherwise(F.least(F.col("n_"), share)))
    spare = F.lit(target) - F.sum("k_").over(W.partitionBy(F.lit(1)))
    turn = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.desc(F.col("n_") - F.col("k_")), F.asc("k_"), F.asc("first_")))
    quota = sizes.select(*strata, (F.col("k_") + F.when((turn <= spare) & (F.col("k_") < F.col("n_")), 1).otherwise(0)).alias("quota_"))
    numbered = df.withColumn("rank_", F.row_number().over(W.partitionBy(*strata).orderBy(rank, seq))).where(F.col("rank_") <= target)
    return numbered.join(quota, strata).where("rank_ <= quota_").drop("rank_", "quota_")


def ks_distance(population: DataFrame, sample: DataFrame, value: str, ranges: int = 64) -> DataFrame:
    """One row: d, n, m. Distances are taken where values occur: two running sums over distinct values.

    The values are cut into ``ranges`` at approximate quantiles of the population; sums run within a range, each
    range starts from the sums of those before it, and only a row for each range meets in one place.
    """
    counts = population.groupBy(F.col(value).alias("x")).agg(F.count("*").alias("p"),
        F.lit(0).cast("long").alias("s")).unionByName(sample.groupBy(F.col(value).alias("x")).agg(F.lit(0).cast("long").alias("p"),
        F.count("*").alias("s")))
    each = counts.groupBy("x").agg(F.sum("p").alias("p"), F.sum("s").alias("s")).where("x is not null")
    cuts = population.agg(F.percentile_approx(value, [i / ranges for i in range(1, ranges)], 100 * ranges).alias("cuts"))
    each = each.crossJoin(F.broadcast(cuts)).select("x", "p", "s", F.size(F.filter("cuts",
        lambda c: c < F.col("x"))).alias("range"))  # one row of cuts
    sums = each.groupBy("range").agg(F.sum("p").alias("rp"), F.sum("s").alias("rs"))
    before = W.partitionBy(F.lit(1)).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("range", F.coalesce(F.sum("rp").over(before), F.lit(0)).alias("bp"),
        F.coalesce(F.sum("rs").over(before), F.lit(0)).alias("bs"))
    w = W.partitionBy("range").orderBy("x").rowsBetween(W.unboundedPreceding, 0)
    run = each.join(F.broadcast(starts), "range").select((F.col("bp") + F.sum("p").over(w)).alias("cp"),
        (F.col("bs") + F.sum("s").over(w)).alias("cs"))  # a row for each range
    total = sums.agg(F.sum("rp").alias("n"), F.sum("rs").alias("m"))
    gap = F.abs(F.try_divide(F.col("cp").cast("double"), F.col("n")) - F.try_divide(F.col("cs").cast("double"), F.col("m")))
    return run.crossJoin(F.broadcast(total)).groupBy("n", "m").agg(F.max(gap).alias("d")).select(F.coalesce("d", F.lit(0.0)).alias("d"), "n", "m")


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic: an alternating series that stops after its first term under 1e-7, at most 100 terms."""
    e = F.sqrt(n * m / (n + m))
    lam = (e + 0.12 + F.lit(0.11) / e) * d
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(False).alias("done"))

    def step(acc, k):
        term = F.lit(2.0) * F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * lam * lam)
        return F.when(acc["done"], acc).otherwise(F.struct((acc["sum"] + term).alias("sum"), (F.abs(term) < 1e-7).alias("done")))

    p = F.aggregate(F.sequence(F.lit(1), F.lit(100)), start, step)["sum"]
    return F.when(lam <= 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))


def chi_square(population: DataFrame, sample: DataFrame, category: str) -> DataFrame:
    """One row: statistic, df. Expected counts are the population's shares; categories that it lacks do not count."""
    p = population.groupBy(category).agg(F.count("*").alias("p"))
    s = sample.groupBy(category).agg(F.count("*").alias("s"))
    total = population.agg(F.count("*").alias("n")).crossJoin(sample.agg(F.count("*").alias("m")))
    expected = F.col("p") * F.col("m") / F.col("n")
    each = p.join(s, category, "left").crossJoin(F.broadcast(total)).where(expected > 0)
    return each.agg(F.coalesce(F.sum(F.pow(F.coalesce("s", F.lit(0)) - expected, 2) / expected), F.lit(0.0)).alias("statistic"),
        F.greatest(F.count("*") - 1, F.lit(1)).alias("df"))


def chi_square_pvalue(statistic: Column, df: Column) -> Column:
    """Wilson-Hilferty: half of erfc(z / sqrt 2), for reports of a row or few."""

    @F.pandas_udf("double")
    def erfc(x: pd.Series) -> pd.Series:
        return x.map(math.erfc)

    k = F.lit(2.0) / (df * 9)
    z = (F.pow(statistic / df, 1 / 3) - (1 - k)) / F.sqrt(k)
    return F.when(statistic <= 0, 1.0).otherwise(erfc(z / F.sqrt(F.lit(2.0))) / 2)


def synthetic_posts(ids: DataFrame, groups: int = 50) -> DataFrame:
    """A made population with closed-form columns: a post for each row of ``ids`` (id)."""
    i = F.col("id")
    pick = lambda *x: F.element_at(F.array(*map(F.lit, x)), (i % len(x) + 1).cast("int"))
    return ids.select(
        (i + 10000).alias("post_id"), (i % groups + 1).alias("group_id"), pick("cafe", "retail", "beauty", "sport").alias("subject"),
        pick("text_only", "text_image", "text_video", "trimodal").alias("modality"),
        ((i * 37) % 800 + 20).alias("text_length"), F.when(i % 4 >= 2, i % 120 + 5).otherwise(0).alias("duration"), (i % 100).alias("likes"),
        i.alias("seq"),
    )


def hash_sample_rank(seed: int, *keys: str) -> Column:
    return c.hash_rank(F.concat_ws(":", F.lit(str(seed)), *keys))
