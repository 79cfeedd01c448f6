"""Keyed merge over immutable tables: one operator, a policy for each column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: keep: the old value; take: the new one; greatest: the larger; coalesce: the new unless null;
#: increment: the sum. A column that the policy leaves out is kept.
POLICIES = ("keep", "take", "greatest", "coalesce", "increment")


def last_wins(source: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: a source must not hit a key twice."""
    return source.withColumn("nth_", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("nth_ = 1").drop("nth_")


def merge(target: DataFrame, source: DataFrame, keys: list[str], policy: Mapping[str, str], insert: bool = True) -> DataFrame:
    """``target`` with ``source`` merged in by ``keys``; both have the same columns, keys are not null.

    One full outer join: both sides are dealt by the key once. New keys are inserted as they are,
    unless ``insert`` is false.
    """
    if wrong := set(policy.values()) - set(POLICIES):
        raise ValueError(f"unknown policies: {sorted(wrong)}")
    old, new = target.withColumn("in_old", F.lit(True)).alias("o"), source.withColumn("in_new", F.lit(True)).alias("n")
    joined = old.join(new, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer" if insert else "left")

    def merged(c: str) -> Column:
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}")
        value = {"keep": o, "take": n, "greatest": F.greatest(o, n), "coalesce": F.coalesce(n, o),
            "increment": F.coalesce(o, F.lit(0)) + F.coalesce(n, F.lit(0))}[policy.get(c, "keep")]
        return F.when(F.col("n.in_new").isNull(), o).when(F.col("o.in_old").isNull(), n).otherwise(value).alias(c)

    return joined.select(*(F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in keys),
        *(merged(c) for c in target.columns if c not in keys))


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` and the rows of ``source`` with keys it has not."""
    return target.unionByName(source.join(target.select(*keys), keys, "left_anti"))


def replace_sets(target: DataFrame, source: DataFrame, owner: list[str]) -> DataFrame:
    """All rows of an owner that ``source`` names are replaced by those of ``source``."""
    return target.join(source.select(*owner).distinct(), owner, "left_anti").unionByName(source)


def replace_positions(target: DataFrame, source: DataFrame, owner: list[str], position: str, policy: Mapping[str, str]) -> DataFrame:
    """Lists of owners that ``source`` names: its positions are merged in by ``policy``, and those beyond its length are gone.

    Positions of a list go from 0 on. An owner whose list is empty is named by one row of a null position: all its rows go.
    """
    sizes = source.groupBy(*owner).agg(F.count(position).alias("size_"))
    merged = merge(target, source.where(F.col(position).isNotNull()), [*owner, position], policy)
    kept = merged.join(sizes, owner, "left").where(F.col("size_").isNull() | (F.col(position) < F.col("size_")))
    return kept.select(*target.columns)


def close_snapshot(target: DataFrame, complete: DataFrame, owner: str, this_run: Column, current: str = "is_current", run: str = "source_run",
    nulls: bool = False) -> DataFrame:
    """Rows of owners whose walk was complete, and that this run did not touch, are no longer current.

    ``complete`` has the owners (key ``owner``). Rows without a run are closed only if ``nulls``.
    """
    from ..functions.columns import untouched

    flagged = target.join(complete.select(owner).distinct().withColumn("complete_", F.lit(True)), owner, "left")
    close = F.coalesce(F.col("complete_"), F.lit(False)) & untouched(F.col(run), this_run, nulls)
    return flagged.withColumn(current, F.when(close, F.lit(False)).otherwise(F.col(current))).drop("complete_")


def erase(key: str, gone: DataFrame, **tables: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Erases the keys of ``gone`` from all tables: (name, n) counts from before, and the tables after."""
    parts = [t.join(gone.select(key), key, "left_semi").agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n, t in tables.items()]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    return counts, {n: t.join(gone.select(key), key, "left_anti") for n, t in tables.items()}
