"""Ranking, latest-per-key, prefixes and gaps-and-islands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group; Spark limits groups before and after the shuffle."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= n)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_group(df, keys, order, 1, "rank_").drop("rank_")


def until(df: DataFrame, group: list[str], order: list[Column], stop: Column) -> DataFrame:
    """Rows of each group before its first row where ``stop`` holds."""
    seen = F.sum(F.coalesce(stop.cast("int"), F.lit(0))).over(W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn("seen_", seen).where("seen_ = 0").drop("seen_")


def islands(df: DataFrame, group: list[str], order: list[Column], breaks: Column, name: str = "island") -> DataFrame:
    """Numbers runs of rows: a row where ``breaks`` holds begins a new one."""
    return df.withColumn(name, F.sum(F.coalesce(breaks.cast("int"),
        F.lit(0))).over(W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
