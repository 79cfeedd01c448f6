"""Aggregations that recur in the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_where(df: DataFrame, key: str, **flags: Column) -> DataFrame:
    """One row: for each flag, how many distinct keys have a row where it holds.

    Groups by the key once and sums flags, where several filtered distinct counts would expand every row.
    """
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(*(F.max(F.coalesce(f, F.lit(False))).alias(n) for n, f in flags.items()))
    return per_key.agg(*(F.count_if(F.col(n)).alias(n) for n in flags))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """One row: how many keys occur more than once."""
    return df.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("duplicates"))


def fingerprint(df: DataFrame, value: Column, order: Column, most: int = 100_000) -> DataFrame:
    """One row: md5 of all values in order, and their number. For control tables of at most ``most`` rows, as the values are one string; more fail."""
    rows = df.select(F.struct(order.alias("o"), value.alias("v")).alias("x")).limit(most + 1)
    listed = F.array_sort(F.collect_list("x"))
    n = F.count("*")
    whole = F.when(n > most, F.raise_error(F.lit(f"a fingerprint takes {most} rows at most"))).otherwise(F.md5(F.array_join(F.transform(listed,
        lambda x: x["v"]), ",")))
    return rows.agg(whole.alias("fingerprint"), n.alias("n"))


def labelled_counts(spark, **tables: DataFrame) -> DataFrame:
    """A row (name, n) for each table."""
    parts = [t.agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
