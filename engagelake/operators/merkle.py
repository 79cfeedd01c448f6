"""Digests of tables of any size, as trees: equal tables have equal roots, and what differs is found by going down.

A row is digested by itself; its digest's first ``depth`` hex digits name its leaf, so that leaves are even whatever the keys are, and no order of
rows or partitions matters. The depth grows with the rows: a leaf has some ``LEAF_ROWS`` of them. Equal rows count in their leaf as one with a
number, so that repeated rows do not fill it either. A node digests its sixteen children with their names. No task holds more than a leaf or a node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF_ROWS = 1024


def canonical(df: DataFrame) -> Column:
    """A row as compact JSON with its columns in alphabetical order, nulls included."""
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})


def depth_for(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    depth = 0
    while leaf_rows * 16**depth < rows:
        depth += 1
    return depth


def row_digests(df: DataFrame, text: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by, row_digest, copies): a row for each different text."""
    return df.select(*by, F.sha2(text, 256).alias("row_digest")).groupBy(*by, "row_digest").agg(F.count("*").alias("copies"))


def leaves(rows: DataFrame, depth: int, by: Sequence[str] = ()) -> DataFrame:
    """(by, prefix, digest, rows) of the leaves."""
    one = F.concat_ws("*", "row_digest", F.col("copies").cast("string"))
    return rows.groupBy(*by, F.substring("row_digest", 1, depth).alias("prefix")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(one)), ","),
        256).alias("digest"), F.sum("copies").alias("rows"))


def parents(nodes: DataFrame, level: int, by: Sequence[str] = ()) -> DataFrame:
    """The nodes of ``level`` above those of the next."""
    child = F.concat_ws(":", "prefix", "digest")
    up = nodes.groupBy(*by, F.substring("prefix", 1, level).alias("up")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(child)), ","),
        256).alias("digest"), F.sum("rows").alias("rows"))
    return up.withColumnRenamed("up", "prefix")


def root(df: DataFrame, text: Column | None = None, by: Sequence[str] = (), depth: int | None = None, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(by, digest, rows): one row, or one for each group ``by``. An empty table has the digest of nothing and no rows."""
    text = canonical(df) if text is None else text
    if depth is None:
        most = df.groupBy(*by).count().agg(F.max("count")).first()[0] if by else df.count()
        depth = depth_for(most or 0, leaf_rows)
    nodes = leaves(row_digests(df, text, by), depth, by)
    for level in range(depth - 1, -1, -1):
        nodes = parents(nodes, level, by)
    if by:
        return nodes.drop("prefix")
    return nodes.agg(F.coalesce(F.first("digest"), F.sha2(F.lit(""), 256)).alias("digest"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def save(df: DataFrame, path: str, depth: int, text: Column | None = None) -> None:
    """Writes the tree of ``df``: a folder for each level, which the level above is made from."""
    nodes = leaves(row_digests(df, canonical(df) if text is None else text), depth)
    for level in range(depth, -1, -1):
        nodes.write.mode("overwrite").parquet(f"{path}/level={level}")
        nodes = parents(df.sparkSession.read.parquet(f"{path}/level={level}"), level - 1) if level else nodes


def changed_leaves(spark, one: str, other: str, depth: int) -> DataFrame:
    """(prefix) of the leaves that differ between two saved trees of one depth; only children of nodes that differ are compared."""
    changed = None
    for level in range(depth + 1):
        a, b = (spark.read.parquet(f"{p}/level={level}").select("prefix", "digest") for p in (one, other))
        if changed is not None:
            up = changed.withColumnRenamed("prefix", "up")
            a, b = (x.join(up, F.substring("prefix", 1, level - 1) == F.col("up"), "left_semi") for x in (a, b))
        changed = a.withColumnRenamed("digest", "a").join(b.withColumnRenamed("digest", "b"), "prefix", "full").where("not (a <=> b)").select("prefix")
    return changed


def differences(one: DataFrame, other: DataFrame, prefixes: DataFrame, depth: int) -> DataFrame:
    """The rows of the leaves ``prefixes`` that the tables do not share, and by how many (``surplus``: more in ``one`` if above zero)."""
    text = canonical(one)

    def part(df: DataFrame, sign: int) -> DataFrame:
        rows = df.withColumn("row_", F.sha2(text, 256)).join(prefixes, F.substring("row_", 1, depth) == F.col("prefix"), "left_semi")
        return rows.groupBy("row_", *one.columns).agg((F.count("*") * sign).alias("n_"))

    both = part(one, 1).unionByName(part(other, -1))
    return both.groupBy("row_", *one.columns).agg(F.sum("n_").alias("surplus")).where("surplus <> 0").drop("row_")
