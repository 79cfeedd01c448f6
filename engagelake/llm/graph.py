"""Connected components, and all pairs within groups by blocks, for groups of any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import shared

#: Rows of a key, at least, that make it heavy, and how many heavy keys there can be: those with more than one in so many rows.
HEAVY, HEAVY_KEYS = 500, 10_000
#: Members of a block of a group, at least, and its growth with the root of the group's size. A task compares two blocks:
#: m members travel m**1.5 / BLOCK_GROWTH times in all, and a million of them come in blocks of 2,000.
BLOCK, BLOCK_GROWTH = 128, 2.0


def spread_join(rows: DataFrame, sums: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``rows`` joined with ``sums``, which has one row for each key and counts its rows in ``size``.

    Keys with more than a ten-thousandth of all ``total`` rows are at most ten thousand: they are broadcast, and
    their rows stay where they are; the rest is shuffled. No key's rows swamp a task.
    """
    least = max(HEAVY, total // HEAVY_KEYS)
    others = [c for c in sums.columns if c not in keys]
    heavy = F.broadcast(sums.where(F.col(size) > least).withColumn("heavy_", F.lit(True)))
    tagged = rows.join(heavy, keys, "left")
    rest = tagged.where("heavy_ is null").select(*rows.columns).join(sums.where(F.col(size) <= least), keys)
    columns = [*rows.columns, *others]
    return tagged.where("heavy_").select(*columns).unionByName(rest.select(*columns))


def spread_anti(rows: DataFrame, sums: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``rows`` whose key is not in ``sums``, which counts the rows of its keys in ``size``; rows of heavy keys go where they lie."""
    least = max(HEAVY, total // HEAVY_KEYS)
    heavy = F.broadcast(sums.where(F.col(size) > least).select(*keys))
    return rows.join(heavy, keys, "left_anti").join(sums.where(F.col(size) <= least).select(*keys), keys, "left_anti")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of ``edges`` (a long, b long); the component is its least id.

    Alternating large and small stars: each round hangs neighbours under the least id in reach, so
    that rounds grow with the logarithm of a component's size. A node with very many edges is never
    gathered: its minimum is a partial aggregate and comes to its edges (``spread_join``).
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e, state = measured(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("size_"))
        large = spread_join(both.where("b > a"), least, ["a"], "size_", 2 * state[0]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("size_"))
        small = spread_join(large, low, ["a"], "size_", 2 * state[0]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before = e
        e, now = measured(small.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        shared.dropped(edges.sparkSession, before)
        if now == state:
            break
        state = now
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("id"),
        F.col("b").alias("component")).distinct())


def measured(e: DataFrame) -> tuple[DataFrame, tuple]:
    """``e`` written, and its number of edges and sum of their hashes, counted as it is written."""
    seen = Observation()
    out = shared.written(e.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        F.lit(0)).alias("sum")))
    return out, (seen.get["n"], seen.get["sum"])


def block_pairs(members: DataFrame, group: list[str], member: str, payload: DataFrame | None = None, total: int | None = None,
    least: int = BLOCK) -> DataFrame:
    """Rows of ``members`` for every pair of blocks of their group that they belong to.

    Adds i_ and j_ (the blocks, i_ <= j_) and own_ (the row's block). Members are dealt to blocks by a hash
    of ``member``; groups of one are left out. Rows with equal
    (group, i_, j_) are in one partition, sorted by these: no task holds more than two blocks of a group at a time.
    ``payload`` (a row for each member) is joined to the members that are left. ``total``: an upper bound of
    the members' number, counted if not given. ``least``: members of a block, at least; small payloads go in larger blocks.
    """
    sizes = members.groupBy(*group).agg(F.count("*").alias("size_")).where("size_ > 1")
    n = F.ceil(F.col("size_") / F.greatest(F.lit(float(least)), F.lit(BLOCK_GROWTH) * F.sqrt("size_"))).cast("int")
    placed = spread_join(members, sizes, group, "size_", members.count() if total is None else total).withColumn("own_",
        F.pmod(F.xxhash64(member, F.lit(5)), n).cast("int"))
    if payload is not None:
        placed = placed.join(payload, member)
    pairs = placed.withColumn("other_", F.explode(F.sequence(F.lit(0), n - 1))).withColumns({"i_": F.least("own_", "other_"),
        "j_": F.greatest("own_", "other_")}).drop("size_", "other_")
    keys = [*group, "i_", "j_"]
    return pairs.repartition(shared.partitions(members.sparkSession), *keys).sortWithinPartitions(*keys, member)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole groups of sorted rows (integer keys), with the groups' bounds."""
    held: list[pa.RecordBatch] = []

    def merged() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def starts(b: pa.RecordBatch) -> np.ndarray:
        new = np.ones(b.num_rows, bool)
        new[1:] = False
        for k in keys:
            v = b.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    for b in batches:
        if not b.num_rows:
            continue
        if held and all(held[-1].column(k)[held[-1].num_rows - 1] == b.column(k)[0] for k in keys) and len(starts(b)) == 1:
            held.append(b)  # one group goes on
            continue
        held.append(b)
        whole = merged()
        at = starts(whole)
        if len(at) > 1:
            yield whole.slice(0, int(at[-1])), at
        held = [whole.slice(int(at[-1]))]
    if held:
        whole = merged()
        yield whole, np.append(starts(whole), whole.num_rows)


class Forest:
    """The trees that links between the rows of a block have joined so far; a tree's label is its least row."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def links(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the links a[i], b[i] join two trees; the others close circles."""
        out, left = [], np.arange(len(a))
        while len(left):
            p, q = self.label[a[left]], self.label[b[left]]
            apart = p != q
            left, low, high = left[apart], np.minimum(p, q)[apart], np.maximum(p, q)[apart]
            tree, first = np.unique(high, return_index=True)  # each tree hangs under a lesser one: no circle
            self.label[tree] = low[first]
            out.append(left[first])
            while not np.array_equal(up := self.label[self.label], self.label):
                self.label = up
        return np.concatenate(out) if out else np.zeros(0, np.int64)
