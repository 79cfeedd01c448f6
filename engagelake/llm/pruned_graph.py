"""Operator 12: nearest neighbours by robust-pruned directed graphs.

Distinct vectors are dealt to shards by a hash. In each shard a graph is built in batches: a greedy search from the entry point over
the graph so far proposes neighbours for every new vector, and robust pruning keeps few of them: going by distance, a candidate stays
unless one kept before is ``relax`` times closer to it than the new vector is, so that edges point in different directions and
some of them are long. Edges are then turned round as well, and a vector with too many is pruned again.

Searches begin at the best of a sample of entry points, which grows with the root of the shard. How wide a beam must be depends on how the
vectors lie: before the last ``TRIED`` vectors of a shard go in, they are searched for, and the beam is doubled until it finds ``RECALL`` of their
nearest neighbours by brute force.

The index is a table with a row for each distinct vector (shard, place, vector, edges). Queries go to every shard in
blocks, where a beam search keeps the best so far; what it has found is ranked by the cosine of the vectors themselves, in double
precision, and the best of all shards are the answer. Searches of a task go together, as arrays.

A shard has at most ``SHARD_ROWS`` vectors and ``SHARD_BYTES`` bytes, so that its task is bounded; the number of shards grows with the table.
Equal vectors are one vertex with its least ids; however many copies a vector has, no task gathers them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import graph, shared
from .vectors import matrix

#: Edges of a vertex, beam of its own search, and how much closer than the new vector another must be to make a candidate redundant.
DEGREE, BUILD_BEAM, RELAX = 24, 48, 1.2
#: A vertex may have so many edges, as a multiple of DEGREE, before it is pruned again.
SLACK = 1.5
#: A shard's vectors at least and at most, and its bytes at most.
LEAST_ROWS, SHARD_ROWS, SHARD_BYTES = 2048, 1 << 18, 256 << 20
#: Entry points of a graph, as a multiple of the root of its size, and those of them that a search begins at.
ENTRIES, ENTER = 4, 8
#: Vectors that a shard's beam is tried with, its first width, and the share of nearest neighbours in the shard that it must find.
TRIED, BEAM, RECALL = 64, 96, 0.97
#: Searches that go together.
TOGETHER = 256


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, by differences: cosines of vectors that are almost equal do not differ in single precision."""
    d = x - y
    return np.einsum("...i,...i->...", d, d)


def beam_search(x: np.ndarray, links: np.ndarray, entries: np.ndarray, q: np.ndarray, beam: int, expanded: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Places and squared distances of the ``beam`` nearest vertices met by greedy searches for the rows of q, nearest first; missing ones are -1.

    A search begins at the ``ENTER`` entry points nearest to q. ``expanded``: also those that were expanded on the way and fell out of the beam again.
    """
    n, width = len(q), links.shape[1]
    at = np.full((n, beam), -1, np.int32)
    away = np.full((n, beam), np.inf, np.float32)
    done = np.ones((n, beam), bool)
    begin = np.argsort(-(q @ x[entries].T), axis=1, kind="stable")[:, : min(ENTER, beam)]
    m = begin.shape[1]
    at[:, :m], done[:, :m] = entries[begin], False
    away[:, :m] = distances(x[at[:, :m]], q[:, None])
    best = np.argsort(away, axis=1, kind="stable")
    at, away, done = (np.take_along_axis(c, best, 1) for c in (at, away, done))
    seen = np.zeros((n, -(-len(x) // 8)), np.uint8)  # a bit for each vertex
    np.bitwise_or.at(seen, (np.arange(n)[:, None], at[:, :m] >> 3), np.left_shift(1, at[:, :m] & 7).astype(np.uint8))
    path_at, path_away, live = [], [], np.arange(n)
    while len(live):
        first = (~done[live]).argmax(1)
        here = at[live, first]
        done[live, first] = True
        if expanded:
            path_at.append((live, here))
            path_away.append(away[live, first])
        near = links[here]
        flat = np.maximum(near, 0)
        bit = np.left_shift(1, flat & 7).astype(np.uint8)
        fresh = (near >= 0) & (seen[live[:, None], flat >> 3] & bit == 0)
        r, c = np.nonzero(fresh)
        np.bitwise_or.at(seen, (live[r], flat[r, c] >> 3), bit[r, c])
        new = np.full((len(live), width), np.inf, np.float32)
        new[r, c] = distances(x[near[r, c]], q[live[r]])
        both = np.concatenate([away[live], new], 1)
        order = np.argsort(both, axis=1, kind="stable")[:, :beam]
        at[live] = np.take_along_axis(np.concatenate([at[live], np.where(fresh, near, -1)], 1), order, 1)
        away[live] = np.take_along_axis(both, order, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ~fresh], 1), order, 1)
        live = live[(~done[live]).any(1)]
    if not expanded:
        return at, away
    steps = len(path_at)
    all_at, all_away = np.full((n, steps), -1, np.int32), np.full((n, steps), np.inf, np.float32)
    for k, ((rows, here), far) in enumerate(zip(path_at, path_away, strict=True)):
        fell = ~(at[rows] == here[:, None]).any(1)
        all_at[rows[fell], k], all_away[rows[fell], k] = here[fell], far[fell]
    at, away = np.concatenate([at, all_at], 1), np.concatenate([away, all_away], 1)
    order = np.argsort(away, axis=1, kind="stable")[:, : 2 * beam]
    return np.take_along_axis(at, order, 1), np.take_along_axis(away, order, 1)


def robust_prune(x: np.ndarray, own: np.ndarray, at: np.ndarray, degree: int, relax: float, most: int = 1 << 30) -> np.ndarray:
    """For vertices ``own`` the ``degree`` candidates that stay, of the ``most`` nearest of ``at`` (-1: none), by relaxed distance pruning."""
    at = np.where(at == own[:, None], -1, at)
    points = x[np.maximum(at, 0)] - x[own][:, None]  # as seen from the vertex: no digits are lost where all are close
    away = np.where(at >= 0, (points * points).sum(2), np.inf)
    order = np.argsort(away, axis=1, kind="stable")[:, :most]
    at, away, points = np.take_along_axis(at, order, 1), np.take_along_axis(away, order, 1), np.take_along_axis(points, order[:, :, None], 1)
    square = (points * points).sum(2)
    between = square[:, :, None] + square[:, None] - 2 * (points @ points.transpose(0, 2, 1))
    alive = at >= 0
    out, kept = np.full((len(own), degree), -1, np.int32), np.zeros(len(own), np.int64)
    for c in range(at.shape[1]):
        take = np.flatnonzero(alive[:, c] & (kept < degree))
        if not len(take):
            continue
        out[take, kept[take]] = at[take, c]
        kept[take] += 1
        alive[take] &= relax**2 * between[take, c] > away[take]
    return out


class Graph:
    """A robust-pruned graph over the unit vectors x: ``links`` (a row of places for each vertex, -1: none), ``entries``, ``beam``."""

    def __init__(self, x: np.ndarray, k: int, seed: int, degree: int = DEGREE, relax: float = RELAX, recall: float = RECALL):
        n = len(x)
        self.x, self.degree, self.relax, self.room = x, degree, relax, int(degree * SLACK)
        self.links, self.size = np.full((n, self.room), -1, np.int32), np.zeros(n, np.int64)
        order = np.random.default_rng(seed).permutation(n).astype(np.int32)
        # entry points are a sample of all vectors: a crowd that no edge leads to from outside still has some of its own
        self.entries = order[: max(1, ENTRIES * int(n**0.5))]
        head = self.entries[: 2 * degree]
        self.join(head, robust_prune(x, head, np.tile(head, (len(head), 1)), degree, relax))
        tried = min(TRIED, n // 8, n - len(head))
        self.insert(order, len(head), n - tried)
        self.beam = self.tuned(order[: n - tried], order[n - tried :], k, recall)
        self.insert(order, n - tried, n)

    def insert(self, order: np.ndarray, inside: int, upto: int) -> None:
        """Vectors order[inside:upto] go in, after those before them."""
        while inside < upto:
            own = order[inside : min(upto, inside + min(TOGETHER, max(16, inside // 4)))]
            at, _ = beam_search(self.x, self.links, self.entries[:inside], self.x[own], BUILD_BEAM, expanded=True)
            self.join(own, robust_prune(self.x, own, at, self.degree, self.relax))
            inside += len(own)

    def tuned(self, inside: np.ndarray, outside: np.ndarray, k: int, recall: float) -> int:
        """The width of beam at which searches for vectors that are not in the graph yet find their k nearest of those that are."""
        beam = BEAM
        if not len(outside):
            return beam
        k = min(k, len(inside))
        away = np.stack([distances(self.x[inside], q) for q in self.x[outside]])
        most = np.partition(away, k - 1, axis=1)[:, k - 1]
        while beam < len(inside):
            _, found = beam_search(self.x, self.links, self.entries[: len(inside)], self.x[outside], beam)
            if (found <= most[:, None] * (1 + 1e-6)).sum(1).clip(max=k).mean() >= recall * k:
                break
            beam *= 2
        return beam

    def join(self, new: np.ndarray, to: np.ndarray) -> None:
        """Sets the edges of ``new``, and turns them round."""
        x, links, size, room, degree = self.x, self.links, self.size, self.room, self.degree
        links[new, :degree] = to
        size[new] = (to >= 0).sum(1)
        r, c = np.nonzero(to >= 0)
        tail, head = to[r, c].astype(np.int64), new[r]
        by = np.argsort(tail, kind="stable")
        tail, head = tail[by], head[by]
        known = (links[tail] == head[:, None]).any(1)  # both are new and chose each other
        tail, head = tail[~known], head[~known]
        vertex, first, count = np.unique(tail, return_index=True, return_counts=True)
        at = size[tail] + np.arange(len(tail)) - np.repeat(first, count)
        fits = at < room
        links[tail[fits], at[fits]] = head[fits]
        full = vertex[size[vertex] + count > room]
        size[vertex] = np.minimum(size[vertex] + count, room)
        if not len(full):
            return
        tail, head = tail[~fits], head[~fits]
        slot = np.searchsorted(full, tail)
        extra = np.full((len(full), int(count.max())), -1, np.int32)
        extra[slot, np.arange(len(slot)) - np.searchsorted(slot, slot)] = head
        for lo in range(0, len(full), TOGETHER):
            own = full[lo : lo + TOGETHER]
            near = np.concatenate([links[own], extra[lo : lo + TOGETHER]], 1)
            links[own, :degree] = robust_prune(x, own, near, degree, self.relax, 4 * degree)
            links[own, degree:] = -1
            size[own] = (links[own] >= 0).sum(1)


def distinct_vectors(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rid, dim, v, one, two, copies) of distinct sound vectors, written; and (vec_id, one, two) of their rows, each id once for a vector."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(F.col("embedding").cast("array<double>"),
        lambda x: x + F.lit(0.0)).alias("v")).where("vec_id is not null")
    sound = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    named = rows.where(F.coalesce(sound, F.lit(False))).select("vec_id", F.xxhash64("v").alias("one"), F.xxhash64(F.lit(7), "v").alias("two"), "v")
    classes = named.groupBy("one", "two").agg(F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
    return shared.written(classes.withColumns({"rid": F.monotonically_increasing_id(), "dim": F.size("v")})), named.drop("v").distinct()


INDEX = "shard long, dim int, place int, entry int, beam int, rid long, v array<double>, links array<int>"


def index(classes: DataFrame, k: int, seed: int = 29) -> tuple[DataFrame, int]:
    """The graphs of all shards as a written table (INDEX), and the number of shards for each length of vector.

    ``entry`` is an entry point's place among these, else -1; ``beam`` the width at which the shard's searches find enough of the ``k`` nearest.
    """
    spark = classes.sparkSession
    n, widest = classes.agg(F.count("*"), F.max("dim")).first()
    room = max(1, min(SHARD_ROWS, SHARD_BYTES // (4 * (widest or 1))))
    shards = max(1, -(-n // min(room, max(LEAST_ROWS, -(-n // shared.partitions(spark))))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, at in graph.whole_groups(batches, ["dim", "shard"]):
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                b = whole.slice(lo, hi - lo)
                made = Graph(matrix(b.column("v")).astype(np.float32), k, seed)
                links, entry = made.links, np.full(hi - lo, -1, np.int32)
                entry[made.entries] = np.arange(len(made.entries))
                count = (links >= 0).sum(1)
                flat = pa.array(links[links >= 0])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), flat)
                place = np.arange(hi - lo, dtype=np.int32)
                out = pa.RecordBatch.from_arrays([b.column("shard"), b.column("dim"), pa.array(place), pa.array(entry),
                    pa.array(np.full(hi - lo, made.beam, np.int32)), b.column("rid"), b.column("v"), lists], [c.split()[0] for c in INDEX.split(", ")])
                for first in range(0, hi - lo, shared.BATCH_ROWS):
                    yield out.slice(first, shared.BATCH_ROWS)

    dealt = classes.select("rid", "dim", "v", F.pmod(F.xxhash64("rid", F.lit(seed)), F.lit(shards)).alias("shard"))
    dealt = dealt.repartition(min(shards, shared.partitions(spark)) if shards > 1 else 1, "dim", "shard").sortWithinPartitions("dim", "shard", "rid")
    return shared.written(dealt.mapInArrow(build, INDEX)), shards


def search(graphs: DataFrame, shards: int, queries: DataFrame, k: int) -> DataFrame:
    """(query, rid, score): of each shard the ``k`` best vectors found for every row of ``queries`` (query, dim, v)."""
    n = max(1, min(shards, shared.partitions(graphs.sparkSession)))
    vertices = graphs.select("dim", "shard", F.lit(0).alias("kind"), "place", "entry", "beam", "rid", "v", "links")
    asked = queries.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("kind"),
        F.lit(0).alias("place"), F.lit(-1).alias("entry"), F.lit(0).alias("beam"), F.col("query").alias("rid"), "v", F.lit(None).cast("array<int>").alias("links"))

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
        """Batches cut where (dim, shard, kind) changes."""
        for b in batches:
            keys = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "shard", "kind")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
                if hi > lo:
                    yield tuple(keys[:, lo].tolist()), b.slice(lo, hi - lo)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts, loaded = None, [], None
        for (dim, shard, kind), b in groups(batches):
            if kind == 0:
                if here != (dim, shard):
                    here, parts, loaded = (dim, shard), [], None
                parts.append(b)
                continue
            if here != (dim, shard):
                continue  # no vectors of this length in the shard
            if loaded is None:
                x = np.concatenate([matrix(p.column("v")) for p in parts])
                rid = np.concatenate([p.column("rid").to_numpy() for p in parts])
                entry = np.concatenate([p.column("entry").to_numpy() for p in parts])
                entries = np.flatnonzero(entry >= 0)
                entries = entries[np.argsort(entry[entries])].astype(np.int32)
                beam = parts[0].column("beam")[0].as_py()
                count = np.concatenate([np.asarray(p.column("links").value_lengths()) for p in parts])
                links = np.full((len(x), int(count.max(initial=0)) or 1), -1, np.int32)
                links[np.repeat(np.arange(len(x)), count), shared.ragged(np.zeros(len(x), np.int64), count)] = np.concatenate(
                    [p.column("links").flatten().to_numpy() for p in parts])
                loaded, parts = (x, x.astype(np.float32), rid, entries, links, beam), []
            x, single, rid, entries, links, beam = loaded
            q = matrix(b.column("v"))
            asks = b.column("rid").to_numpy()
            for lo in range(0, len(q), TOGETHER):
                own = q[lo : lo + TOGETHER]
                at, _ = beam_search(single, links, entries, own.astype(np.float32), beam)
                score = np.where(at >= 0, (x[np.maximum(at, 0)] @ own[:, :, None])[:, :, 0], -np.inf)
                best = np.argsort(-score, axis=1, kind="stable")[:, :k]
                at, score = np.take_along_axis(at, best, 1), np.take_along_axis(score, best, 1)
                r, c = np.nonzero(at >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(asks[lo : lo + TOGETHER][r]), pa.array(rid[at[r, c]]), pa.array(score[r, c])],
                    ["query", "rid", "score"])

    order = ["dim", "shard", "kind", "place", "rid"]
    return vertices.unionByName(asked).repartition(n, "dim", "shard").sortWithinPartitions(*order).mapInArrow(found,
        "query long, rid long, score double")


def nearest(embeddings: DataFrame, every: int = 50, k: int = 5, seed: int = 29) -> DataFrame:
    """Per query (rows whose vec_id is divisible by ``every``) its ``k`` nearest others found: query_id, rank, vec_id, score.

    ``score`` is the cosine in double precision. Vectors that are null, empty, zero or hold a null or non-finite component take no
    part, nor do null ids; vectors of different lengths do not meet. Of equal scores the smaller vec_id comes first. Rows of one id and one vector are
    one row; rows of one id with different vectors are several vectors of that id: none of them answers a query of that id, which is answered
    for each of its vectors. An empty table gives an empty result; other columns are ignored.
    """
    classes, rows = distinct_vectors(embeddings)
    graphs, shards = index(classes, k + 1, seed)
    vector = ["one", "two"]
    # a query leaves out one id, its own: k + 1 ids of a vector are all that it can be answered with
    first = Window.partitionBy(*vector).orderBy("vec_id")
    names = rows.withColumn("n_", F.row_number().over(first)).where(F.col("n_") <= k + 1).join(classes.select(*vector, "rid"), vector)
    names = names.groupBy("rid").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asking = graph.spread_join(rows.where(F.col("vec_id") % every == 0), classes.select(*vector, F.col("rid").alias("query"), "copies"), vector, "copies",
        classes.count()).select(F.col("vec_id").alias("query_id"), "query")
    askers = asking.groupBy("query").agg(F.count(F.lit(1)).alias("askers"))
    queries = askers.join(classes.select(F.col("rid").alias("query"), "dim", "v"), "query")
    # of all shards the best k + 1 vectors, by score and least id, hold the best k + 1 rows
    hits = search(graphs, shards, queries, k + 1).join(names, "rid")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("ids")[0])
    hits = hits.withColumn("n_", F.row_number().over(best)).where(F.col("n_") <= k + 1)
    pairs = F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("away"), i.alias("vec_id")))))
    answers = hits.groupBy("query").agg(F.sort_array(pairs).alias("pairs")).join(askers, "query")
    told = graph.spread_join(asking, answers, ["query"], "askers", classes.count())
    others = F.slice(F.filter("pairs", lambda p: p["vec_id"] != F.col("query_id")), 1, k)
    score = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), -F.col("p.away")))
    return told.select("query_id", F.posexplode(others).alias("at", "p")).select("query_id", (F.col("at") + 1).alias("rank"), "p.vec_id",
        score.alias("score"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(shared.table(spark, sf_dir, "embeddings"))
