"""Operator 10: embedding near-duplicates by sorted projection passes.

Each pass concatenates ``KEY_BITS`` random hashes of a vector into a sort key, orders all vectors by it and
compares each with its next ``window`` neighbours. A hash is the side of a random hyperplane through a
vector of the table (one of ``PIVOTS``, a bounded sample), so that a crowd of vectors of one
direction, which planes through the origin would not part, is parted as well as the rest. Pairs of
cosine ``threshold`` and more are united across passes.

What travels in a pass is not the vector but a sketch of it, a byte for each component, with a bound
of its error: pairs that the sketches leave open are decided on the vectors themselves.

How many passes are enough depends on how the vectors lie. Recall is therefore measured: beside a bounded sample of
vectors (``PROBES``) probes are sorted in, each turned away from its vector just to the threshold, the
hardest case. In a crowd of more vectors than a window has, a probe cannot meet its own, and need not: components are compared whole, so that what
counts there is whether all that its vector links with is in its component. That is tested on the vector's real links, against all vectors.
While fewer than a share of ``recall`` of the probes pass, another round of passes follows with new hashes and twice the window,
so that it ends at the latest when the window is the table.

Vectors of one component are then compared block by block on the vectors themselves, so that every link within
a component is counted, however large it is. Equal vectors are one throughout and count by their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import graph, shared

KEY_BITS, HASHES = 62, 256
PIVOTS, PROBES = 256, 1024
#: Standard deviations of a sketch's error within which a pair is decided on the vectors.
SURE = 6.0


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of unit vectors from a list column of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    with np.errstate(over="ignore"):
        x = x / np.abs(x).max(1, keepdims=True)  # no overflow of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def passes_for(vectors: int, window: int, threshold: float, miss: float) -> int:
    """Passes after which a pair at the threshold is missed with probability ``miss`` at most, if directions are even.

    In one pass its keys must agree on about log2(vectors / window) leading bits. More passes follow
    where that is not enough.
    """
    agree = 1 - math.acos(threshold) / math.pi
    one = agree ** max(0.0, math.log2(max(vectors, 2) / window))
    return max(8, math.ceil(math.log(miss) / math.log(1 - one))) if one < 1 else 8


def sketches(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components as whole numbers from -127 to 127, their unit, and the error that a cosine with any unit vector may have."""
    unit = np.abs(x).max(1, keepdims=True) / 127
    q = np.rint(x / unit)
    error = np.sqrt(((x - q * unit) ** 2).sum(1))
    spread = 1 / (x**4).sum(1)  # over how many components a vector is spread
    return q.astype(np.int8), unit[:, 0].astype(np.float32), (error * np.minimum(1, SURE / np.sqrt(spread))).astype(np.float32)


def sample(classes: DataFrame, seed: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """rid and unit vectors of at most PROBES classes, by length of vector."""
    rows = shared.drawn(classes.select("rid", "dim", "v"), PROBES, seed, "rid").toArrow().combine_chunks()
    dims = rows.column("dim").to_numpy()
    out = {}
    for d in np.unique(dims).tolist():
        own = rows.filter(pa.array(dims == d)).combine_chunks()
        out[d] = own.column("rid").to_numpy(), matrix(pa.concat_arrays(own.column("v").chunks))
    return out


def with_probes(classes: DataFrame, drawn: dict[int, tuple[np.ndarray, np.ndarray]], threshold: float, seed: int) -> DataFrame:
    """rid, v, dim of all classes and of the probes; that of the vector rid is -1 - rid."""
    rows, cos = [], min(1.0, threshold + 1e-4)
    for d, (rid, x) in drawn.items():
        z = np.random.default_rng([seed, d, 1]).normal(size=x.shape)
        z -= (z * x).sum(1, keepdims=True) * x
        y = cos * x + (1 - cos * cos) ** 0.5 * z / np.maximum(np.sqrt((z * z).sum(1, keepdims=True)), 1e-12)
        rows += [(int(-1 - r), v.tolist(), d) for r, v in zip(rid, y, strict=True) if d > 1]
    probes = classes.sparkSession.createDataFrame(rows, "rid long, v array<double>, dim int")
    return classes.select("rid", "v", "dim").unionByName(probes)


def pass_links(points: DataFrame, pivots: dict[int, np.ndarray], passes: int, window: int, vectors: int, threshold: float, seed: int) -> DataFrame:
    """Spanning links (a, b, sure) between neighbours in ``passes`` orders; those not sure are all that sketches leave open.

    A probe that meets its vector gives a link with itself as ``a``.
    """
    n = max(1, min(shared.partitions(points.sparkSession), vectors * passes // (16 * window)))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple] = {}
        for b in batches:
            dims = b.column(2).to_numpy()
            for d in np.unique(dims).tolist():
                own = b.filter(pa.array(dims == d))
                x = matrix(own.column(1))
                if d not in drawn:
                    r = np.random.default_rng([seed, d])
                    planes = r.normal(size=(d, HASHES))
                    through = pivots[d][r.integers(0, len(pivots[d]), HASHES)] if d in pivots else np.zeros((HASHES, d))
                    drawn[d] = planes, (through * planes.T).sum(1), [r.choice(HASHES, KEY_BITS, False) for _ in range(passes)]
                planes, level, chosen = drawn[d]
                side = (x @ planes > level).astype(np.int64)
                q, unit, error = sketches(x)
                packed = np.concatenate([q.view(np.uint8), unit.view(np.uint8).reshape(-1, 4), error.view(np.uint8).reshape(-1, 4)], 1)
                sketch = shared.binary(packed.reshape(-1), np.arange(len(x) + 1) * packed.shape[1])
                for p, bits in enumerate(chosen):
                    key = side[:, bits] @ (1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([own.column(0), pa.array(np.full(len(x), p, np.int32)), pa.array(np.full(len(x), d, np.int32)),
                        pa.array(key), sketch], ["rid", "pass", "dim", "key", "sketch"])

    def compared(rid: np.ndarray, q: np.ndarray, error: np.ndarray, fresh: int) -> Iterator[pa.RecordBatch]:
        """Links of rows in order; those among the first ``fresh`` rows are known."""
        forest, pairs, open_, real = graph.Forest(len(rid)), [], [], rid >= 0
        met = []
        for i in range(0, len(rid), 256):
            cos = q[i : i + 256] @ q[i : i + 256 + window].T
            j = np.arange(cos.shape[1])[None] - np.arange(cos.shape[0])[:, None]
            near = (j > 0) & (j <= window)
            near[: max(0, fresh - i), : max(0, fresh - i)] = False
            a, b = np.nonzero(near & (rid[i : i + 256, None] + rid[None, i : i + 256 + window] == -1))  # probes and their vectors
            met.append(np.minimum(rid[a + i], rid[b + i]))
            near &= real[i : i + 256, None] & real[None, i : i + 256 + window]
            margin = error[i : i + 256, None] + error[None, i : i + 256 + window] + 1e-6
            a, b = np.nonzero(near & (cos >= threshold + margin))
            k = forest.links(a + i, b + i)
            pairs.append((a[k] + i, b[k] + i))
            a, b = np.nonzero(near & (cos >= threshold - margin) & (cos < threshold + margin))
            open_.append((a + i, b + i))
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
        c, d = (np.concatenate(x) for x in zip(*open_, strict=True))
        apart = forest.label[c] != forest.label[d]
        c, d = c[apart], d[apart]
        if len(probe := np.concatenate(met)):
            yield pa.RecordBatch.from_arrays([pa.array(probe), pa.array(-1 - probe), pa.array(np.ones(len(probe), bool))], ["a", "b", "sure"])
        if len(a) + len(c):
            yield pa.RecordBatch.from_arrays([pa.array(rid[np.append(a, c)]), pa.array(rid[np.append(b, d)]),
                pa.array(np.arange(len(a) + len(c)) < len(a))], ["a", "b", "sure"])

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, rid, q, error = None, None, None, None  # the last ``window`` rows of a pass
        for b in batches:
            of = b.column("pass").to_numpy().astype(np.int64) << 32 | b.column("dim").to_numpy()
            cuts = np.flatnonzero(np.diff(of)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(of)], strict=True):
                if hi == lo:
                    continue
                d = int(of[lo] & 0xFFFFFFFF)
                packed = np.frombuffer(b"".join(b.column("sketch").slice(lo, hi - lo).to_pylist()), np.uint8).reshape(hi - lo, d + 8)
                unit, own_error = (np.ascontiguousarray(packed[:, d + k : d + k + 4]).view(np.float32)[:, 0] for k in (0, 4))
                own_q = packed[:, :d].view(np.int8).astype(np.float32) * unit[:, None]
                own_rid = b.column("rid").slice(lo, hi - lo).to_numpy()
                known = 0
                if here == of[lo]:
                    known = len(rid)
                    own_rid, own_q, own_error = np.append(rid, own_rid), np.concatenate([q, own_q]), np.append(error, own_error)
                yield from compared(own_rid, own_q, own_error, known)
                here, rid, q, error = of[lo], own_rid[-window:], own_q[-window:], own_error[-window:]

    order = ["pass", "dim", "key", "rid"]
    ordered = points.select("rid", "v", "dim").mapInArrow(keys, "rid long, pass int, dim int, key long, sketch binary").repartitionByRange(n,
        *order).sortWithinPartitions(*order)
    return ordered.select("pass", "dim", "rid", "sketch").mapInArrow(neighbours, "a long, b long, sure boolean")


def verified(links: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Links that are sure, and of the others those with that cosine on the vectors themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            dims = np.asarray(b.column("x").value_lengths())
            keep = np.zeros(b.num_rows, bool)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                x, y = (matrix(b.column(c).take(pa.array(at))) for c in ("x", "y"))
                keep[at] = (x * y).sum(1) >= threshold
            yield b.select(["a", "b"]).filter(pa.array(keep))

    links = links.where("a >= 0")
    unsure = links.where(~F.col("sure")).select("a", "b").distinct()
    both = unsure.join(classes.select(F.col("rid").alias("a"), F.col("v").alias("x")),
        "a").join(classes.select(F.col("rid").alias("b"), F.col("v").alias("y")), "b")
    return links.where("sure").select("a", "b").unionByName(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))


def whole_in_crowds(classes: DataFrame, found: DataFrame, drawn: dict[int, tuple[np.ndarray, np.ndarray]], met: set[int], window: int,
    threshold: float, recall: float) -> int:
    """Of the sampled vectors whose probes have not met them, how many are in a component of over ``window`` vectors that holds a share of
    ``recall`` of all vectors they link with."""
    spark = classes.sparkSession
    left = [int(r) for rid, _ in drawn.values() for r in rid if int(-1 - r) not in met]
    sizes = found.groupBy("component").count().where(F.col("count") > window)
    rows = found.join(F.broadcast(spark.createDataFrame([(r,) for r in left], "id long")), "id").join(sizes, "component").select("id",
        "component").collect()  # PROBES at most
    component = {r.id: r.component for r in rows}
    asked = {d: (rid[keep], x[keep], np.array([component[r] for r in rid[keep].tolist()])) for d, (rid, x) in drawn.items() if (keep := np.array([r in
        component for r in rid.tolist()])).any()}
    if not asked:
        return 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linked, inside = ({d: np.zeros(len(rid), np.int64) for d, (rid, _, _) in asked.items()} for _ in range(2))
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in asked.keys() & set(dims.tolist()):
                own = b.filter(pa.array(dims == d))
                x, of = matrix(own.column("v")), own.column("component").to_numpy()
                for lo in range(0, len(x), 1024):
                    near = x[lo : lo + 1024] @ asked[d][1].T >= threshold
                    linked[d] += near.sum(0)
                    inside[d] += (near & (of[lo : lo + 1024, None] == asked[d][2][None])).sum(0)
        for d, (rid, _, _) in asked.items():
            yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(linked[d]), pa.array(inside[d])], ["rid", "linked", "inside"])

    placed = classes.join(found.withColumnRenamed("id", "rid"), "rid", "left").select("dim", "v", F.coalesce("component", F.lit(-1)).alias("component"))
    sums = placed.mapInArrow(run, "rid long, linked long, inside long").groupBy("rid").agg(F.sum("linked").alias("linked"), F.sum("inside").alias("inside"))
    return sums.where(F.col("inside") - 1 >= recall * (F.col("linked") - 1)).count()  # itself is no link


def near_vectors(embeddings: DataFrame, threshold: float = 0.95, window: int = 256, miss: float = 0.002, recall: float = 0.995,
    seed: int = 23) -> DataFrame:
    """Per row of ``embeddings``: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, nor do
    vectors of different lengths with each other. Equal vectors link; a repeated id counts as another
    vector. Equal keys go by a number of the vector, so that ties are always ordered alike. A null id takes
    part but never names a component. An empty table gives an empty result; other columns are ignored.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(F.col("embedding").cast("array<double>"),
        lambda x: x + F.lit(0.0)).alias("v"))
    sound = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    # two hashes of 64 bits name a vector
    named = rows.where(F.coalesce(sound, F.lit(False))).select("vec_id", F.xxhash64("v").alias("one"), F.xxhash64(F.lit(seed), "v").alias("two"), "v")
    classes = named.groupBy("one", "two").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v"))
    classes = shared.written(classes.withColumns({"rid": F.monotonically_increasing_id(), "dim": F.size("v")}))
    vectors = classes.count()
    drawn = sample(classes, seed)
    pivots = {d: x[:PIVOTS] for d, (_, x) in drawn.items()}
    points = shared.written(with_probes(classes, drawn, threshold, seed))
    probes, met = sum(len(rid) for d, (rid, _) in drawn.items() if d > 1), set()
    passes, round_, edges, found = passes_for(vectors, window, threshold, miss), 0, None, None
    while True:
        links = shared.written(pass_links(points, pivots, passes, window, vectors, threshold, seed + round_))
        new = verified(links, classes, threshold)
        edges = new if edges is None else edges.unionByName(new)
        met |= {r.a for r in links.where("a < 0").select("a").distinct().collect()}  # PROBES at most
        if window >= vectors or len(met) >= recall * probes:
            break
        found = shared.written(graph.components(edges))
        if len(met) + whole_in_crowds(classes, found, drawn, met, window, threshold, recall) >= recall * probes:
            break
        shared.dropped(embeddings.sparkSession, found)
        found, round_, window = None, round_ + 1, window * 2
    if found is None:
        found = shared.written(graph.components(edges))
    shared.dropped(embeddings.sparkSession, points)
    members = found.withColumnRenamed("id", "rid").join(classes, "rid").select("component", "rid", "dim", "v", "copies")
    pairs = graph.block_pairs(members, ["component"], "rid")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, at in graph.whole_groups(batches, ["component", "i_", "j_"]):
            ids, counts = [], []
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                b = whole.slice(lo, hi - lo)
                x, copies, own, i, j = matrix(b.column("v")), b.column("copies").to_numpy(), b.column("own_").to_numpy(), b.column("i_")[0].as_py(), b.column("j_")[0].as_py()
                c = np.zeros(len(x), np.int64)
                for k in range(0, len(x), 512):
                    near = x[k : k + 512] @ x.T >= threshold
                    near[np.arange(near.shape[0]), np.arange(k, k + near.shape[0])] = False
                    if i != j:
                        near &= own[k : k + 512, None] != own[None]
                    c[k : k + 512] = near @ copies
                ids.append(b.column("rid").to_numpy()[c > 0])
                counts.append(c[c > 0])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(counts))], ["rid", "n"])

    linked = pairs.mapInArrow(counted, "rid long, n long").groupBy("rid").agg(F.sum("n").alias("n"))
    about = classes.select("rid", "one", "two", "id", "copies").join(linked, "rid", "left").join(found.withColumnRenamed("id", "rid"), "rid", "left")
    about = about.select("one", "two", "id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rid").alias("component"))
    names = about.groupBy("component").agg(F.min("id").alias("component_id"))
    about = about.join(names, "component").select("one", "two", "n_links", "component_id")
    sound_rows = named.drop("v").join(about, ["one", "two"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(sound, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"))
    return sound_rows.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(shared.table(spark, sf_dir, "embeddings"))
