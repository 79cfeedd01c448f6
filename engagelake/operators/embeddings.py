"""Quality of embedding tables: norms, anisotropy, clustering tendency, spectrum, and a stand-in encoder."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c


#: Blocks that are added in one step, and steps: enough for a million tasks.
FAN, LEVELS = 32, 4


def norm_report(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row: vectors, bad components, zero vectors, and whether all norms are 1 within 1e-3."""
    n = c.norm(F.col(vector))
    bad = F.exists(vector, lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
    return df.agg(F.count("*").alias("vectors"), F.count_if(bad).alias("bad"), F.count_if(n < 1e-5).alias("zero"),
        F.min(F.abs(n - 1) < 1e-3).alias("unit_norms"), F.round(F.avg(n), 6).alias("mean_norm"))


def _moments(df: DataFrame, vector: str) -> tuple[int, np.ndarray, np.ndarray]:
    """n, sum and sum of outer products: each task gives one d x d block, and blocks are added FAN at a time, level by level."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, ss = 0, None, None
        for b in batches:
            x = np.array(b["v"].tolist(), float)
            if len(x):
                n, s, ss = n + len(x), x.sum(0) + (0 if s is None else s), x.T @ x + (0 if ss is None else ss)
        if n:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "n": [n], "s": [s.tolist()], "ss": [ss.ravel().tolist()]})

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [rows["part"].iloc[0] // FAN], "n": [rows["n"].sum()], "s": [np.sum(np.stack(rows["s"]), 0).tolist()],
            "ss": [np.sum(np.stack(rows["ss"]), 0).tolist()]})

    schema = "part long, n long, s array<double>, ss array<double>"
    parts = df.select(F.col(vector).cast("array<double>").alias("v")).where("v is not null").mapInPandas(run, schema)
    for _ in range(LEVELS):
        parts = parts.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(added, schema)
    rows = parts.collect()  # one row up to FAN ** LEVELS tasks
    if not rows:
        return 0, np.zeros(0), np.zeros((0, 0))
    d = len(rows[0].s)
    return sum(r.n for r in rows), sum(np.array(r.s) for r in rows), sum(np.array(r.ss) for r in rows).reshape(d, d)


def anisotropy(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Mean dot product over all pairs, from sums alone: (|sum v|^2 - sum |v|^2) / (n (n - 1))."""
    long = df.select(F.posexplode(F.col(vector)).alias("i", "x")).select("i", F.col("x").cast("double").alias("x"))
    per = long.groupBy("i").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"), F.count("*").alias("n"))
    n = F.max("n")
    return per.agg(F.round((F.sum(F.col("s") * F.col("s")) - F.sum("q")) / (n * (n - 1)), 6).alias("anisotropy"), n.alias("vectors"))


def spectrum(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """component, ratio, cumulative, with k95 and the effective rank (entropy of singular values) on each row."""
    n, s, ss = _moments(df, vector)
    spark = df.sparkSession
    schema = "component int, ratio double, cumulative double, k95 int, effective_rank double"
    if n < 2:
        return spark.createDataFrame([], schema)
    covariance = (ss - np.outer(s, s) / n) / (n - 1)
    values = np.maximum(np.linalg.eigvalsh(covariance)[::-1], 0)
    singular = np.sqrt(values * (n - 1))
    ratio = values / values.sum() if values.sum() else values
    p = singular / singular.sum() if singular.sum() else singular
    p = p[p > 0]
    cumulative = np.cumsum(ratio)
    k95 = min(len(ratio), int(np.searchsorted(cumulative, 0.95)) + 1)
    rank = float(np.exp(-(p * np.log(p)).sum()))
    return spark.createDataFrame([(i + 1, float(a), float(b), k95, rank) for i, (a, b) in enumerate(zip(ratio[:50], cumulative[:50], strict=True))],
        schema)


def hopkins(df: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 500, seed: int = 42) -> DataFrame:
    """One row: Hopkins statistic from at most ``most`` points. The points are broadcast; every vector meets each in its task."""
    rows = df.select(key, F.col(vector).cast("array<double>").alias("v")).where("v is not null")
    n, s, _ = _moments(rows, "v")
    spark = df.sparkSession
    d = len(s)
    if n < 5 or d < 2:
        return spark.createDataFrame([(0.5, n)], "hopkins double, vectors long")
    m = min(most, max(2, n // 10))
    drawn = [(r[0], r[1]) for r in rows.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(m).collect()]
    box = rows.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.min("x").alias("a"), F.max("x").alias("b")).orderBy("i").collect()
    low, high = np.array([r.a for r in box]), np.array([r.b for r in box])
    uniform = np.random.default_rng(seed).uniform(low, high, (m, d))
    points, own = np.array([v for _, v in drawn]), np.array([k for k, _ in drawn])

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        u, w = np.full(m, np.inf), np.full(m, np.inf)
        for b in batches:
            if not len(b):
                continue
            x, k = np.array(b["v"].tolist(), float), b[key].to_numpy()
            for target, out, skip in ((uniform, u, False), (points, w, True)):
                q = np.sqrt(np.maximum((target**2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * target @ x.T, 0))
                if skip:
                    q[own[:, None] == k[None]] = np.inf
                np.minimum(out, q.min(1), out=out)
        yield pd.DataFrame({"i": np.arange(m), "u": u, "w": w})

    least = rows.mapInPandas(nearest, "i int, u double, w double").groupBy("i").agg(F.min("u").alias("u"), F.min("w").alias("w"))
    return least.agg(F.coalesce(F.try_divide(F.sum("u"), F.sum("u") + F.sum("w")), F.lit(0.5)).alias("hopkins")).withColumn("vectors",
        F.lit(n).cast("long"))


def mock_embeddings(df: DataFrame, key: str, text: str, subject: str, dim: int = 64) -> DataFrame:
    """Stand-in encoder: a centre for each subject and noise for each text, both seeded by SHA-256, scaled to norm 1."""

    def seeded(s: str) -> np.ndarray:
        return np.random.RandomState(int(hashlib.sha256(s.encode()).hexdigest(), 16) % 2**31).normal(size=dim)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t, s in zip(b["t"], b["s"], strict=True):
                v = seeded(s or "") + 0.3 * seeded(t or "")
                out.append((v / max(np.linalg.norm(v), 1e-12)).tolist())
            yield pd.DataFrame({key: b["k"], "embedding": out})

    return df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(subject).alias("s")).mapInPandas(run,
        f"{key} long, embedding array<double>")


def projection(df: DataFrame, key: str, vector: str = "embedding", components: int = 2) -> DataFrame:
    """Coordinates of every vector along the first principal components; a component's largest entry is positive.

    Only the covariance comes to the driver; vectors are multiplied where they are.
    """
    n, s, ss = _moments(df, vector)
    d = len(s)
    if n < 2 or not d:
        return df.select(key, *(F.lit(0.0).alias(f"c{i + 1}") for i in range(components)))
    _, axes = np.linalg.eigh((ss - np.outer(s, s) / n) / (n - 1))
    axes = axes[:, ::-1][:, :components].T
    axes = axes * np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(1)])[:, None]
    centre = F.lit((s / n).tolist())
    centred = F.zip_with(F.col(vector), centre, lambda x, m: x.cast("double") - m)
    return df.where(F.col(vector).isNotNull()).select(key, *(F.round(c.dot(centred, F.lit(a.tolist())), 6).alias(f"c{i + 1}") for i,
        a in enumerate(axes)))
