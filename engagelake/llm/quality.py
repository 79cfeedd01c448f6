"""Operator 1: quality classifier, a byte-level convolutional network in numpy.

Bytes are embedded; learned filters run over overlapping chunks of ``WIDTH`` bytes at every
``STRIDE`` bytes of the whole document. Their rectified responses are averaged over
overlapping stretches of ``STRETCH`` chunks, max-pooled over the document and combined by a
hidden layer into one probability.

Training takes place on the driver over a bounded sample of labelled documents (``train``
names the bounds); scoring runs in the tasks, without a shuffle, on every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

WIDTH, STRIDE, STRETCH, HOP = 16, 4, 64, 32
EMBED, FILTERS, HIDDEN = 6, 24, 16
#: Bytes of text in a vectorised step, which takes some 160 bytes for each; stretches of a block of a longer text.
STEP, BLOCK = 1 << 18, 2048


class ByteConvNet:
    """Weights, a forward pass over a block of documents, and training by gradient descent."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "embed": r.normal(0, 0.5, (257, EMBED)),
            "filters": r.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)),
            "bias": np.zeros(FILTERS),
            "hidden": r.normal(0, (2 / FILTERS) ** 0.5, (FILTERS, HIDDEN)),
            "hidden_bias": np.zeros(HIDDEN),
            "out": r.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN),
            "out_bias": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    @staticmethod
    def layout(data: np.ndarray, offsets: np.ndarray):
        """Byte classes padded to whole chunks, chunk starts, and the documents' bounds among chunks.

        The pad class 256 fills a document's last chunk and stands for an empty document.
        """
        n = np.diff(offsets)
        chunks = np.maximum(1, -(-(n - WIDTH) // STRIDE) + 1)
        padded = (chunks - 1) * STRIDE + WIDTH
        at = np.concatenate([[0], np.cumsum(padded)])
        out = np.full(at[-1], 256, np.int16)
        out[shared.ragged(at[:-1], n)] = data
        return out, shared.ragged_steps(at[:-1], chunks, STRIDE), np.concatenate([[0], np.cumsum(chunks)])

    @staticmethod
    def stretches(bounds: np.ndarray):
        """First and last chunk of each stretch, and the documents' bounds among stretches."""
        n = np.diff(bounds)
        count = np.maximum(1, -(-(n - STRETCH) // HOP) + 1)
        of = np.repeat(np.arange(len(n)), count)
        at = np.concatenate([[0], np.cumsum(count)])
        lo = bounds[:-1][of] + (np.arange(at[-1]) - at[:-1][of]) * HOP
        return lo, np.minimum(lo + STRETCH, bounds[1:][of]), at

    def responses(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Filter responses of all chunks: one product per STRIDE bytes, then sums of shifted rows."""
        p, parts = self.p, WIDTH // STRIDE
        groups = np.take(p["embed"], codes, 0).reshape(-1, STRIDE * EMBED)
        kernel = p["filters"].reshape(parts, STRIDE * EMBED, FILTERS).transpose(1, 0, 2).reshape(STRIDE * EMBED, -1)
        y = groups @ kernel
        n = len(y) - parts + 1
        z = y[:n, :FILTERS] + p["bias"]
        for j in range(1, parts):
            z += y[j : n + j, j * FILTERS : (j + 1) * FILTERS]
        np.maximum(z, 0, out=z)
        return z[starts // STRIDE]

    def pooled(self, data: np.ndarray, offsets: np.ndarray):
        """The largest mean response of each filter for each document, and what it came from."""
        codes, starts, bounds = self.layout(data, offsets)
        z = self.responses(codes, starts)
        lo, hi, at = self.stretches(bounds)
        # sums of HOP chunks; a stretch is two neighbours
        blocks = -(-np.diff(bounds) // HOP)
        first = shared.ragged_steps(bounds[:-1], blocks, HOP)
        sums = np.add.reduceat(z, first, 0)
        base = np.concatenate([[0], np.cumsum(blocks)])
        k = base[:-1].repeat(np.diff(at)) + (lo - bounds[:-1].repeat(np.diff(at))) // HOP
        two = k + 1 < base[1:].repeat(np.diff(at))
        mean = (sums[k] + np.where(two[:, None], sums[np.minimum(k + 1, len(sums) - 1)], 0)) / (hi - lo)[:, None].astype(np.float32)
        return np.maximum.reduceat(mean, at[:-1], 0), mean, at, lo, hi, z, codes, starts

    def pooled_in_blocks(self, data: np.ndarray) -> np.ndarray:
        """``pooled`` of one document of any length: a running maximum over blocks of whole stretches, each a document of its own."""
        out, hop = None, HOP * STRIDE
        for lo in range(0, max(len(data) - STRETCH * STRIDE, 1), BLOCK * hop):
            part = data[lo : lo + (BLOCK - 1) * hop + (STRETCH - 1) * STRIDE + WIDTH] if lo + BLOCK * hop < len(data) - STRETCH * STRIDE else data[lo:]
            own = self.pooled(part, np.array([0, len(part)]))[0]
            out = own if out is None else np.maximum(out, own)
        return out

    def head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities, and the hidden layer."""
        p = self.p
        h = np.maximum(pooled @ p["hidden"] + p["hidden_bias"], 0)
        return 1 / (1 + np.exp(-np.clip(h @ p["out"] + p["out_bias"][0], -30, 30))), h

    def forward(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.head(self.pooled(data, offsets)[0])[0]

    def gradients(self, data: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        pooled, mean, at, lo, hi, z, codes, starts = self.pooled(data, offsets)
        y, h = self.head(pooled)
        dy = ((y - labels) / len(labels)).astype(np.float32)
        g = {"out": h.T @ dy, "out_bias": dy.sum(keepdims=True)}
        dh = np.outer(dy, p["out"]) * (h > 0)
        g |= {"hidden": pooled.T @ dh, "hidden_bias": dh.sum(0)}
        dpool = dh @ p["hidden"].T
        of = np.repeat(np.arange(len(y)), np.diff(at))
        top = mean == pooled[of]
        dmean = top * dpool[of] / np.maximum(np.add.reduceat(top, at[:-1], 0), 1)[of] / (hi - lo)[:, None]
        edge = np.zeros((len(z) + 1, FILTERS), np.float32)
        np.add.at(edge, lo, dmean)
        np.add.at(edge, hi, -dmean)
        dz = np.cumsum(edge[:-1], 0) * (z > 0)
        live = np.flatnonzero(np.abs(dz).max(1) > 1e-12)
        chunks = codes[starts[live][:, None] + np.arange(WIDTH)]
        x = np.take(p["embed"], chunks.reshape(-1), 0).reshape(len(live), WIDTH * EMBED)
        g |= {"filters": x.T @ dz[live], "bias": dz.sum(0)}
        dx = (dz[live] @ p["filters"].T).reshape(-1, WIDTH, EMBED)
        g["embed"] = np.zeros_like(p["embed"])
        where = chunks.reshape(-1)
        for k in range(EMBED):
            g["embed"][:, k] = np.bincount(where, dx[:, :, k].reshape(-1), 257)
        return g

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = 9, batch: int = 24, rate: float = 0.01, seed: int = 7) -> ByteConvNet:
        if len(set(labels.tolist())) < 2:  # nothing to tell apart: the share of label 1
            for k in ("out", "out_bias"):
                self.p[k][:] = 0
            if len(labels):
                self.p["out_bias"][:] = 4 if labels[0] else -4
            return self
        r, m, v, t = np.random.default_rng(seed), {}, {}, 0
        self.p["out_bias"][:] = np.log(labels.mean() / (1 - labels.mean()))
        total = epochs * -(-len(texts) // batch)
        for _ in range(epochs):
            order = r.permutation(len(texts))
            for i in range(0, len(order), batch):
                rows = order[i : i + batch]
                raw = [texts[j] for j in rows]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
                whole, g = np.frombuffer(b"".join(raw), np.uint8), {}
                for lo, hi in shared.steps(ends, STEP):  # the gradient of a batch is the mean of its parts'
                    part = self.gradients(whole[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo], labels[rows[lo:hi]].astype(np.float32))
                    for k, d in part.items():
                        g[k] = g.get(k, 0) + d * np.float32((hi - lo) / len(rows))
                t += 1
                for k, d in g.items():
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * d
                    v[k] = 0.99 * v.get(k, 0) + 0.01 * d * d
                    self.p[k] -= (rate * (1 - t / (total + 1)) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
        return self

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Scores to five places: beyond, single precision depends on where in a block a text stands."""
        out = []
        for lo, hi in shared.steps(offsets, STEP):
            own = data[offsets[lo] : offsets[hi]]
            out.append(self.head(self.pooled_in_blocks(own))[0] if hi == lo + 1 else self.forward(own, offsets[lo : hi + 1] - offsets[lo]))
        return np.round(np.concatenate(out).astype(np.float64), 5) if out else np.zeros(0)


def train(documents: DataFrame, labels: DataFrame, train_rows: int = 1500, train_bytes: int = 4_000_000, text_bytes: int = 100_000,
    seed: int = 7) -> ByteConvNet:
    """Fit on at most ``train_rows`` labelled rows, of at most ``text_bytes`` bytes each and ``train_bytes`` in all, chosen by a hash of the id.

    Rows whose crc32 of the id modulo 4 is 2 are never read as labels; a document with several
    labels counts as its lowest, an id with several texts as one of them. Only whole texts are taken. The
    driver sees sizes first, and only the texts that fit.
    """
    chosen = shared.drawn(
        labels.select("doc_id", "quality")
        .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (shared.id_hash_mod("doc_id", 4) != 2))
        .groupBy("doc_id").agg(F.min("quality").alias("quality")),
        train_rows, seed, "doc_id",
    )
    text = documents.where("text is not null").select("doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("bytes"), "text")
    sized = text.where(F.col("bytes") <= text_bytes).join(F.broadcast(chosen), "doc_id").groupBy("doc_id",
        "quality").agg(F.min(F.struct("h", "bytes")).alias("t"))
    rows = sorted((r.doc_id, r.quality, r.t.h, r.t.bytes) for r in sized.collect())  # train_rows at most
    taken, size = {}, 0
    for i in np.random.default_rng(seed).permutation(len(rows)).tolist():
        doc_id, quality, h, n = rows[i]
        if size + n <= train_bytes:
            size += n
            taken[doc_id] = quality, h
    if not taken:
        return ByteConvNet(seed).fit([], np.zeros(0), seed=seed)
    picks = F.broadcast(documents.sparkSession.createDataFrame([(d, h) for d, (_, h) in taken.items()], "doc_id long, h long"))
    found = text.join(picks, ["doc_id", "h"]).groupBy("doc_id").agg(F.first("text").alias("text")).collect()  # train_bytes at most
    raw = {r.doc_id: r.text.encode() for r in found}
    order = [d for d in taken if d in raw]
    return ByteConvNet(seed).fit([raw[d] for d in order], np.array([taken[d][0] for d in order], float), seed=seed)


def quality_scores(documents: DataFrame, model: ByteConvNet, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted for every row of ``documents``.

    Null and empty texts get the model's score of no bytes; repeated rows get equal scores; a very long text is
    scored whole, in blocks that a running maximum joins; an empty table gives an empty result. Other columns are ignored,
    whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(*shared.utf8(b.column(1))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = shared.table(spark, sf_dir, "documents")
    model = train(documents, shared.table(spark, sf_dir, "labels"))
    return quality_scores(documents, model).withColumn("held_out", F.coalesce(shared.id_hash_mod("doc_id", 4) == 2, F.lit(False)))


def kept_by_quality(documents: DataFrame, model: ByteConvNet, threshold: float = 0.7) -> DataFrame:
    """The rows of ``documents`` that the model does not reject, all columns unchanged."""

    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(*shared.utf8(b.column(names.index("text"))))
            yield b.filter(pa.array(s >= threshold))

    return documents.mapInArrow(run, documents.schema)
