"""Operator 9: document fingerprints by an improbable-feature digest.

Every window of ``WINDOW`` bytes has an entropy level; how rarely a level occurs in the whole
corpus ranks the windows. A window that is the rarest of its neighbourhood often enough is a
feature. Features go, in their order of place, into a chain of Bloom filters of ``BITS`` bits, at most
``PER_FILTER`` to each; two chains are compared by the bits their filters share, less what chance
alone gives, as a share of what they could share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared, textblock

WINDOW, NEIGHBOURS, POPULAR = 32, 32, 8
LEVELS = 128
BITS, PROBES, PER_FILTER = 2048, 5, 128
#: Windows start anew in each block, so that blocks of bytes never reach across documents.
_GAIN = np.array([(c + 1) * np.log2(c + 1) - (c * np.log2(c) if c else 0) for c in range(WINDOW + 1)])


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Quantised entropy of every window, by adding what each entering and leaving byte changes."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int16)
    behind, ahead = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for s in range(1, WINDOW):  # equal bytes among the WINDOW - 1 before and after each
        same = (data[s:] == data[:-s]).view(np.uint8)
        behind[s:] += same
        ahead[:-s] += same
    # a window's sum of c log c, from its predecessor's: the first byte leaves, a new one enters
    first = np.unique(data[:WINDOW], return_counts=True)[1]
    start = float((first * np.log2(first)).sum())
    gain = np.rint(_GAIN * 65536).astype(np.int64)  # whole numbers: sums do not depend on order
    change = gain[behind[WINDOW:]] - gain[ahead[: n - WINDOW]]
    total = np.concatenate([[0], np.cumsum(change)]) / 65536 + start
    level = (np.log2(WINDOW) - total / WINDOW) / np.log2(WINDOW) * LEVELS
    return np.clip(np.rint(level), 0, LEVELS - 1).astype(np.int16)


def in_blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, levels of all windows, windows that lie within one row)."""
    for lo, hi in shared.steps(offsets, 1 << 19):
        part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        levels = entropy_levels(part)
        valid = np.ones(len(levels), bool)
        cross = shared.ragged(np.maximum(at[1:-1] - WINDOW + 1, 0), np.minimum(at[1:-1], WINDOW - 1))
        valid[cross[cross < len(levels)]] = False
        yield lo, hi, part, levels, valid


def rarity(documents: DataFrame) -> np.ndarray:
    """Rank of each entropy level by how many windows of the corpus have it: 0 for the rarest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(LEVELS, np.int64)
        for b in batches:
            for *_, levels, valid in in_blocks(*shared.utf8(b.column(0))):
                counts += np.bincount(levels[valid], minlength=LEVELS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS, dtype=np.int32)), pa.array(counts)], ["level", "n"])

    rows = documents.select("text").mapInArrow(run, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()  # LEVELS rows
    n = np.zeros(LEVELS, np.int64)
    for level, count in rows:
        n[level] = count
    out = np.empty(LEVELS, np.int64)
    out[np.lexsort((np.arange(LEVELS), n))] = np.arange(LEVELS)
    return out


def features(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all selected features in order, and the rows' bounds among them.

    A text shorter than a window, unless empty, is one feature itself; so is one of which no window is
    popular enough its rarest window.
    """
    n = len(offsets) - 1
    out, number = [], np.zeros(n, np.int64)
    for lo, hi, part, levels, valid in in_blocks(data, offsets):
        at = offsets[lo : hi + 1] - offsets[lo]
        sums = textblock.prefix(part.astype(np.uint64) + np.uint64(1))
        size = np.diff(at)
        windows = np.maximum(size - WINDOW + 1, 0)
        place = np.flatnonzero(valid)
        row = np.repeat(np.arange(hi - lo), windows)
        chosen = np.zeros(len(place), bool)
        if len(place):
            key = (rank[levels[place]] << 32) + np.arange(len(place))
            bounds = np.concatenate([[0], np.cumsum(windows)])
            # neighbourhoods within a row; a row with fewer windows is one neighbourhood
            whole = np.flatnonzero(windows >= NEIGHBOURS)
            if len(place) >= NEIGHBOURS and len(whole):
                best = textblock.sliding_min(key, NEIGHBOURS) & 0xFFFFFFFF
                inside = shared.ragged(bounds[whole], windows[whole] - NEIGHBOURS + 1)
                votes = np.bincount(best[inside], minlength=len(place))
                chosen = votes >= POPULAR
            missing = (np.bincount(row[chosen], minlength=hi - lo) == 0) & (windows > 0)
            if missing.any():
                some = np.flatnonzero(windows > 0)
                least = np.minimum.reduceat(key, bounds[some]) & 0xFFFFFFFF
                chosen[least[missing[some]]] = True
        start = place[chosen]
        short = np.flatnonzero((size < WINDOW) & (size > 0))
        h = np.concatenate([textblock.run_hashes(sums, start, start + WINDOW), textblock.run_hashes(sums, at[short], at[short + 1])])
        of = np.concatenate([row[chosen], short])
        order = np.argsort(of, kind="stable")
        out.append(h[order])
        number[lo:hi] = np.bincount(of, minlength=hi - lo)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(number)])


def chain(hashes: np.ndarray) -> np.ndarray:
    """Bloom filters of one document, a row of bytes for each."""
    filters = -(-len(hashes) // PER_FILTER)
    bits = np.zeros((filters, BITS), bool)
    which = np.arange(len(hashes)) // PER_FILTER
    for k in range(PROBES):
        bits[which, ((hashes >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
    return np.packbits(bits, 1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Mean over the shorter chain's filters of their best normalised overlap with the other's; 1 for two empty ones."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if len(b) < len(a):
        a, b = b, a
    x, y = np.unpackbits(a, axis=1).astype(np.float32), np.unpackbits(b, axis=1).astype(np.float32)
    shared_bits, nx, ny = x @ y.T, x.sum(1)[:, None], y.sum(1)[None]
    chance = nx * ny / BITS
    low = chance + 0.15 * (np.minimum(nx, ny) - chance)  # what unlike filters may share
    over = np.clip((shared_bits - low) / np.maximum(np.minimum(nx, ny) - low, 1e-6), 0, 1)
    best, weight = over.max(1), nx[:, 0]
    return float((best * weight).sum() / weight.sum())


def bucketed(documents: DataFrame) -> DataFrame:
    """Rows in as many ranges as there are partitions, in descending order of the id, each in its own partition and in order.

    Columns bucket, guest, doc_id, text. Ids come in the order of ``k``, equal ones in that of a hash of the text.
    Behind the last row of each range stands, as a guest, the first row of the next one (of the first one, behind the
    last), so that every row has the next one at hand. Ranges are cut by the ids and hashes alone. The first rows of the ranges, a
    row for each, come to the driver. Rows with equal ids and texts are interchangeable; where they are more than a
    range's share, they are dealt over several.
    """
    spark = documents.sparkSession
    n = shared.partitions(spark)
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(F.bitwise_not(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))).alias("k"), F.xxhash64(text).alias("h"),
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    keys = shared.written(rows.select("k", "h"))
    share = keys.count() // n + 1
    many = [tuple(r) for r in keys.groupBy("k", "h").count().where(F.col("count") > share).collect()]  # fewer than partitions
    parts = F.broadcast(spark.createDataFrame([(k, h, -(-c // share)) for k, h, c in many], "k long, h long, parts long"))

    def dealt(df: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("parts", F.lit(1)))
        return df.join(parts, ["k", "h"], "left").withColumn("part", part).drop("parts")

    order = ["k", "h", "part"]
    ranges = dealt(keys).repartitionByRange(n, *order).groupBy(F.spark_partition_id().alias("range")).agg(F.min(F.struct(*order)).alias("head"))
    heads = sorted(tuple(r.head) for r in ranges.collect())  # a row for each partition
    cuts = np.array(heads, np.int64).reshape(-1, 3)

    @F.pandas_udf("int")
    def bucket(k: pd.Series, h: pd.Series, part: pd.Series) -> pd.Series:
        """The last range whose first row is not after the row; rows before all are in the first."""
        value = np.concatenate([cuts, np.stack([k, h, part], 1)])
        seq = np.lexsort((np.arange(len(value)), value[:, 2], value[:, 1], value[:, 0]))  # a range's first row comes before its equals
        out = np.empty(len(value), np.int32)
        out[seq] = np.cumsum(seq < len(cuts)) - 1
        return pd.Series(np.maximum(out[len(cuts) :], 0))

    here = [(h[0], h[1], (i - 1) % len(heads)) for i, h in enumerate(heads)]
    first = F.broadcast(spark.createDataFrame(here, "k long, h long, bucket int"))
    guests = rows.join(F.broadcast(spark.createDataFrame(sorted({x[:2] for x in here}), "k long, h long")), ["k", "h"]).groupBy("k",
        "h").agg(F.first("text").alias("text"))
    guests = guests.join(first, ["k", "h"]).select("bucket", F.lit(True).alias("guest"), "k", "h", F.lit(None).cast("long").alias("doc_id"), "text")
    own = dealt(rows).select(bucket("k", "h", "part").alias("bucket"), F.lit(False).alias("guest"), "k", "h", "doc_id", "text")
    return own.unionByName(guests).repartitionById(n, "bucket").sortWithinPartitions("bucket", "guest", "k", "h")


def fingerprints(documents: DataFrame) -> DataFrame:
    """Per row of ``documents``: fingerprints of its text and its edited text, and likenesses.

    The next document is that of the next lower id; equal ids go by a hash of the text; null ids come last, and
    after the last comes the first. Null and empty texts have the empty fingerprint, alike only to
    another empty one. An only document follows itself. Repeated rows get a result each. A very long text is read
    whole and has as many filters as its features need. An empty table gives an empty result; other columns are ignored.
    """
    rank = rarity(documents)
    ordered = bucketed(documents)

    def digest(texts: list[str]) -> list[np.ndarray]:
        raw = [t.encode() for t in texts]
        h, at = features(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]), rank)
        return [chain(h[at[i] : at[i + 1]]) for i in range(len(texts))]

    def pairs(rows: Iterator[tuple]) -> Iterator[tuple]:
        """Each row with the next of its range; of the guests of a range only the first counts."""
        held = None
        for bucket, guest, doc_id, text in rows:
            if held and held[0] == bucket:
                yield held[1], held[2], text
            held = None if guest else (bucket, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from zip(*(b.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text")), strict=True)

        def result(block: list[tuple]) -> pa.RecordBatch:
            ids, texts, following = zip(*block, strict=True)
            edited = [t[: len(t) - len(t) // 3] + f[: len(t) // 3] for t, f in zip(texts, following, strict=True)]
            distinct = list(dict.fromkeys([*texts, *following, *edited]))
            print_of = dict(zip(distinct, digest(distinct), strict=True))
            a, e, f = ([print_of[t] for t in x] for x in (texts, edited, following))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                    pa.array([x.tobytes().hex() for x in a], pa.string()), pa.array([x.tobytes().hex() for x in e], pa.string()),
                    pa.array([likeness(x, y) for x, y in zip(a, e, strict=True)], pa.float64()),
                    pa.array([likeness(x, y) for x, y in zip(a, f, strict=True)], pa.float64()),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        block, size = [], 0
        for row in pairs(rows()):
            block.append(row)
            size += len(row[1])
            if size > shared.STEP_BYTES:
                yield result(block)
                block, size = [], 0
        if block:
            yield result(block)

    return ordered.select("bucket", "guest", "doc_id", "text").mapInArrow(run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(shared.table(spark, sf_dir, "documents"))
