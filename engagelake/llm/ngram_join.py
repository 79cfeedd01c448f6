"""Operator 4: n-gram Jaccard self-join with Bayesian candidate pruning.

Texts are sets of hashed five-word shingles. Equal sets are one class. Classes that agree on all
MinHash values of one of ``BANDS`` bands are candidates; their values are compared a few at a
time, and a pair is dropped as soon as the posterior probability that its similarity reaches
the threshold falls under the tolerance. What is left ties classes into clusters, and within a cluster
all pairs are verified on the exact sets, block by block, so that no link inside is missed.
Tasks give sums and spanning links, never the pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import graph, shared, textblock

SHINGLE, THRESHOLD = 5, 0.8
#: Stands for a null id where rows are matched.
LAST = (1 << 63) - 1
#: A pair at 0.8 agrees on no band with probability (1 - 0.8**4)**20, under 3 in 100,000.
BANDS, ROWS = 20, 4
VALUES = BANDS * ROWS
#: Values compared at each step, and the posterior probability under which a pair goes.
STEP, TOLERANCE = 16, 1e-4
#: Pairs compared at once in a task.
AT_ONCE = 1 << 18

_random = np.random.default_rng(41)
MULTIPLIER = (_random.integers(0, 1 << 31, VALUES, np.uint32) << np.uint32(1)) | np.uint32(1)
OFFSET = _random.integers(0, 1 << 32, VALUES, np.uint64).astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, in order, and the rows' bounds among them.

    A text of fewer than ``size`` words, but at least one, has all of them as its only shingle.
    """
    start, end, bounds = textblock.words(data, offsets)
    words = textblock.word_hashes(data, start, end)
    g, at = textblock.grams(words, bounds, size)
    few = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < size))
    h = np.concatenate([g, textblock.run_hashes(textblock.prefix(words), bounds[few], bounds[few + 1])])
    row = np.concatenate([np.repeat(np.arange(len(bounds) - 1), np.diff(at)), few])
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(row[order].astype(np.uint16 if len(bounds) < 1 << 16 else np.int64), kind="stable")]
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(bounds)))


def set_keys(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two keys of each row's set that do not depend on order."""
    some = np.flatnonzero(np.diff(at) > 0)
    out = np.zeros((2, len(at) - 1), np.uint64)
    if len(some):
        n = np.diff(at)[some].astype(np.uint64)
        out[0, some] = textblock.mix(np.add.reduceat(textblock.mix(h), at[some]) + n)
        out[1, some] = textblock.mix(np.bitwise_xor.reduceat(textblock.mix(h ^ np.uint64(0x51ED2701)), at[some]) + n)
    return out[0].view(np.int64), out[1].view(np.int64)


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MinHash values of each row's set; zeros for an empty one."""
    some = np.flatnonzero(np.diff(at) > 0)
    out = np.zeros((len(at) - 1, VALUES), np.uint32)
    if len(some):
        x = (h >> np.uint64(32)).astype(np.uint32)
        for k in range(VALUES):
            out[some, k] = np.minimum.reduceat(x * MULTIPLIER[k] + OFFSET[k], at[some])
    return out


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, matches needed) at each step.

    With a uniform prior, m matches among n values leave a similarity of ``threshold`` or more the
    probability that a binomial of n + 1 trials stays at m or under.
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def survivors(values: np.ndarray, a: np.ndarray, b: np.ndarray, needed: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that no step drops."""
    matches, done = np.zeros(len(a), np.int64), 0
    for n, m in needed:
        matches += (values[a, done:n] == values[b, done:n]).sum(1)
        keep = matches >= m
        a, b, matches, done = a[keep], b[keep], matches[keep], n
    return a, b


def set_features(documents: DataFrame) -> DataFrame:
    """doc_id, k1, k2, n_shingles, values (the MinHash values) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = shared.utf8(b.column(1))
            for lo, hi in shared.steps(offsets):
                h, at = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                k1, k2 = set_keys(h, at)
                values = shared.binary(signatures(h, at).reshape(-1), np.arange(hi - lo + 1) * VALUES)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(k1), pa.array(k2), pa.array(np.diff(at)), values],
                    ["doc_id", "k1", "k2", "n_shingles", "values"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run,
        "doc_id long, k1 long, k2 long, n_shingles long, values binary")


def candidate_links(classes: DataFrame) -> DataFrame:
    """Spanning links (a, b) between classes that survive the pruning in some band."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, VALUES)
            sums = np.zeros((len(values), BANDS), np.uint64)
            for k in range(ROWS):
                sums = textblock.mix(sums + values[:, k::ROWS][:, :BANDS].astype(np.uint64) + np.uint64(k))
            keys = textblock.mix(sums + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), b.column(0).take(pa.array(np.repeat(np.arange(len(values)), BANDS)))],
                ["band_key", "rid"])

    needed = least_matches()
    members = classes.select("rid", "values").mapInArrow(bands, "band_key long, rid long")
    groups = graph.block_pairs(members, ["band_key"], "rid", payload=classes.select("rid", "values"), total=classes.count() * BANDS, least=512)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, at in graph.whole_groups(batches, ["band_key", "i_", "j_"]):
            values = np.frombuffer(b"".join(whole.column("values").to_pylist()), np.uint32).reshape(-1, VALUES)
            rid, own = whole.column("rid").to_numpy(), whole.column("own_").to_numpy()
            forest, found = graph.Forest(len(rid)), []
            for a, b in pairs_within(at):
                cross = whole.column("i_").to_numpy()[a] != whole.column("j_").to_numpy()[a]
                keep = ~cross | (own[a] != own[b])
                a, b = survivors(values, a[keep], b[keep], needed)
                k = forest.links(a, b)
                found.append((rid[a[k]], rid[b[k]]))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return groups.select("band_key", "i_", "j_", "own_", "rid", "values").mapInArrow(prune, "a long, b long")


def pairs_within(at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of the same group, at most about AT_ONCE at a time."""
    size = np.diff(at)
    after = np.repeat(at[1:], size) - np.arange(at[0], at[-1]) - 1  # partners of each row
    total = np.concatenate([[0], np.cumsum(after)])
    lo = 0
    while lo < len(after):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + AT_ONCE, "right")) - 1)
        rows = np.arange(lo, hi)
        a = np.repeat(rows, after[lo:hi])
        if len(a):
            yield a + at[0], shared.ragged(rows + 1, after[lo:hi]) + at[0]
        lo = hi


def near(sets: list[np.ndarray], threshold: float = THRESHOLD) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of ``threshold`` or more, exactly; a matrix."""
    size = np.array([len(x) for x in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    use = count[column] > 1  # what one set has alone is in no intersection
    number = np.cumsum(count > 1) - 1
    row, column = row[use], number[column[use]]
    both = np.zeros((len(sets), len(sets)), np.float32)  # exact to 16 million shingles
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = 8192
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        lo, hi = np.searchsorted(column, [first, first + width])
        x = np.zeros((len(sets), min(width, int(number[-1]) + 1 - first)), np.float32)
        x[row[lo:hi], column[lo:hi] - first] = 1
        both += x @ x.T
    return both >= threshold * (size[:, None] + size[None] - both) - 1e-9


def similar(documents: DataFrame) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, class_id, n_links, kept, and the keys k1 and k2 of its set.

    Rows of one class are joined by links of similarity 0.8 or more, also through others; class_id is its
    least doc_id. n_links counts the other rows that the row is linked with directly, copies
    included. Null and empty texts have no shingles and link with nothing; a very long text is one set, whole; a
    repeated row is a copy; sets of one size that tie go by their ids; null ids name a class only if no other id can; an empty table gives an empty result;
    other columns are ignored. ``kept`` marks the rows with the class's id.
    """
    features = shared.written(set_features(documents))
    classes = features.where("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"),
        F.first("values").alias("values"))
    classes = shared.written(classes.withColumn("rid", F.monotonically_increasing_id()))
    clusters = shared.written(graph.components(candidate_links(classes)))
    chosen = clusters.withColumnRenamed("id", "rid").join(classes.select("rid", "k1", "k2", "id", "copies"), "rid")
    # texts of these classes: rows of their ids, each once, then of their keys
    text = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("key"), "text")
    of_ids = text.join(chosen.select(F.coalesce("id", F.lit(LAST)).alias("key")).distinct(), "key", "left_semi")

    def exact_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = shared.utf8(b.column(0))
            for lo, hi in shared.steps(offsets):
                h, at = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                k1, k2 = set_keys(h, at)
                yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), shared.binary(h, at)], ["k1", "k2", "shingles"])

    sets = of_ids.select("text").mapInArrow(exact_sets, "k1 long, k2 long, shingles binary").join(chosen.select("k1", "k2"), ["k1", "k2"],
        "left_semi")
    sets = sets.groupBy("k1", "k2").agg(F.first("shingles").alias("shingles")).join(chosen, ["k1", "k2"]).select("component", "rid", "copies",
        "shingles")
    sets = shared.written(sets)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, at in graph.whole_groups(batches, ["component", "i_", "j_"]):
            rid, copies, own, i, j = (whole.column(c).to_numpy() for c in ("rid", "copies", "own_", "i_", "j_"))
            shingles = whole.column("shingles")
            out = []
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                rows = np.arange(lo, hi)
                linked = near([np.frombuffer(shingles[int(k)].as_buffer(), np.uint64) for k in rows])
                np.fill_diagonal(linked, False)
                if i[lo] != j[lo]:
                    linked &= own[rows][:, None] != own[rows][None]
                n = linked @ copies[rows]
                some = n > 0
                out.append((rid[rows[some]], rid[rows[some]], n[some]))
                a, b = np.nonzero(np.triu(linked))
                k = graph.Forest(len(rows)).links(a, b)
                out.append((rid[rows[a[k]]], rid[rows[b[k]]], np.zeros(len(k), np.int64)))
            a, b, n = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n.astype(np.int64))], ["a", "b", "n"])

    pairs = graph.block_pairs(sets.select("component", "rid", "copies"), ["component"], "rid", payload=sets.select("rid", "shingles"))
    verified = shared.written(pairs.select("component", "i_", "j_", "own_", "rid", "copies", "shingles").mapInArrow(verify, "a long, b long, n long"))
    links = verified.groupBy(F.col("a").alias("rid")).agg(F.sum("n").alias("n"))
    joined = graph.components(verified.where("n = 0").select("a", "b"))
    about = classes.select("rid", "k1", "k2", "id", "copies").join(joined.select(F.col("id").alias("rid"), "component"), "rid", "left").join(links,
        "rid", "left")
    about = about.select("k1", "k2", "id", F.coalesce("component", "rid").alias("component"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    names = about.groupBy("component").agg(F.min("id").alias("class_id"))
    about = about.join(names, "component").select("k1", "k2", "class_id", "n_links")
    worded = features.where("n_shingles > 0").select("doc_id", "n_shingles", "k1", "k2").join(about, ["k1", "k2"])
    empty = features.where("n_shingles = 0").select("doc_id", "n_shingles", "k1", "k2", F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"))
    columns = ["doc_id", "n_shingles", "class_id", "n_links", "k1", "k2"]
    return worded.select(*columns).unionByName(empty.select(*columns)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(shared.table(spark, sf_dir, "documents")).drop("k1", "k2")


def one_of_each(documents: DataFrame) -> DataFrame:
    """One row of each class of ``similar``, all columns unchanged: the one with the class's id.

    Of repeated rows of that id and set one stays. Texts without words are all kept.
    """
    decisions = similar(documents)
    chosen = decisions.where(F.col("kept") & (F.col("n_shingles") > 0)).select(F.coalesce("doc_id", F.lit(LAST)).alias("id"), "k1", "k2").distinct()
    # a document travels as one value, whatever its columns are called
    whole = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"))
    schema = T.StructType([*whole.schema.fields, T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = shared.utf8(b.column(0).field("text"))
            keys = [set_keys(*shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])) for lo, hi in shared.steps(offsets)]
            one, two = (np.concatenate(x) for x in zip(*keys, strict=True)) if keys else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(one), pa.array(two)], ["row", "k1", "k2"])

    rows = whole.mapInArrow(run, schema).withColumn("id", F.coalesce(F.col("row.doc_id").cast("long"), F.lit(LAST)))
    empty = rows.where("k1 = 0 and k2 = 0")
    worded = rows.where("k1 <> 0 or k2 <> 0")
    key = ["id", "k1", "k2"]
    # a repeated row is a copy, too: the join has brought such rows together, numbering them moves none
    first = W.partitionBy(*key).orderBy(*key)
    kept = worded.join(chosen, key, "left_semi").withColumn("nth", F.row_number().over(first)).where("nth = 1")
    return kept.select("row").unionByName(empty.select("row")).select("row.*")
