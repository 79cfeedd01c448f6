"""Operator 2: mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. Each cell's tokens are raked until the
weights meet the target share of every source, every language and every topic; a document's
probability of being sampled is its cell's ratio of raked to present tokens, scaled to the token
budget. Only the cells (a row for each combination that occurs) are raked: on the driver while
they are at most ``max_cells``, in Spark beyond that, by the same steps.

Topics are learnt from all documents: seeded centroids (k-means over directions) of their hashed, weighted words, counted once
into a table that each round passes over; every document is of the topic whose centroid its words, all of them, are closest to.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared, textblock

MARGINS = ("source", "lang", "topic")
#: Cells that the driver rakes itself and that are broadcast; more are raked and joined in Spark.
MAX_CELLS = 200_000
#: Topics; classes of hashed words; the least bytes of a word that tells of a topic.
TOPICS, CLASSES, TOPIC_BYTES = 8, 1024, 4
#: Directions are summed as integers, so that sums do not depend on the order of rows: 2**53 of them for eight million rows of a task.
UNIT = 1 << 30


def word_classes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class and row of each word that is long enough to tell of a topic, and each row's number of words."""
    start, end, bounds = textblock.words(data, offsets)
    long = end - start >= TOPIC_BYTES
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))[long]
    return (textblock.word_hashes(data, start[long], end[long]) % np.uint64(CLASSES)).astype(np.int64), row, np.diff(bounds)


@dataclass(frozen=True)
class Block:
    """Word classes of documents that have any: entries (class, count) sorted by document, and the documents' bounds among them."""

    cls: np.ndarray
    count: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Block:
        """From a row of counts for each document."""
        row, at = np.nonzero(counts)
        return cls(at.astype(np.uint16), np.minimum(counts[row, at], 65535).astype(np.uint16), np.flatnonzero(np.diff(row, prepend=-1)).astype(np.int32))

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first)), np.diff(self.first, append=len(self.cls)))

    def directions(self, rarity: np.ndarray) -> np.ndarray:
        """The entries' weights, each document's of length one."""
        x = self.count * rarity[self.cls]
        return x / np.sqrt(np.add.reduceat(x * x, self.first))[self.row]

    def nearness(self, x: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Cosines of each document with each centroid."""
        return np.stack([np.add.reduceat(x * one[self.cls], self.first) for one in c], 1)

    def draws(self, seed: int) -> np.ndarray:
        """A number in (0, 1) for each document, by what it holds alone."""
        h = textblock.mix(self.cls.astype(np.uint64) << np.uint64(16) | self.count) * np.uint64(2 * seed + 1)
        return (textblock.mix(np.add.reduceat(h, self.first)) >> np.uint64(12)).astype(np.float64) / (1 << 52) + 2.0**-53


def documents_with(b: Block) -> np.ndarray:
    """In how many documents each class is, and how many there are."""
    return np.append(np.bincount(b.cls, minlength=CLASSES), len(b.first))


def farthest(b: Block, rarity: np.ndarray, c: np.ndarray, seed: int) -> tuple[float, np.ndarray] | None:
    """A document drawn by its distance from the nearest of the centroids (the least of draws / distance), and its direction."""
    x = b.directions(rarity)
    far = np.clip(1 - b.nearness(x, c).max(1), 0, None) if len(c) else np.ones(len(b.first))
    if not (far > 1e-9).any():
        return None
    with np.errstate(divide="ignore"):
        late = np.where(far > 1e-9, -np.log(b.draws(seed)) / far, np.inf)
    k, out = int(late.argmin()), np.zeros(CLASSES)
    lo, hi = np.append(b.first, len(b.cls))[[k, k + 1]]
    out[b.cls[lo:hi]] = x[lo:hi]
    return float(late[k]), out


def own_sums(b: Block, rarity: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Sums of the directions of each centroid's documents, in units."""
    x = b.directions(rarity)
    own = b.nearness(x, c).argmax(1)
    return np.bincount(own[b.row] * CLASSES + b.cls, np.rint(x * UNIT), len(c) * CLASSES).astype(np.int64)


def fitted(total: Callable, drawn: Callable, topics: int, seed: int, rounds: int) -> np.ndarray:
    """k-means by cosine with far-apart seeds. ``total`` sums a function of the blocks, ``drawn`` takes the least (number, direction) that one gives."""
    *df, n = total(documents_with).tolist()
    if not n:
        return np.zeros((0, CLASSES))
    rarity = np.log((n + 1) / (np.array(df) + 1)) + 1e-6
    c = np.zeros((0, CLASSES))
    for k in range(topics):
        one = drawn(lambda b, c=c, k=k: farthest(b, rarity, c, seed + k))
        if one is None:
            break
        c = np.concatenate([c, one[None]])
    for _ in range(rounds):
        sums, before = total(lambda b, c=c: own_sums(b, rarity, c)).reshape(len(c), CLASSES).astype(np.float64), c
        c = np.where(sums.any(1, keepdims=True), sums, c * UNIT)
        c = c / np.sqrt((c * c).sum(1, keepdims=True))
        if np.array_equal(c, before):
            break
    return c * rarity


def centroids(counts: np.ndarray, topics: int, seed: int, rounds: int = 15) -> np.ndarray:
    """Weights of word classes for each topic, from rows of class counts in memory: the same steps, on one block."""
    b = Block.of(counts)
    if not len(b.first):
        return np.zeros((0, CLASSES))
    return fitted(lambda f: f(b), lambda f: (f(b) or (0.0, None))[1], topics, seed, rounds)


def word_blocks(documents: DataFrame) -> DataFrame:
    """The blocks of all documents as packed rows: whole texts, counted in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = shared.utf8(b.column(0))
            for lo, hi in shared.steps(offsets):
                cls, row, _ = word_classes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                if len(cls):
                    own = Block.of(np.bincount(row * CLASSES + cls, minlength=(hi - lo) * CLASSES).reshape(-1, CLASSES))
                    yield pa.RecordBatch.from_pylist([{"cls": own.cls.tobytes(), "count": own.count.tobytes(), "first": own.first.tobytes()}])

    return documents.select("text").mapInArrow(run, "cls binary, count binary, first binary")


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for b in batches:
        for cls, count, first in zip(*(b.column(c) for c in ("cls", "count", "first")), strict=True):
            yield Block(np.frombuffer(cls.as_buffer(), np.uint16), np.frombuffer(count.as_buffer(), np.uint16), np.frombuffer(first.as_buffer(), np.int32))


def learnt_topics(documents: DataFrame, topics: int = TOPICS, seed: int = 5, rounds: int = 15) -> np.ndarray:
    """Topic weights from all of ``documents``: each round is a pass over their counted words, of which a row of sums for each task and topic is dealt out."""
    spark = documents.sparkSession
    blocks = shared.written(word_blocks(documents))

    def total(f: Callable) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for b in blocks_of(batches):
                sums = f(b) if sums is None else sums + f(b)
            for k in range(0, 0 if sums is None else len(sums), CLASSES):
                yield pa.RecordBatch.from_pylist([{"part": k // CLASSES, "sums": sums[k : k + CLASSES].tobytes()}], SUMS)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for b in batches:
                for part, x in zip(b.column("part").to_pylist(), b.column("sums").to_pylist(), strict=True):
                    sums[part] = sums.get(part, 0) + np.frombuffer(x, np.int64)
            yield pa.RecordBatch.from_pylist([{"part": k, "sums": x.tobytes()} for k, x in sums.items()], SUMS)

        n = min(shared.partitions(spark), topics)
        rows = blocks.mapInArrow(run, "part int, sums binary").repartition(n, "part").mapInArrow(add, "part int, sums binary").collect()
        return np.concatenate([np.frombuffer(r.sums, np.int64) for r in sorted(rows)] or [np.zeros(CLASSES + 1, np.int64)])

    def drawn(f: Callable) -> np.ndarray | None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = [x for b in blocks_of(batches) if (x := f(b))]
            if found:
                late, one = min(found, key=lambda x: (x[0], x[1].tobytes()))
                yield pa.RecordBatch.from_pylist([{"late": late, "one": one.tobytes()}])

        rows = blocks.mapInArrow(run, "late double, one binary").orderBy("late", "one").limit(1).collect()
        return np.frombuffer(rows[0].one) if rows else None

    out = fitted(total, drawn, topics, seed, rounds)
    shared.dropped(spark, blocks)
    return out


#: A part of a task's sums.
SUMS = pa.schema([("part", pa.int32()), ("sums", pa.binary())])


def topics_and_tokens(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's topic (-1 where no word tells of one) and number of words."""
    n = len(offsets) - 1
    topic, tokens = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    by_class = np.ascontiguousarray(weights.T)
    for lo, hi in shared.steps(offsets, shared.STEP_BYTES // 2):
        cls, row, tokens[lo:hi] = word_classes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        if len(cls) and len(weights):
            first = np.flatnonzero(np.diff(row, prepend=-1))
            sums = np.add.reduceat(by_class[cls], first, 0)
            topic[lo + row[first]] = np.where(sums.max(1) > 0, sums.argmax(1), -1)
    return topic, tokens


def with_cells(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """``row``, a struct of all columns of ``documents``, and ``cell``: its source, language, topic and number of words."""
    whole = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"))
    schema = T.StructType([*whole.schema.fields, T.StructField("topic", T.LongType()), T.StructField("tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            topic, tokens = topics_and_tokens(*shared.utf8(b.column(0).field("text")), weights)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(topic), pa.array(tokens)], ["row", "topic", "tokens"])

    none = F.lit("(none)")
    return whole.mapInArrow(run, schema).select(
        "row",
        F.struct(
            F.coalesce("row.source", none).alias("source"), F.coalesce("row.lang", none).alias("lang"),
            F.when(F.col("topic") < 0, none).otherwise(F.concat(F.lit("topic"), "topic")).alias("topic"), "tokens",
        ).alias("cell"),
    )


def tempered(sums: pd.Series, power: float) -> pd.Series:
    """Shares drawn towards even ones: present shares to a power, scaled to one."""
    s = (sums / max(sums.sum(), 1)) ** power
    return s / s.sum() if s.sum() else s


def shares(sums: pd.Series, target: Mapping[str, float] | None, power: float) -> pd.Series:
    """Target shares of the values that occur with tokens; values that a target leaves out get none."""
    sums = sums[sums > 0]
    out = tempered(sums, power) if target is None else sums.index.map(lambda v: float(target.get(v, 0))).to_series(index=sums.index)
    return out / out.sum() if out.sum() else out


def rake(cells: pd.DataFrame, targets: Mapping[str, pd.Series], rounds: int, tolerance: float) -> np.ndarray:
    """Weights of the cells after fitting each margin in turn until no margin is off by more than ``tolerance``."""
    w = cells["tokens"].to_numpy(float) / max(cells["tokens"].sum(), 1)
    codes = {m: pd.factorize(cells[m]) for m in targets}
    goal = {m: targets[m].reindex(codes[m][1]).fillna(0).to_numpy() for m in targets}
    for _ in range(rounds):
        off = 0.0
        for m, (code, values) in codes.items():
            have = np.bincount(code, w, len(values))
            off = max(off, float(np.abs(have - goal[m]).max(initial=0)))
            w = w * np.divide(goal[m], have, out=np.zeros(len(have)), where=have > 0)[code]
        if off < tolerance:
            break
    return w


def shares_in_spark(cells: DataFrame, margin: str, target: Mapping[str, float] | None, power: float, total: float) -> DataFrame:
    """The same shares as a table (the margin's column, share); only their sum comes to the driver."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    if target is None:
        raw = sums.select(margin, F.pow(F.col("tokens") / F.lit(float(total)), F.lit(power)).alias("share"))
    else:
        asked = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in target.items()], f"{margin} string, share double")
        raw = sums.select(margin).join(asked, margin, "left").fillna(0.0, ["share"])
    raw = shared.written(raw)
    whole = raw.agg(F.sum("share")).first()[0] or 1.0
    return raw.withColumn("share", F.col("share") / F.lit(whole))


def rake_in_spark(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int, tolerance: float) -> DataFrame:
    """The same steps over a table of cells of any size; each margin's sums are grouped and joined."""
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    out = cells.withColumn("w", F.col("tokens") / F.lit(float(total)))
    for _ in range(rounds):
        off = []
        for m, goal in targets.items():
            have = out.groupBy(m).agg(F.sum("w").alias("have")).join(goal, m, "left").fillna(0.0, ["share"])
            off.append(have.agg(F.max(F.abs(F.col("have") - F.col("share")))).first()[0] or 0.0)
            out = shared.written(out.join(have, m).withColumn("w", F.when(F.col("have") > 0,
                F.col("w") * F.col("share") / F.col("have")).otherwise(0.0)).drop("have", "share"))
        if max(off) < tolerance:
            break
    return out


def scale(ratio: np.ndarray, tokens: np.ndarray, budget: float) -> float:
    """The factor that makes the expected tokens of min(1, factor * ratio) meet the budget, as far as it can be met."""
    live = (ratio > 0) & (tokens > 0)
    ratio, tokens = ratio[live], tokens[live].astype(float)
    if not len(ratio) or budget >= tokens.sum():
        return float(1 / ratio.min()) if len(ratio) else 0.0
    order = np.argsort(-ratio, kind="stable")
    r, t = ratio[order], tokens[order]
    full = np.concatenate([[0], np.cumsum(t)[:-1]])  # tokens of the cells that are wholly taken
    rest = np.cumsum((r * t)[::-1])[::-1]
    factor = (budget - full) / rest
    return float(factor[np.flatnonzero(factor * r <= 1)[0]])


def cell_probabilities(
    rows: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, token_share: float = 0.5, power: float = 0.5, rounds: int = 200,
    tolerance: float = 1e-9, max_cells: int = MAX_CELLS
) -> DataFrame:
    """source, lang, topic, ratio, probability for each cell of ``rows`` (as ``with_cells`` gives them).

    ``targets`` maps a margin to its values' shares; a margin that is not named tends to even
    shares (present ones to ``power``). ``token_share`` is the budget as a share of all tokens.
    """
    spark = rows.sparkSession
    cells = rows.select("cell.*").groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    cells = shared.written(cells)
    targets = targets or {}
    if cells.count() <= max_cells:
        table = cells.toPandas().sort_values(list(MARGINS), ignore_index=True)
        goals = {m: shares(table.groupby(m)["tokens"].sum(), targets.get(m), power) for m in MARGINS}
        w = rake(table, goals, rounds, tolerance)
        total = max(int(table["tokens"].sum()), 1)
        tokens = table["tokens"].to_numpy(float)
        ratio = np.divide(w * total, tokens, out=np.ones(len(table)), where=tokens > 0)
        factor = scale(ratio, tokens, token_share * total)
        table = table[list(MARGINS)].assign(ratio=ratio, probability=np.minimum(1.0, factor * ratio))
        return F.broadcast(spark.createDataFrame(table, "source string, lang string, topic string, ratio double, probability double"))
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    goals = {m: shares_in_spark(cells, m, targets.get(m), power, total) for m in MARGINS}
    raked = rake_in_spark(cells, goals, rounds, tolerance).withColumn("ratio", F.when(F.col("tokens") > 0,
        F.col("w") * float(total) / F.col("tokens")).otherwise(1.0))
    low, high = 0.0, 1.0 / max(raked.where("ratio > 0").agg(F.min("ratio")).first()[0] or 1.0, 1e-12)
    for _ in range(60):  # the factor by bisection: expected tokens grow with it
        mid = (low + high) / 2
        got = raked.agg(F.sum(F.least(F.lit(1.0), F.col("ratio") * mid) * F.col("tokens"))).first()[0] or 0.0
        low, high = (mid, high) if got < token_share * total else (low, mid)
    return raked.select(*MARGINS, "ratio", F.least(F.lit(1.0), F.col("ratio") * high).alias("probability"))


def draw(column: str = "doc_id", seed: int = 17):
    """A number in [0, 1) from the id alone: the same whenever and wherever it is drawn."""
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def mixed(documents: DataFrame, **options) -> DataFrame:
    """Per row of ``documents``: its cell, tokens, raking ratio, probability, weight, and whether it is sampled.

    The weight, ratio over probability, makes sampled tokens meet the targets in expectation even
    where a probability stops at one. Null sources and languages are a value of their own; texts without words count as no
    tokens and take their cell's probability; a very long text counts whole; a repeated id gets one draw; of topics
    equally close the first counts; an empty table gives an empty result; other columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "lang")
    rows = shared.written(with_cells(rows, learnt_topics(rows)).select("row.doc_id", "cell"))
    cells = cell_probabilities(rows, **options)
    out = rows.select("doc_id", "cell.*").join(cells, list(MARGINS))
    return out.select(
        "doc_id", *MARGINS, F.col("tokens").alias("n_tokens"), "ratio", "probability",
        F.when(F.col("probability") > 0, F.col("ratio") / F.col("probability")).otherwise(0.0).alias("weight"),
        (draw() < F.col("probability")).alias("sampled"),
    )


def sampled(documents: DataFrame, **options) -> DataFrame:
    """The sampled rows of ``documents``, all columns unchanged, whatever they are called."""
    weights = learnt_topics(documents)
    cells = cell_probabilities(with_cells(documents.select("text", "source", "lang"), weights), **options).select(*MARGINS, "probability")
    rows = with_cells(documents, weights).select("row", "cell.*")
    return rows.join(cells, list(MARGINS)).where(draw("row.doc_id") < F.col("probability")).select("row.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(shared.table(spark, sf_dir, "documents"))
