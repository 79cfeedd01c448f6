"""Operator 8: language-model scoring from a log-frequency Bloom filter.

Counting: tasks count words and word pairs of training texts, merge their counts, and deal them
out by hash as packed arrays; each bucket of hashes sums its counts and builds its own segment of
the filter. An n-gram whose count has level q = 1 + floor(log2 count) is put in q times, with
levels 1 to q, so that a look-up probes level after level until one is missing. The filter grows
with the training texts and is never gathered: its segments stay in their buckets.

Scoring: texts are cut into steps. Each step asks the buckets for its distinct words and pairs;
these probe their segment and send back levels, in the order asked; where the answers meet the step's
texts again, pair and word estimates are interpolated.

Base scores need exact counts, which come back with the levels. Words with more than one in ``SHARE``
of all tokens (so at most ``SHARE`` words) are broadcast with their counts and levels. A step asks for
each word and pair once, so that no word's rows can swamp a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared, textblock

SHARE = 50_000
PROBES = 3
#: Weight of the pair estimate against the word estimate.
PAIRS = 0.7
#: Counts that a task merges in memory before it deals them out.
HELD = 1_500_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: Stand-ins for the hashes of a text's start and end; no word's hash is one of them but by chance.
START, END = np.uint64(0x5D1CE0F51A27), np.uint64(0xE4D0F7E47)

MESSAGE = "bucket int, kind int, a binary, b binary, c binary, d binary"
#: In the order in which a bucket, or a step, needs them.
COUNTS, PAIR_COUNTS, SEGMENT, ASKED, LEVELS, TEXTS = range(6)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows with an end after each row's, and the rows' bounds among them."""
    data = LOWER[data]
    start, end, bounds = textblock.words(data, offsets)
    h = np.insert(textblock.word_hashes(data, start, end), bounds[1:], END)
    return h, bounds + np.arange(len(bounds))


def pair_hashes(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash for each token with the one before it in its row."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[bounds[:-1]] = START
    with np.errstate(over="ignore"):
        return textblock.mix(before * np.uint64(0x9E3779B97F4A7C15) ^ (h + np.uint64(0x632BE59BD9B4E019)))


def summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, with their sums."""
    if not len(h):
        return h, n
    order = np.argsort(h)
    h, n = h[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[first], np.add.reduceat(n, first)


def packed_gaps(h: np.ndarray, at: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """48-bit numbers (the top bits of hashes), ascending in each row at[i]:at[i+1], as the gaps between them: low four and high two bytes."""
    low = h >> np.uint64(16)
    gap = np.diff(low, prepend=np.uint64(0))
    first = at[:-1][np.diff(at) > 0]
    gap[first] = low[first]
    return shared.binary((gap & np.uint64(0xFFFFFFFF)).astype(np.uint32), at), shared.binary((gap >> np.uint64(32)).astype(np.uint16), at)


def from_gaps(low: bytes, high: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(low, np.uint32) | np.frombuffer(high, np.uint16).astype(np.uint64) << np.uint64(32)) << np.uint64(16)


def bounds_of(h: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket (the top ``bits`` bits) begins among sorted hashes."""
    return np.searchsorted((h >> np.uint64(64 - bits)).astype(np.int64), np.arange((1 << bits) + 1))


class Filter:
    """Look-ups in segments one after another, of all 2**bits buckets, or in the segment of one (0 bits)."""

    def __init__(self, data: np.ndarray, bits: int):
        self.data, self.bits, self.size = data, bits, len(data) * 8 >> bits

    @staticmethod
    def halves(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = textblock.mix(h ^ np.uint64(0xA24BAED4963EE407))
        return x & np.uint64(0xFFFFFFFF), x >> np.uint64(32) | np.uint64(1)

    @staticmethod
    def place(low: np.ndarray, step: np.ndarray, probe: int, size: int) -> np.ndarray:
        """The bit of a hash's probe, of which each level has PROBES of its own, within its segment."""
        return ((low + np.uint64(probe) * step) & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The last level that is there, by repeated membership probes; 0 if none is."""
        level, live, (low, step) = np.zeros(len(h), np.int64), np.arange(len(h)), self.halves(h)
        base = (h >> np.uint64(64 - self.bits)) * np.uint64(self.size) if self.bits else np.zeros(len(h), np.uint64)
        for probe in range(PROBES, 49 * PROBES):
            at = base + self.place(low, step, probe, self.size)
            found = (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
            live, low, step, base = live[found], low[found], step[found], base[found]
            if probe % PROBES == PROBES - 1:
                level[live] += 1
            if not len(live):
                break
        return level

    def estimates(self, h: np.ndarray) -> np.ndarray:
        return middle(self.levels(h))


def middle(level: np.ndarray) -> np.ndarray:
    """The count that stands for a level: the middle of its range, 0 for none."""
    return np.where(level > 1, 2.0 ** (level - 1.0) * 1.4, level)


def segment(h: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """A bucket's segment of ``size`` bits, with every n-gram at levels 1 to 1 + floor(log2 n)."""
    out = np.zeros(size, bool)
    top, (low, step) = 1 + np.floor(np.log2(n)).astype(np.int64), Filter.halves(h)
    level = 1
    while len(low):
        for k in range(PROBES):
            out[Filter.place(low, step, level * PROBES + k, size).astype(np.int64)] = True
        level += 1
        low, step, top = low[top >= level], step[top >= level], top[top >= level]
    return np.packbits(out, bitorder="little")


def filter_size(text_bytes: int, bits: int) -> int:
    """Bits of the filter: 5/4 bit for each byte of training text, without a limit, in equal segments of whole bytes."""
    return max(1 << (bits + 10), -(-int(text_bytes) * 5 // (32 << bits)) << (bits + 3))


def counted(documents: DataFrame, bits: int, filter_bits: int, partitions: int) -> DataFrame:
    """Messages COUNTS (a bucket's words and counts) and SEGMENT (its part of the filter) from training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {COUNTS: [], PAIR_COUNTS: []}

        def flush(kind: int) -> pa.RecordBatch:
            h, n = summed(*(np.concatenate(x) for x in zip(*held[kind], strict=True)))
            held[kind] = []
            at = bounds_of(h, bits)
            k = np.flatnonzero(np.diff(at))
            at = np.concatenate([at[k], [len(h)]])
            if kind == COUNTS:
                a, b = shared.binary(h, at), shared.binary(n, at)
            else:  # 48 bits are enough for the filter, which is approximate anyway
                a, b = packed_gaps(h, at)
            c = shared.binary(n.astype(np.uint32), at)
            return pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(np.full(len(k), kind, np.int32)), a, b, c,
                pa.nulls(len(k), pa.binary())], ["bucket", "kind", "a", "b", "c", "d"])

        for batch in batches:
            data, offsets = shared.utf8(batch.column(0))
            for lo, hi in shared.steps(offsets):
                h, at = tokens(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                for kind, x in ((COUNTS, h), (PAIR_COUNTS, pair_hashes(h, at))):
                    held[kind].append(summed(x, np.ones(len(x), np.int64)))
                    if sum(len(y) for y, _ in held[kind]) > HELD:
                        yield flush(kind)
        for kind in held:
            if held[kind]:
                yield flush(kind)

    size = filter_bits >> bits

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in shared.runs(batches, ["bucket", "kind", "a", "b", "c"]):  # one bucket at a time
            held = {COUNTS: [], PAIR_COUNTS: []}
            for _, kind, a, b, c in rows:
                if kind == COUNTS:
                    got = np.frombuffer(a, np.uint64), np.frombuffer(b, np.int64)
                else:
                    got = from_gaps(a, b), np.frombuffer(c, np.uint32).astype(np.int64)
                held[kind].append(got)
            x = {k: summed(*(np.concatenate(y) for y in zip(*v, strict=True))) if v else (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for k,
                v in held.items()}
            bits_set = segment(np.concatenate([word_keys(x[COUNTS][0], bits), x[PAIR_COUNTS][0]]), np.concatenate([x[COUNTS][1], x[PAIR_COUNTS][1]]),
                size)
            level = Filter(bits_set, 0).levels(word_keys(x[COUNTS][0], bits)).astype(np.uint8)
            rows = [(bucket, COUNTS, x[COUNTS][0].tobytes(), x[COUNTS][1].tobytes(), level.tobytes(), None),
                (bucket, SEGMENT, bits_set.tobytes(), None, None, None)]
            yield pa.RecordBatch.from_pydict(dict(zip(("bucket", "kind", "a", "b", "c", "d"), map(list, zip(*rows, strict=True)), strict=True)),
                schema=arrow_schema())

    return documents.select("text").mapInArrow(count, MESSAGE).repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(gather,
        MESSAGE)


def arrow_schema() -> pa.Schema:
    return pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in "abcd")])


def word_keys(h: np.ndarray, bits: int) -> np.ndarray:
    """Filter keys of words: apart from those of pairs, in the same bucket as the word's count."""
    high = np.uint64(64 - bits)
    return textblock.mix(h) >> np.uint64(bits) | h >> high << high


def lm_scores(documents: DataFrame) -> DataFrame:
    """Per row of ``documents``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts whose crc32 of the id modulo 5 is 1 are held out, all others (a null id, too) are counted.
    Null and empty texts are their end alone; a table without training texts knows no token
    (probabilities are then those of none seen); repeated rows are scored each, and counted each; a very long
    text is a step of its own; an empty table gives an empty result; other columns are ignored.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(shared.id_hash_mod("doc_id", 5) == 1, F.lit(False)).alias("held_out"))
    training = rows.where(~F.col("held_out"))
    texts, size = training.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    n = shared.partitions(spark)
    bits = max(4, int(2 * n - 1).bit_length())
    table = shared.written(counted(training, bits, filter_size(size or 0, bits), n))
    counts = table.where(F.col("kind") == COUNTS).select("bucket", "kind", "a", "b", "c", "d")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_tokens = distinct = 0
        for b in batches:
            for x in b.column(0).to_pylist():
                c = np.frombuffer(x, np.int64)
                all_tokens, distinct = all_tokens + int(c.sum()), distinct + len(c)
        yield pa.RecordBatch.from_arrays([pa.array([all_tokens]), pa.array([distinct])], ["n", "v"])

    total, distinct = (x or 0 for x in counts.select("b").mapInArrow(totals, "n long, v long").agg(F.sum("n"), F.sum("v")).first())
    least = total // SHARE + 1

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y, z in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                h, c, level = np.frombuffer(x, np.uint64), np.frombuffer(y, np.int64), np.frombuffer(z, np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array(h[c >= least].view(np.int64)), pa.array(c[c >= least]),
                    pa.array(level[c >= least].astype(np.int64))], ["h", "c", "level"])

    hot = counts.select("a", "b", "c").mapInArrow(frequent, "h long, c long, level long").collect()  # at most SHARE rows
    hot_h = np.array([x[0] for x in hot], np.int64).view(np.uint64)
    by_hash = np.argsort(hot_h)
    model = spark.sparkContext.broadcast((hot_h[by_hash], np.array([x[1] for x in hot], np.int64)[by_hash],
        np.array([x[2] for x in hot], np.int64)[by_hash]))
    denominator = total + 0.5 * (distinct + 1)
    narrow = np.min_scalar_type(int(least))  # rare words' counts are less than that

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, step_of = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            data, offsets = shared.utf8(batch.column(1))
            for lo, hi in shared.steps(offsets):
                ids, uid = batch.column(0).slice(lo, hi - lo), task | step_of
                step_of += 1
                about = np.concatenate([ids.fill_null(0).to_numpy(), np.array(ids.is_null()).astype(np.int64),
                    np.array(batch.column(2).slice(lo, hi - lo)).astype(np.int64)])
                yield message([0], [TEXTS], [uid.to_bytes(8, "little")], [about.astype(np.int64).tobytes()],
                    [(offsets[lo : hi + 1] - offsets[lo]).tobytes()], [pa.compress(data[offsets[lo] : offsets[hi]].tobytes(), "zstd", asbytes=True)])

    stepped = shared.written(rows.select("doc_id", "text", "held_out").mapInArrow(cut, MESSAGE))

    def parts(offsets: bytes, text: bytes) -> tuple:
        """A step's tokens with their rows' bounds, its distinct words and pairs in order, where each token's are, and the frequent words' places in the broadcast."""
        at = np.frombuffer(offsets, np.int64)
        h, at = tokens(np.frombuffer(pa.decompress(text, int(at[-1]), "zstd"), np.uint8), at)
        words, which = np.unique(h, return_inverse=True)
        pairs, both = np.unique(pair_hashes(h, at) >> np.uint64(16), return_inverse=True)
        hot_h = model.value[0]
        k = np.minimum(np.searchsorted(hot_h, words), max(len(hot_h) - 1, 0))
        return at, words, which, pairs << np.uint64(16), both, hot_h[k] == words if len(hot_h) else np.zeros(len(words), bool), k

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, offsets, text in zip(*(batch.column(x).to_pylist() for x in range(3)), strict=True):
                _, words, _, pairs, _, is_hot, _ = parts(offsets, text)
                words = words[~is_hot]
                w, p = bounds_of(words, bits), bounds_of(pairs, bits)
                some = np.flatnonzero((np.diff(w) > 0) | (np.diff(p) > 0))
                w, p = np.append(w[some], len(words)), np.append(p[some], len(pairs))
                yield message(some.astype(np.int32), np.full(len(some), ASKED, np.int32), [uid] * len(some), shared.binary(words, w),
                    *packed_gaps(pairs, p))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts and levels of the words, and levels of the pairs, that each step asks for, from one bucket after another."""
        here, h, n, lookup = None, None, None, None
        for batch in batches:
            out = []
            for bucket, kind, a, b, c, d in zip(*(batch.column(x).to_pylist() for x in range(6)), strict=True):
                if bucket != here:
                    here, h, n, lookup = bucket, np.zeros(0, np.uint64), np.zeros(0, np.int64), None
                if kind == COUNTS:
                    h, n = np.frombuffer(a, np.uint64), np.frombuffer(b, np.int64)
                elif kind == SEGMENT:
                    lookup = Filter(np.frombuffer(a, np.uint8), 0)
                else:
                    words = np.frombuffer(b, np.uint64)
                    pairs = from_gaps(c, d)
                    count = np.zeros(len(words), np.int64)
                    if len(h):
                        k = np.minimum(np.searchsorted(h, words), len(h) - 1)
                        count = np.where(h[k] == words, n[k], 0)
                    levels = [lookup.levels(x) if lookup else np.zeros(len(x), np.int64) for x in (word_keys(words, bits), pairs)]
                    out.append((bucket, LEVELS, a, count.astype(narrow).tobytes(), *(x.astype(np.uint8).tobytes() for x in levels)))
            if out:
                yield message(*map(list, zip(*out, strict=True)))

    model_rows = table.where(F.col("kind").isin(COUNTS, SEGMENT)).select("bucket", "kind", "a", "b", "c", "d")
    asked = stepped.select("a", "c", "d").mapInArrow(ask, MESSAGE).unionByName(model_rows)
    answers = asked.repartition(n, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(answer, MESSAGE)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, hot_c, hot_level = model.value
        got: list[tuple[bytes, bytes, bytes]] = []
        for batch in batches:
            for kind, b, c, d in zip(*(batch.column(x).to_pylist() for x in ("kind", "b", "c", "d")), strict=True):
                if kind == LEVELS:
                    got.append((b, c, d))
                    continue
                at, words, which, pairs, both, is_hot, k = parts(c, d)
                answered = [b"".join(x) for x in zip(*got, strict=True)] if got else [b""] * 3
                got = []
                known, level = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
                known[is_hot], level[is_hot] = hot_c[k[is_hot]], hot_level[k[is_hot]]
                known[~is_hot], level[~is_hot] = np.frombuffer(answered[0], narrow), np.frombuffer(answered[1], np.uint8)
                number = np.diff(at)
                m = len(number)
                row = np.repeat(np.arange(m), number)
                # the model
                estimate, pair = middle(level)[which], middle(np.frombuffer(answered[2], np.uint8).astype(np.int64))[both]
                before = np.empty(len(which))
                before[1:] = estimate[:-1]
                before[at[:-1]] = texts
                p = PAIRS * pair / np.maximum(np.maximum(before, pair), 1) + (1 - PAIRS) * np.minimum((estimate + 0.5) / denominator, 1)
                known = known[which]
                ids = np.frombuffer(b, np.int64).reshape(3, m)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[0], pa.int64(), mask=ids[1] > 0), pa.array(ids[2] > 0), pa.array(number.astype(np.int64)),
                        pa.array(np.bincount(row, known > 0, m).astype(np.int64)), pa.array(np.full(m, total)),
                        pa.array(np.bincount(row, np.log10(known + 0.5), m) - number * np.log10(denominator)),
                        pa.array(np.bincount(row, np.log10(p), m)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    every = stepped.unionByName(answers)
    return every.repartition(n, "a").sortWithinPartitions("a", "kind", "bucket").mapInArrow(finish,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def message(bucket, kind, a, b, c, d) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), *(pa.array(x, pa.binary()) for x in (a, b, c, d))],
        schema=arrow_schema())


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(shared.table(spark, sf_dir, "documents"))
