"""Operator 6: best-fit packing by minimum bin slack.

Tokenising runs in the tasks, without a shuffle of texts; what is kept of a piece is its length
and checksum. Packing needs the number of pieces of each length only, at most ``capacity``
counts whatever the corpus holds. On these counts the plan is made bin by bin: a bitset
subset-sum over the lengths at hand finds the fullest feasible combination, which is removed,
as many times as it remains feasible. Pieces then take their places by their rank among
pieces of equal length.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import shared, textblock

LETTER, DIGIT, OTHER, BLANK = 0, 1, 2, 3
CONTRACTION = re.compile(r"'(?:[sdmt]|ll|ve|re)")


class BlockTokenizer:
    """Ids of many texts at once, equal to those of the tokenizer file.

    A byte-level BPE merges inside pieces only (a word with its leading space, a run of digits, of
    signs or of blanks), so the pieces of a block are found and hashed in numpy, and each
    distinct piece is encoded once, by the same vocabulary as ranks. Texts that hold the literal
    name of a special token go through ``tokenizers`` itself.
    """

    #: Distinct pieces that a worker remembers; beyond, it starts anew.
    REMEMBER = 500_000

    def __init__(self, path: str, ranks_path: str):
        # imported here, so that the other operators do without these packages
        import public_tokenizers
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pieces = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        self.kind = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (BLANK, r"\s+")):
            for m in regex.finditer(pattern, every):
                self.kind[ord(m[0][0]) : ord(m[0][-1]) + 1] = kind
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes of pieces
        self.at = np.zeros((0, 2), np.int64)  # their first token and number of tokens
        self.tokens = np.zeros(0, np.uint32)

    def cut(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Starts of all pieces of the texts codes[bounds[i]:bounds[i+1]]."""
        n = len(codes)
        kind = self.kind[codes]
        first = np.zeros(n + 1, bool)
        first[bounds] = True
        last = first[1:]  # last code of a text
        begins = first[:-1].copy()
        begins[1:] |= kind[1:] != kind[:-1]
        blank = kind == BLANK
        # the last blank before something else is a piece of its own, or the lead of the next if it is a space
        closing = np.zeros(n, bool)
        closing[:-1] = blank[:-1] & ~blank[1:] & ~last[:-1]
        begins |= closing
        lead = np.zeros(n, bool)
        lead[1:] = closing[:-1] & (codes[:-1] == 0x20)
        begins &= ~lead
        for p in np.flatnonzero((codes == 0x27) & begins):  # contractions: where a piece begins with an apostrophe
            end = int(bounds[np.searchsorted(bounds, p, "right")])
            if m := CONTRACTION.match("".join(map(chr, codes[p : min(end, p + 3)]))):
                k = p + len(m[0])
                begins[p + 1 : k] = False
                if k < end and not lead[k]:
                    begins[k] = True
        return np.flatnonzero(begins)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the texts' bounds among them."""
        odd = {i: self.exact.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts) if any(s in t for s in self.special)}
        plain = ["" if i in odd else t for i, t in enumerate(texts)]
        codes = np.frombuffer("".join(plain).encode("utf-32-le"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in plain])]).astype(np.int64)
        if not len(codes):
            ids, out = np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        else:
            start = self.cut(codes, bounds)
            end = np.append(start[1:], len(codes))
            h = textblock.run_hashes(textblock.prefix(codes + np.uint32(1)), start, end)
            distinct, example, which = np.unique(h, return_index=True, return_inverse=True)
            k = self.lookup(distinct, codes, start[example], end[example])
            number = self.at[k, 1][which]
            ids = self.tokens[shared.ragged(self.at[k, 0][which], number)]
            total = np.concatenate([[0], np.cumsum(number)])
            out = total[np.searchsorted(start, bounds)]
        if odd:
            each = [np.array(odd[i], np.uint32) if i in odd else ids[out[i] : out[i + 1]] for i in range(len(texts))]
            ids, out = np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])
        return ids, out

    def lookup(self, distinct: np.ndarray, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where the pieces with these sorted hashes stand in ``at``; encodes the new ones."""
        if len(self.known) > self.REMEMBER:
            self.forget()
        k = np.searchsorted(self.known, distinct)
        new = np.flatnonzero(k == len(self.known)) if not len(self.known) else np.flatnonzero(self.known[np.minimum(k,
            len(self.known) - 1)] != distinct)
        if len(new):
            encode = self.pieces.encode_ordinary
            text = codes.tobytes().decode("utf-32-le")
            got = [encode(text[a:b]) for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)]
            number = np.fromiter(map(len, got), np.int64, len(got))
            at = np.stack([len(self.tokens) + np.cumsum(number) - number, number], 1)
            self.tokens = np.concatenate([self.tokens, np.fromiter((t for x in got for t in x), np.uint32, int(number.sum()))])
            where = np.searchsorted(self.known, distinct[new])
            self.known, self.at = np.insert(self.known, where, distinct[new]), np.insert(self.at, where, at, 0)
            k = np.searchsorted(self.known, distinct)
        return k


_tokenizers: dict[tuple[str, str], BlockTokenizer] = {}


def block_tokenizer(path: str, ranks_path: str) -> BlockTokenizer:
    """One for each worker."""
    if (path, ranks_path) not in _tokenizers:
        _tokenizers[path, ranks_path] = BlockTokenizer(path, ranks_path)
    return _tokenizers[path, ranks_path]


def pieces(documents: DataFrame, path: str, ranks_path: str, capacity: int = 1024, closing: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, with its task and rank among the task's pieces of its length."""
    spread = F.spark_partition_id().alias("task")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = block_tokenizer(path, ranks_path)
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            column = b.column(1).fill_null("")
            _, offsets = shared.utf8(column)
            for lo, hi in shared.steps(offsets):
                ids, at = tok.encode(column.slice(lo, hi - lo).to_pylist())
                n = np.diff(at) + 1  # with the closing id
                rest = (n - 1) % capacity + 1  # the first piece takes what is over
                count = (n - rest) // capacity + 1
                row = np.repeat(np.arange(hi - lo), count)
                k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = np.where(k == 0, 0, rest[row] + (k - 1) * capacity)
                length = np.where(k == 0, rest[row], capacity)
                full = np.insert(ids, at[1:], closing).astype("<u4")
                first = at[:-1][row] + row + start
                raw = full.tobytes()
                crc = np.fromiter((zlib.crc32(raw[4 * a : 4 * (a + m)]) for a, m in zip(first.tolist(), length.tolist(), strict=True)), np.int64,
                    len(row))
                order = np.argsort(length, kind="stable")
                sizes, begin, number = np.unique(length[order], return_index=True, return_counts=True)
                rank = np.empty(len(row), np.int64)
                rank[order] = np.arange(len(row)) - np.repeat(begin, number) + np.repeat(seen[sizes], number)
                seen[sizes] += number
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(k.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array(crc), b.column(2).slice(lo, hi - lo).take(pa.array(row)), pa.array(rank)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"],
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", spread).mapInArrow(run,
        "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long")


def fullest(counts: np.ndarray, capacity: int) -> dict[int, int]:
    """The combination of lengths, within their counts, with the largest sum up to ``capacity``: {length: number}.

    Integers serve as bitsets of reachable sums. The longest length at hand is always in, so that
    long pieces find a place while short ones remain to fill up; the rest is a bounded subset-sum
    over the other lengths, longest first, whose bitsets are kept to read the combination back.
    """
    lengths = np.flatnonzero(counts)[::-1].tolist()
    top = lengths[0]
    mask = (1 << (capacity + 1)) - 1
    reach, trail = 1 << top, []
    for length in lengths:
        have = min(int(counts[length]) - (length == top), (capacity - top) // length)
        k = 1
        while have > 0:  # powers of two stand for up to ``have`` of a length
            take = min(k, have)
            trail.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            have -= take
            k *= 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    used = {top: 1}
    for length, take, before in reversed(trail):
        if not before >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return used


def plan(counts: np.ndarray, capacity: int = 1024) -> np.ndarray:
    """Minimum bin slack over counts of lengths.

    Rows (length, first rank, ranks, number per bin, first bin, offset): the pieces of that length
    from that rank on go, so many to each bin, to consecutive bins, from that offset.
    """
    left, used, bins, rows = counts.astype(np.int64).copy(), np.zeros(capacity + 1, np.int64), 0, []
    while left.any():
        combination = fullest(left, capacity)
        times = min(int(left[length]) // number for length, number in combination.items())
        offset = 0
        for length, number in sorted(combination.items(), reverse=True):
            rows.append((length, used[length], number * times, number, bins, offset))
            used[length] += number * times
            left[length] -= number * times
            offset += length * number
        bins += times
    return np.array(rows, np.int64).reshape(-1, 6)


def best_fit_pack(documents: DataFrame, path: str | None = None, ranks_path: str | None = None, capacity: int = 1024, closing: int = 2) -> DataFrame:
    """Packs all documents into as few sequences of at most ``capacity`` tokens as it can.

    Null and empty texts are one piece of the closing id alone; repeated rows are packed each;
    an empty table gives an empty result; columns other than doc_id and text are ignored. A
    document longer than ``capacity`` is cut into full pieces of which the first may be shorter.
    """
    spark = documents.sparkSession
    if not (path and ranks_path):
        import public_tokenizers

        path = path or public_tokenizers.path("byte_bpe_50k.json")
        ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    cut = shared.written(pieces(documents, path, ranks_path, capacity, closing))
    by_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    # a row for each length and task: where the task's ranks of that length begin
    before = by_task.withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding,
        -1))).select("length", "task", F.coalesce("before", F.lit(0)).alias("before"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in by_task.groupBy("length").agg(F.sum("n")).collect():  # at most ``capacity`` rows
        counts[length] = n
    table = plan(counts, capacity)
    order = np.lexsort((table[:, 1], table[:, 0]))
    table = spark.sparkContext.broadcast(table[order])  # bounded by the number of lengths, not by the corpus

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        key = (t[:, 0] << 44) + t[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            row = t[np.searchsorted(key, (length << 44) + rank, "right") - 1]
            i = rank - row[:, 1]
            sequence, offset = row[:, 4] + i // row[:, 3], row[:, 5] + i % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence),
                pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = cut.join(before, ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("rank") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack(shared.table(spark, sf_dir, "documents"))
