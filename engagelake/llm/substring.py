"""Operator 3: substring dedup by suffix automata of reference shards.

The reference is the corpus itself: every distinct segment around a repeated anchor (``segments``). It is dealt to
shards by anchor; in each shard, segments are streamed in the order of the corpus through the automaton of
those before them. Matching statistics of ``WIDTH`` words and more mark the windows that start earlier
elsewhere; then the segment extends the automaton, and is streamed through it once more, as any later occurrence of it would
be. All that is removed is found by these statistics; maximal runs of marked windows are the spans.

A shard is the texts of one anchor. An anchor with more than ``SHARD`` texts (a passage in very many contexts) is refined: each
window is dealt by a longer run around the anchor, the one that reaches over the fuller half of its context, so that
its texts part, and the same automata decide; after four steps the run is the window itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import graph, segments, shared, textblock

WIDTH, GRAM = 20, 8
#: Texts that one automaton takes.
SHARD = 64


class SuffixAutomaton:
    """Of several sequences, with suffix links and longest lengths."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, sequence: list) -> None:
        last = 0
        for c in sequence:
            q = self.next[last].get(c)
            if q is not None and self.length[q] == self.length[last] + 1:
                last = q
                continue
            if q is not None:  # only a clone stands for the new suffixes
                last = self.clone(last, c, q)
                continue
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            new, p = len(self.next) - 1, last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self.clone(p, c, q)
            last = new

    def clone(self, p: int, c, q: int) -> int:
        self.next.append(self.next[q].copy())
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        new = len(self.next) - 1
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def matching(self, sequence: list) -> list[int]:
        """For each place, the length of the longest match that ends there."""
        state = length = 0
        out = []
        for c in sequence:
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if c in self.next[state]:
                state = self.next[state][c]
                length += 1
            else:
                length = 0
            out.append(length)
        return out


def through_automata(texts: DataFrame) -> DataFrame:
    """(key, sub, mask, again) for texts (key, sub, ord, text_key, at, body) of few to a key: one automaton for each key."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, at in graph.whole_groups(batches, ["key"]):
            masks, again = [], []
            bodies = whole.column("body").to_pylist()
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                automaton = SuffixAutomaton()
                for k in range(lo, hi):
                    words = bodies[k].split()
                    mask = [m >= WIDTH for m in automaton.matching(words)[WIDTH - 1 :]] if k > lo else [False]
                    masks.append(bytes(mask) if any(mask) else None)
                    if not all(mask):
                        automaton.add(words)
                    again.append(sum(m >= WIDTH for m in automaton.matching(words)))
            yield pa.RecordBatch.from_arrays([whole.column("key"), whole.column("sub"), pa.array(masks, pa.binary()), pa.array(again, pa.int32())],
                ["key", "sub", "mask", "again"])

    dealt = texts.repartition(shared.partitions(texts.sparkSession), "key").sortWithinPartitions("key", "ord", "text_key", "at", "sub")
    return dealt.select("key", "sub", "body").mapInArrow(shard, "key long, sub long, mask binary, again int")


PIECE = "content long, k0 int, n int, ord long, text_key long, at int, run int, key long, sub long, body binary"


def refined(pieces: DataFrame, gram: int, half: int) -> DataFrame:
    """Pieces (see PIECE) cut in two: windows with ``half`` words or more before their run, and the others, which have as many behind it.

    ``run`` is where in the body the run of ``gram`` words begins that all windows share; it is made longer by ``half`` on that side,
    and names the key of the part.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = shared.utf8(b.column("body"))
            raw = data.tobytes()
            start, end, bounds = textblock.words(data, offsets)
            sums = textblock.prefix(textblock.word_hashes(data, start, end))
            rows = []
            columns = (b.column(c).to_pylist() for c in ("content", "k0", "n", "ord", "text_key", "at", "run"))
            for w0, (content, k0, n, o, text_key, at, run) in zip(bounds[:-1].tolist(), zip(*columns, strict=True), strict=True):
                if run < 0:  # the anchor: the least run of the first window, leftmost of equals
                    places = w0 + np.arange(WIDTH - gram + 1)
                    run = int(np.argmin(textblock.run_hashes(sums, places, places + gram)))
                left = min(n, max(0, run - half + 1))
                for lo, hi, a, z in ((0, left, run - half, run + gram), (left, n, run, run + gram + half)):
                    if hi > lo:
                        x, y = w0 + lo, w0 + hi + WIDTH - 1
                        key, sub = textblock.run_hashes(sums, np.array([w0 + a, x]), np.array([w0 + z, y])).view(np.int64).tolist()
                        rows.append((content, k0 + lo, hi - lo, o, text_key, at + lo, a - lo, key ^ (a == run), sub, raw[start[x] : end[y - 1]]))
            if rows:
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)],
                    [c.split()[0] for c in PIECE.split(", ")])

    return pieces.select("content", "k0", "n", "ord", "text_key", "at", "run", "body").mapInArrow(cut, PIECE)


def put_together(parts: DataFrame) -> DataFrame:
    """(content, mask, again) of segments from the parts (content, k0, n, first, mask, again) that they were cut in, thirteen at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            masks, agains = [], []
            for own in b.column("parts").to_pylist():
                mask = np.zeros(sum(p["n"] for p in own), np.uint8)
                for p in own:
                    repeats = np.frombuffer(p["mask"], np.uint8) if p["mask"] else 0
                    mask[p["k0"] : p["k0"] + p["n"]] = repeats if p["first"] else p["again"] == p["n"]
                masks.append(mask.tobytes() if mask.any() else None)
                agains.append(sum(p["again"] for p in own))
            yield pa.RecordBatch.from_arrays([b.column("content"), pa.array(masks, pa.binary()), pa.array(agains, pa.int32())],
                ["content", "mask", "again"])

    return parts.groupBy("content").agg(F.collect_list(F.struct("k0", "n", "first", "mask", "again")).alias("parts")).mapInArrow(run,
        "content long, mask binary, again int")


def judged(distinct: DataFrame) -> DataFrame:
    """(content, mask, again) for ``segments.repeated_windows``: all from matching statistics in automata of bounded size."""
    pieces = distinct.select("content", F.lit(0).alias("k0"), "n", "ord", "text_key", F.col("at0").alias("at"), F.lit(-1).alias("run"),
        F.col("anchor").alias("key"), F.col("content").alias("sub"), "body")
    texts, gram, out, parts = pieces, GRAM, None, None
    while True:
        half = (WIDTH - gram + 1) // 2
        sizes = texts.groupBy("key").agg(F.count(F.lit(1)).alias("texts"))
        wide = sizes.where(F.col("texts") > SHARD) if half else sizes.limit(0)  # a run of all words has one text
        found = through_automata(graph.spread_anti(texts, wide, ["key"], "texts", texts.count()))
        if out is None:  # whole segments, each of them a text
            out = found.select(F.col("sub").alias("content"), "mask", "again")
        else:
            found = found.join(texts.select("key", "sub", F.struct("ord", "text_key", "at").alias("of"), "copies"), ["key", "sub"])
            some = graph.spread_join(pieces, found, ["key", "sub"], "copies", pieces.count()).select("content", "k0", "n", (F.struct("ord", "text_key", "at") == F.col("of")).alias("first"),
                "mask", "again")
            parts = some if parts is None else parts.unionByName(some)
        if not half or not wide.take(1):
            return out if parts is None else out.unionByName(put_together(parts))
        many = graph.spread_join(pieces, wide, ["key"], "texts", pieces.count())
        pieces = shared.written(refined(many, gram, half))
        place = F.min(F.struct("ord", "text_key", "at"))
        texts = shared.written(pieces.groupBy("key", "sub").agg(place.alias("first"), F.max("body").alias("body"), F.count("*").alias("copies")).select("key",
            "sub", "first.*", "body", "copies"))
        gram += half


WORDS = segments.Windows(WIDTH, GRAM, segments.word_symbols)


def substring_dedup(documents: DataFrame) -> DataFrame:
    """Per row of ``documents``: doc_id, n_words, n_removed, kept_sha256, kept (the words that stay).

    A window of 20 words that also starts earlier (in a smaller id, or earlier in its document) is
    removed. Null and empty texts have no words; a very long text is one document, whole; rows that share an id
    go in the order of a hash of their texts, equal rows are treated alike; null ids come after all
    others, as one id; an empty table gives an empty result; other columns are ignored.
    """
    removed = segments.repeated_windows(documents, WORDS, judged, within=True)
    rows = segments.ordered_rows(documents).join(removed, ["ord", "text_key"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number, gone, hashes, kept = [], [], [], []
            for text, marks in zip(b.column("text").to_pylist(), b.column("removed").to_pylist(), strict=True):
                words = text.encode().split()
                number.append(len(words))
                if marks:
                    out = segments.covered(marks, len(words), WIDTH)
                    gone.append(int(out.sum()))
                    words = [w for w, x in zip(words, out.tolist(), strict=True) if not x]
                else:
                    gone.append(0)
                whole = b" ".join(words)
                hashes.append(hashlib.sha256(whole).hexdigest())
                kept.append(whole.decode())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(number, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(hashes, pa.string()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return rows.select("doc_id", "text", "removed").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(shared.table(spark, sf_dir, "documents")).drop("kept")
