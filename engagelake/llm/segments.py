"""Repeated passages: which stretches of texts can hold a window that also stands elsewhere.

Every window of ``width`` symbols (words or bytes) has an anchor: of its runs of ``gram`` symbols the one
with the least hash, leftmost of equals. Equal windows have equal anchors at the same place, so that
only windows whose anchor occurs twice can be repeated. A segment is a maximal run of windows
with one anchor. Anchors are counted in tasks and dealt out as packed arrays; those that
occur twice go into a Bloom filter of at most ``MAX_BITS`` bits, whatever the corpus holds, which
errs only towards keeping too much. Segments that pass are named by a hash of their text, so that equal
ones are looked at once, where they stand first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph, shared, textblock

MAX_BITS = 1 << 29
PROBES = 2
#: Anchors that a task merges before it deals them out.
HELD = 2_000_000
LAST = (1 << 63) - 1
#: Bytes of text whose segments are found in one step: its arrays stay in the processor's cache.
STEP = 1 << 18


@dataclass(frozen=True)
class Windows:
    """What a window is: ``symbols`` gives values, the rows' bounds among them, and their first and last bytes."""

    width: int
    gram: int
    symbols: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def word_symbols(data: np.ndarray, offsets: np.ndarray):
    start, end, bounds = textblock.words(data, offsets)
    return textblock.word_hashes(data, start, end), bounds, start, end


def byte_symbols(data: np.ndarray, offsets: np.ndarray):
    at = np.arange(len(data), dtype=np.int64)
    return data.astype(np.uint64) + np.uint64(1), offsets, at, at + 1


def segments_of(sums: np.ndarray, bounds: np.ndarray, w: Windows):
    """All segments of a block: (row, first window among all symbols, number of windows, anchor hash)."""
    n = len(sums) - 1
    nothing = np.zeros(0, np.int64)
    if n < w.width:
        return nothing, nothing, nothing, nothing.astype(np.uint64)
    count = np.maximum(np.diff(bounds) - w.width + 1, 0)
    live = np.flatnonzero(count)
    if not len(live):
        return nothing, nothing, nothing, nothing.astype(np.uint64)
    h = textblock.all_run_hashes(sums, w.gram)
    low = np.uint64((1 << max(1, int(n - 1).bit_length())) - 1)
    least = textblock.sliding_min(h & ~low | np.arange(len(h), dtype=np.uint64), w.width - w.gram + 1)  # its low bits: the anchor of each window
    begin = bounds[:-1][live]
    end = begin + count[live]
    new = np.empty(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    outside = np.append(0, end)  # windows over a row's end
    new[shared.ragged(outside, np.append(begin, len(least)) - outside)] = False
    new[begin] = True
    place = np.flatnonzero(new)
    own = np.searchsorted(begin, place, "right") - 1
    anchor = (least[place] & low).astype(np.int64)
    return live[own], place, np.minimum(np.append(place[1:], n), end[own]) - place, textblock.mix(h[anchor])  # least hashes are small: spread them


def bloom_places(h: np.ndarray, size: int) -> Iterator[np.ndarray]:
    x = textblock.mix(h ^ np.uint64(0x6A09E667F3BCC909))
    for k in range(PROBES):
        yield (x >> np.uint64(32 * k)) & np.uint64(size - 1)


def by_row(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes of each row, each once."""
    order = np.argsort(h, kind="stable")
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new]


def repeated_hashes(texts: DataFrame, hashes: Callable[[np.ndarray, np.ndarray], np.ndarray], density: int) -> tuple[np.ndarray, int]:
    """The filter of hashes (48 of their bits) that occur more than once in ``texts`` (a column text), and its bucket bits.

    ``hashes`` gives those of a block; there is about one in ``density`` bytes.
    """
    n = shared.partitions(texts.sparkSession)
    bits = max(4, int(2 * n - 1).bit_length())
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    filter_bits = min(MAX_BITS, max(1 << (bits + 6), 1 << int(2 * size // density).bit_length()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            h, count = np.unique(np.concatenate(held), return_counts=True)
            h = np.repeat(h, np.minimum(count, 2))
            at = np.searchsorted((h >> np.uint64(64 - bits)).astype(np.int64), np.arange((1 << bits) + 1))
            k = np.flatnonzero(np.diff(at))
            at = np.concatenate([at[k], [len(h)]])
            return pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), shared.binary((h >> np.uint64(32)).astype(np.uint32), at),
                shared.binary((h >> np.uint64(16)).astype(np.uint16), at)], ["bucket", "high", "low"])

        for b in batches:
            data, offsets = shared.utf8(b.column(0))
            for lo, hi in shared.steps(offsets, STEP):
                held.append(hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
                if sum(map(len, held)) > HELD:
                    yield flush()
                    held = []
        if held:
            yield flush()

    step = filter_bits >> bits

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in shared.runs(batches, ["bucket", "high", "low"]):  # one bucket at a time
            parts = [(np.frombuffer(high, np.uint32).astype(np.uint64) << np.uint64(16) | np.frombuffer(low, np.uint16)) << np.uint64(16) for _, high,
                low in rows]
            h = np.sort(np.concatenate(parts))
            again = np.zeros(len(h), bool)
            again[1:] = h[1:] == h[:-1]
            out = np.zeros(step, bool)
            for place in bloom_places(h[again], step):
                out[place.astype(np.int64)] = True
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())],
                ["bucket", "bits"])

    data = np.zeros(filter_bits >> 3, np.uint8)
    parts = texts.select("text").mapInArrow(deal, "bucket int, high binary, low binary").repartition(n,
        "bucket").sortWithinPartitions("bucket").mapInArrow(gather, "bucket int, bits binary")
    for bucket, part in parts.collect():  # MAX_BITS bits in all
        data[bucket * (step >> 3) : (bucket + 1) * (step >> 3)] = np.frombuffer(part, np.uint8)
    return data, bits


def passes(data: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    size = len(data) * 8 >> bits
    h = h >> np.uint64(16) << np.uint64(16)
    base = (h >> np.uint64(64 - bits)) * np.uint64(size)
    out = np.ones(len(h), bool)
    for place in bloom_places(h, size):
        at = base + place
        out &= (data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out


def occurrences(rows: DataFrame, w: Windows, within: bool) -> DataFrame:
    """A row for each text of a segment in each row of ``rows`` (ord, text_key, text), where its anchor passes the filter.

    Columns content (hash of the segment, which is also its key), ord, text_key, at (packed places of
    the first windows, counted in symbols), at0 (the least of them), n (windows), and, once for each
    task, anchor and body (its bytes). At 64 bits, two of a million million different segments share a
    key with a chance of one in about ten million.
    """

    def anchors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        values, bounds, _, _ = w.symbols(data, offsets)
        row, _, _, h = segments_of(textblock.prefix(values), bounds, w)
        return h if within else by_row(h, row)

    filter_, bits = repeated_hashes(rows.select("text"), anchors, 16)
    model = rows.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            data, offsets = shared.utf8(b.column(2))
            for lo, hi in shared.steps(offsets):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                values, bounds, begin, end = w.symbols(part, at)
                sums = textblock.prefix(values)
                row, place, n, anchor = segments_of(sums, bounds, w)
                keep = passes(model.value, bits, anchor)
                row, place, n, anchor = row[keep], place[keep], n[keep], anchor[keep]
                if not len(row):
                    continue
                content = textblock.run_hashes(sums, place, place + n + w.width - 1)
                order = np.lexsort((place, content, anchor, row))
                row, place, n, anchor, content = row[order], place[order], n[order], anchor[order], content[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
                first = np.flatnonzero(new)
                places = shared.binary((place - bounds[row]).astype(np.int32), np.append(first, len(row)))
                row, place, n, anchor, content = row[first], place[first], n[first], anchor[first], content[first]
                raw, body, new = part.tobytes(), [], []
                for c, x, y in zip(content.tolist(), begin[place].tolist(), end[place + n + w.width - 2].tolist(), strict=True):
                    new.append(c not in seen)
                    body.append(raw[x:y] if new[-1] else None)
                    seen.add(c)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64), mask=~np.array(new)), pa.array(content.view(np.int64)),
                    b.column(0).slice(lo, hi - lo).take(take), b.column(1).slice(lo, hi - lo).take(take), places,
                    pa.array((place - bounds[row]).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(body, pa.binary())],
                    ["anchor", "content", "ord", "text_key", "at", "at0", "n", "body"],
                )

    return rows.select("ord", "text_key", "text").mapInArrow(run,
        "anchor long, content long, ord long, text_key long, at binary, at0 int, n int, body binary")


def ordered_rows(documents: DataFrame) -> DataFrame:
    """doc_id, ord (the id, null ids last), text_key (a hash of the text, for rows that share an id), text (null: empty)."""
    text = F.coalesce("text", F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"),
        F.xxhash64(text).alias("text_key"), text.alias("text"))


def repeated_windows(documents: DataFrame, w: Windows, judge: Callable[[DataFrame], DataFrame], within: bool) -> DataFrame:
    """ord, text_key, removed (a list of packed (first window, number) pairs) of every text with repeated windows.

    ``judge`` takes the distinct segments (anchor, content, ord, text_key, at0, n, body; where each stands first) and gives for each of
    them (content, mask, again): a byte for each window, 1 where the window of the first occurrence stands
    earlier, too (null: nowhere), and the number of windows that any later occurrence repeats. ``within``: a text's
    later occurrences in one document are repeats of the first.
    """
    found = shared.written(occurrences(ordered_rows(documents), w, within))
    texts = found.groupBy("content").agg(F.min(F.struct("ord", "text_key", "at0")).alias("first"), F.first("n").alias("n"),
        F.max("anchor").alias("anchor"), F.max("body").alias("body"), F.count(F.lit(1)).alias("times"))
    texts = shared.written(texts.select("content", "anchor", "first.*", "n", "times", "body"))
    judged = shared.written(judge(texts.select("anchor", "content", "ord", "text_key", "at0", "n", "body")))
    known = texts.select("content", F.struct("ord", "text_key").alias("first"), "n", "times").join(judged, "content")
    decided = graph.spread_join(found.select("content", "ord", "text_key", "at"), known, ["content"], "times", found.count())

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for is_first, at, n, m, again in zip(*(b.column(c).to_pylist() for c in ("is_first", "at", "n", "mask", "again")), strict=True):
                at = np.frombuffer(at, np.int32)
                later = at if not is_first else at[1:] if within else at[:0]
                runs = [np.stack([later, np.full(len(later), again, np.int32)], 1)] if again == n else []
                if is_first and m is not None:
                    edge = np.diff(np.concatenate([[0], np.frombuffer(m, np.uint8), [0]]).astype(np.int8))
                    lo, hi = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
                    for a in (at[:1] if within else at).tolist():
                        runs.append(np.stack([a + lo, hi - lo], 1))
                runs = np.concatenate(runs).astype(np.int32) if runs else np.zeros((0, 2), np.int32)
                out.append(runs.tobytes() if len(runs) else None)
            yield pa.RecordBatch.from_arrays([b.column("ord"), b.column("text_key"), pa.array(out, pa.binary())], ["ord", "text_key", "removed"])

    is_first = (F.struct("ord", "text_key") == F.col("first")).alias("is_first")
    rows = decided.select("ord", "text_key", "at", is_first, "n", "mask", "again").mapInArrow(pairs, "ord long, text_key long, removed binary")
    return rows.where("removed is not null").groupBy("ord", "text_key").agg(F.collect_list("removed").alias("removed"))


def covered(removed: list[bytes] | None, symbols: int, width: int) -> np.ndarray:
    """Which of a text's symbols the repeated windows cover."""
    edge = np.zeros(symbols + 1, np.int64)
    for packed in removed or ():
        runs = np.frombuffer(packed, np.int32).reshape(-1, 2).astype(np.int64)
        np.add.at(edge, runs[:, 0], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1] + width - 1, -1)
    return np.cumsum(edge[:-1]) > 0
