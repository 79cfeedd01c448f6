"""Operator 7: substring dedup of bytes by suffix arrays, built by the difference-cover algorithm.

A suffix array of the whole corpus would move every byte several times as a row of its own; instead,
repeated passages are found first (``segments``), and only what can be repeated in parts is sorted:

1. Segments around repeated anchors are compared as wholes. Within a task every occurrence but that
   in the least id is settled at once; one question for each segment and task goes to the segment's
   bucket, where the least id of all is found. Later occurrences are removed as wholes.
2. Segments whose anchor has several texts are dealt to shards by anchor. In each shard, a suffix
   array is built by difference cover modulo 3 (sort sampled triples, recurse on their names, merge the
   remaining suffixes), adjacent suffixes are compared by their first ``WIDTH`` bytes, and of
   equal ones all but those in the least id are removed. An anchor with more than ``SHARD`` texts is refined: each
   window is dealt by a longer run around the anchor, until a shard takes the texts of each.
3. Spans meet their texts by bucket of the id.

Equal windows have equal anchors, so no pair of them is ever in two shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import graph, segments, shared, textblock

WIDTH, GRAM = 50, 20
BYTES = segments.Windows(WIDTH, GRAM, segments.byte_symbols)
#: Segments that a task holds before it settles them.
HELD = 2_000_000
#: Texts of one anchor that a shard takes; anchors with more are refined.
SHARD = 4096
#: Bytes of segments that one suffix array covers.
ARRAY_BYTES = 1 << 20

SPANS, QUESTIONS, ANCHORS, TEXT = range(4)
PACKED = "bucket int, kind int, content binary, anchor binary, ord binary, text_key binary, at binary, n binary"
COLUMNS = [x.split()[0] for x in PACKED.split(", ")]


# --- suffix arrays ---


def suffix_array(s: np.ndarray, top: int) -> np.ndarray:
    """Starts of all suffixes of ``s`` (integers from 1 to ``top``) in order, by difference cover modulo 3."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    x = np.concatenate([s.astype(np.int64), np.zeros(3, np.int64)])
    base, size, ones = top + 1, n + 4, n + (n % 3 == 1)  # an empty triple closes the first half, if nothing else does
    triple = (x[:-2] * base + x[1:-1]) * base + x[2:]
    key = np.concatenate([triple[1:ones:3], triple[2:n:3]])
    half = len(range(1, ones, 3))
    order = np.argsort(key)  # equal triples get one name, in any order
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    name = np.empty(len(key), np.int64)
    name[order] = np.cumsum(new)
    names = int(new.sum())
    if names < len(key):  # recurse on the names
        order = suffix_array(name, names)
        name[order] = np.arange(1, len(order) + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[1:ones:3], rank[2:n:3] = name[:half], name[half:]
    if ones > n:
        order = order[order != half - 1]
    own = order < half
    a, b = order[own], order[~own] - half
    first = x[0:n:3] * size + rank[1 : n + 1 : 3]
    rest = np.argsort(first)
    # merge: each remaining suffix against both kinds of sampled ones
    before = np.searchsorted((x[1:n:3] * size + rank[2 : n + 1 : 3])[a], first[rest])
    two = (x[: n + 1] * base + x[1 : n + 2]) * size
    before += np.searchsorted((two[2:n:3] + rank[4 : n + 2 : 3])[b], (two[0:n:3] + rank[2 : n + 2 : 3])[rest])
    out = np.empty(n, np.int64)
    place = before + np.arange(len(rest))
    out[place] = 3 * rest
    free = np.ones(n, bool)
    free[place] = False
    out[free] = np.where(own, 3 * order + 1, 3 * (order - half) + 2)
    return out


def repeated_starts(bodies: list[bytes], windows: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
    """For each body, which of its first ``windows`` starts has its WIDTH bytes in a body of a smaller id, too."""
    size = np.array([len(x) for x in bodies])
    at = np.concatenate([[0], np.cumsum(size + 1)])
    raw = b"\0".join(bodies) + b"\0"
    s = np.frombuffer(raw, np.uint8).astype(np.int64) + 2
    s[at[1:] - 1] = 1  # between bodies
    order = suffix_array(s, 257)
    of = np.full(len(s), -1, np.int64)
    starts = shared.ragged(at[:-1], windows)
    of[starts] = np.repeat(np.arange(len(bodies)), windows)
    order = order[of[order] >= 0]
    eight = np.ndarray(len(raw), np.uint64, raw + bytes(8), strides=(1,)).copy()  # the eight bytes from each place on
    same = np.ones(len(order), bool)
    same[:1] = False
    for k in (*range(0, WIDTH - 8, 8), WIDTH - 8):  # adjacent prefixes
        part = eight[order + k]
        same[1:] &= part[1:] == part[:-1]
    first = np.flatnonzero(~same)
    own = ids[of[order]]
    least = np.minimum.reduceat(own, first) if len(first) else own
    out = np.zeros(len(s), bool)
    out[order] = own > least[np.cumsum(~same) - 1]
    return [out[a : a + w] for a, w in zip(at[:-1].tolist(), windows.tolist(), strict=True)]


# --- packed rows ---


def buckets_of(spark: SparkSession) -> int:
    """A prime number of buckets of ids, several for each partition."""
    n = 4 * shared.partitions(spark) + 1
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def dealt(bucket: np.ndarray, kind: int, **columns: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket, with the packed values of its entries."""
    order = np.argsort(bucket, kind="stable")
    own, first = np.unique(bucket[order], return_index=True)
    at = np.append(first, len(bucket))
    packed = [shared.binary(columns[c][order], at) if c in columns else pa.nulls(len(own), pa.binary()) for c in COLUMNS[2:]]
    return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(np.full(len(own), kind, np.int32)), *packed], COLUMNS)


def least_ids(content: np.ndarray, *rest: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """All entries by content, id and place, and which of them are in their content's least id. rest: anchor, ord, text_key, at, n."""
    order = np.lexsort((rest[3], rest[1], content))
    content, ids = content[order], rest[1][order]
    new = np.ones(len(content), bool)
    new[1:] = content[1:] != content[:-1]
    least = ids[np.flatnonzero(new)][np.cumsum(new) - 1] if len(content) else ids
    return [content, *(x[order] for x in rest)], ids == least


def segment_batches(batches: Iterator[pa.RecordBatch], keep) -> Iterator[list[np.ndarray]]:
    """(content, anchor, ord, text_key, at, n, first byte, last byte, block) of segments whose anchor ``keep`` takes, a block at a time."""
    for b in batches:
        data, offsets = shared.utf8(b.column(2))
        ids, keys = b.column(0).to_numpy(), b.column(1).to_numpy()
        for lo, hi in shared.steps(offsets, segments.STEP):
            part, bounds = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            sums = textblock.prefix(part.astype(np.uint64) + np.uint64(1))
            row, place, n, anchor = segments.segments_of(sums, bounds, BYTES)
            take = keep(anchor)
            row, place, n, anchor = row[take], place[take], n[take], anchor[take]
            end = place + n + WIDTH - 1
            yield [textblock.run_hashes(sums, place, end), anchor, ids[lo:hi][row], keys[lo:hi][row], (place - bounds[row]).astype(np.int32),
                n.astype(np.int32), place, end, part]


def settled(rows: DataFrame, filter_: tuple[np.ndarray, int], buckets: int) -> DataFrame:
    """SPANS of whole segments that stand in a smaller id, too, and ANCHORS with the texts that are left, as packed rows."""
    spark = rows.sparkSession
    model, bits = spark.sparkContext.broadcast(filter_[0]), filter_[1]
    types = {"content": np.uint64, "anchor": np.uint64, "ord": np.int64, "text_key": np.int64, "at": np.int32, "n": np.int32}

    def spans(entries: list[np.ndarray], gone: np.ndarray) -> pa.RecordBatch:
        _, _, ids, keys, at, n = (x[gone] for x in entries)
        return dealt(ids % buckets, SPANS, ord=ids, text_key=keys, at=at, n=n)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def settle() -> Iterator[pa.RecordBatch]:
            entries, least = least_ids(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield spans(entries, ~least)
            content, anchor, ids, keys, at, n = (x[least] for x in entries)
            yield dealt((content >> np.uint64(64 - bits)).astype(np.int64), QUESTIONS, content=content, anchor=anchor, ord=ids, text_key=keys, at=at,
                n=n)

        for block in segment_batches(batches, lambda h: segments.passes(model.value, bits, h)):
            held.append(block[:6])
            if sum(len(x[0]) for x in held) > HELD:
                yield from settle()
                held = []
        if held:
            yield from settle()

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def asked() -> Iterator[pa.RecordBatch]:
            """Questions; spans pass by."""
            for b in batches:
                kind = b.column("kind").to_numpy()
                if (kind == SPANS).any():
                    passing.append(b.filter(pa.array(kind == SPANS)))
                yield b.filter(pa.array(kind == QUESTIONS))

        passing: list[pa.RecordBatch] = []
        gone: list[list[np.ndarray]] = []
        counted: list[tuple[np.ndarray, np.ndarray]] = []

        def decided() -> Iterator[pa.RecordBatch]:
            """What is held, of many buckets, in one go: rows are packed by where they go to."""
            if gone:
                entries = [np.concatenate(x) for x in zip(*gone, strict=True)]
                yield spans(entries, np.ones(len(entries[0]), bool))
            if counted:
                anchor, texts = (np.concatenate(x) for x in zip(*counted, strict=True))
                yield dealt((anchor >> np.uint64(64 - bits)).astype(np.int64), ANCHORS, anchor=anchor, n=texts.astype(np.int32))
            gone.clear()
            counted.clear()

        for _, group in shared.runs(asked(), ["bucket", *types]):  # one bucket at a time
            held = [[np.frombuffer(x, t) for x, t in zip(r[1:], types.values(), strict=True)] for r in group]
            yield from passing
            passing.clear()
            entries, least = least_ids(*(np.concatenate(x) for x in zip(*held, strict=True)))
            if not least.all():
                gone.append([x[~least] for x in entries])
            content, anchor = entries[0][least], entries[1][least]
            new = np.ones(len(content), bool)
            new[1:] = content[1:] != content[:-1]
            counted.append(np.unique(anchor[new], return_counts=True))
            if sum(len(x[0]) for x in [*gone, *counted]) > HELD:
                yield from decided()
        yield from passing
        yield from decided()

    n = shared.partitions(spark)
    return shared.written(rows.mapInArrow(ask, PACKED).repartition(n, "bucket").sortWithinPartitions("kind", "bucket").mapInArrow(decide, PACKED))


def several_texts(decided: DataFrame, bits: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Filters (as bits of ``size`` for each bucket) of anchors with several texts, and of those with more than SHARD."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in shared.runs(batches, ["bucket", "anchor", "n"]):
            parts = [(np.frombuffer(anchor, np.uint64), np.frombuffer(n, np.int32).astype(np.int64)) for _, anchor, n in rows]
            anchor, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            anchor, which = np.unique(anchor >> np.uint64(16) << np.uint64(16), return_inverse=True)
            n = np.bincount(which, n)
            out = []
            for least in (1, SHARD):
                marks = np.zeros(size, bool)
                for place in segments.bloom_places(anchor[n > least], size):
                    marks[place.astype(np.int64)] = True
                out.append(np.packbits(marks, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([x], pa.binary()) for x in out)],
                ["bucket", "several", "many"])

    n = shared.partitions(decided.sparkSession)
    rows = decided.where(F.col("kind") == ANCHORS).select("bucket", "anchor", "n").repartition(n,
        "bucket").sortWithinPartitions("bucket").mapInArrow(gather, "bucket int, several binary, many binary")
    out = np.zeros((2, size << bits >> 3), np.uint8)
    for bucket, *parts in rows.collect():  # twice segments.MAX_BITS / 4 bits at most
        for k, part in enumerate(parts):
            out[k, bucket * (size >> 3) : (bucket + 1) * (size >> 3)] = np.frombuffer(part, np.uint8)
    return out[0], out[1]


def closer(rows: DataFrame, several: np.ndarray, many: np.ndarray, bits: int) -> DataFrame:
    """Segments whose anchor has several texts: of each task those in the text's least id. Bodies come with the first."""
    model = rows.sparkSession.sparkContext.broadcast((several, many))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bodies, size = [], [], 0

        def settle() -> pa.RecordBatch:
            content, *rest = (np.concatenate(x) for x in zip(*held, strict=True))
            entries, least = least_ids(content, *rest, np.arange(len(content)))
            content, anchor, ids, keys, at, n, number = (x[least] for x in entries)
            new = np.ones(len(content), bool)
            new[1:] = content[1:] != content[:-1]
            body = [bodies[k] if x else None for k, x in zip(number.tolist(), new.tolist(), strict=True)]
            hot = segments.passes(model.value[1], bits, anchor)
            return pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), *map(pa.array, (ids, keys, at, n)),
                pa.array(hot), pa.array(body, pa.binary())], ["anchor", "content", "ord", "text_key", "at", "n", "many", "body"])

        for *block, begin, end, part in segment_batches(batches, lambda h: segments.passes(model.value[0], bits, h)):
            held.append(block)
            raw = part.tobytes()
            bodies += [raw[a:z] for a, z in zip(begin.tolist(), end.tolist(), strict=True)]
            if len(bodies) > HELD // 4:
                yield settle()
                held, bodies = [], []
        if held:
            yield settle()

    return rows.mapInArrow(run, "anchor long, content long, ord long, text_key long, at int, n int, many boolean, body binary")


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)


def mask_spans(masks: list[np.ndarray], number: np.ndarray, later: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, windows) of each run that the masks of the rows' texts mark; of ``later`` rows of a text, all windows are one run."""
    size = np.array([len(m) for m in masks])
    begin = np.cumsum(size) - size
    edge = np.zeros(int(size.sum()) + len(masks) + 1, np.int8)  # a zero closes each mask
    edge[1:][np.arange(int(size.sum())) + np.repeat(np.arange(len(masks)), size)] = np.concatenate(masks)
    a, z = runs_of(edge[1:])
    text = np.searchsorted(begin + np.arange(len(masks)), a, "right") - 1
    a_in = a - (begin + np.arange(len(masks)))[text]
    runs = np.bincount(text, minlength=len(masks))
    rows, whole = np.flatnonzero(~later), np.flatnonzero(later)
    take = shared.ragged((np.cumsum(runs) - runs)[number[rows]], runs[number[rows]])
    return (np.concatenate([np.repeat(rows, runs[number[rows]]), whole]), np.concatenate([a_in[take], np.zeros(len(whole), np.int64)]),
        np.concatenate([(z - a)[take], size[number[whole]]]))


def shard_spans(segments_: DataFrame, buckets: int) -> DataFrame:
    """SPANS of windows that suffix arrays find in a smaller id, too.

    An occurrence of a text in a greater id than its least is a span as a whole.
    """
    n = shared.partitions(segments_.sparkSession)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, at in graph.whole_groups(batches, ["anchor"]):
            content, ids, keys, places, windows = (whole.column(c).to_numpy() for c in ("content", "ord", "text_key", "at", "n"))
            bodies = whole.column("body")
            new = np.ones(len(content), bool)
            new[1:] = content[1:] != content[:-1]  # rows of a text: the least id first, with its body
            number = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            size = np.cumsum(windows[first] + WIDTH)
            # whole anchors together, about ARRAY_BYTES at a time
            ends = np.searchsorted(first, at[1:])
            lo, masks = 0, []
            while lo < len(first):
                limit = (size[lo - 1] if lo else 0) + ARRAY_BYTES
                fit = ends[(ends > lo) & (size[ends - 1] <= limit)]
                hi = int(fit[-1]) if len(fit) else int(ends[ends > lo][0])
                k = first[lo:hi]
                masks += repeated_starts([bodies[int(x)].as_py() for x in k], windows[k], ids[k])
                lo = hi
            removed = mask_spans(masks, number, ids != ids[first[number]])
            if len(removed[0]):
                i, place, count = removed
                yield dealt(ids[i] % buckets, SPANS, ord=ids[i], text_key=keys[i], at=(places[i] + place).astype(np.int32), n=count.astype(np.int32))

    dealt_ = segments_.repartition(n, "anchor").sortWithinPartitions("anchor", "content", "ord", F.col("body").isNull())
    return dealt_.select("anchor", "content", "ord", "text_key", "at", "n", "body").mapInArrow(shard, PACKED)


PIECE = "anchor long, content long, ord long, text_key long, at int, n int, run int, body binary"


def refined(rows: DataFrame, gram: int, half: int) -> DataFrame:
    """Segments (see PIECE) cut in two: windows with ``half`` bytes or more before their run, and the others, which have as many behind it.

    ``run`` is where in the body the run of ``gram`` bytes begins that all windows share (-1: the anchor, to be found); it is made
    longer by ``half`` on that side, and is the anchor of the part.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = shared.utf8(b.column("body"))
            sums, raw, out = textblock.prefix(data.astype(np.uint64) + np.uint64(1)), data.tobytes(), []
            columns = (b.column(c).to_pylist() for c in ("ord", "text_key", "at", "n", "run"))
            for w0, (o, key, at, n, run) in zip(offsets[:-1].tolist(), zip(*columns, strict=True), strict=True):
                if run < 0:
                    places = w0 + np.arange(WIDTH - gram + 1)
                    run = int(np.argmin(textblock.run_hashes(sums, places, places + gram)))
                left = min(n, max(0, run - half + 1))
                for lo, hi, a, z in ((0, left, run - half, run + gram), (left, n, run, run + gram + half)):
                    if hi > lo:
                        x, y = w0 + lo, w0 + hi + WIDTH - 1
                        anchor, content = textblock.run_hashes(sums, np.array([w0 + a, x]), np.array([w0 + z, y])).view(np.int64).tolist()
                        out.append((anchor ^ (a == run), content, o, key, at + lo, hi - lo, a - lo, raw[x:y]))
            if out:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)],
                    [c.split()[0] for c in PIECE.split(", ")])

    return rows.select("ord", "text_key", "at", "n", "run", "body").mapInArrow(cut, PIECE)


def many_spans(segments_: DataFrame, buckets: int) -> DataFrame:
    """The same for anchors with very many texts: parts with longer and longer anchors, until a shard takes their texts; at last the anchor is the window."""
    lead = segments_.where("body is not null").groupBy("content").agg(F.max("body").alias("body"))
    rows, gram, out = segments_.drop("body").join(lead, "content").withColumn("run", F.lit(-1)), GRAM, None
    while True:
        half = (WIDTH - gram + 1) // 2
        pieces, gram = shared.written(refined(rows, gram, half)), gram + half
        sizes = pieces.groupBy("anchor").agg(F.countDistinct("content").alias("texts"), F.count(F.lit(1)).alias("rows"))
        wide = sizes.where(F.col("texts") > SHARD) if gram < WIDTH else sizes.limit(0)
        spans = shard_spans(graph.spread_anti(pieces, wide, ["anchor"], "rows", pieces.count()), buckets)
        out = spans if out is None else out.unionByName(spans)
        if gram == WIDTH or not wide.take(1):
            return out
        rows = graph.spread_join(pieces, wide, ["anchor"], "rows", pieces.count())


def suffix_dedup(documents: DataFrame) -> DataFrame:
    """Per row of ``documents``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay).

    Each byte covered by a string of 50 bytes that also starts in a smaller id is removed. Null and
    empty texts have no bytes; a very long text is one document, whole; rows that share an id do not count
    against one another; null ids come after all others; ties (equal strings in one id) stay; an empty table gives an empty result; other columns are ignored.
    """
    spark = documents.sparkSession
    n, buckets = shared.partitions(spark), buckets_of(spark)
    rows = segments.ordered_rows(documents)
    if not documents.groupBy("doc_id").count().where("count > 1").take(1):
        rows = rows.withColumn("text_key", F.lit(0).cast("long"))  # texts of one id need not be told apart
    texts = rows.select("ord", "text_key", "text")

    def anchors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, _, _, h = segments.segments_of(textblock.prefix(data.astype(np.uint64) + np.uint64(1)), offsets, BYTES)
        return segments.by_row(h, row)

    filter_, bits = segments.repeated_hashes(texts.select("text"), anchors, 16)
    decided = settled(texts, (filter_, bits), buckets)
    several, many = several_texts(decided, bits, max(64, len(filter_) * 8 >> bits >> 2))
    near = closer(texts, several, many, bits)
    if many.any():  # an anchor with more texts than a shard takes; the texts are read once for both
        near = shared.written(near)
    spans = decided.where(F.col("kind") == SPANS).unionByName(shard_spans(near.where("not many"), buckets))
    if many.any():
        spans = spans.unionByName(many_spans(near.where("many"), buckets))
    packed = spans.select("bucket", "kind", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("id"),
        F.lit(None).cast("long").alias("key"), "ord", "text_key", "at", "n", F.lit(None).cast("binary").alias("raw"))
    none = F.lit(None).cast("binary")
    whole = rows.select(F.pmod("ord", F.lit(buckets)).cast("int").alias("bucket"), F.lit(TEXT).alias("kind"), "doc_id", F.col("ord").alias("id"),
        F.col("text_key").alias("key"), none.alias("ord"), none.alias("text_key"), none.alias("at"), none.alias("n"),
        F.col("text").cast("binary").alias("raw"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, found = None, [], None
        for b in batches:
            out: list[list] = [[], [], [], [], [], []]
            for r in b.to_pylist():
                if r["bucket"] != bucket:
                    bucket, held, found = r["bucket"], [], None
                if r["kind"] == SPANS:
                    held.append((np.frombuffer(r["ord"], np.int64), np.frombuffer(r["text_key"], np.int64), np.frombuffer(r["at"], np.int32),
                        np.frombuffer(r["n"], np.int32)))
                    continue
                if found is None:
                    found = [np.concatenate(x) for x in zip(*held, strict=True)] if held else [np.zeros(0, np.int64)] * 4
                    order = np.argsort(found[0], kind="stable")
                    found, held = [x[order] for x in found], []
                raw = r["raw"]
                lo, hi = np.searchsorted(found[0], [r["id"], r["id"] + 1]) if r["id"] < segments.LAST else (np.searchsorted(found[0], r["id"]),
                    len(found[0]))
                own = np.flatnonzero(found[1][lo:hi] == r["key"]) + lo
                removed = spans_ = 0
                if len(own):
                    runs = np.stack([found[2][own], found[3][own]], 1).astype(np.int32)
                    gone = segments.covered([runs.tobytes()], len(raw), WIDTH)
                    removed, spans_ = int(gone.sum()), len(runs_of(gone)[0])
                    raw = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                for x, y in zip(out, (r["doc_id"], len(r["raw"]), removed, spans_, hashlib.sha256(raw).hexdigest(), raw), strict=True):
                    x.append(y)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    both = packed.unionByName(whole).repartition(n, "bucket").sortWithinPartitions("bucket", "kind")
    return both.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(shared.table(spark, sf_dir, "documents")).drop("kept")
