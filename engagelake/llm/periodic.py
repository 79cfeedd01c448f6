"""Operator 11: periodic runs of words by harmonic grid probing.

A run is a maximal stretch of words with a smallest period p that is at least ``max(24, 3 p)`` long. The places i with
word i = word i + p are then an interval of at least 2 p, so that it holds two neighbouring points of the grid of multiples of p.
For every p the words at jp, (j + 1)p and (j + 2)p are compared; over all p that is n log n probes. Survivors are
compared in chunks of doubling length from jp to (j + 1)p, and those that agree throughout are extended to both sides in the same way.

Periods go in bands from 2**k up to 2**(k + 1), so that a multiple of a period is in a later band than itself. A grid point
jp whose words up to (j + 2)p all lie in a run of an earlier band is skipped: two runs with different smallest periods p and q
share fewer than p + q words, so that no run of period p can reach over it, and what has a smaller period is never taken again.

Many texts go through the probes together, as one array of word numbers; a long text is probed in blocks, so that what a
task holds is a few arrays of the text's words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared, textblock

#: Words of a run, at least, and how often its period stands in it, at least.
LEAST, TIMES = 24, 3
#: Probes, or compared words, of a vectorised step.
PROBES = 1 << 19


def word_table(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the words (equal words, equal numbers), each row's bounds among them, and the words joined by single spaces with their starts."""
    start, end, bounds = textblock.words(data, offsets)
    size = end - start
    at = np.concatenate([[0], np.cumsum(size)])
    letters = data[~textblock.SPACE[data]]
    kind, width = (pa.binary(), np.int32) if len(letters) < 1 << 31 else (pa.large_binary(), np.int64)
    column = pa.Array.from_buffers(kind, len(size), [None, pa.py_buffer(at.astype(width).tobytes()), pa.py_buffer(letters.tobytes())])
    ids = column.dictionary_encode().indices.to_numpy().astype(np.int32)
    joined = np.full(len(letters) + len(size), 0x20, np.uint8)
    gap = np.zeros(len(joined) + 1, bool)
    gap[at[1:] + np.arange(len(size))] = True
    joined[~gap[:-1]] = letters
    return ids, bounds, joined, at + np.arange(len(at))


def reach(ids: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many words are equal in a row from a and from b on, going by ``step`` (1 or -1), ``most`` at most; in chunks of doubling length."""
    done, live, chunk = np.zeros(len(a), np.int64), np.flatnonzero(most > 0), 4
    while len(live):
        left = []
        for lo in range(0, len(live), max(1, PROBES // chunk)):
            own = live[lo : lo + max(1, PROBES // chunk)]
            room = np.minimum(most[own] - done[own], chunk)
            off = np.minimum(np.arange(chunk)[None], room[:, None] - 1)  # beyond the room the last word is compared again
            place = (done[own][:, None] + off) * step
            differs = ids[a[own][:, None] + place] != ids[b[own][:, None] + place]
            first = np.where(differs.any(1), differs.argmax(1), chunk)
            done[own] += np.minimum(first, room)
            left.append(own[(first == chunk) & (done[own] < most[own])])
        live, chunk = np.concatenate(left), min(2 * chunk, PROBES)
    return done


def grid(first: np.ndarray, count: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, j) of all grid points with two more behind them, for periods low <= p < high; about PROBES at a time."""
    top = np.minimum(count // TIMES, high - 1)
    texts = np.flatnonzero(top >= low)
    many = top[texts] - low + 1
    ends = np.cumsum(many)
    for lo in range(0, int(ends[-1]) if len(ends) else 0, PROBES):  # (text, period) in blocks
        flat = np.arange(lo, min(lo + PROBES, int(ends[-1])))
        k = np.searchsorted(ends, flat, "right")
        text, p = texts[k], flat - (ends[k] - many[k]) + low
        points = (count[text] - 1) // p - 1  # j = 0 .. points - 1
        upto = np.cumsum(points)
        for a in range(0, int(upto[-1]), PROBES):
            point = np.arange(a, min(a + PROBES, int(upto[-1])))
            r = np.searchsorted(upto, point[[0, -1]], "right")
            rows = np.arange(r[0], r[1] + 1)
            inside = np.minimum(upto[rows], point[-1] + 1) - np.maximum(upto[rows] - points[rows], a)
            row = np.repeat(rows, inside)
            yield text[row], p[row], point - (upto[row] - points[row])


def runs_of(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of all runs of the rows bounds[k]:bounds[k + 1] of ``ids``, by start and then period."""
    first, count = bounds[:-1], np.diff(bounds)
    longest = int(count.max(initial=0))
    found = np.zeros((3, 0), np.int64)
    low = 1
    while low <= longest // TIMES and longest >= LEAST:
        order = np.argsort(found[0], kind="stable")
        starts, ends = found[0][order], np.maximum.accumulate(found[1][order])  # the furthest end of a run that starts no later
        new = []
        for text, p, j in grid(first, np.where(count >= LEAST, count, 0), low, 2 * low):
            x = first[text] + j * p
            alike = ids[x] == ids[x + p]
            text, p, j, x = text[alike], p[alike], j[alike], x[alike]
            alike = ids[x + p] == ids[x + 2 * p]
            text, p, j, x = text[alike], p[alike], j[alike], x[alike]
            if len(starts):
                before = np.searchsorted(starts, x, "right") - 1
                fresh = (before < 0) | (ends[before] <= x + 2 * p)
                text, p, j, x = text[fresh], p[fresh], j[fresh], x[fresh]
            whole = reach(ids, x, x + p, p, 1) == p
            new.append(np.stack([text, p, j])[:, whole])
        text, p, j = np.concatenate(new, 1) if new else np.zeros((3, 0), np.int64)
        if len(text):
            # neighbouring survivors are one interval of equal words
            opens = np.ones(len(text), bool)
            opens[1:] = (text[1:] != text[:-1]) | (p[1:] != p[:-1]) | (j[1:] != j[:-1] + 1)
            head = np.flatnonzero(opens)
            tail = np.append(head[1:], len(text)) - 1
            text, p, left, right = text[head], p[head], first[text[head]] + j[head] * p[head], first[text[head]] + (j[tail] + 1) * p[head]
            a = left - reach(ids, left - 1, left - 1 + p, left - first[text], -1)
            b = right + reach(ids, right, right + p, first[text] + count[text] - right - p, 1) + p
            good = b - a >= np.maximum(LEAST, TIMES * p)
            found = np.concatenate([found, np.unique(np.stack([a, b, p])[:, good], axis=1)], 1)
        low *= 2
    return tuple(found[:, np.lexsort((found[2], found[0]))])


def rebuilt(ids: np.ndarray, n: int, h: int) -> np.ndarray | None:
    """Which original word stands at each of n places: a tail repeats for one text in ten, by the hash ``h`` of its id; None for the others."""
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def digest_of(joined: np.ndarray, begin: np.ndarray, words: np.ndarray | None, lo: int, hi: int) -> str:
    """SHA-256 of words joined by single spaces: those at lo:hi, or the chosen ones of them, in blocks."""
    out = hashlib.sha256()
    if words is None:
        out.update(memoryview(joined[begin[lo] : max(begin[hi] - 1, begin[lo])]))
        return out.hexdigest()
    size = begin[words + 1] - begin[words]
    upto = np.cumsum(size)
    k = 0
    while k < len(words):
        to = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + PROBES, "right")))
        block = joined[shared.ragged(begin[words[k:to]], size[k:to])]
        out.update(memoryview(block if to < len(words) else block[:-1]))
        k = to
    return out.hexdigest()


def strongest(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> int:
    """The run with the greatest length / period, exactly; the first of equals."""
    ratio = (end - start) / period
    best, *others = np.flatnonzero(ratio >= ratio.max() * (1 - 1e-9)).tolist()
    for k in others:
        if int(end[k] - start[k]) * int(period[best]) > int(end[best] - start[best]) * int(period[k]):
            best = k
    return best


OUT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
    "n_words long, n_dropped long")


def periodic_runs(documents: DataFrame, repeat_tails: bool = False) -> DataFrame:
    """Per row of ``documents``: doc_id, n_runs, the run of the greatest exponent (start, length, period, exponent_milli), digests, n_words, n_dropped.

    ``runs_sha256`` is over all runs, ``collapsed_sha256`` over the words that stay when each run keeps its first period alone.
    ``repeat_tails``: one text in ten, by the hash of its id, is searched with its tail made periodic (a test of recall
    that any corpus can be put to); never for a null id. Null and empty texts have no words and no runs; texts are searched whole,
    whatever their length; repeated rows and ids are each a row of the result; of runs with one exponent the first counts, then that of the
    smaller period; an empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = shared.utf8(b.column("text"))
            hashes = b.column("h").to_pylist()
            for lo, hi in shared.steps(offsets, 1 << 20):
                ids, bounds, joined, begin = word_table(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                source = {}
                for k in range(hi - lo):
                    x, y = int(bounds[k]), int(bounds[k + 1])
                    if hashes[lo + k] is not None and (at := rebuilt(ids, y - x, hashes[lo + k])) is not None:
                        source[k] = x + at
                        ids[x:y] = ids[source[k]]
                start, end, period = runs_of(ids, bounds)
                of = np.searchsorted(start, bounds)
                depth = np.zeros(len(ids) + 1, np.int32)  # how many runs repeat a word
                np.add.at(depth, start + period, 1)
                np.add.at(depth, end, -1)
                gone = np.cumsum(depth[:-1]) > 0
                lost = np.concatenate([[0], np.cumsum(gone)])
                rows = []
                for k in range(hi - lo):
                    x, y, own = int(bounds[k]), int(bounds[k + 1]), slice(int(of[k]), int(of[k + 1]))
                    s, e, p = start[own], end[own], period[own]
                    best = (None,) * 4
                    if len(s):
                        m = strongest(s, e, p)
                        length = int(e[m] - s[m])
                        best = (int(s[m]) - x, length, int(p[m]), 1000 * length // int(p[m]))
                    listed = hashlib.sha256()
                    for q in range(len(s)):
                        listed.update(b"%d,%d,%d\n" % (s[q] - x, e[q] - s[q], p[q]))
                    dropped = int(lost[y] - lost[x])
                    chosen = source.get(k)
                    if dropped:
                        chosen = (np.arange(x, y) if chosen is None else chosen)[~gone[x:y]]
                    rows.append((len(s), *best, listed.hexdigest(), digest_of(joined, begin, chosen, x, y), y - x, dropped))
                kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()] * 2
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True),
                    kinds, strict=True))], [c.split()[0] for c in OUT.split(", ")])

    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) if repeat_tails else F.lit(None).cast("long")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), h.alias("h"))
    return rows.mapInArrow(run, OUT)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(shared.table(spark, sf_dir, "documents"), repeat_tails=True)
