"""Helpers the corpus operators share: tables, the shared folder, Arrow batches."""

from __future__ import annotations

import contextlib
import itertools
import tempfile
import uuid
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker takes in one vectorised step.
STEP_BYTES = 2 << 20


#: Bytes and rows of an Arrow batch between Spark and Python: texts can be long, and a batch is held several times over.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session's Python tasks, so that workers stay small beside full executors."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the session names it.

    Only a local session without the setting gets a folder of its own.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: Tables that ``written`` has made and nobody has dropped, in order.
_tables: list[str] = []


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: cuts lineage, survives lost executors.

    The driver's garbage is collected then: Spark drops shuffle files and broadcasts only of plans that are, and a chain of many
    small jobs would let the heap grow to its bound.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark).rstrip('/')}/engagelake-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _tables.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    spark.sparkContext._jvm.System.gc()
    return out


def dropped(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Deletes tables of ``written`` that nothing reads any more."""
    for t in tables:
        path = t if isinstance(t, str) else t.written_to
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        if path in _tables:
            _tables.remove(path)


def mark() -> int:
    return len(_tables)


def sweep(spark: SparkSession, since: int, keep: DataFrame) -> None:
    """Drops what has been written since a ``mark``, but for ``keep``: once a result is a table itself, nothing reads them."""
    dropped(spark, *(p for p in _tables[since:] if p != keep.written_to))


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Drops, at its end, the tables that operators have written inside: results are lazy and read them, so that a result is used or written within.

    ::

        with shared.scope(spark):
            substring.substring_dedup(documents).write.parquet(path)
    """
    since = mark()
    try:
        yield
    finally:
        dropped(spark, *_tables[since:])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut(df: DataFrame, rows: int, seed: int, *keys: str) -> DataFrame:
    """A little more than ``rows`` rows of ``df``, those with the least hashes of ``keys``, in a column r_.

    Cut at a hash, by the table's size: what leaves the tasks does not grow with their number.
    """
    share = min(1.0, (1.5 * rows + 100) / max(df.count(), 1))
    return df.withColumn("r_", F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1 << 40))).where(F.col("r_") < int(share * (1 << 40)))


def drawn(df: DataFrame, rows: int, seed: int, *keys: str) -> DataFrame:
    """At most ``rows`` rows of ``df``, those of the least hashes of ``keys``."""
    return cut(df, rows, seed, *keys).orderBy("r_", *keys).limit(rows).drop("r_")


def id_hash_mod(column: str, n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def steps(offsets: np.ndarray, size: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row is a range of its own."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for each length, concatenated."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Rows bounds[i]:bounds[i+1] (in elements) of ``data`` as a binary column."""
    data = np.ascontiguousarray(data)
    at = (bounds * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data.tobytes())])


def ragged_steps(starts: np.ndarray, counts: np.ndarray, step: int) -> np.ndarray:
    """starts[0], starts[0]+step, ... ``counts`` times for each start, concatenated."""
    total = int(counts.sum())
    first = np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(starts, counts) + (np.arange(total, dtype=np.int64) - first) * step


def runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Rows (of these columns) of sorted batches, grouped by the first column; one group after another, none held whole."""
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in columns), strict=True))
    return itertools.groupby(rows, itemgetter(0))
