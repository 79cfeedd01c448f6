"""Encoders over tables: an interface, the run with its failures and its resumption, a benchmark, and the media a run needs."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import files
from . import media


class Encoder(Protocol):
    """A model that a task loads once and gives batches of rows; rows of the matrix have norm 1."""

    name: str
    dim: int

    def load(self) -> None: ...

    def encode(self, batch: pd.DataFrame) -> np.ndarray: ...

    def memory_bytes(self) -> int: ...


class Seeded:
    """A stand-in encoder: a vector from the bytes of the text; texts with ``fails`` in them cannot be encoded."""

    def __init__(self, dim: int = 16, fails: str | None = None):
        self.name, self.dim, self.fails, self.loaded = f"seeded-{dim}", dim, fails, False

    def load(self) -> None:
        self.loaded = True

    def encode(self, batch: pd.DataFrame) -> np.ndarray:
        texts = batch["text"].fillna("")
        if self.fails and texts.str.contains(self.fails, regex=False).any():
            raise ValueError(f"cannot encode {self.fails}")
        counts = np.array([np.bincount(np.frombuffer(t.encode(), np.uint8) % self.dim, minlength=self.dim) + 1.0 for t in texts]).reshape(-1,
            self.dim)
        return counts / np.linalg.norm(counts, axis=1, keepdims=True)

    def memory_bytes(self) -> int:
        return 0


def within_quota(encoder: Encoder, quota_bytes: int = 20 << 30) -> bool:
    return encoder.memory_bytes() <= quota_bytes


ENCODED = "vector array<double>, stage string, error_type string, message string"


def encoded(df: DataFrame, encoder: Encoder, key: str, size: int = 32) -> DataFrame:
    """``key`` and a vector for each row, or stage, error_type and message where it cannot be encoded.

    Tasks encode ``size`` rows at a time; where a batch fails, each of its rows is tried by itself, so that one bad row
    costs no other.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder.load()
        for b in batches:
            for lo in range(0, len(b), size):
                part = b.iloc[lo : lo + size]
                try:
                    vectors, faults = list(encoder.encode(part)), [None] * len(part)
                except Exception:  # any fault of a model: the rows are tried one by one
                    vectors, faults = [], []
                    for i in range(len(part)):
                        try:
                            vectors.append(encoder.encode(part.iloc[i : i + 1])[0])
                            faults.append(None)
                        except Exception as fault:
                            vectors.append(None)
                            faults.append(fault)
                yield pd.DataFrame({
                    key: part[key].to_numpy(), "vector": [None if v is None else v.tolist() for v in vectors],
                    "stage": [f and "encode_batch" for f in faults],
                    "error_type": [f and type(f).__name__ for f in faults], "message": [f and str(f) for f in faults],
                })

    return df.mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, {ENCODED}")


def resumable(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows that are not completed yet."""
    return df.join(done.select(key), key, "left_anti")


def run_encoder(df: DataFrame, encoder: Encoder, key: str, path: str, size: int = 32, chunk_rows: int = 10_000,
    together: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Encodes what ``path`` has not yet, adds it there, and gives all (vectors, failures of this run).

    A run first writes what is to be done as files of ``chunk_rows`` rows at most. A stream over these files encodes ``together`` of
    them at a time (as many as there are cores) and commits each such chunk by itself: a chunk's rows are a folder of their own, written whole,
    before the stream's checkpoint moves on. A run that is killed has lost the chunk that it was at; the next call goes on with exactly
    the rest of it, then takes up what else ``df`` has. A chunk that is written again replaces itself, so that no row is there twice. Rows that failed
    are tried again by the next run.
    """
    spark = df.sparkSession
    runs, schema = f"{path}/runs", f"{key} {df.schema[key].dataType.simpleString()}, {ENCODED}"
    known = [int(n) for n in files.names(spark, runs)]
    broken = [n for n in known if files.exists(spark, f"{runs}/{n}/todo/_SUCCESS") and not files.exists(spark, f"{runs}/{n}/finished")]
    for run in broken:
        _finish(spark, encoder, key, path, run, df.schema, size, together)
    run = max(known, default=-1) + 1
    todo = resumable(df, _rows(spark, path, schema).where("vector is not null"), key)
    todo.write.option("maxRecordsPerFile", chunk_rows).parquet(f"{runs}/{run}/todo")
    _finish(spark, encoder, key, path, run, df.schema, size, together)
    rows = _rows(spark, path, schema)
    return rows.where("vector is not null").select(key, "vector"), rows.where((F.col("run") == run) & F.col("vector").isNull()).select(key, "stage",
        "error_type", "message")


def _rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All committed rows, with their run and chunk."""
    whole = f"{schema}, run long, chunk long"
    return spark.read.schema(whole).parquet(f"{path}/rows") if files.exists(spark, f"{path}/rows") else spark.createDataFrame([], whole)


def _finish(spark: SparkSession, encoder: Encoder, key: str, path: str, run: int, schema: StructType, size: int, together: int | None) -> None:
    """Encodes the chunks of a run that are not committed yet."""
    home = f"{path}/runs/{run}"

    def commit(batch: DataFrame, chunk: int) -> None:
        encoded(batch, encoder, key, size).write.mode("overwrite").parquet(f"{path}/rows/run={run}/chunk={chunk}")

    chunks = spark.readStream.schema(schema).option("maxFilesPerTrigger", together or spark.sparkContext.defaultParallelism).parquet(f"{home}/todo")
    query = chunks.writeStream.foreachBatch(commit).option("checkpointLocation", f"{home}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    files.put_new(spark, f"{home}/finished", "")


def benchmark(df: DataFrame, encoders: Sequence[Encoder], key: str, quota_bytes: int = 20 << 30) -> list[dict]:
    """For each encoder: status, rows, seconds, rows a second, whether it keeps to its memory, and the largest deviation of a norm from 1; a fault is recorded."""
    out = []
    for e in encoders:
        began = time.perf_counter()
        try:
            deviation = F.abs(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)) - 1)
            x = encoded(df, e, key).agg(F.count("*").alias("n"), F.count("error_type").alias("failed"), F.max(deviation).alias("worst"),
                F.max("message").alias("message")).first()
            if x.failed:
                raise RuntimeError(x.message)
            seconds = time.perf_counter() - began
            out.append({"model": e.name, "dim": e.dim, "status": "success", "rows": x.n, "seconds": seconds,
                "rows_a_second": x.n / max(1e-5, seconds), "quota_respected": within_quota(e, quota_bytes), "worst_norm": x.worst or 0.0})
        except Exception as fault:
            out.append({"model": e.name, "dim": e.dim, "status": "failed", "error": str(fault)})
    return out


# --- media ---


def media_key(kind, owner, number, position):
    """The name, without its ending, that an attachment's file has in the cache."""
    return F.concat_ws("_", kind, owner.cast("string"), number.cast("string"), position.cast("string"))


def cached_media(spark: SparkSession, path: str) -> DataFrame:
    """(key, ending, path, length) of the files of a cache; empty ones are none. Contents are not read."""
    name = F.element_at(F.split("path", "/"), -1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").where("length > 0")
    return files.select(F.regexp_extract(name, r"^(.*)\.([^.]+)$", 1).alias("key"), F.regexp_extract(name, r"\.([^.]+)$", 1).alias("ending"), "path",
        "length")


#: The ending that files of a kind have.
ENDINGS = {"photo": "jpg", "video": "mp4"}


def resolved(attachments: DataFrame, cache: DataFrame) -> DataFrame:
    """``attachments`` (post_id, position, type, owner, number) with the path of their file; null where there is none of their kind."""
    ending = F.create_map(*[F.lit(x) for pair in ENDINGS.items() for x in pair])[F.col("type")]
    named = attachments.withColumn("key", media_key(F.col("type"), F.col("owner"), F.col("number"), F.col("position"))).withColumn("ending", ending)
    return named.join(cache.select("key", "ending", "path"), ["key", "ending"], "left").drop("key", "ending")


def image_kind(content):
    """What an image file says it is: jpeg or png with a beginning and an end, or null."""
    head, tail = F.hex(F.substring(content, 1, 8)), F.hex(F.substring(content, -8, 8))
    return F.when(head.startswith("FFD8FF") & tail.endswith("FFD9"), "jpeg").when((head == "89504E470D0A1A0A") & (tail == "49454E44AE426082"), "png")


def dataset(posts: DataFrame, attachments: DataFrame, cache: DataFrame) -> DataFrame:
    """Posts with the paths of their images and videos in order of position; media that cannot be found are left out, posts never."""
    found = resolved(attachments, cache).where("path is not null")
    listed = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.struct("position", "path")))),
        lambda x: x["path"])
    media = found.groupBy("post_id").agg(listed("photo").alias("images"), listed("video").alias("videos"))
    none = F.array().cast("array<string>")
    return posts.join(media, "post_id", "left").withColumns({"images": F.coalesce("images", none), "videos": F.coalesce("videos", none)})


def decoded_dataset(posts: DataFrame, attachments: DataFrame, cache: DataFrame, files: DataFrame, most: int = 8) -> DataFrame:
    """(post_id, kind, position, frame, height, width, pixels): the images and the key frames of the videos of posts, decoded and resized.

    Media that cannot be found or decoded are left out, as ``dataset`` does; ``media.images`` and ``media.videos`` tell why. ``files`` are those of
    ``media.opened``. Each file is decoded once, however many posts show it.
    """
    found = resolved(attachments, cache).where("path is not null").join(posts.select("post_id"), "post_id", "left_semi")
    shown = found.select("path", F.col("type").alias("kind")).distinct()
    of = lambda kind: files.join(shown.where(F.col("kind") == kind), "path", "left_semi")
    keys = media.video_key_frames(of("video"), most=most).select("path", "frame")
    frames = media.images(of("photo")).unionByName(media.videos(of("video")).join(keys, ["path", "frame"], "left_semi")).where("reason is null")
    return found.join(frames, "path").select("post_id", F.col("type").alias("kind"), "position", "frame", "height", "width", "pixels")


def provenance(df: DataFrame, key: str, **settings) -> DataFrame:
    """One row that says what a table came from: rows, least and largest key, a sum of row hashes that no order changes, and the settings as JSON."""
    made = F.to_json(F.struct(*(F.lit(v).alias(k) for k, v in sorted(settings.items())))) if settings else F.lit("{}")
    return df.agg(F.count("*").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"),
        F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).alias("content")).withColumn("settings", made)
