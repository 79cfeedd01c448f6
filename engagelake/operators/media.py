"""Media in tasks: files decoded one at a time, resized images, histograms, key frames by the change between neighbours.

Files come from Spark's ``binaryFile`` source and are decoded in ``mapInArrow``: PNG and PPM images and YUV4MPEG2 videos here, other images by Pillow
where it is installed. A file that cannot be decoded is a row with a reason, never a failed task. A task holds one file and one frame at a time.
Key frames of scalar series are SQL.
"""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Weights of red, green and blue, the longest side of a picture, bins of a channel's histogram.
LUMA, LONGEST, BINS = (0.299, 0.587, 0.114), 448, 16
#: Bytes of an Arrow batch of files, and of a file at most.
BATCH_BYTES, FILE_BYTES = 16 << 20, 1 << 30


def key_frames(df: DataFrame, clip: list[str], order: list[Column], value: Column, threshold: float, most: int, least: int = 1) -> DataFrame:
    """The first frame (score 1), and of those that change by more than ``threshold`` the ``most`` - 1 largest.

    If that is fewer than ``least``, the largest changes fill up.
    """
    w = W.partitionBy(*clip).orderBy(*order)
    scored = df.withColumn("frame", F.row_number().over(w)).withColumn("score", F.when(F.col("frame") == 1,
        1.0).otherwise(F.abs(value - F.lag(value).over(w))))
    rest = F.row_number().over(W.partitionBy(*clip).orderBy(F.asc(F.col("frame") != 1), F.desc("score"), F.asc("frame")))
    return scored.withColumn("nth",
        rest).where((F.col("frame") == 1) | ((F.col("score") > threshold) & (F.col("nth") <= most)) | (F.col("nth") <= least)).drop("nth")


def luma_change(a: np.ndarray, b: np.ndarray) -> float:
    """Mean absolute difference of luma over the common size, 0 to 1."""
    h, w = min(a.shape[0], b.shape[0]), min(a.shape[1], b.shape[1])
    x, y = (f[:h, :w].astype(float) @ np.array(LUMA) for f in (a, b))
    return float(np.abs(x - y).mean() / 255)


def resized(frame: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Nearest pixels, the long side at most ``longest``."""
    h, w = frame.shape[:2]
    if max(h, w) <= longest:
        return frame
    k = longest / max(h, w)
    rows = (np.arange(max(1, round(h * k))) / k).astype(int).clip(0, h - 1)
    cols = (np.arange(max(1, round(w * k))) / k).astype(int).clip(0, w - 1)
    return frame[rows][:, cols]


def histogram_embedding(frames: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """Mean of the frames' channel histograms, scaled to norm 1."""
    each = [np.concatenate([np.histogram(f[..., c], bins, (0, 256), density=True)[0] for c in range(3)]) for f in frames]
    v = np.mean(each, 0)
    return v / max(np.linalg.norm(v), 1e-12)


def pixel_changes(df: DataFrame) -> DataFrame:
    """(clip, frame, score) from rows (clip, frame, height, width, pixels as bytes). A clip's frames are read in order, one pair at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple | None = None
        for b in batches:
            scores = []
            for r in b.itertuples(index=False):
                frame = np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width, 3)
                scores.append(luma_change(last[1], frame) if last and last[0] == r.clip else 1.0)
                last = (r.clip, frame)
            yield pd.DataFrame({"clip": b["clip"], "frame": b["frame"], "score": scores})

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "clip").sortWithinPartitions("clip", "frame").mapInPandas(run, "clip long, frame long, score double")


# --- files ---


def png_pixels(raw: bytes) -> np.ndarray:
    """Of a PNG file of eight bits a channel (grey, RGB, palette, with alpha or without): height x width x 3."""
    at, parts, palette, head = 8, [], None, None
    while True:
        size, kind = int.from_bytes(raw[at : at + 4], "big"), raw[at + 4 : at + 8]
        body = raw[at + 8 : at + 8 + size]
        if len(body) < size or zlib.crc32(kind + body) != int.from_bytes(raw[at + 8 + size : at + 12 + size], "big"):
            raise ValueError("a chunk is cut off or damaged")
        if kind == b"IHDR":
            head = int.from_bytes(body[:4], "big"), int.from_bytes(body[4:8], "big"), *body[8:]
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            parts.append(body)
        elif kind == b"IEND":
            break
        at += 12 + size
    width, height, depth, colour, _, _, interlaced = head
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    if depth != 8 or interlaced:
        raise ValueError("only eight bits a channel, not interlaced")
    rows = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, 1 + width * channels)
    out, above = np.zeros((height, width, channels), np.uint8), np.zeros((width, channels), np.int64)
    for y, row in enumerate(rows):
        line, way = row[1:].reshape(width, channels).astype(np.int64), row[0]
        if way == 1:
            line = np.cumsum(line, 0) & 255
        elif way == 2:
            line = (line + above) & 255
        elif way in (3, 4):
            left, corner = np.zeros(channels, np.int64), np.zeros(channels, np.int64)
            for x in range(width):
                up = above[x]
                if way == 3:
                    guess = (left + up) >> 1
                else:
                    a, b, c = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
                left, corner = (line[x] + guess) & 255, up
                line[x] = left
        out[y], above = line, line
    if colour == 3:
        return palette[out[..., 0]]
    return out[..., :3] if channels > 2 else np.repeat(out[..., :1], 3, 2)


def ppm_pixels(raw: bytes) -> np.ndarray:
    head = re.match(rb"P6" + rb"\s+(?:#[^\n]*\n\s*)*(\d+)" * 3 + rb"\s", raw)
    width, height, _ = map(int, head.groups())
    return np.frombuffer(raw[head.end() : head.end() + width * height * 3], np.uint8).reshape(height, width, 3)


def image_pixels(raw: bytes) -> np.ndarray:
    if raw[:8] == b"\x89PNG\r\n\x1a\n":
        return png_pixels(raw)
    if raw[:2] == b"P6":
        return ppm_pixels(raw)
    try:
        from PIL import Image
    except ImportError:
        raise ValueError("no decoder for this kind of image") from None
    with Image.open(io.BytesIO(raw)) as image:
        return np.array(image.convert("RGB"))


def video_pixels(raw: bytes) -> Iterator[np.ndarray]:
    """Frames of a YUV4MPEG2 file (4:2:0, 4:4:4 or grey), one after another."""
    line = raw[: raw.index(b"\n")].split()
    if line[0] != b"YUV4MPEG2":
        raise ValueError("no decoder for this kind of video")
    tags = {t[:1]: t[1:] for t in line[1:]}
    width, height, way = int(tags[b"W"]), int(tags[b"H"]), tags.get(b"C", b"420")
    half = way.startswith(b"420")
    w, h = (-(-width // 2), -(-height // 2)) if half else (width, height)
    size, at = width * height + (0 if way.startswith(b"mono") else 2 * w * h), raw.index(b"\n") + 1
    while at < len(raw):
        at = raw.index(b"\n", at) + 1
        body = np.frombuffer(raw[at : at + size], np.uint8).astype(float)
        if len(body) < size:
            raise ValueError("a frame is cut off")
        y, at = body[: width * height].reshape(height, width), at + size
        if len(body) == width * height:
            yield np.repeat(y[..., None], 3, 2).astype(np.uint8)
            continue
        u, v = (p.reshape(h, w) - 128 for p in (body[width * height : width * height + w * h], body[width * height + w * h :]))
        if half:
            u, v = (np.repeat(np.repeat(p, 2, 0), 2, 1)[:height, :width] for p in (u, v))
        yield np.clip(np.rint(np.stack([y + 1.402 * v, y - 0.344136 * u - 0.714136 * v, y + 1.772 * u], -1)), 0, 255).astype(np.uint8)


def opened(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of the files of a folder; contents travel to Python in batches of some megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "content")


FRAMES = "path string, frame int, height int, width int, pixels binary, reason string"


def decoded(files: DataFrame, frames_of: Callable[[bytes], Iterator[np.ndarray]], longest: int = LONGEST) -> DataFrame:
    """Rows (FRAMES) of files (path, length, content): frames from 0 on with the long side at most ``longest``, or a row with the reason there are none.

    A file that breaks off gives the frames before, then the reason; a null content has a reason (empty files are no rows of the source), and so has one of over ``FILE_BYTES``.
    """

    def rows(path: str, length: int, content: pa.Scalar) -> Iterator[tuple]:
        n = 0
        try:
            if not length or content.as_buffer() is None:
                raise ValueError("empty")
            if length > FILE_BYTES:
                raise ValueError(f"over {FILE_BYTES} bytes")
            for frame in frames_of(content.as_py()):
                small = np.ascontiguousarray(resized(frame, longest))
                yield path, n, *small.shape[:2], small.tobytes(), None
                n += 1
        except Exception as fault:  # any fault of a file
            yield path, None, None, None, None, f"{type(fault).__name__}: {fault}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("frame", pa.int32()), ("height", pa.int32()), ("width", pa.int32()), ("pixels", pa.binary()),
            ("reason", pa.string())])
        for b in batches:
            for i in range(b.num_rows):
                for row in rows(b.column("path")[i].as_py(), b.column("length")[i].as_py(), b.column("content")[i]):
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True))], schema)

    return files.select("path", "length", "content").mapInArrow(run, FRAMES)


def images(files: DataFrame, longest: int = LONGEST) -> DataFrame:
    """One row (FRAMES) for each image file."""
    return decoded(files, lambda raw: iter([image_pixels(raw)]), longest)


def videos(files: DataFrame, longest: int = LONGEST) -> DataFrame:
    """A row (FRAMES) for each frame of each video file."""
    return decoded(files, video_pixels, longest)


def validity(files: DataFrame) -> DataFrame:
    """(path, valid, reason) of image files, by decoding them."""
    return images(files).select("path", F.col("reason").isNull().alias("valid"), "reason")


def histograms(frames: DataFrame, bins: int = BINS) -> DataFrame:
    """(path, frames, vector): the mean of all channel histograms of a file's frames, of norm 1. Tasks send counts, not pixels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, pixels in zip(b.column("path"), b.column("pixels"), strict=True):
                x = np.frombuffer(pixels.as_buffer(), np.uint8).reshape(-1, 3)
                each = np.concatenate([np.histogram(x[:, k], bins, (0, 256), density=True)[0] for k in range(3)])
                yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([each.tolist()])], ["path", "h"])

    each = frames.where("pixels is not null").select("path", "pixels").mapInArrow(run, "path string, h array<double>")
    sums = each.groupBy("path").agg(F.count("*").cast("int").alias("frames"), F.array(*(F.sum(F.col("h")[k]) for k in range(3 * bins))).alias("s"))
    norm = F.sqrt(F.aggregate("s", F.lit(0.0), lambda a, x: a + x * x))
    return sums.select("path", "frames", F.transform("s", lambda x: x / F.greatest(norm, F.lit(1e-12))).alias("vector"))


def video_key_frames(files: DataFrame, threshold: float = 0.15, most: int = 8, least: int = 1) -> DataFrame:
    """(path, frame, score) of the key frames of video files.

    The first frame (score 1), and of those that change by more than ``threshold`` the ``most`` - 1 largest; a video with fewer than ``least``
    such frames gives ``least`` at even steps instead. Frames are compared where they are decoded: scores travel, pixels do not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                path, scores, last = b.column("path")[i].as_py(), [], None
                try:
                    for frame in video_pixels(b.column("content")[i].as_py() or b""):
                        scores.append(1.0 if last is None else luma_change(last, frame))
                        last = frame
                except Exception:  # a file that breaks off has the frames before; ``videos`` gives the reason
                    pass
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(scores), pa.string()), pa.array(range(len(scores)), pa.int32()),
                    pa.array(scores, pa.float64())], ["path", "frame", "score"])

    scored = files.where(F.col("length") <= FILE_BYTES).select("path", "content").mapInArrow(run, "path string, frame int, score double")
    file, changes = W.partitionBy("path"), (F.col("frame") == 0) | (F.col("score") > threshold)
    nth = F.row_number().over(file.orderBy(F.col("frame") != 0, F.desc("score"), F.asc("frame")))
    x = scored.withColumns({"nth": nth, "changes": changes, "n": F.count_if(changes).over(file), "all": F.count("*").over(file)})
    step = F.greatest(F.lit(1), F.floor(F.col("all") / least))
    even = (F.col("frame") % step == 0) & (F.col("frame") / step < least)
    return x.where(F.when(F.least(F.col("n"), F.lit(most)) < least, even).otherwise(F.col("changes") & (F.col("nth") <= most))).select("path", "frame",
        "score")


def grid_score(similarity: Column, compression: Column) -> Column:
    """What a setting of the grid is worth: similarity with a bonus for compression, halved where too much is lost."""
    s = similarity * (1 + 0.2 * F.ln(1 + compression))
    return F.when(similarity < 0.85, s / 2).otherwise(s)
