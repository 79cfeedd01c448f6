import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from engagelake.operators import encoding, media


def png(x: np.ndarray, ways=(0,), colour=2, palette=None) -> bytes:
    """A PNG file; row k is filtered in the way ways[k % len(ways)]."""
    h, w, c = x.shape
    lines, above = b"", np.zeros((w, c), int)
    for k, row in enumerate(x.astype(int)):
        left, way = np.concatenate([np.zeros((1, c), int), row[:-1]]), ways[k % len(ways)]
        corner = np.concatenate([np.zeros((1, c), int), above[:-1]])
        p = left + above - corner
        a, b, d = abs(p - left), abs(p - above), abs(p - corner)
        guess = [0, left, above, (left + above) // 2, np.where((a <= b) & (a <= d), left, np.where(b <= d, above, corner))][way]
        lines += bytes([way]) + ((row - guess) & 255).astype(np.uint8).tobytes()
        above = row
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    extra = chunk(b"PLTE", palette.astype(np.uint8).tobytes()) if palette is not None else b""
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + extra + chunk(b"IDAT",
        zlib.compress(lines)) + chunk(b"IEND", b"")


def grey_video(levels, w=6, h=4) -> bytes:
    return f"YUV4MPEG2 W{w} H{h} F25:1 Cmono\n".encode() + b"".join(b"FRAME\n" + bytes([v]) * (w * h) for v in levels)


@pytest.fixture
def folder(tmp_path):
    r = np.random.default_rng(1)
    x = r.integers(0, 256, (7, 9, 3), np.uint8)
    (tmp_path / "a.png").write_bytes(png(x, (0, 1, 2, 3, 4)))
    (tmp_path / "grey.png").write_bytes(png(x[..., :1], (4, 3), 0))
    (tmp_path / "alpha.png").write_bytes(png(np.concatenate([x, x[..., :1]], 2), (2, 4), 6))
    (tmp_path / "palette.png").write_bytes(png(x[..., :1] % 4, (1,), 3, np.arange(12).reshape(4, 3)))
    (tmp_path / "b.ppm").write_bytes(b"P6\n# made\n1000 10\n255\n" + r.integers(0, 256, (10, 1000, 3), np.uint8).tobytes())
    (tmp_path / "cut.png").write_bytes(png(x)[:-30])
    (tmp_path / "none.png").write_bytes(b"")
    (tmp_path / "text.png").write_bytes(b"no picture at all")
    return tmp_path, x


def test_images_of_a_folder(spark, folder):
    path, x = folder
    got = {r.path.split("/")[-1]: r for r in media.images(media.opened(spark, str(path))).collect()}
    pixels = {n: np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width, 3) for n, r in got.items() if r.reason is None}
    assert set(pixels) == {"a.png", "grey.png", "alpha.png", "palette.png", "b.ppm"} and len(got) == 7 and "none.png" not in got
    assert (pixels["a.png"] == x).all() and (pixels["alpha.png"] == x).all() and (pixels["grey.png"] == x[..., :1]).all()
    assert (pixels["palette.png"] == np.arange(12).reshape(4, 3)[x[..., 0] % 4]).all() and pixels["b.ppm"].shape == (4, 448, 3)
    assert "cut off" in got["cut.png"].reason and "no decoder" in got["text.png"].reason
    nothing = spark.createDataFrame([("x", None, None)], "path string, length long, content binary")
    assert media.images(nothing).first().reason == "ValueError: empty"
    valid = {r.path.split("/")[-1]: r.valid for r in media.validity(media.opened(spark, str(path))).collect()}
    assert valid == {n: n in pixels for n in got}
    vectors = {r.path.split("/")[-1]: r.vector for r in media.histograms(media.images(media.opened(spark, str(path)))).collect()}
    assert set(vectors) == set(pixels) and all(np.allclose(v, media.histogram_embedding([pixels[n]])) for n, v in vectors.items())


def test_videos_of_a_folder(spark, tmp_path):
    levels = [0, 0, 100, 100, 250, 250, 180, 180, 90]
    (tmp_path / "v.y4m").write_bytes(grey_video(levels))
    (tmp_path / "still.y4m").write_bytes(grey_video([5] * 12))
    (tmp_path / "cut.y4m").write_bytes(grey_video([0, 200, 0])[:-5])
    (tmp_path / "bad.y4m").write_bytes(b"no video\n")
    yuv = b"YUV4MPEG2 W3 H3 C420jpeg\nFRAME\n" + bytes([76] * 9 + [85] * 4 + [255] * 4)  # red
    (tmp_path / "red.y4m").write_bytes(yuv)
    files = media.opened(spark, str(tmp_path))
    frames = media.videos(files)
    counts = {r.path.split("/")[-1]: (r.n, r.reason) for r in frames.groupBy("path").agg(F.count("pixels").alias("n"), F.max("reason").alias("reason")).collect()}
    assert {k: v[0] for k, v in counts.items()} == {"v.y4m": 9, "still.y4m": 12, "cut.y4m": 2, "bad.y4m": 0, "red.y4m": 1}
    assert counts["cut.y4m"][1] and counts["bad.y4m"][1] and not counts["v.y4m"][1]
    red = np.frombuffer(frames.where("path like '%red%'").first().pixels, np.uint8).reshape(-1, 3)
    assert (abs(red.astype(int) - [254, 0, 0]) <= 2).all()

    def keys(**settings):
        out = {}
        for r in media.video_key_frames(files, **settings).orderBy("path", "frame").collect():
            out.setdefault(r.path.split("/")[-1], []).append((r.frame, round(r.score, 4)))
        return out

    score = [1.0] + [round(abs(b - a) / 255, 4) for a, b in zip(levels, levels[1:], strict=False)]
    assert keys()["v.y4m"] == [(k, score[k]) for k in (0, 2, 4, 6, 8)]
    assert [k for k, _ in keys(most=3)["v.y4m"]] == [0, 2, 4]
    assert [k for k, _ in keys(least=4)["still.y4m"]] == [0, 3, 6, 9] and keys()["still.y4m"] == [(0, 1.0)]
    assert keys()["cut.y4m"] == [(0, 1.0), (1, round(200 / 255, 4))] and "bad.y4m" not in keys()


def test_a_dataset_is_decoded(spark, folder):
    path, x = folder
    (path / "photo_5_7_0.jpg").write_bytes(png(x))
    (path / "photo_5_8_1.jpg").write_bytes(png(x)[:40])
    (path / "video_5_9_0.mp4").write_bytes(grey_video([0, 0, 200]))
    attachments = spark.createDataFrame([(1, 0, "photo", 5, 7), (1, 1, "photo", 5, 8), (2, 0, "video", 5, 9), (3, 4, "photo", 5, 7)],
        "post_id long, position int, type string, owner long, number long")
    attachments = attachments.withColumn("position", F.when(F.col("post_id") == 3, 0).otherwise(F.col("position")))
    posts = spark.createDataFrame([(1,), (2,), (3,), (4,)], "post_id long")
    got = encoding.decoded_dataset(posts, attachments, encoding.cached_media(spark, str(path)), media.opened(spark, str(path))).collect()
    assert sorted((r.post_id, r.kind, r.position, r.frame) for r in got) == [(1, "photo", 0, 0), (2, "video", 0, 0), (2, "video", 0, 2), (3, "photo", 0, 0)]
    assert all(bytes(r.pixels) == x.tobytes() for r in got if r.kind == "photo")
