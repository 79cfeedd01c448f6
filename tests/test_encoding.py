import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from engagelake.operators import embeddings, encoding

JPEG = b"\xff\xd8\xff\xe0 picture \xff\xd9"
PNG = b"\x89PNG\r\n\x1a\n picture IEND\xaeB`\x82"


@pytest.fixture
def posts(spark):
    return spark.createDataFrame([(i, f"text {i}" if i % 10 else f"bad {i}") for i in range(1, 101)], "post_id long, text string")


def test_a_bad_row_costs_no_other(posts):
    got = encoding.encoded(posts.coalesce(1), encoding.Seeded(8, fails="bad"), "post_id", size=16).collect()
    assert len(got) == 100 and {r.post_id for r in got if r.vector is None} == {i for i in range(1, 101) if i % 10 == 0}
    assert all(abs(np.linalg.norm(r.vector) - 1) < 1e-9 for r in got if r.vector) and {(r.stage,
        r.error_type) for r in got if r.vector is None} == {("encode_batch", "ValueError")}
    whole = encoding.Seeded(8).encode(pd.DataFrame({"text": [f"text {i}" for i in (1, 2)]}))
    assert np.allclose([r.vector for r in sorted(got)[:2]], whole)


def test_a_run_resumes(posts, tmp_path):
    path = str(tmp_path / "run")
    first, failed = encoding.run_encoder(posts.where("post_id <= 40"), encoding.Seeded(8, fails="bad"), "post_id", path)
    assert first.count() == 36 and {r.post_id for r in failed.collect()} == {10, 20, 30, 40}

    everything, failed = encoding.run_encoder(posts, encoding.Seeded(8), "post_id", path)
    assert everything.count() == 100 and everything.select("post_id").distinct().count() == 100 and failed.count() == 0
    third, _ = encoding.run_encoder(posts, encoding.Seeded(8, fails="text"), "post_id", path)  # nothing is left to do
    assert third.count() == 100


def test_a_killed_run_keeps_its_chunks(spark, posts, tmp_path):
    class Breaks(encoding.Seeded):
        """Its task dies at one text, as if the machine had gone."""

        def encode(self, batch):
            if batch["text"].str.fullmatch("text 61").any():
                raise SystemExit("gone")
            return super().encode(batch)

    path, whole = str(tmp_path / "run"), str(tmp_path / "whole")
    ordered = posts.orderBy("post_id").coalesce(1)
    with pytest.raises(Exception):  # noqa: B017  whatever Spark says when a task is lost
        encoding.run_encoder(ordered, Breaks(8, fails="bad"), "post_id", path, chunk_rows=10, together=1)
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "run/rows").rglob("part-*") if "_temporary" not in str(p)}
    done = {r.post_id for r in spark.read.parquet(*{str(p.parent) for p in kept}).collect()}
    assert 0 < len(done) < 100 and len(done) % 10 == 0

    seen = []

    class Counts(encoding.Seeded):
        def encode(self, batch):
            (tmp_path / "seen" / f"{batch['post_id'].min()}-{len(batch)}").write_text(",".join(map(str, batch["post_id"])))
            return super().encode(batch)

    (tmp_path / "seen").mkdir()
    vectors, _ = encoding.run_encoder(ordered, Counts(8), "post_id", path, chunk_rows=10, together=1)
    seen = {int(x) for p in (tmp_path / "seen").iterdir() for x in p.read_text().split(",")}
    assert seen == {i for i in range(1, 101)} - {i for i in done if i % 10}  # the rest, and the failures of the broken run
    assert all(p.stat().st_mtime_ns == t for p, t in kept.items())
    unbroken, _ = encoding.run_encoder(ordered, encoding.Seeded(8), "post_id", whole, chunk_rows=10)
    assert sorted(map(tuple, vectors.collect())) == sorted(map(tuple, unbroken.collect())) and vectors.count() == 100


def test_a_chunk_written_twice_is_there_once(spark, posts, tmp_path):
    """A run that dies between a chunk's rows and its commit writes the chunk again."""
    import shutil

    path = str(tmp_path / "run")
    encoding.run_encoder(posts.coalesce(1), encoding.Seeded(8), "post_id", path, chunk_rows=20, together=1)
    commits = sorted((tmp_path / "run/runs/0/progress/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last = commits[-1].name
    for p in (tmp_path / "run/runs/0/progress/commits").glob(f"*{last}*"):
        p.unlink()
    (tmp_path / "run/runs/0/finished").unlink()
    vectors, _ = encoding.run_encoder(posts, encoding.Seeded(8), "post_id", path)
    assert vectors.count() == 100 == vectors.select("post_id").distinct().count()
    shutil.rmtree(tmp_path / "run")


def test_of_several_writers_one_wins(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from engagelake.sources import files

    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: files.put_new(spark, f"{tmp_path}/a/one", str(i)), range(8)))
    assert sum(won) == 1 and files.text_of(spark, f"{tmp_path}/a/one") == str(won.index(True)) and files.names(spark, f"{tmp_path}/a") == ["one"]
    assert files.names(spark, f"{tmp_path}/none") == []


def test_benchmark(posts):
    good, bad = encoding.benchmark(posts, [encoding.Seeded(8), encoding.Seeded(4, fails="text 7")], "post_id")
    assert good["status"] == "success" and good["rows"] == 100 and good["worst_norm"] < 1e-9 and good["quota_respected"] and good["rows_a_second"] > 0
    assert bad == {"model": "seeded-4", "dim": 4, "status": "failed", "error": "cannot encode text 7"}


def test_media(spark, posts, tmp_path):
    for name, raw in (("photo_5_7_0.jpg", JPEG), ("photo_5_8_1.png", PNG), ("video_5_9_0.mp4", b"v"), ("photo_5_10_0.jpg", b""),
        ("photo_5_11_2.jpg", b"no picture")):
        (tmp_path / name).write_bytes(raw)
    cache = encoding.cached_media(spark, str(tmp_path))
    assert {(r.key, r.ending) for r in cache.collect()} == {("photo_5_7_0", "jpg"), ("photo_5_8_1", "png"), ("video_5_9_0", "mp4"),
        ("photo_5_11_2", "jpg")}
    attachments = spark.createDataFrame([(1, 0, "photo", 5, 7), (1, 1, "photo", 5, 8), (2, 0, "video", 5, 9), (2, 2, "photo", 5, 11),
        (3, 0, "photo", 5, 10), (3, 1, "audio", 5, 7)], "post_id long, position int, type string, owner long, number long")
    found = {(r.post_id, r.position): r.path and r.path.split("/")[-1] for r in encoding.resolved(attachments, cache).collect()}
    assert found == {(1, 0): "photo_5_7_0.jpg", (1, 1): None, (2, 0): "video_5_9_0.mp4", (2, 2): "photo_5_11_2.jpg", (3, 0): None, (3, 1): None}
    data = {r.post_id: (len(r.images), len(r.videos)) for r in encoding.dataset(posts.where("post_id < 5"), attachments, cache).collect()}
    assert data == {1: (1, 0), 2: (1, 1), 3: (0, 0), 4: (0, 0)}
    kinds = spark.read.format("binaryFile").load(str(tmp_path)).select(F.element_at(F.split("path", "/"), -1).alias("name"),
        encoding.image_kind(F.col("content")).alias("kind"))
    assert {r.name: r.kind for r in kinds.collect() if r.kind} == {"photo_5_7_0.jpg": "jpeg", "photo_5_8_1.png": "png"}


def test_provenance(posts):
    one = encoding.provenance(posts, "post_id", seed=42, mode="dev").first()
    assert (one["rows"], one["first"], one["last"], one["settings"]) == (100, 1, 100, '{"mode":"dev","seed":42}')
    assert encoding.provenance(posts.repartition(7), "post_id").first().content == one.content != encoding.provenance(posts.where("post_id > 1"),
        "post_id").first().content


def test_plane_of_components(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(120, 5)) * [5, 3, 1, 0.5, 0.1]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = np.array([(p.c1, p.c2) for p in embeddings.projection(df, "vec_id").orderBy("vec_id").collect()])
    u, s, v = np.linalg.svd(x - x.mean(0), full_matrices=False)
    v = v[:2] * np.sign(v[:2][np.arange(2), np.abs(v[:2]).argmax(1)])[:, None]
    assert np.abs(got - (x - x.mean(0)) @ v.T).max() < 1e-4
