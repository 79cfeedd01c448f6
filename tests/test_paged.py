import json

import pytest
from pyspark.sql import functions as F

from engagelake.sources import files, paged


def land_wall(spark, path, target, rows, size, total=None, upto=None):
    """Lands the pages of a wall of ``rows`` items, as a collector asks for them."""
    offset = 0
    while upto is None or offset < upto:
        items = [{"id": i, "text": f"{target} é {i}"} for i in range(offset, min(rows, offset + size))]
        paged.land(spark, path, target, offset, size, rows if total is None else total, items)
        offset += len(items)
        if len(items) < size or offset >= (rows if total is None else total):
            break


def ids(df):
    return sorted((r.target, json.loads(r.item)["id"]) for r in df.collect())


def test_stop_rules(spark, tmp_path):
    path = str(tmp_path / "p")
    assert paged.read(spark, path).count() == 0
    land_wall(spark, path, "short", 7, 3)
    land_wall(spark, path, "total", 6, 3)
    land_wall(spark, path, "empty", 0, 3, total=5)
    land_wall(spark, path, "long", 12, 3)
    paged.land(spark, path, "short", 7, 3, 9, [{"id": 99}])  # after a short page nothing is read
    paged.land(spark, path, "gap", 0, 2, 9, [{"id": 0}, {"id": 1}])
    paged.land(spark, path, "gap", 4, 2, 9, [{"id": 4}, {"id": 5}])  # the page between has not landed
    want = [("gap", i) for i in range(2)] + [("long", i) for i in range(12)] + [("short", i) for i in range(7)] + [("total", i) for i in range(6)]
    assert ids(paged.read(spark, path)) == want
    assert ids(paged.read(spark, path, maximum=5)) == [(t, i) for t, i in want if i < 5]
    pages = spark.createDataFrame([(t, o, a, n, total) for t, ps in paged.Store({"path": path}).landed().items() for o, (a, n, total, _) in ps.items()],
        "target string, offset long, asked long, items long, total long")
    for maximum in (1 << 60, 5):
        got = paged.walked(pages, maximum)
        rows = {r.target: r.n for r in got.groupBy("target").agg(F.sum(F.least(F.col("items"), F.lit(maximum) - F.col("offset"))).alias("n")).collect() if r.n}
        read = {r.target: r["count"] for r in paged.read(spark, path, maximum).groupBy("target").count().collect()}
        assert rows == read
    assert {r.target: r.reason for r in paged.walked(pages).where("last").collect()} == {"short": "short", "total": "total", "empty": "empty", "long": "total"}


def test_a_walk_goes_on_after_a_restart(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / x) for x in ("p", "out", "c"))

    def run(maximum=None):
        q = paged.stream(spark, path, maximum).writeStream.format("parquet").option("path", out).option("checkpointLocation",
            checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        return ids(spark.read.schema(paged.SCHEMA).parquet(out))

    files.put_new(spark, f"{path}/.keep", "")
    land_wall(spark, path, "a", 10, 3, upto=6)
    land_wall(spark, path, "b", 4, 4, upto=4)
    first = run()
    assert first == [("a", i) for i in range(6)] + [("b", i) for i in range(4)]
    assert run() == first  # nothing has landed
    land_wall(spark, path, "a", 10, 3, upto=9)
    paged.land(spark, path, "b", 4, 4, 8, [{"id": 4}])  # the walk of b was over
    land_wall(spark, path, "c", 2, 3)
    second = [("a", i) for i in range(9)] + first[6:] + [("c", i) for i in range(2)]
    assert run() == second
    land_wall(spark, path, "a", 10, 3)
    assert run() == sorted([*second, ("a", 9)]) and run() == sorted([*second, ("a", 9)])


def test_too_many_targets_fail(spark, tmp_path):
    for t in ("a", "b", "c"):
        paged.land(spark, str(tmp_path), t, 0, 2, 1, [{"id": 0}])
    with pytest.raises(ValueError, match="2 at most"):
        paged.Store({"path": str(tmp_path), "most_targets": "2"}).landed()
