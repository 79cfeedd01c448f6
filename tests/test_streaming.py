import pytest
from pyspark.sql import functions as F

from engagelake import bindings as b
from engagelake.plans import stateful
from engagelake.sources.tables import VersionedTable
from engagelake.streaming import processors


def run(spark, df, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def streamed(spark, df, folder, files=3):
    """``df`` (with ts) as a stream of files, in order of time."""
    cuts = [r[0] for r in df.selectExpr(f"percentile_approx(event_id, array({','.join(str(i / files) for i in range(1, files))}))").collect()][0]
    for i, (lo, hi) in enumerate(zip([-1, *cuts], [*cuts, 1 << 60], strict=True)):
        df.where((F.col("event_id") > lo) & (F.col("event_id") <= hi)).coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


def test_breakers_equal_batch(spark, sf_dir, tmp_path):
    calls = b.calls(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    got = run(spark, processors.breakers(streamed(spark, calls, str(tmp_path / "c"))), "breakers")
    want = stateful.breaker_cooldowns(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("event_id", "hits", "cooldown").collect()))


def test_alerts_equal_batch(spark, sf_dir, tmp_path):
    checks = stateful.alert_cycles(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")).withColumn("event_id", F.unix_seconds("ts"))
    last = spark.createDataFrame([("end", "none")], "key string, severity string").select("key", F.lit(b.EVENTS_AS_OF).cast("timestamp").alias("ts"),
        "severity", F.lit(1 << 50).alias("event_id"))  # the watermark goes on
    stream = streamed(spark, checks.unionByName(last), str(tmp_path / "a"), files=4).drop("event_id")
    got = run(spark, processors.alerts(stream, repeat_seconds=3 * 3600), "alerts").where("key <> 'end'")
    want = stateful.alert_dedup(spark, sf_dir).withColumn("at", F.col("at").cast("timestamp")).select("key", "at", "kind", "severity")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and {r.kind for r in got.collect()} == {"alert", "recovery"}


def test_alerts_repeat_from_the_last_message(spark, tmp_path):
    """An alarm in every check of a day is sent every three hours, not once."""
    hours = spark.range(24).select(F.lit("k").alias("key"), F.lit("warning").alias("severity"),
        F.timestamp_seconds(F.col("id") * 3600 + 1_700_000_000).alias("ts"), F.col("id").alias("event_id"))
    got = run(spark, processors.alerts(streamed(spark, hours, str(tmp_path / "h")), repeat_seconds=3 * 3600), "hourly")
    assert [r.kind for r in got.collect()].count("alert") == 8


def test_trailing_counts(spark, sf_dir, tmp_path):
    calls = b.calls(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    got = run(spark, processors.trailing_counts(streamed(spark, calls, str(tmp_path / "t"))), "trailing")
    want = calls.groupBy(F.window("ts", "24 hours", "6 hours")).agg(F.count("*").alias("calls"))
    closed = {r.window.start: r.calls for r in got.collect()}
    assert closed and all({r.window.start: r.calls for r in want.collect()}[k] == n for k, n in closed.items())


def test_ingest_merges_once(spark, sf_dir, tmp_path):
    posts = b.posts(spark, sf_dir).withColumn("event_id", F.col("post_id")).select("event_id", "group_id", "published", "kind")
    table = VersionedTable(spark, str(tmp_path / "table"), ["key"], buckets=4)
    folder, policy = str(tmp_path / "p"), {"kind": "take", "published": "greatest"}
    stream = streamed(spark, posts.withColumn("key", F.col("group_id") % 50), folder)
    go = lambda: processors.ingest(stream, table, ["key"], [F.desc("published"), F.desc("event_id")], policy, str(tmp_path / "ck"))
    go()
    first = sorted(map(str, table.read().collect()))
    assert table.read().count() == 50 and table.mark() is not None
    go()
    assert sorted(map(str, table.read().collect())) == first
    newest = {r[0]: r[1] for r in posts.groupBy(F.col("group_id") % 50).agg(F.max("published")).collect()}
    assert {r.key: r.published for r in table.read().collect()} == newest


class Broken(Exception):
    pass


def test_a_crash_between_steps_loses_nothing(spark, tmp_path, monkeypatch):
    """Whatever step of a write breaks off, the table is the one before, and the next write succeeds."""
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], buckets=3)
    rows = lambda lo, hi, v: spark.createDataFrame([(i, v) for i in range(lo, hi)], "k long, v string")
    table.write(rows(0, 9, "a"), mark=0)
    before = sorted(table.read().collect())
    for step in ("_add", "_publish"):
        with monkeypatch.context() as m:
            old = getattr(VersionedTable, step)

            def broken(self, *x, old=old, step=step, **y):
                if step == "_add":
                    old(self, *x, **y)
                raise Broken

            m.setattr(VersionedTable, step, broken)
            with pytest.raises(Broken):
                table.upsert(rows(5, 12, "b"), {"v": "take"}, mark=1)
        assert sorted(table.read().collect()) == before and table.mark() == 0
    (tmp_path / "t" / "_manifests" / "000000000009").write_text('{"folders": {"0"')  # a manifest that broke off
    assert sorted(table.read().collect()) == before
    table.upsert(rows(5, 12, "b"), {"v": "take"}, mark=1)
    assert {r.k: r.v for r in table.read().collect()} == {i: "a" if i < 5 else "b" for i in range(12)} and table.mark() == 1
    assert table._manifest()["number"] == 10
    monkeypatch.setattr(VersionedTable, "_numbers", lambda self: [8])
    with pytest.raises(FileExistsError):  # another writer has the number
        table._publish({}, table._rows({"schema": rows(0, 1, "a").schema.jsonValue(), "folders": {}}).schema, 2)
        table._publish({}, rows(0, 1, "a").schema, 2)


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], buckets=8)
    table.write(spark.range(200).selectExpr("id as k", "'a' as v"))
    first = table._manifest()["folders"]
    table.upsert(spark.createDataFrame([(3, "b")], "k long, v string"), {"v": "take"})
    second = table._manifest()["folders"]
    assert sum(first[k] != second[k] for k in first) == 1 and table.read().count() == 200 and table.read().where("k = 3").first().v == "b"
    table.write(spark.range(0).selectExpr("id as k", "'a' as v"))
    assert table.read().count() == 0
    table.vacuum(keep=1)
    assert table.read().count() == 0 and len(list((tmp_path / "t" / "_manifests").glob("0*"))) == 1
