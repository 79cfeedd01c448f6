import pytest
from pyspark.sql import functions as F

from engagelake import bindings as b
from engagelake.plans import exports, planning, stateful
from engagelake.streaming import ordered


@pytest.fixture(scope="module")
def shuffled(spark, sf_dir, tmp_path_factory):
    """Calls as a stream of four files: each has rows of every day, up to a day late; a last row of all keys moves the watermark on."""
    ordered.use_rocksdb(spark)
    calls = b.calls(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    folder = tmp_path_factory.mktemp("calls")
    late = F.unix_seconds("ts") + F.pmod(F.xxhash64("event_id"), F.lit(86_000))  # when a call arrives
    cuts = [r[0] for r in calls.select(F.percentile_approx(late, [0.25, 0.5, 0.75])).collect()][0]
    for i, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, 1 << 60], strict=True)):
        calls.where((late > lo) & (late <= hi)).orderBy(F.rand(3)).coalesce(1).write.parquet(f"{folder}/{i}")
    for i in (4, 5):  # the watermark follows a micro-batch later
        calls.limit(1).select("event_id", F.lit(-1).cast("long").alias("token"), "method", F.lit(f"203{i}-01-01").cast("timestamp").alias("ts"),
            F.lit(0).alias("code"), "k").select(*calls.columns).coalesce(1).write.parquet(f"{folder}/{i}")
    return spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def rows(spark, stream, name):
    query = stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 6
    return sorted(tuple(r) for r in spark.table(name).collect())


def test_slots_of_calls_out_of_order(spark, sf_dir, shuffled):
    want = planning.token_slots(spark, sf_dir).select("event_id", "slot", "wait")
    assert [r for r in rows(spark, ordered.token_slots(shuffled), "slots") if r[1] < 1_800_000_000] == sorted(map(tuple, want.collect()))


def test_probes_out_of_order(spark, sf_dir, shuffled):
    want = exports.probes(spark, sf_dir).select("limit_id", "probe_id", "outcome")
    assert rows(spark, ordered.probes(shuffled), "probes") == sorted(map(tuple, want.collect()))


def test_limited_methods_out_of_order(spark, sf_dir, shuffled):
    want = stateful.trailing_distinct_methods(spark, sf_dir).select("event_id", "methods", "escalates")
    assert rows(spark, ordered.limited_methods(shuffled), "limited") == sorted(map(tuple, want.collect()))
