import datetime

import pandas as pd
from pyspark.sql import functions as F

from engagelake.streaming import outbox


def test_a_sink_that_fails_twice(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(source)
    faults = ["first", "second"]

    def sink(rows, number):
        if faults:
            raise OSError(faults.pop(0))
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    box = outbox.Outbox(spark, str(tmp_path / "box"), sink)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
    box.run(stream, str(tmp_path / "c"))  # the query does not end in an error
    assert box.failures() == [(0, "OSError: first"), (0, "OSError: second")] and box.pending() == []
    got = spark.read.parquet(out)
    assert sorted(r.id for r in got.collect()) == list(range(30)) and got.select("batch").distinct().count() == 3


def test_what_fails_stays_in_order(spark, tmp_path):
    down, seen = [True], []

    def sink(rows, number):
        if down[0] and number >= 1:
            raise RuntimeError("down")
        seen.append((number, rows.count()))

    box = outbox.Outbox(spark, str(tmp_path / "box"), sink)
    for n in range(3):
        box.take(spark.range(n + 1), n)
    box.take(spark.range(99), 1)  # a batch that is run again is the same batch
    assert seen == [(0, 1)] and box.pending() == [1, 2] and [n for n, _ in box.failures()] == [1, 1, 1]
    down[0] = False
    assert box.flush() == 2 and seen == [(0, 1), (1, 2), (2, 3)] and box.flush() == 0


def at(hour):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hour)


def test_alerts_stay_pending_until_they_are_sent(spark, tmp_path):
    down = tmp_path / "down"  # tasks look whether delivery works

    def send(messages: pd.DataFrame) -> list[bool]:
        return [not down.exists() or k == "always" for k in messages["key"]]

    box = outbox.Alerts(spark, str(tmp_path / "alerts"), send, repeat_seconds=6 * 3600)
    schema = "key string, severity string, at timestamp"

    def check(n, hour, *issues):
        box.check(spark.createDataFrame([(*i, at(hour)) for i in issues] or [(None, None, at(hour))], schema), n)
        return sorted((r.key, r.kind, r.delivered) for r in box.tried(n).collect()) if n in box.checks() else None

    down.touch()
    assert check(0, 0, ("disk", "critical"), ("always", "warning")) == [("always", "alert", True), ("disk", "alert", False)]
    assert {r.key: r.pending for r in box.state().collect()} == {"disk": True, "always": False}
    assert check(1, 1, ("disk", "critical"), ("always", "warning")) == [("disk", "alert", False)]
    down.unlink()
    assert check(2, 2, ("disk", "critical"), ("always", "warning")) == [("disk", "alert", True)]
    assert check(3, 3, ("disk", "critical"), ("always", "warning")) == []
    assert check(4, 6, ("disk", "critical"), ("always", "warning")) == [("always", "alert", True)]  # six hours after it was sent
    assert check(5, 7, ("disk", "warning"), ("always", "warning")) == [("disk", "alert", True)]  # another severity
    down.touch()
    assert check(6, 8, ("always", "warning")) == [("disk", "recovery", False)]
    assert check(7, 9, ("always", "warning"), ("new", "warning")) == [("disk", "recovery", False), ("new", "alert", False)]
    down.unlink()
    assert check(8, 10) == [("always", "recovery", True), ("disk", "recovery", True)]  # what was never sent does not recover
    assert box.state().count() == 0
    check(8, 11, ("again", "warning"))
    assert box.state().count() == 0  # a check that is run again changes nothing
    first = {r.key: r.first_seen for r in spark.read.parquet(str(tmp_path / "alerts/4")).collect()}
    assert first["disk"] == at(0)


def test_alerts_of_a_stream(spark, tmp_path):
    source, box = str(tmp_path / "in"), outbox.Alerts(spark, str(tmp_path / "alerts"), lambda m: [True] * len(m))
    for i, keys in enumerate((["a"], ["a", "b"], ["b"])):
        spark.createDataFrame([(k, "warning", at(i)) for k in keys], "key string, severity string, at timestamp").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("key string, severity string, at timestamp").option("maxFilesPerTrigger", 1).parquet(source)
    box.run(stream, str(tmp_path / "c"))
    tried = [sorted((r.key, r.kind) for r in box.tried(n).collect()) for n in box.checks()]
    assert tried == [[("a", "alert")], [("b", "alert")], [("a", "recovery")]]
    assert box.state().select(F.count("*")).first()[0] == 1
