"""Delivery that can fail: an outbox of rows for a sink, and alerts that stay pending until they are sent.

Both keep their state as folders written whole, one for each micro-batch, and take no lock: a batch that is run again finds its folder and changes
nothing. A crash between a delivery and its mark delivers once more (at least once).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files

log = logging.getLogger(__name__)


class Outbox:
    """Rows of micro-batches, held in ``path`` until ``sink`` has taken them.

    Each batch is written to the outbox first, then everything that is pending is offered to the sink in order of batches; where the sink fails, the
    fault is logged and noted beside the batch, the batch stays pending with all later ones, and the query goes on.
    """

    def __init__(self, spark: SparkSession, path: str, sink: Callable[[DataFrame, int], None]):
        self.spark, self.path, self.sink = spark, path, sink

    def batches(self, folder: str) -> list[int]:
        return sorted(int(n.split("-")[0]) for n in files.names(self.spark, f"{self.path}/{folder}") if n[0].isdigit())

    def pending(self) -> list[int]:
        done = set(self.batches("delivered"))
        return [n for n in self.batches("rows") if n not in done and files.exists(self.spark, f"{self.path}/rows/{n}/_SUCCESS")]

    def failures(self) -> list[tuple[int, str]]:
        """(batch, fault) of all deliveries that failed."""
        names = [n for n in files.names(self.spark, f"{self.path}/failed") if n[0].isdigit()]
        return [(int(n.split("-")[0]), files.text_of(self.spark, f"{self.path}/failed/{n}")) for n in sorted(names, key=lambda n: [int(x) for x in n.split("-")])]

    def take(self, batch: DataFrame, number: int) -> None:
        if not files.exists(self.spark, f"{self.path}/rows/{number}/_SUCCESS"):
            batch.write.mode("overwrite").parquet(f"{self.path}/rows/{number}")
        self.flush()

    def flush(self) -> int:
        """Offers all that is pending to the sink; how many batches it has taken."""
        taken = 0
        for n in self.pending():
            try:
                self.sink(self.spark.read.parquet(f"{self.path}/rows/{n}"), n)
            except Exception as fault:  # any fault of a sink: its rows stay
                log.warning("batch %s was not delivered: %s", n, fault)
                tries = sum(k == n for k, _ in self.failures())
                files.put_new(self.spark, f"{self.path}/failed/{n}-{tries}", f"{type(fault).__name__}: {fault}")
                break
            files.put_new(self.spark, f"{self.path}/delivered/{n}", "")
            files.delete(self.spark, f"{self.path}/rows/{n}")
            taken += 1
        return taken

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Takes all of a stream that is available."""
        query = stream.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()


STATE = "key string, severity string, first_seen timestamp, last_seen timestamp, last_sent timestamp, pending boolean, recovering boolean"


def alert_step(state: DataFrame, issues: DataFrame, now, repeat_seconds: int, send: Callable[[pd.DataFrame], list[bool]]) -> DataFrame:
    """State (STATE) after one check, whose ``issues`` (key, severity) hold at ``now``, with what was tried: columns kind and delivered.

    An alert is due if it was never sent, if its severity has changed, or ``repeat_seconds`` after it was last sent; one that fails to go out
    stays pending and is due again. A key that was sent and does not show any more is due a recovery, until that has gone out; one that was never sent
    is forgotten. ``send`` takes a frame (key, kind, severity) in a task and says of each row whether it went out.
    """
    at = F.lit(now).cast("timestamp")
    new = issues.groupBy("key").agg(F.min("severity").alias("now_"))
    x = state.join(new, "key", "full")
    shows = F.col("now_").isNotNull()
    late = F.unix_seconds(at) - F.unix_seconds("last_sent") >= repeat_seconds
    due = shows & (F.col("last_sent").isNull() | ~F.col("severity").eqNullSafe(F.col("now_")) | F.coalesce(F.col("pending"), F.lit(False)) | late)
    kind = F.when(due, "alert").when(~shows & F.col("last_sent").isNotNull(), "recovery")
    x = x.select("key", F.coalesce("now_", "severity").alias("severity"), F.coalesce("first_seen", at).alias("first_seen"), F.when(shows,
        at).otherwise(F.col("last_seen")).alias("last_seen"), "last_sent", shows.alias("shows"), kind.alias("kind"))

    def deliver(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            went = pd.Series([None] * len(b), dtype="object")
            tried = b["kind"].notna().to_numpy()
            if tried.any():
                went[tried] = list(map(bool, send(b.loc[tried, ["key", "kind", "severity"]].reset_index(drop=True))))
            yield b.assign(delivered=went.to_numpy())

    schema = "key string, severity string, first_seen timestamp, last_seen timestamp, last_sent timestamp, shows boolean, kind string, delivered boolean"
    return x.mapInPandas(deliver, schema).select("key", "severity", "first_seen", "last_seen", F.when((F.col("kind") == "alert") & F.col("delivered"),
        at).otherwise(F.col("last_sent")).alias("last_sent"), ((F.col("kind") == "alert") & ~F.col("delivered")).alias("pending"),
        ((F.col("kind") == "recovery") & ~F.col("delivered")).alias("recovering"), "shows", "kind", "delivered")


class Alerts:
    """The alerts of a stream of checks; their state is a table for each check in ``path``, and the last one counts."""

    def __init__(self, spark: SparkSession, path: str, send: Callable[[pd.DataFrame], list[bool]], repeat_seconds: int = 21_600):
        self.spark, self.path, self.send, self.repeat_seconds = spark, path, send, repeat_seconds

    def checks(self) -> list[int]:
        return sorted(int(n) for n in files.names(self.spark, self.path) if n.isdigit() and files.exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def tried(self, check: int) -> DataFrame:
        """(key, kind, severity, delivered) of what a check has tried to send."""
        return self.spark.read.parquet(f"{self.path}/{check}").where("kind is not null").select("key", "kind", "severity", "delivered")

    def state(self) -> DataFrame:
        """What is known of each alert that shows, or whose recovery has not gone out; ``pending``: it is still to be sent."""
        done = self.checks()
        if not done:
            return self.spark.createDataFrame([], STATE)
        kept = self.spark.read.parquet(f"{self.path}/{done[-1]}").where("shows or recovering")
        return kept.select(*(c.split()[0] for c in STATE.split(", ")))

    def check(self, issues: DataFrame, number: int) -> None:
        """One check: rows (key, severity, at); a row of a null key only says that there was a check."""
        done = self.checks()
        if done and done[-1] >= number:
            return
        now = issues.agg(F.max("at")).first()[0]
        if now is None:
            return
        after = alert_step(self.state(), issues.where("key is not null").select("key", "severity"), now, self.repeat_seconds, self.send)
        after.write.mode("overwrite").parquet(f"{self.path}/{number}")

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        query = stream.writeStream.foreachBatch(self.check).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
