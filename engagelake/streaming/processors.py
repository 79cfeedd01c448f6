"""Structured Streaming twins of the stateful rules: breakers, alerts, trailing windows, keyed ingest.

Each has a batch twin in ``plans.stateful``; tests run both over the same rows and compare.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import merge as keyed
from ..sources import tables


def breakers(calls: DataFrame, first: int = 30, most: int = 3600) -> DataFrame:
    """(event_id, hits, cooldown) for each limited call (token, method, ts, event_id, code) of a stream.

    State for each token and method: hits of each code since the last success; it goes with the success, so that
    only pairs under a limit have any. Calls of a micro-batch are taken in order of time; across micro-batches the
    source has to keep that order.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        hits = dict(zip(*state.get, strict=True)) if state.exists else {}
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        out = []
        for r in rows.itertuples(index=False):
            if r.code == 0:
                hits = {}
                continue
            hits[r.code] = hits.get(r.code, 0) + 1
            out.append((r.event_id, hits[r.code], min(most, first * 2 ** min(hits[r.code] - 1, 20))))
        if hits:
            state.update((list(hits), list(hits.values())))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["event_id", "hits", "cooldown"])

    return calls.groupBy("token", "method").applyInPandasWithState(step, "event_id long, hits int, cooldown long",
        "codes array<int>, hits array<int>", "append", GroupStateTimeout.NoTimeout)


def alerts(issues: DataFrame, repeat_seconds: int = 86400, cycle_seconds: int = 3600, late: str = "0 seconds") -> DataFrame:
    """The messages to send from a stream of issues (key, severity, ts; one for each key and cycle of checks in which it shows).

    An alert is sent for a new key, for a changed severity, and ``repeat_seconds`` after the last one
    **sent**. A key that does not show in the next cycle has recovered: one message, then it is forgotten. State is a
    key's severity, last message and last cycle, and goes with its recovery, by the watermark.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        severity, sent, seen = state.get if state.exists else (None, None, None)
        out = []
        rows = [] if state.hasTimedOut else pd.concat(list(batches)).sort_values("ts").itertuples(index=False)
        for r in rows:
            now = r.ts.timestamp()
            if seen is not None and now > seen + cycle_seconds:
                out.append((key[0], seen + cycle_seconds, "recovery", severity))
                severity = None
            if severity is None or severity != r.severity or now - sent >= repeat_seconds:
                out.append((key[0], now, "alert", r.severity))
                sent = now
            severity, seen = r.severity, now
        if state.hasTimedOut:
            out.append((key[0], seen + cycle_seconds, "recovery", severity))
            state.remove()
        else:
            state.update((severity, sent, seen))
            due = int((seen + cycle_seconds) * 1000)
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": [x[0] for x in out], "at": pd.to_datetime([x[1] for x in out], unit="s"), "kind": [x[2] for x in out],
            "severity": [x[3] for x in out]})

    marked = issues.withWatermark("ts", late)
    return marked.groupBy("key").applyInPandasWithState(step, "key string, at timestamp, kind string, severity string",
        "severity string, sent double, seen double", "append", GroupStateTimeout.EventTimeTimeout)


def trailing_counts(calls: DataFrame, window: str = "24 hours", slide: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """Calls and limited calls in sliding windows, with a bound for late rows (``ts`` is a timestamp)."""
    return calls.withWatermark("ts", late).groupBy(F.window("ts", window, slide)).agg(F.count("*").alias("calls"),
        F.count_if(F.col("code") != 0).alias("limited"))


def ingest(stream: DataFrame, table: tables.VersionedTable, keys: list[str], order: list, policy: dict[str, str], checkpoint: str):
    """Merges each micro-batch into a versioned table by key; a batch that is run again changes nothing.

    Runs over what is available and stops. The table (of these keys) remembers the last batch it has taken, in
    the manifest that makes the batch's rows visible: a crash between leaves both as before.
    """
    if table.keys != keys:
        raise ValueError(f"the table's keys are {table.keys}")

    def sink(batch: DataFrame, number: int) -> None:
        if table.mark() is not None and table.mark() >= number:
            return
        table.upsert(keyed.last_wins(batch, keys, order), policy, mark=number)

    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return table
