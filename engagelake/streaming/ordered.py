"""Stateful rules over calls that arrive out of order, by ``transformWithState``: slots of tokens, probes after a limit, limited methods.

Rows wait in map state, by time and number, until the watermark has passed them; an event-time timer then takes them in order. So a rule sees the
same order whatever the micro-batches were, and equals its batch twin as long as rows are no later than the watermark allows. What a rule remembers
is value, list or map state of its own; state that can no longer matter is dropped by a timer.

The state store must be RocksDB: ``use_rocksdb`` sets it for the session.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class InOrder(StatefulProcessor):
    """Takes rows (ts, event_id, method, code) of a key in order of time, once the watermark has passed them.

    Subclasses give ``columns`` of the result, ``remember`` (their state) and ``step`` (the results of the rows of one moment).
    """

    columns: tuple[str, ...] = ()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "ts long, event_id long", "method string, code int")
        self.remember(handle)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        moments = set()
        for batch in rows:
            for r in batch.itertuples(index=False):
                at = int(r.ts.value // 1000)
                self.waiting.updateValue((at, int(r.event_id)), (r.method, int(r.code)))
                moments.add(at)
        for at in moments:
            # a timer runs when the watermark is past it: one more millisecond, so that the moment is complete
            self.handle.registerTimer(at // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        upto = expiredTimerInfo.getExpiryTimeInMs() * 1000
        due = sorted(k for k in self.waiting.keys() if k[0] < upto)
        out, lo = [], 0
        while lo < len(due):
            hi = lo
            while hi < len(due) and due[hi][0] == due[lo][0]:
                hi += 1
            out += self.step(key, due[lo][0], [(k[1], *self.waiting.getValue(k)) for k in due[lo:hi]])
            lo = hi
        for k in due:
            self.waiting.removeKey(k)
        self.forget(upto)
        return iter([pd.DataFrame(out, columns=list(self.columns))] if out else [])

    def remember(self, handle: StatefulProcessorHandle) -> None:
        pass

    def step(self, key, at: int, rows: list[tuple]) -> list[tuple]:
        """Results of the rows (event_id, method, code) of the moment ``at`` in microseconds."""
        return []

    def forget(self, upto: int) -> None:
        pass

    def close(self) -> None:
        pass


class Slots(InOrder):
    """One call of a token in ``interval`` seconds: each at its own time or after the slot of the call before."""

    columns = ("event_id", "slot", "wait")

    def __init__(self, interval: int):
        self.interval = interval

    def remember(self, handle):
        self.last = handle.getValueState("last", "slot long")

    def step(self, key, at, rows):
        out = []
        for event_id, _, _ in rows:
            own = at // 1_000_000
            slot = max(own, self.last.get()[0] + self.interval) if self.last.exists() else own
            self.last.update((slot,))
            out.append((event_id, slot, slot - own))
        return out


class Probes(InOrder):
    """Limits that are open: the first call of their token and method at the end of the pause is the probe of each."""

    columns = ("limit_id", "probe_id", "outcome")

    def __init__(self, pause: int):
        self.pause = pause * 1_000_000

    def remember(self, handle):
        self.open = handle.getListState("open", "ts long, event_id long")

    def step(self, key, at, rows):
        limits, out = list(self.open.get()), []
        for event_id, _, code in rows:
            out += [(i, event_id, "opened" if code == 0 else "prolonged") for t, i in limits if at >= t + self.pause]
            limits = [(t, i) for t, i in limits if at < t + self.pause]
            if code == 9:
                limits.append((at, event_id))
        if limits:
            self.open.put(limits)
        else:
            self.open.clear()
        return out


class Limited(InOrder):
    """Distinct methods of a token that were limited in the last ``window`` seconds, at each limited call."""

    columns = ("event_id", "methods", "escalates")

    def __init__(self, window: int, most: int):
        self.window, self.most = window, most

    def remember(self, handle):
        self.seen = handle.getMapState("seen", "method string", "second long")

    def step(self, key, at, rows):
        now = at // 1_000_000
        limited = [(i, m) for i, m, code in rows if code != 0]
        for _, method in limited:
            self.seen.updateValue((method,), (now,))
        methods = sum(now - self.window <= v[0] for _, v in self.seen.iterator())
        return [(i, methods, methods >= self.most) for i, _ in limited]

    def forget(self, upto):
        for k, v in list(self.seen.iterator()):
            if v[0] < upto // 1_000_000 - self.window:
                self.seen.removeKey(k)


def _run(calls: DataFrame, keys: list[str], rule: InOrder, schema: str, late: str) -> DataFrame:
    rows = calls.select(*keys, *(c for c in ("ts", "event_id", "method", "code") if c not in keys))
    return rows.withWatermark("ts", late).groupBy(*keys).transformWithStateInPandas(rule, schema, "append", "eventTime")


def token_slots(calls: DataFrame, interval: int = 7200, late: str = "1 day") -> DataFrame:
    """(event_id, slot, wait) for each call (token, method, ts, event_id, code) of a stream."""
    return _run(calls, ["token"], Slots(interval), "event_id long, slot long, wait long", late)


def probes(calls: DataFrame, pause: int = 3600, late: str = "1 day") -> DataFrame:
    """(limit_id, probe_id, outcome) for each limit of a stream of calls, when its probe has been made."""
    rows = calls.withColumn("method_", calls["method"])
    rows = rows.select("token", "method_", "ts", "event_id", "method", "code")
    return rows.withWatermark("ts", late).groupBy("token", "method_").transformWithStateInPandas(Probes(pause),
        "limit_id long, probe_id long, outcome string", "append", "eventTime")


def limited_methods(calls: DataFrame, window: int = 6 * 3600, most: int = 3, late: str = "1 day") -> DataFrame:
    """(event_id, methods, escalates) for each limited call of a stream."""
    return _run(calls, ["token"], Limited(window, most), "event_id long, methods long, escalates boolean", late)
