"""Keyed state with timers: retries with backoff and dead letters (T3), groups that pass whole or not at all.

Both need a watermark on their time column: timers are in event time, so a replay gives the same answers, and a timer fires once the
watermark has passed it.  State lies in RocksDB below the checkpoint, one key's state at a time in a task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RETRIES = "key string, action string, attempts long, at timestamp, error string"
GROUPS = "key string, action string, parts long, payload array<string>, at timestamp"


def with_state_store(spark: SparkSession) -> SparkSession:
    """Sets the state store that keyed state with timers needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark




def _ms(at: dt.datetime) -> int:
    """Spark hands timestamps over in the worker's zone, without saying so."""
    return round(at.timestamp() * 1000)


def _move_timer(handle: StatefulProcessorHandle, old: int, new: int) -> None:
    """A key has one timer at most, whose time its state knows (0: none)."""
    if old != new:
        if old:
            handle.deleteTimer(old)
        if new:
            handle.registerTimer(new)


class Retrying(StatefulProcessor):
    """Attempts of a key: waits after a failure, asks for a retry when the wait is over, gives up at `most`."""

    def __init__(self, first_seconds: int, longest_seconds: int, most: int):
        self.first, self.longest, self.most = first_seconds, longest_seconds, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("attempts", "attempts long, due long, dead boolean, error string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self.state.get()  # each call on state or timers is a round trip: one to read, one to write
        attempts, due, dead, error = held or (0, 0, False, None)
        timer = due
        out = []
        for r in sorted(rows, key=lambda r: (_ms(r.at), r.outcome)):
            if dead:
                continue  # a dead letter stays one until it is queued anew
            now = _ms(r.at)
            if r.outcome == "ok":
                attempts, due, error = 0, 0, None
                out.append((key[0], "done", attempts, now, None))
                continue
            attempts, error = attempts + 1, r.error
            if r.outcome == "fatal" or attempts >= self.most:
                dead, due = True, 0
                out.append((key[0], "dead", attempts, now, error))
            else:
                due = now + 1000 * min(self.longest, self.first * 2 ** (attempts - 1))
                out.append((key[0], "waiting", attempts, due, error))
        _move_timer(self.handle, timer, due)
        if attempts or dead:
            if (attempts, due, dead, error) != held:
                self.state.update((attempts, due, dead, error))
        elif held:
            self.state.clear()  # nothing is held of keys that are done
        for k, action, n, ms, said in out:
            yield Row(key=k, action=action, attempts=n, at=_local(ms), error=said)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        attempts, due, _, error = self.state.get() or (0, 0, False, None)
        if attempts and due == expiredTimerInfo.getExpiryTimeInMs():
            yield Row(key=key[0], action="retry", attempts=attempts, at=_local(due), error=error)

    def close(self) -> None:
        pass


def _local(ms: int) -> dt.datetime:
    """The form in which Spark takes timestamps back."""
    return dt.datetime.fromtimestamp(ms / 1000)


def retries(results: DataFrame, late: str = "1 hour", first_seconds: int = 60, longest_seconds: int = 3600, most: int = 5) -> DataFrame:
    """From results of attempts (key, at, outcome, error) what is to happen to each key: key, action, attempts, at, error.

    outcome: ok, failed, or fatal (won't go away).  After the n-th failure in a row a key is `waiting` until first_seconds * 2**(n - 1) later,
    `longest_seconds` at most; when the watermark passes that time it is to `retry`, unless a result came before.  At `most` failures, or
    a fatal one, it is `dead` and counts no further.  A success is `done` and forgets the failures.  Results of one micro-batch count
    in their order in time; those older than the watermark (`late` behind the newest) are left out by it.
    """
    keyed = results.select(F.coalesce(F.col("key").cast("string"), F.lit("")).alias("key"), F.col("at").cast("timestamp").alias("at"), "outcome", "error").where("at IS NOT NULL")
    return keyed.withWatermark("at", late).groupBy("key").transformWithState(Retrying(first_seconds, longest_seconds, most), RETRIES, "append", "eventTime")


class Gathering(StatefulProcessor):
    """Parts of a group, held until all are there."""

    def __init__(self, most: int, patience_seconds: int):
        self.most, self.patience = most, patience_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("group", "action string, parts long, since long, due long, places array<long>, payloads array<string>")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        before = self.state.get()  # all of a group is one value: each call on state or timers is a round trip
        action, n, since, due, places, payloads = before or ("open", 0, 0, 0, [], [])
        if action != "open":
            return  # the group has passed, or was given up
        held, last = dict(zip(places, payloads, strict=True)), since
        for r in rows:
            n = max(n, r.parts)
            last = max(last, _ms(r.at))
            if n > self.most:
                action = "refused"
                break
            if 0 <= r.part < r.parts:
                held[r.part] = r.payload
        if action == "open" and len(held) == n > 0:
            action = "whole"
        if action == "open":
            after = last + 1000 * self.patience
            _move_timer(self.handle, due, after)
            self.state.update(("open", n, last, after, list(held), list(held.values())))
            return
        _move_timer(self.handle, due, 0)
        self.state.update((action, n, last, 0, [], []))
        payload = [held[i] for i in sorted(held)] if action == "whole" else None
        yield Row(key=key[0], action=action, parts=n, payload=payload, at=_local(last))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        action, n, since, _, _, _ = self.state.get()
        if action == "open":
            self.state.update(("incomplete", n, since, 0, [], []))
            yield Row(key=key[0], action="incomplete", parts=n, payload=None, at=_local(since))

    def close(self) -> None:
        pass


def whole_groups(parts: DataFrame, late: str = "1 hour", most: int = 32, patience_seconds: int = 86_400) -> DataFrame:
    """From parts (key, part, parts, payload, at) the groups that are whole: key, action, parts, payload, at; one row a group.

    part counts from 0, parts is the group's size.  A group that is spread over files and micro-batches is held until all its parts
    are there, then passes as one row (`whole`, payloads in the order of their parts), so it can't be split by a later batch; parts that come
    again are one part, and a group passes once.  One of more than `most` parts is `refused`, one that got no part for
    `patience_seconds` is `incomplete`; neither passes later.  State holds at most `most` payloads a group, and of a finished group its fate.
    """
    keyed = parts.select(F.coalesce(F.col("key").cast("string"), F.lit("")).alias("key"), F.col("part").cast("long").alias("part"), F.col("parts").cast("long").alias("parts"), F.col("payload").cast("string").alias("payload"), F.col("at").cast("timestamp").alias("at"))
    keyed = keyed.where("at IS NOT NULL AND part IS NOT NULL AND parts IS NOT NULL")
    return keyed.withWatermark("at", late).groupBy("key").transformWithState(Gathering(most, patience_seconds), GROUPS, "append", "eventTime")
