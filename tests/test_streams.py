"""Streams with timers, leases, heartbeats and fenced writes."""

import datetime as dt
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from tally.plans.streams import state_store
from tally.sources.commits import Stale, TableSet
from tally.streaming import runner as U
from tally.streaming import stateful as W
from tally.streaming.projection import run_to_end

START = dt.datetime(2026, 1, 1)
RESULTS = "key string, at timestamp, outcome string, error string"
PARTS = "key string, part long, parts long, payload string, at timestamp"


def feed(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_retries_over_batches(spark, tmp_path):
    """A failing key waits, is asked for late, waits longer, and is a dead letter in the end; others go on.  A restart loses nothing."""
    root = str(tmp_path)

    def run(*rows):
        feed(spark, f"{root}/in", [(k, START + dt.timedelta(seconds=t), o, e) for k, t, o, e in rows], RESULTS)
        stream = spark.readStream.schema(RESULTS).parquet(f"{root}/in")
        with state_store(spark):
            U.to_files(W.retries(stream, "10 seconds", 60, 600, 3), root)
        got = spark.read.schema(W.RETRIES).parquet(f"{root}/data").collect()
        return sorted((r.key, (r.at - START).seconds, r.action, r.attempts, r.error) for r in got)

    seen = run(("a", 0, "failed", "x"), ("b", 0, "ok", None), ("c", 0, "fatal", "gone"), (None, 0, "ok", None))
    assert seen == [("", 0, "done", 0, None), ("a", 60, "waiting", 1, "x"), ("b", 0, "done", 0, None), ("c", 0, "dead", 1, "gone")]
    seen = run(("b", 100, "ok", None))  # the watermark passes 60
    assert ("a", 60, "retry", 1, "x") in seen and len(seen) == 6
    seen = run(("a", 130, "failed", "y"), ("c", 131, "ok", None))
    assert ("a", 250, "waiting", 2, "y") in seen and len(seen) == 7  # a dead letter counts no further
    seen = run(("b", 200, "ok", None))
    assert len(seen) == 8  # not yet
    seen = run(("a", 255, "failed", "z"), ("b", 400, "failed", "n"), ("b", 401, "ok", None))
    assert ("a", 255, "dead", 3, "z") in seen and not any(r[:3] == ("a", 250, "retry") for r in seen)  # the result came first
    assert len(seen) == 11 and run(("b", 9000, "ok", None))[-1][0] == "c"


def test_groups_over_files(spark, tmp_path):
    """Parts in three files, one of them twice: whole once.  Too large, never whole, and a part of no group."""
    root, t = str(tmp_path), START
    out = []

    def run(*rows):
        feed(spark, f"{root}/in", [(k, p, n, x, t + dt.timedelta(seconds=s)) for k, p, n, x, s in rows], PARTS)
        stream = spark.readStream.schema(PARTS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        with state_store(spark):
            run_to_end(W.whole_groups(stream, "1 second", 3, 60), lambda df, i: out.extend(df.collect()), f"{root}/c")
        return {(r.key, r.action): r.payload for r in out}

    assert run(("g", 2, 3, "c", 0), ("big", 0, 4, "x", 0), ("lone", 0, 2, "x", 0), ("one", 0, 1, None, 0), ("g", 7, 3, "?", 0)) == {("big", "refused"): None, ("one", "whole"): [None]}
    assert ("g", "whole") not in run(("g", 0, 3, "a", 1), ("g", 2, 3, "c", 1), ("big", 1, 4, "x", 1))
    assert run(("g", 1, 3, "b", 2))[("g", "whole")] == ["a", "b", "c"]
    run(("g", 0, 3, "a", 3), ("one", 0, 1, "again", 3))
    got = run(("late", 0, 2, "x", 300))
    assert got[("lone", "incomplete")] is None and run(("lone", 1, 2, "y", 301)) == got
    assert len(out) == len(got) == 4


def test_gathered_groups_over_files(spark, tmp_path):
    """The rules of whole_groups without a Python call for each key (F2): state is tables, a batch that runs again changes nothing."""
    root, t = str(tmp_path), START
    store = TableSet(spark, f"{root}/store")
    sink = U.gathering_sink(store, "parts", lambda b: {"out": b}, 1, 3, 60)

    def run(*rows):
        feed(spark, f"{root}/in", [(k, p, n, x, t + dt.timedelta(seconds=s)) for k, p, n, x, s in rows], PARTS)
        run_to_end(spark.readStream.schema(PARTS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in"), sink, f"{root}/c")
        return {(r.key, r.action): r.payload for r in store.snapshot().read("out").collect()}

    waits = lambda: sorted((r.key, r.part, r.payload) for r in store.snapshot().read("parts.open").where("part IS NOT NULL").collect())
    assert run(("g", 2, 3, "c", 0), ("big", 0, 4, "x", 0), ("lone", 0, 2, "x", 0), ("one", 0, 1, None, 0), ("g", 7, 3, "?", 0)) == {("big", "refused"): None, ("one", "whole"): [None]}
    assert waits() == [("g", 2, "c"), ("lone", 0, "x")]
    assert ("g", "whole") not in run(("g", 0, 3, "a", 1), ("g", 2, 3, "c", 1), ("big", 1, 4, "x", 1))
    assert waits() == [("g", 0, "a"), ("g", 2, "c"), ("lone", 0, "x")]
    assert run(("g", 1, 3, "b", 2))[("g", "whole")] == ["a", "b", "c"]
    run(("g", 0, 3, "a", 3), ("one", 0, 1, "again", 3))
    got = run(("late", 0, 2, "x", 300), ("huge", 2, 2**62, "x", 300))
    assert got[("lone", "incomplete")] is None and run(("lone", 1, 2, "y", 301), ("old", 0, 1, "x", 200)) == got
    assert store.snapshot().read("out").count() == len(got) == 5 and waits() == [("late", 0, "x")]
    turn = store.snapshot().turn
    sink(spark.createDataFrame([("new", 0, 1, "x", t)], PARTS), 2)
    assert store.snapshot().turn == turn


def test_streamed_groups_ask_no_worker(spark):
    """Groups are gathered by joins and groupings, not by a Python call for each key and batch (F2)."""
    import inspect

    from tally.plans import streams

    assert "whole_groups" not in inspect.getsource(streams.streamed_groups)


def test_leases(spark, tmp_path):
    now = [1000.0]
    one, two = (U.Lease(spark, str(tmp_path), "work", o, 60, lambda: now[0]) for o in ("one", "two"))
    assert one.acquire() and one.acquire() and not two.acquire() and one.token == 1
    now[0] += 50
    assert one.renew() and not two.renew()
    now[0] += 50
    assert not two.acquire()  # prolonged
    now[0] += 20
    assert two.acquire() and two.token == 2 and not one.renew() and not one.acquire()
    two.release()
    assert one.acquire() and one.token == 3
    for _ in range(12):
        one.renew()
    assert len(U.numbers(spark, one.folder)) <= 5 and one.current()["token"] == 3


def test_one_of_many_gets_a_lease(spark, tmp_path):
    leases = [U.Lease(spark, str(tmp_path), "work", f"o{i}", 60) for i in range(6)]
    won = []
    threads = [threading.Thread(target=lambda x=x: won.append(x.acquire())) for x in leases]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sum(won) == 1


def test_a_dead_runner_is_taken_over(spark, tmp_path):
    """Two runners: the second waits, takes over the dead one's lease and goes on where it stopped; what the first still
    tries to write is refused."""
    root = str(tmp_path)
    feed(spark, f"{root}/in", [(1,), (2,)], "id long")
    store = TableSet(spark, f"{root}/store")
    clock = [0.0]
    one, two = (U.Lease(spark, f"{root}/leases", "work", o, 60, lambda: clock[0]) for o in ("one", "two"))

    def start(token):
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        sink = U.atomic_sink(store, "work", lambda b: {"rows": b.withColumn("token", F.lit(token)), "counts": b.agg(F.count("*").alias("n"))}, token)
        return stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start()

    query = U.run_leased(spark, one, start, f"{root}/one.json", 0.2)
    assert U.run_leased(spark, two, start, f"{root}/two.json") is None
    query.awaitTermination()
    query._keeper.join(30)
    state = json.load(open(f"{root}/one.json"))
    assert (state["status"], state["rows"], state["owner"], state["error"]) == ("done", 2, "one", None) and state["beats"] >= 1
    assert two.acquire()  # the first has given it back
    two.release()
    assert one.acquire()  # again, and dies without a word: its lease runs out
    feed(spark, f"{root}/in", [(3,)], "id long")
    clock[0] += 61
    query = U.run_leased(spark, two, start, f"{root}/two.json", 0.2)
    query.awaitTermination()
    query._keeper.join(30)
    now = store.snapshot()
    assert sorted(tuple(r) for r in now.read("rows").collect()) == [(1, 1), (2, 1), (3, two_token := now.fences["work"])] and two_token > one.token
    with pytest.raises(Stale):
        U.atomic_sink(store, "work", lambda b: {"rows": b.withColumn("token", F.lit(1))}, one.token)(spark.range(1), 99)
    assert store.snapshot().turn == now.turn


def test_a_run_that_lost_its_lease_stops(spark, tmp_path):
    root = str(tmp_path)
    feed(spark, f"{root}/in", [(1,)], "id long")
    clock = [0.0]
    one, two = (U.Lease(spark, f"{root}/leases", "work", o, 60, lambda: clock[0]) for o in ("one", "two"))
    start = lambda token: spark.readStream.schema("id long").parquet(f"{root}/in").writeStream.format("noop").option("checkpointLocation", f"{root}/c").trigger(processingTime="200 milliseconds").start()
    query = U.run_leased(spark, one, start, f"{root}/one.json", 0.3)
    time.sleep(2)
    assert query.isActive and one.current()["owner"] == "one"  # polls, and renews when idle
    clock[0] += 1000
    with one._lock:  # between two beats
        assert two.acquire()
    assert query.awaitTermination(20) and not query.isActive
    query._keeper.join(30)


def test_fenced_update(spark, tmp_path):
    """Only writes that hold the lease count; buckets that aren't touched stay as they are; nulls hold nothing."""
    rows = [(i, "processing" if i % 2 else None if i == 4 else "done", i % 3, "t", None) for i in range(40)] + [(None, "processing", 0, "t", None)]
    tasks = spark.createDataFrame(rows, "k int, status string, generation int, token string, page_state string")
    store = TableSet(spark, str(tmp_path))
    first = U.create_bucketed(store, "tasks", tasks, ["k"], 8)
    writes = spark.createDataFrame([(1, 1, "t", "a"), (3, 1, "t", "stale"), (5, 2, "old", "stale"), (4, 1, "t", "done"), (7, 1, "t", "z"), (7, 1, "t", "b"), (99, 0, "t", "none"), (None, 0, "t", "null")], "k int, generation int, token string, page_state string")
    args = ("tasks", writes, ["k"], ["generation", "token"], F.col("status") == "processing", ["page_state"])
    after, n = U.update_fenced(store, *args)
    got = {r.k: r.page_state for r in U.read_bucketed(after, "tasks").collect()}
    assert n == 2 and {k: v for k, v in got.items() if v} == {1: "a", 7: "b"} and len(got) == 41
    assert sum(after.parts[t] != first.parts[t] for t in first.parts) <= 2
    same, n = U.update_fenced(store, "tasks", writes.where("k = 3"), *args[2:])
    assert n == 0 and same.turn == after.turn


def test_updates_at_the_same_time(spark, tmp_path):
    """Four runners write different rows of the same buckets: all count."""
    store = TableSet(spark, str(tmp_path))
    U.create_bucketed(store, "tasks", spark.range(20).select(F.col("id").alias("k"), F.lit("processing").alias("status"), F.lit(1).alias("generation"), F.lit(None).cast("string").alias("page_state")), ["k"], 2)
    done = []

    def run(i):
        writes = spark.range(20).where(f"id % 4 = {i}").select(F.col("id").alias("k"), F.lit(1).alias("generation"), F.lit(f"w{i}").alias("page_state"))
        done.append(U.update_fenced(store, "tasks", writes, ["k"], ["generation"], F.col("status") == "processing", ["page_state"], 50)[1])

    threads = [threading.Thread(target=run, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert done == [5] * 4 and {r.k: r.page_state for r in U.read_bucketed(store.snapshot(), "tasks").collect()} == {k: f"w{k % 4}" for k in range(20)}


def test_page_state_writes(spark):
    df = spark.createDataFrame([(1, 2, "captcha", "text", "e" * 600), (2, 2, "ok", None, None)], "k int, generation int, state string, reason string, evidence string")
    got = U.page_state_writes(df, ["k"], ["generation"], F.lit("now")).collect()
    assert (got[0].page_state, len(got[0].page_state_reason), got[0].page_state_reason[:6], got[1].page_state_reason, got[0].updated_at) == ("captcha", 500, "text:e", ":", "now")


class Calls:
    """A handle that counts what would be round trips."""

    def __init__(self):
        self.value, self.timers, self.n = None, [], 0

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def get(self):
        self.n += 1
        return self.value

    def update(self, value):
        self.n, self.value = self.n + 1, value

    def registerTimer(self, at):  # noqa: N802
        self.n += 1
        self.timers.append(at)

    def deleteTimer(self, at):  # noqa: N802
        self.n += 1
        self.timers.remove(at)


def test_state_costs_few_round_trips():
    """However many rows a key has in a micro-batch: one read, one write, one timer set, one deleted."""
    from pyspark.sql import Row

    at = lambda s: START + dt.timedelta(seconds=s)
    calls, p = Calls(), W.Retrying(60, 600, 50)
    p.init(calls)
    for lot in (range(20), range(20, 40)):
        assert len(list(p.handleInputRows(("k",), iter([Row(at=at(s), outcome="failed", error="x") for s in lot]), None))) == 20
    assert calls.n <= 7 and len(calls.timers) == 1 and calls.value[:2] == (40, calls.timers[0])
    calls, g = Calls(), W.Gathering(32, 60)
    g.init(calls)
    assert list(g.handleInputRows(("k",), iter([Row(part=i, parts=20, payload=None if i == 3 else str(i), at=at(i)) for i in range(0, 20, 2)]), None)) == [] and len(calls.timers) == 1
    whole = list(g.handleInputRows(("k",), iter([Row(part=i, parts=20, payload=str(i), at=at(i)) for i in range(1, 20, 2)]), None))
    assert [(r.action, r.payload) for r in whole] == [("whole", [str(i) for i in range(20)])] and calls.timers == [] and calls.n <= 6
