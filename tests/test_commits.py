"""Batches over several tables: all or nothing for readers, whatever dies; cascades; versions with children."""

import collections
import os
import subprocess
import sys
import threading

import pytest
from pyspark.sql import functions as F

from tally.operators import cascades as K
from tally.plans.batches import written
from tally.sources import commits
from tally.sources.commits import Conflict, TableSet


def rows(spark, tag, n):
    return spark.range(n).withColumn("tag", F.lit(tag))


def seen(snapshot):
    return {t: sorted((r.id, r.tag) for r in snapshot.read(t).collect()) for t in snapshot.parts}


@pytest.fixture
def store(spark, tmp_path):
    return TableSet(spark, str(tmp_path / "store"))


def test_readers_stay_at_their_turn(spark, store):
    empty = store.snapshot()
    one = store.commit(replace={"a": rows(spark, "x", 2), "b": rows(spark, "x", 3)})
    store.commit(replace={"a": rows(spark, "y", 1)}, append={"b": rows(spark, "y", 1)})
    now = store.snapshot()
    assert empty.parts == {} and (one.turn, now.turn) == (1, 2)
    assert seen(one) == {"a": [(0, "x"), (1, "x")], "b": [(0, "x"), (1, "x"), (2, "x")]} == seen(store.snapshot(1))
    assert seen(now) == {"a": [(0, "y")], "b": [(0, "x"), (0, "y"), (1, "x"), (2, "x")]}


@pytest.mark.parametrize("step", [0, 1, 2])
def test_a_writer_that_fails_changes_nothing(spark, store, monkeypatch, step):
    """Before the first table, between the tables, before the manifest."""
    before = store.commit(replace={"a": rows(spark, "old", 2), "b": rows(spark, "old", 2)})
    calls, writer = [], type(spark.range(1).write)
    real = writer.parquet

    def parquet(self, path, *a, **k):
        calls.append(path)
        if len(calls) > step:
            raise OSError("disk gone")
        return real(self, path, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(writer, "parquet", parquet)
        if step == 2:
            m.setattr(commits, "publish", lambda *a: (_ for _ in ()).throw(OSError("disk gone")))
        with pytest.raises(OSError):
            store.commit(replace={"a": rows(spark, "new", 2), "b": rows(spark, "new", 2)})
    assert store.snapshot().turn == before.turn and seen(store.snapshot()) == seen(before)
    after = store.commit(replace={"a": rows(spark, "new", 1), "b": rows(spark, "new", 1)})
    assert seen(after) == {"a": [(0, "new")], "b": [(0, "new")]}
    gone = store.vacuum(keep=1, hours=0)
    assert len(gone) == 2 + step and seen(store.snapshot()) == seen(after)


KILLED = """
import os, sys
from pyspark.sql import SparkSession, functions as F
from tally.sources.commits import TableSet
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
store = TableSet(spark, sys.argv[1])
rows = lambda tag: spark.range(3).withColumn("tag", F.lit(tag))
store.commit(replace={"a": rows("old"), "b": rows("old")})
real = type(rows("x").write).parquet
def parquet(self, path, *a, **k):
    if "/b/" in path:
        os._exit(7)
    return real(self, path, *a, **k)
type(rows("x").write).parquet = parquet
store.commit(replace={"a": rows("new"), "b": rows("new")})
"""


def test_a_writer_that_is_killed_between_tables(spark, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", KILLED, str(tmp_path / "s")], cwd=root, capture_output=True, timeout=180)
    assert done.returncode == 7
    store = TableSet(spark, str(tmp_path / "s"))
    assert {t for v in seen(store.snapshot()).values() for _, t in v} == {"old"}
    after = store.commit(replace={"b": rows(spark, "newer", 1)})
    assert {t for _, t in seen(after)["a"]} == {"old"} and {t for _, t in seen(after)["b"]} == {"newer"}


def test_conflicts(spark, store):
    base = store.commit(replace={"a": rows(spark, "x", 1), "b": rows(spark, "x", 1)})
    store.commit(replace={"a": rows(spark, "y", 1)}, base=base)
    with pytest.raises(Conflict):
        store.commit(replace={"a": rows(spark, "z", 1)}, base=base)
    with pytest.raises(Conflict):
        store.commit(replace={"b": rows(spark, "z", 1)}, base=base, reads=["a"])
    with pytest.raises(Conflict):
        store.commit(append={"b": spark.range(1)})
    after = store.commit(replace={"b": rows(spark, "z", 1)}, base=base)  # another table
    assert seen(after) == {"a": [(0, "y")], "b": [(0, "z")]}


def test_a_batch_that_runs_again_does_nothing(spark, store):
    for batch in (0, 1, 1, 0):
        store.commit(append={"a": rows(spark, f"b{batch}", 2), "b": rows(spark, f"b{batch}", 1)}, by=("stream", batch))
    now = store.snapshot()
    assert (now.turn, now.done, now.read("a").count(), now.read("b").count()) == (2, {"stream": 1}, 4, 2)


def test_writers_at_the_same_time(spark, store):
    """Appends of four threads all count, and every turn on the way holds as many rows in both tables."""
    errors = []

    def run(i):
        try:
            for j in range(3):
                store.commit(append={"a": rows(spark, f"{i}{j}", 2), "b": rows(spark, f"{i}{j}", 2)}, by=(f"w{i}", j))
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    for turn in range(1, 13):
        state = store.snapshot(turn)
        assert state.read("a").count() == state.read("b").count() == 2 * turn


def test_cascade(spark):
    """Two levels, two parents, null keys, doomed rows in the middle; a table without links stays."""
    a = spark.createDataFrame([(1, "bad"), (2, "ok"), (3, None)], "id int, state string")
    b = spark.createDataFrame([(10, 1), (20, 2), (21, 2), (30, None)], "id int, a int")
    c = spark.createDataFrame([(100, 10, 2), (200, 20, 2), (201, 21, 1), (300, None, None)], "id int, b int, a int")
    tables = {"c": c, "b": b, "a": a, "d": a}
    links = [("b", "a", "a", "id"), ("c", "b", "b", "id"), ("c", "a", "a", "id")]
    out = K.cascade(tables, links, {"a": F.col("state") == "bad", "b": F.col("id") == 21})
    ids = {t: tuple(sorted(r.id for r in side.collect()) for side in sides) for t, sides in out.items()}
    assert ids == {"a": ([2, 3], [1]), "b": ([20, 30], [10, 21]), "c": ([200, 300], [100, 201]), "d": ([1, 2, 3], [])}
    assert [x.columns for side in out.values() for x in side] == [x for t in out for x in [tables[t].columns] * 2]
    assert K.orphans(out["c"][0], "b", out["b"][0], "id").count() == 0 and K.orphans(c, "b", out["b"][0], "id").count() == 2
    with pytest.raises(ValueError):
        K.cascade({"a": a, "b": b}, [("b", "a", "a", "id"), ("a", "id", "b", "id")], {})


def test_next_in_key(spark):
    df = spark.createDataFrame([("hot", i) for i in range(0, 400, 2)] + [(None, 5), (None, 9), ("x", 1)], "k string, seq int").repartition(5)
    got = {(r.k, r.seq): r.next for r in K.next_in_key(df, ["k"], "seq", "next", written).collect()}
    assert got == {("hot", i): i + 2 if i < 398 else None for i in range(0, 400, 2)} | {(None, 5): 9, (None, 9): None, ("x", 1): None}


def test_catalogue(spark):
    """A version that comes back is active again; siblings of other contexts are superseded; no plans; only first prices."""
    p = lambda k, *prices: (k, k.upper(), [(x,) for x in prices])
    one, two = [p("free", 0), p("pro", 9, 90)], [p("pro", 12)]
    saves = [("s", "us", 1, one), ("s", "us", 2, two), ("s", "eu", 3, one), ("s", "us", 4, one), ("s", "us", 6, one), ("t", "us", 5, None), ("u", None, 1, [p("x")])]
    df = spark.createDataFrame(saves, "source string, context string, seq int, plans array<struct<key:string,name:string,prices:array<struct<amount:int>>>>")
    versions, plans, prices = K.catalogue(df, "source", "context", "seq", "plans", written)
    got = {(r.source, r.context, r.first_observed): (r.last_observed, r.saves, r.superseded_at, r.status) for r in versions.collect()}
    assert got == {("s", "us", 1): (6, 3, None, "active"), ("s", "us", 2): (2, 1, 3, "superseded"), ("s", "eu", 3): (3, 1, 4, "superseded"), ("t", "us", 5): (5, 1, None, "active"), ("u", None, 1): (1, 1, None, "active")}
    assert collections.Counter((r.source, r.context, r.status, r.display_order, r.plan_key) for r in plans.collect())[("s", "us", "active", 1, "pro")] == 1
    assert [(r.context, r.status, r.plan_name) for r in plans.collect() if r.source == "u"] == [(None, "active", "X")]
    assert sorted((r.source, r.context, r.plan_key, r.amount) for r in prices.collect() if r.source == "s") == [("s", "eu", "free", 0), ("s", "eu", "pro", 9), ("s", "us", "free", 0), ("s", "us", "pro", 9), ("s", "us", "pro", 12)]
