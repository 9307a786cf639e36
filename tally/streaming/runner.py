"""Streams run under a lease: polling, heartbeats, takeover, fenced and atomic writes."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tally.sources.commits import Conflict, Snapshot, TableSet, numbers, publish, read_json


class Lease:
    """A lease by name in a shared folder, taken by one owner at a time.

    Each change is a file <root>/<name>/<turn> that must not meet an existing one, so of two owners that try at once one wins.  Whoever
    takes it over gets a higher token; a lease that wasn't renewed in time, or was given back, is free.  Clocks of the owners may
    differ by less than `seconds`; writes are safe whatever the clocks say, by the token (`TableSet.commit`).
    """

    def __init__(self, spark: SparkSession, root: str, name: str, owner: str, seconds: float = 60, clock: Callable[[], float] = time.time):
        self.spark, self.folder, self.owner, self.seconds, self.clock = spark, f"{root.rstrip('/')}/{name}", owner, seconds, clock
        self.token: int | None = None
        self._lock = threading.Lock()
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)

    def current(self) -> dict:
        """The newest state: turn, owner, token, until."""
        while True:
            turn = max(numbers(self.spark, self.folder), default=0)
            if not turn:
                return {"turn": 0, "owner": None, "token": 0, "until": 0.0}
            try:
                return read_json(self.spark, f"{self.folder}/{turn:012d}") | {"turn": turn}
            except Exception:
                if turn == max(numbers(self.spark, self.folder), default=0):  # not just pruned by a newer turn
                    raise

    def _put(self, turn: int, owner: str | None, token: int, until: float) -> bool:
        if not publish(self.spark, f"{self.folder}/{turn:012d}", {"owner": owner, "token": token, "until": until}):
            return False
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        for old in numbers(self.spark, self.folder):
            if old < turn - 4:
                path = fs_path(f"{self.folder}/{old:012d}")
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, False)
        return True

    def acquire(self) -> bool:
        """Takes the lease if it is free."""
        with self._lock:
            now = self.current()
            if now["owner"] is not None and now["until"] > self.clock():
                return now["owner"] == self.owner and now["token"] == self.token
            self.token = now["token"] + 1 if self._put(now["turn"] + 1, self.owner, now["token"] + 1, self.clock() + self.seconds) else None
            return self.token is not None

    def renew(self) -> bool:
        """Prolongs the lease; False once it was taken over.  One that ran out and that nobody took is still the owner's."""
        with self._lock:
            now = self.current()
            held = self.token is not None and now["owner"] == self.owner and now["token"] == self.token
            return held and self._put(now["turn"] + 1, self.owner, self.token, self.clock() + self.seconds)

    def release(self) -> None:
        with self._lock:
            now = self.current()
            if self.token is not None and now["token"] == self.token and now["owner"] == self.owner:
                self._put(now["turn"] + 1, None, self.token, 0.0)
            self.token = None


class Heartbeats(StreamingQueryListener):
    """Renews a lease with every progress of a query, or idle turn, and keeps the run's newest state in one small file."""

    def __init__(self, spark: SparkSession, lease: Lease, path: str):
        self.spark, self.lease, self.path = spark, lease, path
        self.run: str | None = None
        self._ending = threading.Lock()
        self.state: dict = {"owner": lease.owner, "token": lease.token, "status": "running", "batch": None, "rows": 0, "beats": 0, "error": None}

    def _write(self, **changes) -> None:
        self.state |= changes | {"at": time.time()}
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        stream = target.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(target, True)
        stream.write(bytearray(json.dumps(self.state).encode()))
        stream.close()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass  # the run's id is set by run_leased, before its first progress

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if str(p.runId) == self.run:
            self.lease.renew()
            self._write(batch=p.batchId, rows=self.state["rows"] + max(0, int(p.numInputRows)), beats=self.state["beats"] + 1)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        if str(event.runId) == self.run:
            self.lease.renew()
            self._write(beats=self.state["beats"] + 1)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if str(event.runId) == self.run:
            self.end(event.exception)

    def end(self, exception: str | None) -> None:
        """The run's last state; the lease is given back.  The first call counts."""
        with self._ending:
            if self.state["status"] == "running":
                self._write(status="failed" if exception else "done", error=(exception or "")[:2000] or None)
                self.lease.release()


def run_leased(spark: SparkSession, lease: Lease, start: Callable[[int], StreamingQuery], path: str, beat_seconds: float = 30) -> StreamingQuery | None:
    """Starts a query if the lease is free, else returns None (poll again later).

    start gets the lease's token, for its writes.  Progress renews the lease; so does a thread every beat_seconds, for batches that
    take long.  A run that has lost its lease stops its query.  `path`: the file that holds the run's state.
    """
    if not lease.acquire():
        return None
    beats = Heartbeats(spark, lease, path)
    spark.streams.addListener(beats)
    query = start(lease.token)
    beats.run = str(query.runId)
    beats._write()

    def keep() -> None:
        failure = None
        try:
            while not query.awaitTermination(beat_seconds):
                if not lease.renew():
                    query.stop()
                    break
        except Exception as e:
            failure = str(e)
        for _ in range(50):  # the last events may still be on their way
            if beats.state["status"] != "running":
                break
            time.sleep(0.1)
        beats.end(failure)
        spark.streams.removeListener(beats)

    query._keeper = threading.Thread(target=keep, daemon=True)
    query._keeper.start()
    return query


def atomic_sink(store: TableSet, name: str, tables: Callable[[DataFrame], dict[str, DataFrame]], token: int | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink: what `tables` makes of a micro-batch is appended to all its tables in one commit, once however often the
    batch runs, and not after a higher token has committed (T7).  A group that is one row of the stream can't be split."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            store.commit(append=tables(batch), by=(name, batch_id), fence=None if token is None else (name, token))
        finally:
            batch.unpersist()

    return sink


def gathering_sink(store: TableSet, name: str, tables: Callable[[DataFrame], dict[str, DataFrame]], late_seconds: int = 3600, most: int = 32, patience_seconds: int = 86_400, token: int | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink for parts of groups (key, part, parts, payload, at), with the rules of `stateful.whole_groups`, for bulk data.

    What `tables` makes of the groups that a batch decides (key, action, parts, payload, at) is appended in one commit with the state, so a
    batch that runs again changes nothing.  State is three tables of the set: <name>.open holds the parts of groups that wait and
    is replaced, <name>.done the keys of finished ones, <name>.clock the newest time seen.  A batch is a join and a grouping of its own
    rows with what is open, on Spark's side alone; it costs a scan of the finished keys as well, so batches should be large.
    Of a part that comes again while its group waits the newest counts.  A group is `incomplete` in the batch whose rows, less
    `late_seconds`, pass its last part by `patience_seconds`.
    """
    waiting, done, clock = (f"{name}.{x}" for x in ("open", "done", "clock"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        base = store.snapshot()
        if base.done.get(name, -1) >= batch_id:
            return
        spark, late, patience = batch.sparkSession, late_seconds * 1_000_000, patience_seconds * 1_000_000
        before = base.read(clock).first()[0] if clock in base.parts else None
        at = F.unix_micros(F.col("at").cast("timestamp"))
        rows = batch.select(F.coalesce(F.col("key").cast("string"), F.lit("")).alias("key"), F.col("part").cast("long").alias("part"), F.col("parts").cast("long").alias("parts"), F.col("payload").cast("string").alias("payload"), at.alias("at"))
        rows = rows.where("at IS NOT NULL AND part IS NOT NULL AND parts IS NOT NULL")
        if before is not None:
            rows = rows.where(F.col("at") > before - late)
        # Only places that count are held, so a group holds at most `most` payloads.
        rows = rows.withColumn("part", F.when((F.col("part") >= 0) & (F.col("part") < F.col("parts")) & (F.col("parts") <= most), F.col("part"))).withColumn("last", F.col("at"))
        if done in base.parts:
            rows = rows.join(base.read(done), "key", "left_anti")
        if waiting in base.parts:
            rows = rows.unionByName(base.read(waiting))
        newest = F.max_by(F.struct("payload", "at"), F.struct("at", "payload")).alias("p")
        held = rows.repartition("key").groupBy("key", "part").agg(F.max("parts").alias("parts"), F.max("last").alias("last"), newest)
        piece = F.when(F.col("part").isNotNull(), F.struct("part", "p.payload", "p.at"))
        groups = held.groupBy("key").agg(F.max("parts").alias("parts"), F.max("last").alias("last"), F.array_sort(F.collect_list(piece)).alias("held"))
        path = f"{store.root}/steps/{name}-{batch_id}"
        groups.write.mode("overwrite").parquet(path)
        groups = spark.read.schema(groups.schema).parquet(path)
        now = max((x for x in (before, groups.agg(F.max("last")).first()[0]) if x is not None), default=None)
        action = F.when(F.col("parts") > most, "refused").when((F.col("parts") > 0) & (F.size("held") == F.col("parts")), "whole")
        groups = groups.withColumn("action", action.when(F.col("last") + patience <= F.lit(now).cast("long") - late, "incomplete"))
        decided, still = groups.where("action IS NOT NULL"), groups.where("action IS NULL")
        payload = F.when(F.col("action") == "whole", F.col("held.payload")).alias("payload")
        out = tables(decided.select("key", "action", "parts", payload, F.timestamp_micros("last").alias("at")))
        still = still.select("key", "parts", "last", F.explode_outer("held").alias("h")).select("key", "h.part", "parts", "h.payload", F.coalesce("h.at", "last").alias("at"), "last")
        state = {waiting: still, clock: spark.range(1).select(F.lit(now).cast("long").alias("at"))}
        store.commit(replace=state, append=out | {done: decided.select("key")}, base=base, by=(name, batch_id), fence=None if token is None else (name, token))
        store.remove(path)

    return sink


def to_files(stream: DataFrame, root: str) -> None:
    """Runs a stream to the end of its input into files below root/data, resuming at root/checkpoint."""
    stream.writeStream.format("parquet").option("path", f"{root}/data").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def create_bucketed(store: TableSet, table: str, rows: DataFrame, keys: list[str], buckets: int = 16) -> Snapshot:
    """Stores a table in buckets of its keys, each a table of the set, so that an update rewrites only those it touches."""
    marked = rows.withColumn("_b", _bucket(keys, buckets)).persist()
    try:
        return store.commit(replace={f"{table}.{b:04d}": marked.where(F.col("_b") == b).drop("_b") for b in range(buckets)})
    finally:
        marked.unpersist()


def read_bucketed(snapshot: Snapshot, table: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [snapshot.read(t) for t in sorted(snapshot.parts) if t.rpartition(".")[0] == table])


def update_fenced(store: TableSet, table: str, writes: DataFrame, keys: list[str], fence: list[str], held: Column, columns: list[str], tries: int = 10) -> tuple[Snapshot, int]:
    """Writes columns of rows whose lease still holds (M28): the row has the write's keys and `fence` values (generation, token), and fulfils
    `held`.  Stale and unknown writes change nothing.  Returns the state after it and how many rows were written.

    writes: keys, fence and columns, one row a key (of several, the smallest values count).  Compare and set: buckets that another
    commit changed meanwhile are read again, so two runners' writes can't undo one another; only touched buckets are rewritten.
    """
    one = writes.groupBy(*keys, *fence).agg(F.min(F.struct(*columns)).alias("_new"))
    buckets = sum(1 for t in store.snapshot().parts if t.rpartition(".")[0] == table)
    one = one.withColumn("_b", _bucket(keys, buckets)).persist()
    try:
        touched = sorted(r[0] for r in one.select("_b").distinct().collect())  # at most the number of buckets
        for _ in range(tries):
            base, changes = store.snapshot(), {}
            written = 0
            for b in touched:
                name = f"{table}.{b:04d}"
                rows = base.read(name)
                mine = one.where(F.col("_b") == b).select(*[F.col(k).alias(f"_w{i}") for i, k in enumerate([*keys, *fence])], "_new")
                same = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"_w{i}") for i, k in enumerate([*keys, *fence])])
                joined = rows.join(mine, same & F.coalesce(held, F.lit(False)), "left")
                n = joined.where("_new IS NOT NULL").count()
                if n:
                    written += n
                    changes[name] = joined.select(*[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns])
            if not changes:
                return base, 0
            try:
                return store.commit(replace=changes, base=base), written
            except Conflict:
                continue
        raise Conflict(f"{table}: {tries} tries")
    finally:
        one.unpersist()


def page_state_writes(assessed: DataFrame, keys: list[str], fence: list[str], now: Column) -> DataFrame:
    """Writes of page assessments (keys, fence, state, reason, evidence): state, `reason:evidence` of at most 500 characters, times."""
    said = F.substring(F.concat(F.coalesce("reason", F.lit("")), F.lit(":"), F.coalesce("evidence", F.lit(""))), 1, 500)
    return assessed.select(*keys, *fence, F.col("state").alias("page_state"), said.alias("page_state_reason"), now.alias("last_page_checked_at"), now.alias("updated_at"))
