"""Structured Streaming: incremental projections, leased work queues, windows.

Every sink is idempotent by batch id: a batch that is run again writes the same version again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LEASE_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("key", T.StringType()), ("event", T.StringType()), ("status", T.StringType()), ("attempts", T.LongType()), ("token", T.LongType()))])
LEASE_STATE = T.StructType([T.StructField("status", T.StringType()), T.StructField("attempts", T.LongType()), T.StructField("token", T.LongType()), T.StructField("until", T.LongType()), T.StructField("ready", T.LongType())])


def read_files(spark: SparkSession, path: str, schema: str, per_trigger: int = 16) -> DataFrame:
    """A file source that resumes where its checkpoint stands."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def _versions(spark: SparkSession, root: str, buckets: int) -> dict[int, int]:
    """The newest version of each bucket's state."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/bucket=*/version=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    newest: dict[int, int] = {}
    for s in found or []:
        version, bucket = s.getPath().getParent(), s.getPath().getParent().getParent()
        b, v = int(bucket.getName().split("=")[1]), int(version.getName().split("=")[1])
        newest[b] = max(newest.get(b, -1), v)
    return newest


def _parts(spark: SparkSession, root: str, versions: dict[int, int]) -> DataFrame | None:
    paths = [f"{root}/bucket={b}/version={v}" for b, v in sorted(versions.items())]
    return spark.read.parquet(*paths) if paths else None


def projected(spark: SparkSession, root: str, keys: list[str], order: str, fill: list[str], buckets: int = 16) -> DataFrame | None:
    """The current rows of a projection; None before its first batch."""
    state = _parts(spark, root, _versions(spark, root, buckets))
    return None if state is None else state.select(*keys, order, *[F.col(f"{c}.value").alias(c) for c in fill])


def project(stream: DataFrame, root: str, checkpoint: str, keys: list[str], order: str, fill: list[str], buckets: int = 16) -> StreamingQuery:
    """Keeps the coalesced last values of a log (M1, T4), late rows included; nothing is dropped by a watermark.

    State holds each filled value with the order of the row it came from, so a late row wins only
    where its own order does.  State is dealt into buckets by key; a batch reads and writes only the
    buckets it touches, as a new version (its batch id).  A batch that runs again reads the versions
    before its own and writes the same files anew.  Read the result with `projected`.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        named = [F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("order"), F.col(c).alias("value"))).alias(c) for c in fill]
        rows = batch.select(*keys, order, *named, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket")).persist()
        try:
            touched = sorted(r[0] for r in rows.select("_bucket").distinct().collect())
            before = {}
            for b in touched:  # at most `buckets`
                path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/bucket={b}/version=*/_SUCCESS")
                found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
                seen = [v for s in found if (v := int(s.getPath().getParent().getName().split("=")[1])) < batch_id]
                if seen:
                    before[b] = max(seen)
            for b in touched:
                mine = rows.where(F.col("_bucket") == b).drop("_bucket")
                if b in before:
                    mine = mine.unionByName(spark.read.parquet(f"{root}/bucket={b}/version={before[b]}").select(*mine.columns))
                # The greatest struct is the one of the greatest order; nulls don't count.
                merged = mine.groupBy(*keys).agg(F.max(order).alias(order), *[F.max_by(c, F.col(f"{c}.order")).alias(c) for c in fill])
                merged.write.mode("overwrite").parquet(f"{root}/bucket={b}/version={batch_id}")
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def leases(stream: DataFrame, seconds: int = 60, most: int = 3, backoff: int = 0) -> DataFrame:
    """A work queue with fenced leases (T2, T3) over events (key, event, token, at).

    A key's events of one trigger are put in order as a whole, however Spark hands them over; the
    source's files per trigger bound how many those are.

    claim: grants a lease with the next token, if none is held at that time.  done and failed: count only
    with the current token; stale ones are ignored.  beat: prolongs a lease that is held.  After a failure the
    next claim waits backoff * 2**(attempts - 1) seconds; too many failures make a dead letter.
    Time is the events' own, so replays give the same answers.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, attempts, token, until, ready = state.get if state.exists else ("queued", 0, 0, 0, 0)
        rows = []
        for e in pd.concat(list(batches)).sort_values(["at", "event"]).itertuples():
            now, verdict = int(e.at.timestamp()), "ignored"
            held = status == "running" and now < until
            if e.event == "claim" and status not in ("dead", "done") and not held and now >= ready:
                if attempts >= most:
                    status, verdict = "dead", "dead"
                else:
                    status, attempts, token, until, verdict = "running", attempts + 1, token + 1, now + seconds, "granted"
            elif e.event == "beat" and held and e.token == token:  # a heartbeat prolongs the lease (T8)
                until, verdict = now + seconds, "prolonged"
            elif e.event in ("done", "failed") and held and e.token == token:
                status = "done" if e.event == "done" else "dead" if attempts >= most else "queued"
                ready = now + backoff * 2 ** (attempts - 1) if status == "queued" else ready
                verdict = status
            rows.append((key[0], verdict, status, attempts, token))
        state.update((status, attempts, token, until, ready))
        yield pd.DataFrame(rows, columns=[f.name for f in LEASE_SCHEMA])

    return stream.groupBy("key").applyInPandasWithState(step, LEASE_SCHEMA, LEASE_STATE, "append", GroupStateTimeout.NoTimeout)


def windowed_counts(stream: DataFrame, ts: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Extension: tumbling counts with a watermark."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def run_to_end(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    query = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
