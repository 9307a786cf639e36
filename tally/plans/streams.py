"""Queries that run a stream over whole tables to its end: retries, whole groups, fenced writes."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.plans.batches import shared_folder, written
from tally.plans.catalog import query
from tally.sources.commits import TableSet
from tally.sources.tables import table
from tally.streaming import runner as U
from tally.streaming import stateful as W

STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_store(spark: SparkSession):
    """The state store that timers need, for streams started here."""
    old = spark.conf.get(STORE)
    W.with_state_store(spark)
    try:
        yield
    finally:
        spark.conf.set(STORE, old)


@query("""
    WITH r AS (SELECT user_id AS k, ts, CASE WHEN event_type = 'error' AND event_id % 40 = 0 THEN 'fatal' WHEN event_type IN ('error', 'purchase', 'signup') THEN 'failed' ELSE 'ok' END AS outcome FROM events),
         s AS (SELECT *, row_number() OVER w AS i, count(*) FILTER (WHERE outcome = 'ok') OVER w AS g FROM r WINDOW w AS (PARTITION BY k ORDER BY ts, outcome ROWS UNBOUNDED PRECEDING)),
         n AS (SELECT *, count(*) FILTER (WHERE outcome <> 'ok') OVER (PARTITION BY k, g ORDER BY i ROWS UNBOUNDED PRECEDING) AS streak FROM s),
         d AS (SELECT *, min(CASE WHEN outcome = 'fatal' OR streak >= 6 THEN i END) OVER (PARTITION BY k) AS dead FROM n),
         a AS (SELECT k, i, CASE WHEN outcome = 'ok' THEN 'done' WHEN i = dead THEN 'dead' ELSE 'waiting' END AS action, streak AS attempts,
                      epoch_ms(ts) + CASE WHEN outcome = 'ok' OR i = dead THEN 0 ELSE 1000 * least(3600, 60 * power(2, streak - 1)) END AS ms FROM d WHERE dead IS NULL OR i <= dead),
         l AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY k ORDER BY i DESC) = 1),
         x AS (SELECT k, action, attempts, ms FROM a UNION ALL SELECT k, 'retry', attempts, ms FROM l WHERE action = 'waiting' AND ms < (SELECT epoch_ms(max(ts)) - 3600000 FROM events))
    SELECT CAST(k AS VARCHAR) AS key, action, CAST(attempts AS BIGINT) AS attempts, CAST(floor(ms / 1000) AS BIGINT) AS second FROM x""")
def retried_events(spark: SparkSession, d: str) -> DataFrame:
    """Each user's events as attempts: waits that double, a retry where the wait is over, dead letters."""
    kind = F.col("event_type")
    outcome = F.when((kind == "error") & (F.col("event_id") % 40 == 0), "fatal").when(kind.isin("error", "purchase", "signup"), "failed").otherwise("ok")
    events = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*")
    results = events.select(F.col("user_id").alias("key"), F.col("ts").cast("timestamp").alias("at"), outcome.alias("outcome"), kind.alias("error"))
    out = shared_folder(spark, "retries")
    with state_store(spark):
        U.to_files(W.retries(results, most=6), out)
    return spark.read.schema(W.RETRIES).parquet(f"{out}/data").select("key", "action", "attempts", F.unix_seconds("at").alias("second"))


@query("""
    WITH p AS (SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS part, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
         w AS (SELECT l_orderkey AS k, n, sum(CAST(l_quantity AS BIGINT)) AS total, string_agg(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), ',' ORDER BY part) AS quantities FROM p WHERE l_orderkey % 10 <> 0 AND n <= 6 GROUP BY 1, 2)
    SELECT 'group' AS kind, k, CAST(n AS BIGINT) AS n, quantities AS detail FROM w UNION ALL SELECT 'total', k, CAST(total AS BIGINT), 'whole' FROM w
    UNION ALL SELECT DISTINCT 'fate', l_orderkey, n, 'refused' FROM p WHERE l_orderkey % 10 <> 0 AND n > 6 UNION ALL SELECT DISTINCT 'fate', l_orderkey, n + 1, 'refused' FROM p WHERE l_orderkey % 10 = 0 AND n + 1 > 6""")
def streamed_groups(spark: SparkSession, d: str) -> DataFrame:
    """The lines of an order as a group that comes in three lots of files, its parts apart: it is written whole, to two tables in one commit, or not at
    all (T7).  Orders that end in 0 lack a line and don't pass; those of more than six lines are refused."""
    lines = table(spark, d, "lineitem")
    quantity = F.col("l_quantity").cast("long").cast("string")
    held = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", quantity.alias("payload")))).alias("lines"))
    size = F.size("lines") + F.when(F.col("l_orderkey") % 10 == 0, 1).otherwise(0)
    parts = held.select(F.col("l_orderkey").alias("key"), size.alias("parts"), F.posexplode("lines").alias("part", "_l")).select("key", "part", "parts", "_l.payload", F.lit("2026-01-01").cast("timestamp").alias("at"))
    root = shared_folder(spark, "groups")
    parts, files = written(parts), int(spark.conf.get("spark.sql.shuffle.partitions"))
    for i in range(3):
        parts.where(F.col("part") % 3 == i).coalesce(files).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(parts.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in")
    store = TableSet(spark, f"{root}/store")

    def tables(batch: DataFrame) -> dict[str, DataFrame]:
        whole = batch.where("action = 'whole'")
        total = F.aggregate("payload", F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
        return {"groups": whole.select("key", "parts", "payload"), "totals": whole.select("key", total.alias("total")), "fates": batch.where("action <> 'whole'").select("key", "parts", "action")}

    sink = U.gathering_sink(store, "parts", tables, most=6)
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    now = store.snapshot()
    key = F.col("key").cast("long").alias("k")
    out = now.read("groups").select(F.lit("group").alias("kind"), key, F.col("parts").alias("n"), F.array_join("payload", ",").alias("detail"))
    out = out.unionByName(now.read("totals").select(F.lit("total").alias("kind"), key, F.col("total").alias("n"), F.lit("whole").alias("detail")))
    return out.unionByName(now.read("fates").select(F.lit("fate").alias("kind"), key, F.col("parts").alias("n"), F.col("action").alias("detail")))


@query("""
    WITH t AS (SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'O' THEN 'processing' WHEN 'F' THEN 'done' ELSE 'queued' END AS status, o_orderkey % 4 AS generation, 't' || (o_orderkey % 7) AS token FROM orders),
         w AS (SELECT l_orderkey AS k, CASE WHEN min(l_partkey) % 3 = 0 THEN l_orderkey % 4 + 1 ELSE l_orderkey % 4 END AS generation, CASE WHEN min(l_suppkey) % 4 = 0 THEN 'old' ELSE 't' || (l_orderkey % 7) END AS token,
                      CASE min(l_returnflag) WHEN 'A' THEN 'valid_product_page' WHEN 'N' THEN 'captcha' ELSE 'access_denied' END AS state, 'line ' || count(*) AS reason, repeat('evidence ', CAST(sum(l_linenumber) AS INTEGER)) AS evidence FROM lineitem GROUP BY 1)
    SELECT t.k, t.status, t.generation, t.token, w.state AS page_state, substr(w.reason || ':' || w.evidence, 1, 500) AS page_state_reason, CASE WHEN w.k IS NOT NULL THEN '2026-01-01' END AS last_page_checked_at, CASE WHEN w.k IS NOT NULL THEN '2026-01-01' ELSE '2025-12-31' END AS updated_at
    FROM t LEFT JOIN w ON t.k = w.k AND t.generation = w.generation AND t.token = w.token AND t.status = 'processing'""")
def guarded_page_states(spark: SparkSession, d: str) -> DataFrame:
    """Page states written under the lease (M28): each order is a task, its lines an assessment by a worker whose generation or token may be
    old; only a write that still holds the lease of a task in work counts."""
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    tasks = table(spark, d, "orders").select(
        k.alias("k"), F.when(status == "O", "processing").when(status == "F", "done").otherwise("queued").alias("status"), (k % 4).alias("generation"), F.concat(F.lit("t"), (k % 7).cast("string")).alias("token"),
        *[F.lit(None).cast("string").alias(c) for c in ("page_state", "page_state_reason", "last_page_checked_at")], F.lit("2025-12-31").alias("updated_at"),
    )
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"), F.min("l_returnflag").alias("flag"), F.count("*").alias("n"), F.sum("l_linenumber").cast("int").alias("m"))
    assessed = lines.select(
        "k", (F.col("k") % 4 + F.when(F.col("p") % 3 == 0, 1).otherwise(0)).alias("generation"), F.when(F.col("s") % 4 == 0, "old").otherwise(F.concat(F.lit("t"), (F.col("k") % 7).cast("string"))).alias("token"),
        F.when(F.col("flag") == "A", "valid_product_page").when(F.col("flag") == "N", "captcha").otherwise("access_denied").alias("state"), F.concat(F.lit("line "), F.col("n").cast("string")).alias("reason"), F.expr("repeat('evidence ', m)").alias("evidence"),
    )
    writes = U.page_state_writes(assessed, ["k"], ["generation", "token"], F.lit("2026-01-01"))
    store = TableSet(spark, shared_folder(spark, "tasks"))
    U.create_bucketed(store, "tasks", tasks, ["k"], 4)
    after, _ = U.update_fenced(store, "tasks", writes, ["k"], ["generation", "token"], F.col("status") == "processing", ["page_state", "page_state_reason", "last_page_checked_at", "updated_at"])
    return U.read_bucketed(after, "tasks")
