"""Queue, lease, version and audit rules over whole tables.

A table's next state is a function of its last state and a batch of changes: joins and CASE
columns, never row-by-row updates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def requeue(tasks: DataFrame, wanted: DataFrame, keys: list[str], generation: str = "generation", status: str = "status") -> DataFrame:
    """Guarded re-queue (M4): new keys start queued; done ones start over with the next generation; others stay."""
    old = tasks.select(*keys, F.struct(status, generation, "attempts").alias("_o"))
    new = wanted.select(*keys).distinct().withColumn("_w", F.lit(True))
    both = old.join(new, keys, "full")
    again = F.col("_w") & (F.col("_o").isNull() | (F.col(f"_o.{status}") == "done"))
    return both.select(
        *keys, F.when(again, "queued").otherwise(F.col(f"_o.{status}")).alias(status),
        F.when(F.col("_o").isNull(), F.lit(1).cast("long")).when(again, F.col(f"_o.{generation}") + 1).otherwise(F.col(f"_o.{generation}")).alias(generation),
        F.when(again, F.lit(0).cast("long")).otherwise(F.col("_o.attempts")).alias("attempts"),
    )


def fenced(results: DataFrame, leases: DataFrame, keys: list[str]) -> DataFrame:
    """Results whose generation and token still hold the lease."""
    return results.join(leases.select(*keys, "generation", "token"), [*keys, "generation", "token"], "left_semi")


def after_failure(attempts: Column, most: Column, retryable: Column) -> Column:
    """dead for attempts that are used up or errors that won't go away, else failed."""
    return F.when(~retryable | (attempts >= most), "dead").otherwise("failed")


def fill_blanks(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], review: str) -> DataFrame:
    """First non-empty value wins, unless the row awaits review (M9)."""
    n = new.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    both = old.join(n, keys, "left")
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    return both.withColumns({c: F.when(blank(c) | (F.col(review) == "needs_review"), F.coalesce(f"_{c}", c)).otherwise(F.col(c)) for c in columns}).drop(*[f"_{c}" for c in columns])


def supersede(rows: DataFrame, keys: list[str], run: str, status: str = "status", source: str = "source") -> DataFrame:
    """Automatic rows of older runs are superseded by the newest run of their key; manual ones stay."""
    newest = rows.groupBy(*keys).agg(F.max(run).alias("_run"))
    old = (F.col(run) < F.col("_run")) & (F.col(source) != "manual")
    return rows.join(newest, keys).withColumn(status, F.when(old, "superseded").otherwise(F.col(status))).drop("_run")


def content_versions(log: DataFrame, keys: list[str], order: str, content: list[str]) -> DataFrame:
    """Versions by content hash (M12): a version lasts while its content does, then is superseded."""
    w = Window.partitionBy(*keys).orderBy(order)
    h = log.withColumn("version_hash", F.sha2(F.to_json(F.struct(*content)), 256))
    h = h.withColumn("_new", (~F.col("version_hash").eqNullSafe(F.lag("version_hash").over(w))).cast("int")).withColumn("version", F.sum("_new").over(w))
    runs = h.groupBy(*keys, "version", "version_hash").agg(F.min(order).alias("first_seen"), F.max(order).alias("last_seen"), F.count("*").alias("seen"))
    after = F.lead("first_seen").over(Window.partitionBy(*keys).orderBy("version"))
    return runs.withColumn("superseded_at", after).withColumn("status", F.when(F.col("superseded_at").isNull(), "active").otherwise("superseded"))


def claimable(rows: DataFrame, now: Column, most: int = 5, stale_hours: int = 1) -> DataFrame:
    """Work not started, failed, or stuck for an hour."""
    stuck = (F.col("status") == "running") & (F.col("updated_at") <= now - F.expr(f"INTERVAL {stale_hours} HOURS"))
    return rows.where((F.col("status").isin("pending", "failed") | stuck) & (F.col("attempts") < most))


def failure_streak(events: DataFrame, keys: list[str], order: str, failed: str, limit: int = 3) -> DataFrame:
    """Failures since the last success; from `limit` on a person is asked."""
    last_ok = events.groupBy(*keys).agg(F.max(F.when(~F.col(failed), F.col(order))).alias("_ok"))
    n = F.count_if(F.col(failed) & (F.col("_ok").isNull() | (F.col(order) > F.col("_ok"))))
    return events.join(last_ok, keys).groupBy(*keys).agg(n.alias("failures")).withColumn("state", F.when(F.col("failures") >= limit, "needs_manual").otherwise("automatic"))


def write_plan(assignments: DataFrame, tree: DataFrame, item: str, leaf: str) -> DataFrame:
    """Leaf and parent ids of each item, distinct and in order; items with an unknown leaf come apart."""
    t = tree.select(F.col("slug").alias("_slug"), F.col("id").alias("_id"), F.col("parent_id").alias("_parent"))
    j = assignments.join(F.broadcast(t), F.col(leaf) == F.col("_slug"), "left")
    one = j.select(item, F.explode(F.array("_id", "_parent")).alias("_one"), F.col("_id").isNull().alias("_unknown"))
    return one.groupBy(item).agg(F.array_sort(F.collect_set("_one")).alias("ids"), F.max("_unknown").alias("invalid"))


def current_rows(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One current row per key (M23): a changed value retires the old row, an unchanged one touches nothing."""
    o = old.where("is_current").select(*keys, F.struct(*values).alias("_o"))
    changed = new.join(o, keys, "left").where(F.col("_o").isNull() | ~F.col("_o").eqNullSafe(F.struct(*values)))
    gone = changed.select(*keys).distinct().withColumn("_gone", F.lit(True))
    kept = old.join(gone, keys, "left").withColumn("is_current", F.col("is_current") & F.col("_gone").isNull()).drop("_gone")
    return kept.unionByName(changed.select(*keys, *values, F.lit(True).alias("is_current")))


def audit(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One event per changed value."""
    both = old.select(*keys, F.col(value).alias("old_value")).join(new.select(*keys, F.col(value).alias("new_value")), keys, "full")
    return both.where(~F.col("old_value").eqNullSafe(F.col("new_value")))


def untouched(before: DataFrame, after: DataFrame) -> bool:
    """Whether two tables hold the same rows."""
    return before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


def confidence_band(confidence: Column, accept: float = 0.8, provisional: float = 0.5) -> Column:
    return F.when(confidence >= accept, "auto_accepted").when(confidence >= provisional, "provisional").otherwise("unresolved")


def circuit_breaker(rows: DataFrame, keys: list[str], order: str, error: str, pattern: str) -> DataFrame:
    """Rows after the first provider error of a batch are deferred."""
    first = rows.groupBy(*keys).agg(F.min(F.when(F.col(error).rlike(pattern), F.col(order))).alias("_at"))
    state = F.when(F.col("_at").isNull() | (F.col(order) < F.col("_at")), "run").when(F.col(order) == F.col("_at"), "tripped").otherwise("deferred")
    return rows.join(first, keys).withColumn("state", state).drop("_at")


def release_gate(observations: DataFrame, keys: list[str]) -> DataFrame:
    """A month is available once an observation is done and has visits or a rank."""
    ok = (F.col("status") == "done") & (F.col("visits").isNotNull() | F.col("global_rank").isNotNull())
    return observations.groupBy(*keys).agg(F.when(F.max(ok), "available").otherwise("unavailable").alias("status"), F.count("*").alias("attempts"))


def probe_due(keys: DataFrame, observed: DataFrame, on: list[str], before: Column) -> DataFrame:
    """Whether a release must be probed (G9): never seen, or not available and last checked by `before`.

    observed: the keys, available, checked_at; one row a key.
    """
    j = keys.join(observed.withColumn("_seen", F.lit(True)), on, "left")
    return j.select(*on, F.when(F.col("_seen").isNull(), True).when(F.col("available"), False).otherwise(F.col("checked_at") <= before).alias("due"))
