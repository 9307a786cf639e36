"""Writes as table rules: retries, recovery, replacement with audit, positions, decisions, telemetry.

A write is a function of the old table and a batch; the caller stores the result as a new
version.  What a database would return from an UPDATE is the DataFrame itself (M20).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Minutes until a retry, by kind of work.
DAY, ASSET_HOURS, PRICING_HOURS = 1440, [6, 24, 72], 6
PAGE_BYTES, PAGE_TYPES = 1_200_000, r"(?i)\b(?:html|xml|text)\b"


def retry_minutes(kind: str, attempts: Column) -> Column:
    """Delay before the next attempt (M19): a day for traffic, 6, 24 and 72 hours for assets, doubling
    minutes up to an hour for ratings, six hours for pricing."""
    if kind == "assets":
        return F.when(attempts <= 1, ASSET_HOURS[0] * 60).when(attempts == 2, ASSET_HOURS[1] * 60).otherwise(ASSET_HOURS[2] * 60)
    if kind == "rating":
        return F.least(F.lit(60), F.pow(F.lit(2), F.least(attempts, F.lit(6)))).cast("int")
    return F.lit({"traffic": DAY, "pricing": PRICING_HOURS * 60}[kind])


def recover(rows: DataFrame, dead: Column, order: list[str], most: int, status: str = "status") -> DataFrame:
    """Queues the first `most` dead rows again (M22): a top-k and a join, no sort of the table.  The last
    column of `order` is the unique key."""
    key = order[-1]
    top = rows.where(dead).orderBy(*order).limit(most).select(F.col(key).alias("_again"))
    again = rows.join(F.broadcast(top), F.col(key) == F.col("_again"), "left")
    return again.withColumn(status, F.when(F.col("_again").isNotNull(), "queued").otherwise(F.col(status))).drop("_again")


def discovery_backoff(rows: DataFrame, now: Column, most: int, first_hours: int = 24) -> DataFrame:
    """A failed search (M17): attempts go up, waits double, and at `most` the search is exhausted."""
    n = F.col("attempts") + 1
    over = n >= most
    wait = F.make_dt_interval(hours=(F.lit(first_hours) * F.pow(F.lit(2), n - 1)).cast("int"))
    return rows.select(*[c for c in rows.columns if c != "attempts"], n.alias("attempts"), F.when(over, "exhausted").otherwise("not_found").alias("status"), F.when(~over, now + wait).alias("next_at"))


def replace_automatic(old: DataFrame, new: DataFrame, keys: list[str], values: list[str], source: str = "source") -> tuple[DataFrame, DataFrame]:
    """Replaces the automatic rows of the keys that a batch names; returns the new table and its audit.

    Manual rows stay, and a proposal equal to one adds nothing.  Audit: one row for each row added or removed.
    """
    new = new.select(*keys, *values).distinct()
    named = new.select(*keys).distinct()
    manual = old.where(F.col(source) == "manual")
    auto = old.where(F.col(source) != "manual")
    added = new.join(manual.select(*keys, *values), [*keys, *values], "left_anti").withColumn(source, F.lit("auto"))
    gone = auto.join(named, keys, "left_semi")
    table = manual.unionByName(auto.join(named, keys, "left_anti")).unionByName(added)
    events = gone.select(*keys, *values).distinct().withColumn("_o", F.lit(True)).join(added.select(*keys, *values).withColumn("_n", F.lit(True)), [*keys, *values], "full")
    events = events.where("_o IS NULL OR _n IS NULL").select(*keys, *values, F.when(F.col("_n").isNull(), "removed").otherwise("added").alias("event"))
    return table, events


def positions(lists: DataFrame, keys: list[str], items: str, name: str, most: int) -> DataFrame:
    """The first items of each list as rows with their places from 1."""
    rows = lists.select(*keys, F.posexplode(F.slice(items, 1, most)).alias("_p", name))
    return rows.select(*keys, (F.col("_p") + 1).alias("position"), name)


def highlights(stored: str, new: str) -> Column:
    """JSON array of highlights: the stored one unless it is empty or missing."""
    n = F.coalesce(F.json_array_length(F.col(stored)), F.lit(0))
    return F.when(n > 0, F.col(stored)).otherwise(F.col(new))


def safety_decision(published: str, label: str, evidence: str, most: int = 12) -> list[Column]:
    """Status and evidence to store (M26): a published entry is only proposed as nsfw."""
    proposed = F.col(published) & (F.col(label) == "nsfw")
    kept = F.when(proposed, F.array_append(F.col(evidence), F.lit("proposed:nsfw"))).otherwise(F.col(evidence))
    return [F.when(proposed, "needs_review").otherwise(F.col(label)).alias("status"), F.slice(kept, 1, most).alias("evidence")]


def telemetry(rows: DataFrame, keys: list[str], outcome: str, ts: str) -> DataFrame:
    """Runs with their counts; degraded when anything failed or went stale."""
    n = lambda v: F.count_if(F.col(outcome) == v)
    bad = ("failed", "materialization_failed", "stale")
    out = rows.groupBy(*keys).agg(F.count("*").alias("items"), *[n(v).alias(v) for v in bad], F.min(ts).alias("started_at"), F.max(ts).alias("finished_at"))
    return out.withColumn("status", F.when(sum(F.col(v) for v in bad) > 0, "degraded").otherwise("ok"))


def limited_pages(pages: DataFrame, html: str, kind: str, most: int = PAGE_BYTES) -> DataFrame:
    """Adds status and body (S14): only pages of a text type and of at most `most` characters have one."""
    ok = F.coalesce(F.col(kind), F.lit("")).rlike(PAGE_TYPES)
    status = F.when(~ok, "unsupported_type").when(F.length(html) > most, "too_large").otherwise("ok")
    return pages.withColumn("status", status).withColumn("body", F.when(F.col("status") == "ok", F.col(html)))


def payload_status(code: Column, has_month: Column) -> Column:
    """Status of a provider's answer."""
    return F.when(code == 404, "no_data").when(code == 403, "forbidden").when(code != 200, "failed").when(has_month, "done").otherwise("no_data")


def combined(ratings: DataFrame, births: DataFrame, keys: list[str]) -> DataFrame:
    """One observation of both sources (S13): the rating, clamped to 0..100, owns the status."""
    both = ratings.join(births, keys, "full")
    rating = F.when(F.col("rating").isNotNull(), F.least(F.greatest("rating", F.lit(0.0)), F.lit(100.0)))
    return both.select(*keys, rating.alias("rating"), "born", F.when(F.col("rating").isNull(), "failed").otherwise("done").alias("status"))


def fan_out(batch: DataFrame, targets: dict[str, DataFrame], root: str, batch_id: int) -> None:
    """Writes several tables derived from one batch (S8, S9): each under its batch id, so a batch that runs again
    replaces its own files and nothing else."""
    for name, rows in targets.items():
        rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")


def written(df: DataFrame, path: str, mode: str = "append") -> int:
    """Appends rows and returns how many (S3), counted by the write itself."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(path)
    return seen.get["n"]
