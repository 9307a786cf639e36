"""Deduplication, latest rows, nearest baselines, upserts, set reconciliation and history.

Every operator takes and returns DataFrames, uses built-in aggregates where they combine before
the shuffle, and orders by a unique key, so results don't depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list, order: list) -> DataFrame:
    """One row per key: the first in `order` (W1).  Spark limits groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest in `order` (W2, J12); an aggregation, so hot keys combine early."""
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_top"))
    return top.select(*keys, *[F.col(f"_top.{c}").alias(c) for c in rest])


def nearest_baseline(history: DataFrame, key: str, day: str, value: str, low: int, high: int, target: int) -> DataFrame:
    """Latest value of each key and the earlier one nearest to `target` days back.

    A candidate is low to high days older; ties go to the later day.  Keys without a candidate stay,
    with null baseline.
    """
    now = history.groupBy(key).agg(F.max(day).alias("latest_day"), F.max_by(value, F.col(day)).alias("latest_value"))
    aged = history.join(now.select(key, "latest_day"), key).withColumn("_age", F.datediff("latest_day", day)).where(F.col("_age").between(low, high))
    base = aged.groupBy(key).agg(F.min_by(F.struct(F.col(day).alias("d"), F.col(value).alias("v"), F.col("_age").alias("a")), F.struct(F.abs(F.col("_age") - target), F.col("_age"))).alias("b"))
    return now.join(base, key, "left").select(key, "latest_day", "latest_value", F.col("b.d").alias("base_day"), F.col("b.v").alias("base_value"), F.col("b.a").alias("days"))


def longest_suffix(names: DataFrame, name: str, services: DataFrame, suffix: str, value: str) -> DataFrame:
    """The service of the longest suffix of dotted names (J18): suffixes are exploded and equi-joined."""
    labels = F.split(F.col(name), r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = names.select(name, F.explode(ends).alias("_end")).distinct().join(services.select(F.col(suffix).alias("_s"), F.col(value)), F.col("_end") == F.col("_s"))
    best = each.groupBy(name).agg(F.max_by(value, F.struct(F.length("_end"), F.col(value))).alias(value))
    return names.join(best, name, "left")


def coalescing_upsert(log: DataFrame, keys: list[str], order: str, fill: list[str], top: list[str] = (), newest: list[str] = ()) -> DataFrame:
    """Replays a log (M1): the last non-null value of each `fill` column, the greatest of `top`, and
    `newest` from the last row, null or not.  `order` must be unique within a key."""
    value = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
    return log.groupBy(*keys).agg(*[value(c) for c in fill], *[F.max(c).alias(c) for c in top], *[F.max_by(c, F.col(order)).alias(c) for c in newest])


def latest_set(events: DataFrame, keys: list[str], order: str, items: str, visits: str) -> DataFrame:
    """Set reconciliation (M3): the items of the last event that has any, and the visits by which their
    estimates are computed: of that event, or of the last later one that has visits."""
    has = F.size(F.coalesce(F.col(items), F.array().cast(events.schema[items].dataType))) > 0
    last = events.groupBy(*keys).agg(F.max(F.when(has, F.col(order))).alias("_at")).where("_at IS NOT NULL")
    after = events.join(last, keys).where(F.col(order) >= F.col("_at"))
    current = (F.col(order) == F.col("_at"))
    return after.groupBy(*keys).agg(
        F.max("_at").alias("set_source"),
        F.max_by(items, F.when(current, F.col(order))).alias(items),
        F.max_by(visits, F.when(current | F.col(visits).isNotNull(), F.col(order))).alias(visits),
    )


def manual_wins(old: DataFrame, new: DataFrame, keys: list[str], values: list[str], source: str = "source") -> DataFrame:
    """Upsert that leaves manual rows alone (M8)."""
    o = old.select(*[F.col(k) for k in keys], F.struct(*values, source).alias("_old"))
    n = new.select(*[F.col(k) for k in keys], F.struct(*values, source).alias("_new"))
    both = o.join(n, keys, "full")
    pick = F.when(F.col(f"_old.{source}") == "manual", F.col("_old")).otherwise(F.coalesce("_new", "_old"))
    return both.select(*keys, pick.alias("_v")).select(*keys, "_v.*")


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-or-ignore (M5)."""
    return old.unionByName(new.join(old, keys, "left_anti").dropDuplicates(keys))


def continuity(log: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Runs of equal values in order (W6): island number and place in the island for each row."""
    w = Window.partitionBy(*keys).orderBy(order)
    changed = (~F.col(value).eqNullSafe(F.lag(value).over(w)) | F.lag(order).over(w).isNull()).cast("int")
    islands = log.withColumn("_new", changed).withColumn("island", F.sum("_new").over(w)).drop("_new")
    return islands.withColumn("seen", F.row_number().over(Window.partitionBy(*keys, "island").orderBy(order)))


def unpivot_positions(df: DataFrame, keys: list[str], columns: list[tuple[str, str]], code: str, share: str) -> DataFrame:
    """Wide (code_i, share_i) columns to rows with position; the first place of a code counts."""
    cells = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.col(c).alias(code), F.col(s).alias(share)) for i, (c, s) in enumerate(columns)])
    rows = df.select(*keys, F.explode(cells).alias("x")).select(*keys, "x.*").where(F.col(code).isNotNull() & F.col(share).isNotNull())
    return rows.groupBy(*keys, code).agg(F.min("position").alias("position"), F.min_by(share, "position").alias(share))


def facet_rollup(facts: DataFrame, item: str, category: str, country: str, visits: str) -> DataFrame:
    """Counts and visits at four grains (A4-A7): all, category, country, category and country.

    Items are first reduced to one row per (category, country, item); unknown visits are counted, not
    taken as zero.  One Expand feeds one partial aggregation.
    """
    one = facts.groupBy(category, country, item).agg(F.max(visits).alias(visits))
    grains = one.cube(category, country).agg(F.grouping_id().alias("grain"), F.countDistinct(item).alias("items"), F.sum(visits).alias("visits"), F.sum(F.col(visits).isNull().cast("long")).alias("unknown_visits"))
    return grains.where(F.col("items") > 0)


def lifecycle_flags(base: DataFrame, key: str, parts: dict[str, DataFrame]) -> DataFrame:
    """EXISTS flags (P10): one left join for each part, reduced to its distinct keys."""
    out = base
    for name, part in parts.items():
        out = out.join(part.select(F.col(part.columns[0]).alias(key)).distinct().withColumn(name, F.lit(True)), key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return out


def due(status: str, retry: str, lease: str, now: Column, attempts: str, most: str, dead: str) -> Column:
    """Work that may be claimed."""
    waiting = F.col(status).isin("queued", "failed", "sync_failed") & (F.col(retry).isNull() | (F.col(retry) <= now))
    expired = (F.col(status) == "running") & (F.col(lease) <= now)
    return (waiting | expired) & F.col(dead).isNull() & (F.col(attempts) < F.col(most))


def retry_delay_minutes(attempts) -> Column:
    return F.least(F.lit(60), F.pow(F.lit(2), F.least(F.col(attempts), F.lit(6)))).cast("int")


def jaccard(a, b) -> Column:
    """Similarity of two distinct arrays, 0 when either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / F.size(F.array_union(a, b)))


#: Sets of candidates with a common word that one task compares with the known sets of that word.
SHARE = 4096


def most_similar(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """candidate, subject, similarity: of all known subjects the one whose words are most like the candidate's, of equals the smallest.

    candidates: candidate, words; known: subject, words; null words count as none.  No pair is left out: an equal set is the best there
    is; else sets meet by each word that they share, and a frequent word's candidates are dealt out over tasks; a candidate that
    shares no word has similarity 0.  Rows with the same words are compared once, and no pair is shuffled.
    """
    words = F.array_sort(F.array_distinct(F.coalesce("words", F.array().cast("array<string>"))))
    every = candidates.select("candidate", words.alias("_a"))
    sets = every.select("_a").distinct()
    of_set = known.groupBy(words.alias("_b")).agg(F.min("subject").alias("subject"))
    same = (F.col("_a") == F.col("_b")) & (F.size("_a") > 0)
    equal = sets.join(of_set, same).select("_a", "subject", F.lit(1.0).alias("similarity"))
    mine = sets.join(of_set, same, "left_anti").withColumn("_word", F.explode("_a"))
    shares = mine.groupBy("_word").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("_shares"))
    mine = mine.join(shares, "_word").withColumn("_share", F.pmod(F.xxhash64("_a"), F.col("_shares")).cast("int"))
    theirs = of_set.withColumn("_word", F.explode("_b")).join(shares, "_word").withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
    pairs = mine.join(theirs, ["_word", "_share"]).select("_a", "subject", jaccard("_a", "_b").alias("_j"))
    near = pairs.groupBy("_a").agg(F.max_by("subject", F.struct(F.col("_j"), -F.col("subject"))).alias("subject"), F.max("_j").alias("similarity"))
    least = known.agg(F.min("subject").alias("_least"))
    best = every.join(equal.unionByName(near), "_a", "left").crossJoin(F.broadcast(least))
    return best.select("candidate", F.coalesce("subject", "_least").alias("subject"), F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


def absolute_gate(covered: str, total: str, bps: int) -> Column:
    """Least count max(1, ceil(total * bps / 10000)) in integers."""
    least = F.greatest(F.lit(1).cast("long"), F.floor((F.col(total) * bps + 9999) / 10000).cast("long"))
    return F.col(covered) >= least
