"""Changes that follow from one another: deletes along foreign keys, catalogue versions with their children."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Link = tuple[str, str, str, str]  # child, its column, parent, its column


def marked(tables: dict[str, DataFrame], links: list[Link], doomed: dict[str, Column]) -> dict[str, tuple[DataFrame, bool]]:
    """Each table with a boolean `_gone`, and whether any of its rows can go, when rows are deleted with all that hangs on them.

    doomed: a condition for each table where the delete starts (null: stays).  A row goes with any of its parents, over any
    number of links; a null key has no parent.  Parents come first, so each link is one join with the distinct keys of the parent's
    rows that go; a parent of which nothing can go costs nothing.  Those keys are hashed and the children stream past them: no task sorts
    its children, of which there are many more.  Links in a circle raise.
    """
    order = TopologicalSorter({t: [p for c, _, p, _ in links if c == t] for t in tables}).static_order()
    out: dict[str, tuple[DataFrame, bool]] = {}
    for table in order:
        rows, marks = tables[table], []
        if table in doomed:
            rows = rows.withColumn("_m0", F.coalesce(doomed[table], F.lit(False)))
            marks.append("_m0")
        for i, (child, column, parent, key) in enumerate(links, 1):
            if child == table and out[parent][1]:
                gone = out[parent][0].where("_gone").select(F.col(key).alias(f"_k{i}")).where(F.col(f"_k{i}").isNotNull()).distinct().hint("shuffle_hash")
                rows = rows.join(gone, F.col(column) == F.col(f"_k{i}"), "left").withColumn(f"_m{i}", F.col(f"_k{i}").isNotNull()).drop(f"_k{i}")
                marks.append(f"_m{i}")
        goes = reduce(lambda a, b: a | b, [F.col(m) for m in marks], F.lit(False))
        out[table] = (rows.withColumn("_gone", goes).drop(*marks), bool(marks))
    return out


def cascade(tables: dict[str, DataFrame], links: list[Link], doomed: dict[str, Column]) -> dict[str, tuple[DataFrame, DataFrame]]:
    """What stays and what goes in each table, as `marked` tells."""
    split = lambda m: tuple(m.where(w).drop("_gone") for w in ("NOT _gone", "_gone"))
    return {t: split(m) if some else (tables[t], tables[t].where("false")) for t, (m, some) in marked(tables, links, doomed).items()}


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose parent isn't there."""
    return child.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias("_key")), F.col(column) == F.col("_key"), "left_anti")


def next_in_key(rows: DataFrame, keys: list[str], order: str, out: str, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Adds `out`: the value of `order` (unique within the keys) that comes next within the keys, null for the last.

    A key's rows are dealt out by ranges of their order and looked at range by range, so a hot key runs over many tasks; a range's
    last row takes the first value of the next range that has the key (one row for each key and range).  `write` stores the ranges.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = write(rows.repartitionByRange(n, *keys, order).withColumn("_range", F.spark_partition_id()))
    later = F.lead(order).over(Window.partitionBy(*keys, "_range").orderBy(order))
    first = ranged.groupBy(*keys, "_range").agg(F.min(order).alias("_first"))
    ahead = F.lead("_first").over(Window.partitionBy(*keys).orderBy("_range")).alias("_ahead")
    first = first.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"), ahead)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.col("_range") == F.col("_r"))
    return ranged.withColumn("_later", later).join(first, same).select(*rows.columns, F.coalesce("_later", "_ahead").alias(out))


def catalogue(saves: DataFrame, source: str, context: str, order: str, children: str, write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Versions, plans and prices after a log of saves.

    saves: one row a save with its place in time (`order`, a whole number, unique within a source), its context and its plans (`children`:
    an array of structs with key, name and prices, an array of structs).  A version is a source, a context and the hash of the plans: a
    save of one that was seen before makes it active again, and supersedes the active versions of the same source, whatever their
    context.  Children belong to versions: plans with their places, and of each plan the first price, as the last save of the version
    left them; a version that is superseded keeps them, with its status.

    Returns versions (source, context, version_hash, first_observed, last_observed, saves, superseded_at, status), plans (version's keys,
    status, display_order, plan_key, plan_name) and prices (those, then the fields of the price).  `write` stores what several steps read.
    """
    kept = saves.select(F.col(source).alias("source"), F.col(context).alias("context"), F.col(order).alias("at"), F.col(children).alias("plans"))
    kept = kept.withColumn("version_hash", F.sha2(F.to_json("plans", {"ignoreNullFields": "false"}), 256))
    timed = next_in_key(kept.select("source", "context", "version_hash", "at"), ["source"], "at", "next", write)
    keys = ["source", "context", "version_hash"]
    versions = timed.groupBy(*keys).agg(F.min("at").alias("first_observed"), F.max("at").alias("last_observed"), F.count("*").alias("saves"), F.max_by(F.struct("next"), "at")["next"].alias("superseded_at"))
    versions = write(versions.withColumn("status", F.when(F.col("superseded_at").isNull(), "active").otherwise("superseded")))
    # The plans of a version are the same at every save, so any save's will do: the least costly is the first that a task meets.
    states = versions.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("status"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])  # a null source or context is one like others
    held = kept.groupBy(*keys).agg(F.any_value("plans").alias("plans")).join(states, same)
    plans = held.select(*keys, "status", F.posexplode("plans").alias("display_order", "_plan"))
    named = [*keys, "status", "display_order", F.col("_plan.key").alias("plan_key")]
    prices = plans.select(*named, F.get("_plan.prices", F.lit(0)).alias("_price")).where("_price IS NOT NULL").select("*", "_price.*").drop("_price")
    return versions, plans.select(*named, F.col("_plan.name").alias("plan_name")), prices
