"""Queries of changes that span several tables: atomic batches, cascading deletes, versions with children."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.operators import cascades as K
from tally.plans.catalog import query
from tally.sources.commits import TableSet
from tally.sources.tables import table


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; a temporary one only where the session names none and
    runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    path = shared_folder(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


LINKS = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey")]


def _tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "customer": table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal"),
        "orders": table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
        "lineitem": table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"),
    }


_GONE = """gc AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0),
         go AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM gc) OR o_orderstatus = 'P'),
         gl AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM go))"""


@query(f"""
    WITH {_GONE}
    SELECT 'customer' AS name, c_custkey AS k, CAST(0 AS BIGINT) AS line, c_custkey IN (SELECT c_custkey FROM gc) AS gone FROM customer UNION ALL
    SELECT 'orders', o_orderkey, 0, o_orderkey IN (SELECT o_orderkey FROM go) FROM orders UNION ALL
    SELECT 'lineitem', l_orderkey, l_linenumber, l_orderkey IN (SELECT o_orderkey FROM go) FROM lineitem""")
def cascading_delete(spark: SparkSession, d: str) -> DataFrame:
    """Every row of three tables and whether it goes with a customer in debt or a pending order."""
    tables = K.marked(_tables(spark, d), LINKS, {"customer": F.col("c_acctbal") < 0, "orders": F.col("o_orderstatus") == "P"})
    keys = {"customer": ("c_custkey", F.lit(0)), "orders": ("o_orderkey", F.lit(0)), "lineitem": ("l_orderkey", F.col("l_linenumber"))}
    out = None
    for name, (rows, _) in tables.items():
        part = rows.select(F.lit(name).alias("name"), F.col(keys[name][0]).alias("k"), keys[name][1].cast("long").alias("line"), F.col("_gone").alias("gone"))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""
    WITH {_GONE},
         l1 AS (SELECT 1 AS turn, l_orderkey, l_linenumber, l_quantity FROM lineitem),
         l2 AS (SELECT 2, l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM go)),
         l3 AS (SELECT 3, l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM go)
                UNION ALL SELECT 3, l_orderkey, l_linenumber + 100, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM go)),
         o AS (SELECT 1 AS turn, o_orderkey, o_custkey FROM orders UNION ALL SELECT 2, o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM go)
               UNION ALL SELECT 3, o_orderkey, o_custkey FROM orders),
         c AS (SELECT 1 AS turn, c_custkey FROM customer UNION ALL SELECT t, c_custkey FROM customer, (VALUES (2), (3)) v(t) WHERE c_custkey NOT IN (SELECT c_custkey FROM gc)),
         l AS (SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3)
    SELECT turn, 'customer' AS name, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS total, CAST(0 AS BIGINT) AS orphans FROM c GROUP BY 1 UNION ALL
    SELECT turn, 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT), count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.turn = o.turn AND c.c_custkey = o.o_custkey)) FROM o GROUP BY 1 UNION ALL
    SELECT turn, 'lineitem', count(*), CAST(sum(l_orderkey * 1000 + l_linenumber) AS BIGINT), count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.turn = l.turn AND o.o_orderkey = l.l_orderkey)) FROM l GROUP BY 1""")
def atomic_batches(spark: SparkSession, d: str) -> DataFrame:
    """Three commits over three tables (S4): all rows; a cascading delete; the deleted orders and lines appended again.  Read back at each
    turn, with the rows whose parent is missing: none after the first two, those whose customer is gone after the third."""
    store, rows = TableSet(spark, shared_folder(spark, "batches")), _tables(spark, d)
    base = store.commit(replace=rows)
    split = K.cascade({t: base.read(t) for t in rows}, LINKS, {"customer": F.col("c_acctbal") < 0, "orders": F.col("o_orderstatus") == "P"})
    less = store.commit(replace={t: stays for t, (stays, _) in split.items()}, base=base, by=("deletes", 1))
    store.commit(replace={t: stays for t, (stays, _) in split.items()}, base=less, by=("deletes", 1))  # runs again: nothing happens
    lines = split["lineitem"][1].withColumn("l_linenumber", F.col("l_linenumber") + 100)
    store.commit(append={"orders": split["orders"][1], "lineitem": lines}, reads=["customer"])
    out = None
    for turn in (1, 2, 3):
        state = store.snapshot(turn)
        customer, orders, lines = (state.read(t) for t in ("customer", "orders", "lineitem"))
        counted = {
            "customer": (customer, F.col("c_custkey"), None), "orders": (orders, F.col("o_orderkey"), K.orphans(orders, "o_custkey", customer, "c_custkey")),
            "lineitem": (lines, F.col("l_orderkey") * 1000 + F.col("l_linenumber"), K.orphans(lines, "l_orderkey", orders, "o_orderkey")),
        }
        for name, (df, key, lost) in counted.items():
            n = df.agg(F.count("*").alias("n"), F.sum(key).cast("long").alias("total"))
            lone = spark.range(1).select(F.lit(0).cast("long").alias("orphans")) if lost is None else lost.agg(F.count("*").alias("orphans"))
            part = n.crossJoin(lone).select(F.lit(turn).alias("turn"), F.lit(name).alias("name"), "n", "total", "orphans")
            out = part if out is None else out.unionByName(part)
    return out


#: Each order is a save of its customer's catalogue in the context of its priority: what it lists are its lines by return flag.
_SAVES = """l AS (SELECT l_orderkey, l_returnflag AS key, min(l_linestatus) AS name, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) // 10 AS q FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1, 2),
         s AS (SELECT o_custkey AS source, substr(o_orderpriority, 1, 1) AS context, o_orderkey AS seq,
                      (SELECT list({'key': key, 'name': name, 'n': CASE WHEN q > 0 THEN n END, 'q': q} ORDER BY key) FROM l WHERE l_orderkey = o_orderkey) AS plans FROM orders),
         h AS (SELECT *, CAST(plans AS VARCHAR) AS content, lead(seq) OVER (PARTITION BY source ORDER BY seq) AS next FROM s),
         v AS (SELECT source, context, content, min(seq) AS first_observed, max(seq) AS last_observed, count(*) AS saves, arg_max(coalesce(next, -1), seq) AS after FROM h GROUP BY ALL)"""


def _saves(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem").where("l_linenumber <= 2").groupBy("l_orderkey", F.col("l_returnflag").alias("key"))
    line = line.agg(F.min("l_linestatus").alias("name"), F.count("*").alias("n"), F.expr("sum(cast(l_quantity AS BIGINT)) div 10").alias("q"))
    price = F.when(F.col("q") > 0, F.array(F.struct(F.col("q").alias("amount"), F.col("n").alias("units")), F.struct((F.col("q") * 10).alias("amount"), F.col("n").alias("units"))))
    plans = line.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("key", "name", price.alias("prices")))).alias("plans"))
    orders = table(spark, d, "orders").join(plans, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return orders.select(F.col("o_custkey").alias("source"), F.substring("o_orderpriority", 1, 1).alias("context"), F.col("o_orderkey").alias("at"), "plans")


@query(f"""
    WITH {_SAVES}
    SELECT source, context, first_observed, last_observed, saves, CASE WHEN after >= 0 THEN after END AS superseded_at, CASE WHEN after >= 0 THEN 'superseded' ELSE 'active' END AS status FROM v""")
def catalogue_versions(spark: SparkSession, d: str) -> DataFrame:
    """Versions by content of each customer's catalogue, over all its contexts: a save supersedes its siblings."""
    return K.catalogue(_saves(spark, d), "source", "context", "at", "plans", written)[0].drop("version_hash")


@query(f"""
    WITH {_SAVES},
         p AS (SELECT source, context, first_observed, CASE WHEN after >= 0 THEN 'superseded' ELSE 'active' END AS status, content, (SELECT any_value(plans) FROM h WHERE h.source = v.source AND h.seq = v.first_observed) AS plans FROM v),
         e AS (SELECT source, context, first_observed, status, unnest(plans) AS plan, generate_subscripts(plans, 1) - 1 AS display_order FROM p)
    SELECT source, context, first_observed, status, CAST(display_order AS INTEGER) AS display_order, plan.key AS plan_key, plan.name AS plan_name,
           CASE WHEN plan.q > 0 THEN plan.q END AS amount, CASE WHEN plan.q > 0 THEN plan.n END AS units FROM e""")
def catalogue_children(spark: SparkSession, d: str) -> DataFrame:
    """Plans and first prices of all versions, with the version's status: three levels."""
    versions, plans, prices = K.catalogue(_saves(spark, d), "source", "context", "at", "plans", written)
    keys = ["source", "context", "version_hash"]
    both = plans.join(prices.drop("status", "plan_key"), [*keys, "display_order"], "left").join(versions.select(*keys, "first_observed"), keys)
    return both.select("source", "context", "first_observed", "status", "display_order", "plan_key", "plan_name", "amount", "units")
