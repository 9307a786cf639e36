"""The registered queries of the analytics library and their SQL.

Each query applies operators of the library to the given tables; the tables stand in for traffic,
rating, catalogue and page logs.  SQL states the same result in plain terms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tally.functions import documents as H
from tally.functions import numbers as N
from tally.functions import pricing as PR
from tally.functions import text as X
from tally.functions.safety import content_safety
from tally.operators import claims as C
from tally.operators import page_claims as PC
from tally.operators import relational as R
from tally.operators import state as ST
from tally.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def monthly(spark: SparkSession, d: str) -> DataFrame:
    """Orders as monthly values of each customer."""
    month = F.trunc("o_orderdate", "MM").cast("date").alias("month")
    return table(spark, d, "orders").groupBy("o_custkey", month).agg(F.round(F.sum("o_totalprice"), 2).alias("visits"), F.count("*").alias("n_orders"))


# -- market snapshot and its parts ------------------------------------------------------------------


@query("""
    WITH seen AS (SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 0
                  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY c_acctbal, c_nationkey, c_mktsegment) = 1),
         m AS (SELECT o_custkey, CAST(date_trunc('year', o_orderdate) AS DATE) AS y, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY 1, 2),
         t AS (SELECT max(y) AS y FROM m), p AS (SELECT max(y) AS y FROM m WHERE y < (SELECT y FROM t))
    SELECT n.n_name, s.c_mktsegment, count(*) AS customers, sum(a.cents) AS now_cents, sum(b.cents) AS before_cents,
           CASE WHEN sum(b.cents) > 0 THEN round((sum(a.cents) - sum(b.cents)) / CAST(sum(b.cents) AS DOUBLE), 6) END AS growth
    FROM seen s JOIN nation n ON n.n_nationkey = s.c_nationkey
    LEFT JOIN m a ON a.o_custkey = s.c_custkey AND a.y = (SELECT y FROM t)
    LEFT JOIN m b ON b.o_custkey = s.c_custkey AND b.y = (SELECT y FROM p)
    GROUP BY 1, 2""")
def market_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Visible customers, current and previous year, growth by nation and segment."""
    seen = R.first_per_key(table(spark, d, "customer").where("c_acctbal > 0"), ["c_custkey"], ["c_acctbal", "c_nationkey", "c_mktsegment"])
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents")
    m = table(spark, d, "orders").groupBy("o_custkey", F.trunc("o_orderdate", "year").cast("date").alias("y")).agg(cents)
    ends = m.select("y").distinct().orderBy(F.desc("y")).limit(2).agg(F.max("y").alias("t"), F.min("y").alias("p"))
    ends = ends.select("t", F.when(F.col("p") < F.col("t"), F.col("p")).alias("p"))
    wide = m.crossJoin(F.broadcast(ends)).groupBy("o_custkey").agg(F.sum(F.when(F.col("y") == F.col("t"), F.col("cents"))).alias("a"), F.sum(F.when(F.col("y") == F.col("p"), F.col("cents"))).alias("b"))
    out = seen.join(wide, F.col("c_custkey") == F.col("o_custkey"), "left").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    g = out.groupBy("n_name", "c_mktsegment").agg(F.count("*").alias("customers"), F.sum("a").alias("now_cents"), F.sum("b").alias("before_cents"))
    return g.withColumn("growth", F.round(N.growth_rate("now_cents", "before_cents"), 6))


@query("""SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
    QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal ASC NULLS FIRST, c_custkey) = 1""")
def visible_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = R.first_per_key(table(spark, d, "customer"), ["c_nationkey", "c_mktsegment"], [F.asc_nulls_first("c_acctbal"), "c_custkey"])
    return rows.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query("""SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1""")
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return R.latest(e.select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("""
    WITH h AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS rating FROM events GROUP BY 1, 2),
         l AS (SELECT user_id, max(day) AS latest_day, arg_max(rating, day) AS latest_value FROM h GROUP BY 1),
         c AS (SELECT h.user_id, h.day, h.rating, l.latest_day - h.day AS days FROM h JOIN l USING (user_id) WHERE l.latest_day - h.day BETWEEN 20 AND 45
               QUALIFY row_number() OVER (PARTITION BY h.user_id ORDER BY abs(l.latest_day - h.day - 30), h.day DESC) = 1)
    SELECT l.user_id, l.latest_day, l.latest_value, c.day AS base_day, c.rating AS base_value, CAST(c.days AS INTEGER) AS days,
           round((l.latest_value - c.rating) * 30.0 / nullif(c.days, 0), 6) AS velocity FROM l LEFT JOIN c USING (user_id)""")
def nearest_baseline(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("rating"))
    return R.nearest_baseline(h, "user_id", "day", "rating", 20, 45, 30).withColumn("velocity", F.round(N.velocity_30d("latest_value", "base_value", "days"), 6))


@query("""
    WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1), g AS (SELECT month FROM m WHERE n >= (SELECT avg(n) FROM m))
    SELECT o_custkey, max(g.month) AS latest_month, count(*) AS gated FROM orders o JOIN g ON CAST(date_trunc('month', o.o_orderdate) AS DATE) = g.month GROUP BY 1""")
def release_gate_months(spark: SparkSession, d: str) -> DataFrame:
    """Only months with at least the mean number of rows are released."""
    o = table(spark, d, "orders").withColumn("month", F.trunc("o_orderdate", "MM").cast("date"))
    m = o.groupBy("month").agg(F.count("*").alias("n"))
    gate = m.join(F.broadcast(m.agg(F.avg("n").alias("mean"))), F.col("n") >= F.col("mean")).select("month")
    return o.join(F.broadcast(gate), "month").groupBy("o_custkey").agg(F.max("month").alias("latest_month"), F.count("*").alias("gated"))


@query("""SELECT k, kind FROM (SELECT c_custkey AS k, 'customer' AS kind FROM customer UNION SELECT s_suppkey, 'supplier' FROM supplier) u
    WHERE kind = 'supplier' OR NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = u.k)""")
def monitored_union(spark: SparkSession, d: str) -> DataFrame:
    """Distinct union of two catalogues without those that have orders."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("kind"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.lit("supplier").alias("kind"))
    done = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.lit("customer").alias("kind"))
    return c.union(s).distinct().join(done, ["k", "kind"], "left_anti")


@query("""
    SELECT o_orderkey, status, attempts, CAST(least(60, pow(2, least(attempts, 6))) AS INTEGER) AS delay FROM (
        SELECT o_orderkey, o_orderpriority, CASE o_orderstatus WHEN 'O' THEN 'queued' WHEN 'F' THEN 'failed' ELSE 'running' END AS status, o_orderkey % 5 AS attempts, o_orderdate FROM orders) q
    WHERE attempts < 3 AND ((status IN ('queued', 'failed') AND o_orderdate <= TIMESTAMP '1999-01-01') OR (status = 'running' AND o_orderdate <= TIMESTAMP '1996-01-01'))
    ORDER BY o_orderpriority, o_orderdate, o_orderkey LIMIT 100""")
def due_queue_topk(spark: SparkSession, d: str) -> DataFrame:
    """The hundred tasks that are claimed next (P11, O2, O3): TakeOrderedAndProject, no full sort."""
    o = table(spark, d, "orders").withColumns({
        "status": F.when(F.col("o_orderstatus") == "O", "queued").when(F.col("o_orderstatus") == "F", "failed").otherwise("running"),
        "attempts": F.col("o_orderkey") % 5, "most": F.lit(3), "dead": F.lit(None).cast("timestamp"), "lease": F.col("o_orderdate") + F.expr("INTERVAL 1096 DAYS"),
    })
    ready = R.due("status", "o_orderdate", "lease", F.lit("1999-01-01").cast("timestamp_ntz"), "attempts", "most", "dead")
    top = o.where(ready).orderBy("o_orderpriority", "o_orderdate", "o_orderkey").limit(100)
    return top.select("o_orderkey", "status", "attempts", R.retry_delay_minutes("attempts").alias("delay"))


@query("""
    SELECT c_custkey, list_filter([CASE WHEN NOT has_order THEN 'no_order' END, CASE WHEN NOT has_open THEN 'no_open_order' END, CASE WHEN c_acctbal < 0 THEN 'debt' END], lambda x: x IS NOT NULL) AS blocking FROM (
        SELECT c_custkey, c_acctbal, EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c_custkey) AS has_order, EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c_custkey AND o_orderstatus = 'O') AS has_open FROM customer)""")
def readiness_flags(spark: SparkSession, d: str) -> DataFrame:
    """Existence flags to a list of what blocks (P10, P12, G10): one aggregation and one join for all flags."""
    flags = table(spark, d, "orders").groupBy("o_custkey").agg(F.lit(True).alias("has_order"), F.max(F.col("o_orderstatus") == "O").alias("has_open"))
    c = table(spark, d, "customer").join(flags, F.col("c_custkey") == F.col("o_custkey"), "left")
    no = lambda c, label: F.when(~F.coalesce(c, F.lit(False)), label)
    items = F.array(no(F.col("has_order"), "no_order"), no(F.col("has_open"), "no_open_order"), F.when(F.col("c_acctbal") < 0, "debt"))
    return c.select("c_custkey", F.filter(items, lambda x: x.isNotNull()).alias("blocking"))


@query("""SELECT u.user_id, coalesce(n, 0) AS errors FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) e USING (user_id) WHERE coalesce(n, 0) < 3""")
def attempts_budget(spark: SparkSession, d: str) -> DataFrame:
    """Users with fewer than three errors (A11): one conditional count."""
    return table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("errors")).where("errors < 3")


@query("""
    SELECT count(*) AS lines, count(*) FILTER (WHERE l_discount > 0) AS discounted, count(DISTINCT l_orderkey) AS orders, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned_parts,
           coalesce(sum(CASE WHEN l_quantity > 1000 THEN 1 END), 0) AS huge, sum(CAST(l_quantity AS BIGINT)) AS quantity, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS open_orders FROM lineitem""")
def conditional_coverage(spark: SparkSession, d: str) -> DataFrame:
    """A one-row coverage of two tables (A1-A3, A15), one aggregation each."""
    l = table(spark, d, "lineitem").agg(  # noqa: E741
        F.count("*").alias("lines"), F.count_if(F.col("l_discount") > 0).alias("discounted"), F.countDistinct("l_orderkey").alias("orders"),
        F.countDistinct(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("returned_parts"),
        F.coalesce(F.sum(F.when(F.col("l_quantity") > 1000, 1)), F.lit(0)).alias("huge"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
    )
    return l.crossJoin(table(spark, d, "orders").agg(F.count_if(F.col("o_orderstatus") == "O").alias("open_orders")))


@query("""
    WITH f AS (SELECT DISTINCT o_custkey, c_mktsegment, n_name, max(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_totalprice AS BIGINT) END) OVER (PARTITION BY c_mktsegment, n_name, o_custkey) AS v
               FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
    SELECT c_mktsegment, n_name, CAST(grouping(c_mktsegment) * 2 + grouping(n_name) AS BIGINT) AS grain, count(DISTINCT o_custkey) AS items, sum(v) AS visits, count(*) FILTER (WHERE v IS NULL) AS unknown_visits
    FROM f GROUP BY CUBE (c_mktsegment, n_name) HAVING count(*) > 0""")
def facet_rollups(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    facts = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    # DuckDB rounds where Spark cuts: the SQL's cast is matched by rounding.
    facts = facts.withColumn("v", F.when(F.col("o_orderstatus") == "P", None).otherwise(F.bround("o_totalprice").cast("long")))
    out = R.facet_rollup(facts.withColumnRenamed("v", "value"), "o_custkey", "c_mktsegment", "n_name", "value")
    return out.withColumn("grain", F.col("grain").cast("long"))


@query("""
    WITH y AS (SELECT year(o_orderdate) AS y, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1)
    SELECT CAST(y AS INTEGER) AS y, total, done, done >= greatest(1, (total * 2500 + 9999) // 10000) AS passes_absolute,
           lag(done) OVER (ORDER BY y) IS NULL OR lag(done) OVER (ORDER BY y) = 0 OR done >= lag(done) OVER (ORDER BY y) * 0.95 AS passes_relative FROM y""")
def coverage_gates(spark: SparkSession, d: str) -> DataFrame:
    """Absolute and relative gates of each year (G4, G5).  Years are few, so one window is enough."""
    y = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    before = F.lag("done").over(Window.orderBy("y"))
    return y.select("y", "total", "done", R.absolute_gate("done", "total", 2500).alias("passes_absolute"), (before.isNull() | (before == 0) | (F.col("done") >= before * 0.95)).alias("passes_relative"))


@query("""SELECT l_orderkey, l_linenumber, CAST(floor(least(l_discount, 1.0) * 10000 + 0.5) AS INTEGER) AS bps, CAST(round(l_tax * 10000.0) AS BIGINT) AS tax_bps,
    CAST(floor((CAST(l_quantity AS BIGINT) * floor(l_discount * 10000 + 0.5) + 5000) / 10000) AS BIGINT) AS estimate FROM lineitem""")
def bps_projection(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").withColumn("bps", N.share_to_bps("l_discount"))  # noqa: E741
    return l.select("l_orderkey", "l_linenumber", "bps", N.round_bps("l_tax").alias("tax_bps"), N.visits_from_bps(F.col("l_quantity").cast("long"), "bps").alias("estimate"))


@query("""SELECT event_id, round(CASE WHEN k % 3 = 0 THEN value WHEN k % 3 = 1 THEN coalesce(value / 2, 0) + 0.25 ELSE NULL END, 6) AS share FROM (SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""")
def search_share_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Explicit share, else the parts, else unknown."""
    k = F.get_json_object("props", "$.k").try_cast("long")
    e = table(spark, d, "events").withColumn("k", k)
    share = N.search_share(F.when(F.col("k") % 3 == 0, F.col("value")), F.when(F.col("k") % 3 == 1, F.col("value") / 2), F.when(F.col("k") % 3 == 1, F.lit(0.25)))
    return e.select("event_id", F.round(share, 6).alias("share"))


# -- replay, upserts, history -----------------------------------------------------------------------


@query("""
    SELECT user_id, CAST(ts AS DATE) AS day, arg_max(CASE WHEN event_type = 'click' THEN value END, CASE WHEN event_type = 'click' THEN event_id END) AS clicks,
           arg_max(CASE WHEN event_type = 'view' THEN value END, CASE WHEN event_type = 'view' THEN event_id END) AS views, max(value) AS version, arg_max(event_type, event_id) AS last_type FROM events GROUP BY 1, 2""")
def coalescing_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Last known value of each measure in replay order (M1)."""
    e = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", F.when(F.col("event_type") == "click", F.col("value")).alias("clicks"), F.when(F.col("event_type") == "view", F.col("value")).alias("views"), F.col("value").alias("version"), F.col("event_type").alias("last_type"))
    return R.coalescing_upsert(e, ["user_id", "day"], "event_id", ["clicks", "views"], ["version"], ["last_type"])


@query("""SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2""")
def overwriting_upsert(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", "value")
    return R.latest(e, ["user_id", "day"], ["event_id"])


@query("""
    WITH e AS (SELECT o_custkey, l_orderkey, CASE WHEN l_orderkey % 3 = 0 THEN [] ELSE list(l_partkey ORDER BY l_linenumber, l_partkey)[1:5] END AS items, CASE WHEN l_orderkey % 2 = 0 THEN CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) END AS visits
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
         s AS (SELECT o_custkey, max(l_orderkey) AS set_source FROM e WHERE len(items) > 0 GROUP BY 1)
    SELECT s.o_custkey, s.set_source, arg_max(e.items, e.l_orderkey) FILTER (WHERE e.l_orderkey = s.set_source) AS items,
           arg_max(struct_pack(v := e.visits), e.l_orderkey) FILTER (WHERE e.l_orderkey = s.set_source OR e.visits IS NOT NULL).v AS visits
    FROM s JOIN e ON e.o_custkey = s.o_custkey AND e.l_orderkey >= s.set_source GROUP BY 1, 2""")
def set_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """The last non-empty set of each customer, estimates from the last known volume (M3)."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    g = lines.groupBy("o_custkey", "l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("x"), F.sum(F.col("l_quantity").cast("long")).alias("q"))
    e = g.select("o_custkey", "l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.array().cast("array<bigint>")).otherwise(F.slice(F.col("x.l_partkey"), 1, 5)).alias("items"), F.when(F.col("l_orderkey") % 2 == 0, F.col("q")).alias("visits"))
    return R.latest_set(e, ["o_custkey"], "l_orderkey", "items", "visits")


@query("""
    WITH w AS (SELECT l_orderkey, l_suppkey % 7 AS code, l_discount AS share, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey % 7, l_discount) AS pos FROM lineitem)
    SELECT l_orderkey, code, CAST(min(pos) AS INTEGER) AS position, arg_min(share, pos) AS share FROM w WHERE pos <= 5 GROUP BY 1, 2""")
def unpivot_top5(spark: SparkSession, d: str) -> DataFrame:
    """Five wide pairs to rows, the first place of a code wins."""
    l = table(spark, d, "lineitem")  # noqa: E741
    g = l.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", (F.col("l_suppkey") % 7).alias("c"), F.col("l_discount").alias("s")))).alias("x"))
    wide = g.select("l_orderkey", *[F.get("x", F.lit(i))["c"].alias(f"c{i}") for i in range(5)], *[F.get("x", F.lit(i))["s"].alias(f"s{i}") for i in range(5)])
    return R.unpivot_positions(wide, ["l_orderkey"], [(f"c{i}", f"s{i}") for i in range(5)], "code", "share")


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_valid(props) AS valid, json_extract_string(props, '$.missing') AS missing FROM events""")
def json_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"), F.try_parse_json("props").isNotNull().alias("valid"), F.get_json_object("props", "$.missing").alias("missing"))


@query("""
    WITH c AS (SELECT user_id, event_id, event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR lag(event_id) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
         i AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM c)
    SELECT user_id, event_id, event_type, island, CAST(row_number() OVER (PARTITION BY user_id, island ORDER BY event_id) AS INTEGER) AS seen FROM i""")
def claim_history(spark: SparkSession, d: str) -> DataFrame:
    return R.continuity(table(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", "event_type").select("user_id", "event_id", "event_type", F.col("island").cast("long"), F.col("seen").cast("int"))


@query("""
    WITH m AS (SELECT user_id, list(props ORDER BY event_id) AS l FROM events GROUP BY 1)
    SELECT user_id, '{"k":' || json_extract_string(l[-1], '$.k') || '}' AS merged FROM m""")
def json_merge_replay(spark: SparkSession, d: str) -> DataFrame:
    """Merge patches folded in replay order (A25); with one key the last patch wins."""
    return H.merge_in_order(table(spark, d, "events"), ["user_id"], "event_id", "props", "merged")


@query("""
    WITH o AS (SELECT s_suppkey, CAST(s_acctbal AS INTEGER) AS v, CASE WHEN s_suppkey % 4 = 0 THEN 'manual' ELSE 'auto' END AS source FROM supplier WHERE s_suppkey % 3 <> 0),
         n AS (SELECT s_suppkey, s_nationkey AS v, 'auto' AS source FROM supplier WHERE s_suppkey % 2 = 0)
    SELECT coalesce(o.s_suppkey, n.s_suppkey) AS s_suppkey, CASE WHEN o.source = 'manual' THEN o.v ELSE coalesce(n.v, o.v) END AS v, CASE WHEN o.source = 'manual' THEN 'manual' ELSE coalesce(n.source, o.source) END AS source FROM o FULL JOIN n ON o.s_suppkey = n.s_suppkey""")
def manual_wins_upsert(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    old = s.where("s_suppkey % 3 <> 0").select("s_suppkey", F.bround("s_acctbal").cast("int").alias("v"), F.when(F.col("s_suppkey") % 4 == 0, "manual").otherwise("auto").alias("source"))
    new = s.where("s_suppkey % 2 = 0").select("s_suppkey", F.col("s_nationkey").alias("v"), F.lit("auto").alias("source"))
    return R.manual_wins(old, new, ["s_suppkey"], ["v"])


@query("""SELECT p_partkey, p_name FROM part WHERE p_size < 20 UNION ALL SELECT p_partkey, p_name FROM part p WHERE p_size >= 10 AND NOT EXISTS (SELECT 1 FROM part q WHERE q.p_size < 20 AND q.p_partkey = p.p_partkey)""")
def insert_or_ignore(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    return R.insert_missing(p.where("p_size < 20"), p.where("p_size >= 10"), ["p_partkey"]).drop("p_size")


@query("""SELECT n.n_name, r.r_name AS parent, p.p_brand, p.n FROM (SELECT p_brand, count(*) AS n, min(p_size) % 25 AS nk FROM part WHERE p_size = (SELECT max(p_size) FROM part) GROUP BY 1) p JOIN nation n ON n.n_nationkey = p.nk LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def latest_taxonomy_version(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the greatest version, joined to their parents."""
    part, nation, region = (table(spark, d, t) for t in ("part", "nation", "region"))
    top = part.join(F.broadcast(part.agg(F.max("p_size").alias("m"))), F.col("p_size") == F.col("m")).groupBy("p_brand").agg(F.count("*").alias("n"), (F.min("p_size") % 25).alias("nk"))
    tree = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return top.join(F.broadcast(tree), F.col("nk") == F.col("n_nationkey")).select("n_name", F.col("r_name").alias("parent"), "p_brand", "n")


# -- identity, evaluation, claims -------------------------------------------------------------------


@query("""
    WITH t AS (SELECT p_partkey, coalesce(list_sort(list_distinct(string_split(lower(p_name), ' '))), []) AS s FROM part),
         a AS (SELECT DISTINCT s FROM t WHERE p_partkey % 2 = 0), b AS (SELECT s, min(p_partkey) AS subject FROM t WHERE p_partkey % 2 = 1 GROUP BY 1),
         c AS (SELECT a.s, subject, coalesce(len(list_intersect(a.s, b.s)) / CAST(nullif(len(a.s) + len(b.s) - len(list_intersect(a.s, b.s)), 0) AS DOUBLE), 0) AS j FROM a LEFT JOIN b ON TRUE),
         m AS (SELECT s, arg_max(subject, (j, -subject)) AS subject, round(max(j), 6) AS similarity FROM c GROUP BY 1)
    SELECT p_partkey AS candidate, subject, similarity FROM t JOIN m USING (s) WHERE p_partkey % 2 = 0""")
def identity_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """The most similar known part of every part, among all known ones."""
    t = table(spark, d, "part").select("p_partkey", F.split(F.lower("p_name"), " ").alias("words"))
    out = R.most_similar(t.where("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "candidate"), t.where("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "subject"))
    return out.withColumn("similarity", F.round("similarity", 6))


@query("""
    WITH t AS (SELECT p_partkey, p_brand, p_type, p_size, lower(p_name) AS n, list_distinct(string_split(lower(p_name), ' ')) AS s FROM part),
         c AS (SELECT a.p_partkey AS candidate, b.p_partkey AS subject, CASE WHEN a.n = b.n THEN 0.38 ELSE 0.0 END + 0.24 * len(list_intersect(a.s, b.s)) / CAST(len(a.s) + len(b.s) - len(list_intersect(a.s, b.s)) AS DOUBLE) AS score FROM t a JOIN t b ON a.p_brand = b.p_brand AND a.p_type = b.p_type WHERE a.p_partkey % 2 = 0 AND b.p_partkey % 2 = 1),
         r AS (SELECT *, row_number() OVER (PARTITION BY candidate ORDER BY score DESC, subject) AS rn FROM c),
         b AS (SELECT candidate, max(CASE WHEN rn = 1 THEN subject END) AS s, max(CASE WHEN rn = 1 THEN score END) AS best, max(CASE WHEN rn = 2 THEN score END) AS second FROM r WHERE rn <= 2 GROUP BY 1)
    SELECT candidate, CASE WHEN best >= 0.3 AND NOT coalesce(second >= 0.3 AND best - second < 0.02, FALSE) THEN s END AS subject, round(best, 6) AS best, CASE WHEN best < 0.3 THEN 'new' WHEN second >= 0.3 AND best - second < 0.02 THEN 'conflict' ELSE 'matched' END AS status FROM b""")
def identity_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Scores to matched, conflict or new by the two best subjects (H-10)."""
    none = F.array().cast("array<string>")
    t = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", F.lower("p_name").alias("name"), F.array_distinct(F.split(F.lower("p_name"), " ")).alias("card"), none.alias("anchor"), none.alias("price"), F.lit("").alias("audience"), F.lit("").alias("billing"), F.lit(None).cast("int").alias("position"))
    a = t.where("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "candidate").withColumn("structured_id", F.lit(""))
    b = t.where("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "subject").withColumn("structured_ids", none).withColumn("names", F.array("name")).drop("name")
    block = ["p_brand", "p_type"]
    scored = C.identity_shortlist(a, b, block)
    compared = a.join(b.select(*block).distinct(), block, "left_semi")
    return C.resolve_identity(scored, 0.3, 0.02, compared).withColumn("best", F.round("best", 6))


def _judged(spark: SparkSession, d: str) -> DataFrame:
    short = F.when(F.col("n_chars") < 600, "short").when(F.col("n_chars") < 1500, "middle").otherwise("long")
    j = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id")
    return j.select("doc_id", F.when(F.col("quality") == 1, short).otherwise("long").alias("gold"), F.when(F.col("toxic") == 1, "short").otherwise(short).alias("pred"))


_JUDGED = """j AS (SELECT doc_id, CASE WHEN quality = 1 THEN k ELSE 'long' END AS gold, CASE WHEN toxic = 1 THEN 'short' ELSE k END AS pred FROM (
    SELECT l.doc_id, quality, toxic, CASE WHEN n_chars < 600 THEN 'short' WHEN n_chars < 1500 THEN 'middle' ELSE 'long' END AS k FROM labels l JOIN documents d ON l.doc_id = d.doc_id))"""


@query(f"WITH {_JUDGED} SELECT gold, pred, count(*) AS n FROM j GROUP BY 1, 2")
def eval_confusion(spark: SparkSession, d: str) -> DataFrame:
    return C.confusion(_judged(spark, d), "gold", "pred")


@query(f"""
    WITH {_JUDGED}, g AS (SELECT gold AS label, count(*) AS support, count(*) FILTER (WHERE gold = pred) AS tp FROM j GROUP BY 1), p AS (SELECT pred AS label, count(*) AS predicted FROM j GROUP BY 1),
         x AS (SELECT label, support, tp, coalesce(predicted, 0) AS predicted FROM g LEFT JOIN p USING (label)),
         y AS (SELECT *, CASE WHEN predicted > 0 THEN tp / CAST(predicted AS DOUBLE) ELSE 0 END AS p, tp / CAST(support AS DOUBLE) AS r FROM x)
    SELECT label, support, tp, predicted - tp AS fp, support - tp AS fn, round(p, 4) AS precision, round(r, 4) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 4) AS f1 FROM y""")
def eval_macro(spark: SparkSession, d: str) -> DataFrame:
    return C.per_class(_judged(spark, d), "gold", "pred")


@query("""
    WITH s AS (SELECT event_id, (['pending', 'normalized', 'failed', 'not_applicable'])[event_id % 4 + 1] AS n, (['pending', 'entailed', 'unsupported', 'conflict'])[(event_id // 4) % 4 + 1] AS v,
                 (['unreviewed', 'auto_verified', 'human_verified', 'corrected', 'unresolved', 'rejected'])[(event_id // 16) % 6 + 1] AS d, (['active', 'aging', 'stale', 'superseded', 'invalidated'])[(event_id // 96) % 5 + 1] AS l,
                 (['not_eligible', 'eligible', 'published', 'withdrawn'])[(event_id // 480) % 4 + 1] AS p FROM events)
    SELECT event_id, NOT (p IN ('eligible', 'published') AND (n NOT IN ('normalized', 'not_applicable') OR v <> 'entailed' OR d NOT IN ('auto_verified', 'human_verified', 'corrected') OR l NOT IN ('active', 'aging') OR (p = 'eligible' AND l <> 'active'))) AS legal FROM s""")
def claim_states(spark: SparkSession, d: str) -> DataFrame:
    """Invariants of claim states over every event's derived state."""
    e, step = table(spark, d, "events"), 1
    for name, values in C.STATES.items():
        place = (F.floor(F.col("event_id") / step) % len(values)).cast("int")
        e = e.withColumn(name, F.get(F.array(*[F.lit(v) for v in values]), place))
        step *= len(values)
    return e.select("event_id", (F.size(C.claim_errors()) == 0).alias("legal"))


# -- text, URL and page functions -------------------------------------------------------------------


@query("""SELECT p_partkey, trim(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part""")
def slug_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", X.slug(F.concat_ws(" / ", "p_name", "p_type")).alias("slug"))


@query("""SELECT p_partkey, CASE WHEN rn = 1 THEN base ELSE base || '-' || rn END AS slug FROM (SELECT p_partkey, base, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS rn FROM (SELECT p_partkey, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') AS base FROM part))""")
def slug_allocation(spark: SparkSession, d: str) -> DataFrame:
    """Numbered slugs on collision."""
    p = table(spark, d, "part").select("p_partkey", X.slug("p_type").alias("base"))
    return p.withColumn("rn", F.row_number().over(Window.partitionBy("base").orderBy("p_partkey"))).select("p_partkey", X.numbered_slug("base", "rn").alias("slug"))


@query("""
    WITH h AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '^www\\.', '') AS host FROM pages)
    SELECT page_id, host AS domain, array_to_string(string_split(host, '.')[-2:], '.') AS registrable FROM h""")
def domain_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", X.domain("url").alias("domain"), X.registrable(X.domain("url")).alias("registrable"))


@query("""
    WITH h AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '^www\\.', '') AS host FROM pages), s AS (SELECT * FROM (VALUES ('example', 'a'), ('com', 'b'), ('org', 'c'), ('test', 'd'), ('net', 'e')) v(suffix, service))
    SELECT page_id, arg_max(service, length(suffix)) AS service FROM h LEFT JOIN s ON host = suffix OR ends_with(host, '.' || suffix) GROUP BY 1""")
def longest_suffix(spark: SparkSession, d: str) -> DataFrame:
    """Service of a host's longest known suffix."""
    names = table(spark, d, "pages").select("page_id", X.domain("url").alias("host"))
    services = spark.createDataFrame([("example", "a"), ("com", "b"), ("org", "c"), ("test", "d"), ("net", "e")], "suffix string, service string")
    return R.longest_suffix(names, "host", F.broadcast(services), "suffix", "service").select("page_id", "service")


@query(r"""SELECT page_id, substr(trim(regexp_replace(regexp_extract(html, '(?i)<title[^>]*>([\s\S]*?)</title>', 1), '\s+', ' ', 'g')), 1, 120) AS title,
    length(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?i)<script\b[\s\S]*?</script>', ' ', 'g'), '(?i)<style\b[\s\S]*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS n_visible FROM pages""")
def page_title_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", H.page_title("html").alias("title"), F.length(H.visible_text("html", 1 << 30)).alias("n_visible"))


@query(r"""
    WITH t AS (SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?i)<title[^>]*>([\s\S]*?)</title>', 1), '\s+', ' ', 'g')) AS title, lower(html) AS raw,
        lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?i)<script\b[\s\S]*?</script>', ' ', 'g'), '(?i)<style\b[\s\S]*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS v FROM pages)
    SELECT page_id, CASE WHEN regexp_matches(title, '(?i)^(access\s+denied|forbidden|unauthorized)\b') THEN 'access_denied' WHEN regexp_matches(title, '(?i)^(404|not\s+found|page\s+not\s+found|500)\b') THEN 'error_page'
        WHEN contains(raw, 'cf-chl-') THEN 'anti_bot' WHEN contains(substr(v, 1, 12000), 'verify you are human') THEN 'captcha' WHEN length(v) < 20 THEN 'empty_page' ELSE 'valid_product_page' END AS state FROM t""")
def page_state(spark: SparkSession, d: str) -> DataFrame:
    return H.page_state(table(spark, d, "pages").select("page_id", "html")).select("page_id", "state")


@query("""SELECT sha256(text) AS hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1""")
def content_hash_dedup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("hash")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query(r"""SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '\$\s?\d|usd\s?\d')) * 3 + len(regexp_extract_all(lower(text), '\bpricing|plans?|monthly|yearly|per month|per user|contact sales|enterprise\b')) - len(regexp_extract_all(lower(text), '\bblog|privacy|terms|careers|cookie|shopping|purchase|cart\b')) * 2 AS INTEGER) AS score FROM documents""")
def text_quality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.pricing_text_quality("text").cast("int").alias("score"))


@query("""SELECT 'orders' AS queue, o_orderstatus AS status, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS attempts FROM orders GROUP BY 2 UNION ALL SELECT 'lines', l_linestatus, count(*), CAST(sum(l_linenumber) AS BIGINT) FROM lineitem GROUP BY 2""")
def queue_census(spark: SparkSession, d: str) -> DataFrame:
    """Work by status over several queues."""
    part = lambda t, name, status, n: table(spark, d, t).groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n"), F.sum(n).cast("long").alias("attempts")).select(F.lit(name).alias("queue"), "status", "n", "attempts")
    return part("orders", "orders", "o_orderstatus", "o_custkey").unionByName(part("lineitem", "lines", "l_linestatus", "l_linenumber"))


@query()
def dom_nodes(spark: SparkSession, d: str) -> DataFrame:
    """All elements of all pages (H-2, H-3); tested against a tree walk."""
    return H.dom_nodes(table(spark, d, "pages")).select("page_id", "node", "parent", "end", "tag", "hidden", "table_row", "table_column", F.length("text").alias("n_text"))


@query()
def pricing_regions(spark: SparkSession, d: str) -> DataFrame:
    """The best container of prices of each page (H-4)."""
    return H.pricing_regions(H.dom_nodes(table(spark, d, "pages")), least=3, with_text=False).select("page_id", "root", "end", "score")


@query()
def page_claims(spark: SparkSession, d: str) -> DataFrame:
    """Price claims of each page's region (H-5, H-7); tested on literal pages."""
    nodes = H.dom_nodes(table(spark, d, "pages"))
    return PC.claims(PC.region_nodes(nodes, H.pricing_regions(nodes, least=3, with_text=False)))


@query()
def text_plans(spark: SparkSession, d: str) -> DataFrame:
    """Priced plans in every document (H-12); tested on literal texts."""
    return PR.text_plans(table(spark, d, "documents"), "doc_id", "text").select("doc_id", F.size("plans").alias("n_plans"), F.get("plans", F.lit(0))["amount"].alias("least"))


@query(r"""SELECT page_id, CASE WHEN regexp_matches(v, '(?i)\bnsfw\b|\bxxx\b|\bsexting\b') THEN 'nsfw' ELSE 'needs_review' END AS status FROM (SELECT page_id, substr(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?i)<script\b[\s\S]*?</script>', ' ', 'g'), '(?i)<style\b[\s\S]*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), 1, 12000) AS v FROM pages)""")
def page_safety(spark: SparkSession, d: str) -> DataFrame:
    """Content safety of every page by rules (H-19)."""
    return table(spark, d, "pages").select("page_id", content_safety(H.visible_text("html"), X.domain("url"))["status"].alias("status"))


@query("""SELECT doc_id, CAST(round(n_chars / 100.0) AS BIGINT) AS hundreds, n_chars // 1000 AS thousands FROM documents""")
def integer_arithmetic(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.round(F.col("n_chars") / 100.0).cast("long").alias("hundreds"), F.floor(F.col("n_chars") / 1000).cast("long").alias("thousands"))


@query("""SELECT o_orderkey, CAST(round_even(CAST(o_totalprice AS DECIMAL(18, 3)) * 100, 0) AS BIGINT) AS minor, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month FROM orders""")
def money_and_months(spark: SparkSession, d: str) -> DataFrame:
    """Minor units and month starts."""
    return table(spark, d, "orders").select("o_orderkey", N.amount_minor(F.col("o_totalprice").cast("decimal(18,3)")).alias("minor"), N.month_start(F.col("o_orderdate").cast("string")).cast("string").alias("month"))


@query("""
    SELECT conv_id, arg_max(role, (turn, text)) AS last_role, max(turn) AS last_turn, count(*) AS turns, count(*) FILTER (WHERE role = 'user') AS user_turns FROM conversations GROUP BY 1""")
def conversation_latest(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    return c.groupBy("conv_id").agg(F.max_by("role", F.struct("turn", "text")).alias("last_role"), F.max("turn").alias("last_turn"), F.count("*").alias("turns"), F.count_if(F.col("role") == "user").alias("user_turns"))


@query("""SELECT c_nationkey, c_custkey, c_acctbal FROM customer WHERE c_custkey > 500 ORDER BY c_custkey LIMIT 200""")
def keyset_page(spark: SparkSession, d: str) -> DataFrame:
    """One page of a keyset scan (O1)."""
    return table(spark, d, "customer").where("c_custkey > 500").orderBy("c_custkey").limit(200).select("c_nationkey", "c_custkey", "c_acctbal")


@query("""SELECT a.c_custkey, a.c_acctbal FROM customer a WHERE a.c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA'))""")
def semi_join_chain(spark: SparkSession, d: str) -> DataFrame:
    """Semi joins through two small tables."""
    n = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region").where("r_name = 'ASIA'")), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    return table(spark, d, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey", "c_acctbal")


@query("""SELECT o_custkey, month, visits, n_orders, round(visits - prev, 2) AS delta FROM (SELECT *, lag(visits) OVER (PARTITION BY o_custkey ORDER BY month) AS prev FROM (
    SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, round(sum(o_totalprice), 2) AS visits, count(*) AS n_orders FROM orders GROUP BY 1, 2))""")
def monthly_deltas(spark: SparkSession, d: str) -> DataFrame:
    """Monthly series and change since the month before."""
    w = Window.partitionBy("o_custkey").orderBy("month")
    return monthly(spark, d).withColumn("delta", F.round(F.col("visits") - F.lag("visits").over(w), 2))


@query("""SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2""")
def tumbling_hours(spark: SparkSession, d: str) -> DataFrame:
    """Extension: tumbling windows on the event stream's table."""
    return table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


# -- state rules ------------------------------------------------------------------------------------


@query("""
    WITH t AS (SELECT o_custkey AS k, max(CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'queued' END) AS status, count(*) AS generation, max(o_orderkey % 4) AS attempts FROM orders GROUP BY 1), w AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0)
    SELECT coalesce(t.k, w.k) AS k, CASE WHEN w.k IS NOT NULL AND (t.k IS NULL OR t.status = 'done') THEN 'queued' ELSE t.status END AS status,
           CASE WHEN t.k IS NULL THEN 1 WHEN w.k IS NOT NULL AND t.status = 'done' THEN generation + 1 ELSE generation END AS generation, CASE WHEN w.k IS NOT NULL AND (t.k IS NULL OR t.status = 'done') THEN 0 ELSE attempts END AS attempts FROM t FULL JOIN w ON t.k = w.k""")
def requeue_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Guarded re-queue with generations (M4)."""
    t = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max(F.when(F.col("o_orderstatus") == "F", "done").otherwise("queued")).alias("status"), F.count("*").alias("generation"), F.max(F.col("o_orderkey") % 4).alias("attempts"))
    return ST.requeue(t, table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k")), ["k"])


@query("""SELECT event_id, user_id FROM events e WHERE EXISTS (SELECT 1 FROM (SELECT user_id, max(event_id) % 5 AS generation FROM events GROUP BY 1) l WHERE l.user_id = e.user_id AND l.generation = e.event_id % 5)""")
def fenced_results(spark: SparkSession, d: str) -> DataFrame:
    """Only results that still hold the lease are written."""
    e = table(spark, d, "events")
    leases = e.groupBy("user_id").agg((F.max("event_id") % 5).alias("generation")).withColumn("token", F.lit(1))
    results = e.select("event_id", "user_id", (F.col("event_id") % 5).alias("generation"), F.lit(1).alias("token"))
    return ST.fenced(results, leases, ["user_id"]).select("event_id", "user_id")


@query("""
    WITH h AS (SELECT user_id, event_id, event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 1 ELSE 0 END AS new FROM events),
         v AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS version FROM h),
         r AS (SELECT user_id, CAST(version AS BIGINT) AS version, min(event_id) AS first_seen, max(event_id) AS last_seen, count(*) AS seen FROM v GROUP BY 1, 2)
    SELECT *, lead(first_seen) OVER (PARTITION BY user_id ORDER BY version) AS superseded_at, CASE WHEN lead(first_seen) OVER (PARTITION BY user_id ORDER BY version) IS NULL THEN 'active' ELSE 'superseded' END AS status FROM r""")
def content_versions(spark: SparkSession, d: str) -> DataFrame:
    """Versions by content, each superseded by the next."""
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return ST.content_versions(e, ["user_id"], "event_id", ["event_type"]).drop("version_hash")


@query("""
    WITH l AS (SELECT user_id, max(CASE WHEN event_type <> 'error' THEN event_id END) AS ok FROM events GROUP BY 1)
    SELECT e.user_id, count(*) FILTER (WHERE event_type = 'error' AND (ok IS NULL OR event_id > ok)) AS failures, CASE WHEN count(*) FILTER (WHERE event_type = 'error' AND (ok IS NULL OR event_id > ok)) >= 3 THEN 'needs_manual' ELSE 'automatic' END AS state FROM events e JOIN l ON e.user_id = l.user_id GROUP BY 1""")
def failure_streaks(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("failed", F.col("event_type") == "error")
    return ST.failure_streak(e, ["user_id"], "event_id", "failed")


@query("""
    WITH f AS (SELECT user_id, min(CASE WHEN regexp_matches(event_type, 'error|purchase') THEN event_id END) AS hit FROM events GROUP BY 1)
    SELECT event_id, CASE WHEN hit IS NULL OR event_id < hit THEN 'run' WHEN event_id = hit THEN 'tripped' ELSE 'deferred' END AS state FROM events e JOIN f ON e.user_id = f.user_id""")
def circuit_breaker(spark: SparkSession, d: str) -> DataFrame:
    return ST.circuit_breaker(table(spark, d, "events"), ["user_id"], "event_id", "event_type", "error|purchase").select("event_id", "state")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount * 10 >= 0.8 THEN 'auto_accepted' WHEN l_discount * 10 >= 0.5 THEN 'provisional' ELSE 'unresolved' END AS band FROM lineitem""")
def confidence_bands(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ST.confidence_band(F.col("l_discount") * 10).alias("band"))


@query("""
    WITH r AS (SELECT o_custkey AS k, o_orderkey AS run, CASE WHEN o_orderpriority = '1-URGENT' THEN 'manual' ELSE 'auto' END AS source, o_orderstatus AS status FROM orders)
    SELECT k, run, source, CASE WHEN run < max(run) OVER (PARTITION BY k) AND source <> 'manual' THEN 'superseded' ELSE status END AS status FROM r""")
def supersede_runs(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("run"), F.when(F.col("o_orderpriority") == "1-URGENT", "manual").otherwise("auto").alias("source"), F.col("o_orderstatus").alias("status"))
    return ST.supersede(r, ["k"], "run").select("k", "run", "source", "status")


@query("""
    WITH o AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey AS k, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 4 <> 0)
    SELECT coalesce(o.k, n.k) AS k, o.v AS old_value, n.v AS new_value FROM o FULL JOIN n ON o.k = n.k WHERE o.v IS DISTINCT FROM n.v""")
def change_log(spark: SparkSession, d: str) -> DataFrame:
    """Audit events from two states."""
    c = table(spark, d, "customer").withColumnRenamed("c_custkey", "k")
    old = c.where("k % 3 <> 0").select("k", F.col("c_mktsegment").alias("v"))
    new = c.where("k % 4 <> 0").select("k", F.when(F.col("c_acctbal") < 0, "DEBT").otherwise(F.col("c_mktsegment")).alias("v"))
    return ST.audit(old, new, ["k"], "v")


@query("""
    SELECT p_brand, list_sort(list_distinct(flatten(list(CASE WHEN n_nationkey IS NULL THEN [] ELSE [n_nationkey, n_regionkey + 100] END)))) AS ids, bool_or(n_nationkey IS NULL) AS invalid
    FROM part LEFT JOIN nation ON p_size = n_nationkey GROUP BY 1""")
def category_write_plan(spark: SparkSession, d: str) -> DataFrame:
    """Leaf and parent ids of each brand; unknown leaves are told."""
    tree = table(spark, d, "nation").select(F.col("n_nationkey").alias("slug"), F.col("n_nationkey").alias("id"), (F.col("n_regionkey") + 100).alias("parent_id"))
    return ST.write_plan(table(spark, d, "part"), tree, "p_brand", "p_size")
