"""Queries of enrichment: readiness, work queues, writes and audits over the catalogue.

The given tables stand in for the catalogue's: customers are entries, orders their assets and
localizations, events their traffic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.operators import readiness as RD
from tally.operators import state as ST
from tally.operators import writes as W
from tally.plans.catalog import query
from tally.sources.tables import table

NOW, STALE = "TIMESTAMP '1999-01-01 00:00:00'", "TIMESTAMP '1997-06-01 00:00:00'"

#: The stand-in tables, in terms that Spark SQL and DuckDB share.
PARTS = {
    "tools": """SELECT c_custkey AS id, CAST(c_custkey % 200 AS VARCHAR(9)) AS normalized_domain, CASE WHEN c_acctbal >= 0 THEN 'safe' ELSE 'pending' END AS content_safety_status,
        CASE WHEN c_nationkey >= 8 THEN c_nationkey END AS primary_category_id, CASE WHEN c_custkey % 7 = 0 THEN 'needs_manual' ELSE 'auto_ok' END AS category_classification_status,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'unknown' ELSE 'paid' END AS pricing_model, CASE c_custkey % 4 WHEN 0 THEN 'published' WHEN 1 THEN 'pending_enrich' WHEN 2 THEN 'pending_review' ELSE 'rejected' END AS status,
        CASE WHEN c_custkey % 11 = 0 THEN c_custkey - 1 END AS duplicate_of_tool_id, CASE c_custkey % 3 WHEN 0 THEN 'ready' WHEN 1 THEN 'blocked' END AS previous_readiness, TIMESTAMP '1998-01-01 00:00:00' AS previous_transition FROM customer""",
    "assets": """SELECT o_custkey AS tool_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'screenshot' WHEN '2-HIGH' THEN 'favicon' ELSE 'logo' END AS asset_kind, CASE WHEN o_orderkey % 5 = 0 THEN 'b' ELSE 'a' END AS storage_bucket, o_orderstatus <> 'F' OR o_orderkey % 2 = 0 AS is_current FROM orders""",
    "localizations": """SELECT o_custkey AS tool_id, CASE o_orderstatus WHEN 'P' THEN 'draft' ELSE 'published' END AS translation_status, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS published_at, o_orderpriority AS name, CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE o_orderpriority END AS short_description,
        CASE o_orderkey % 5 WHEN 0 THEN 'rejected' WHEN 1 THEN 'approved' END AS name_review_status, CASE o_orderkey % 6 WHEN 1 THEN '["x"]' WHEN 2 THEN '[]' END AS feature_highlights FROM orders WHERE o_orderkey % 2 = 0""",
    "features": "SELECT l_partkey AS tool_id FROM lineitem WHERE l_linenumber = 7",
    "categories": "SELECT p_partkey AS tool_id FROM part WHERE p_size < 5",
    "sources": "SELECT o_custkey AS tool_id FROM orders WHERE o_totalprice > 100000",
    "traffic": "SELECT CAST(user_id AS VARCHAR(9)) AS normalized_domain FROM events WHERE event_type = 'view'",
    "states": "SELECT CAST(user_id AS VARCHAR(9)) AS normalized_domain, CASE WHEN event_type = 'click' THEN ts END AS last_crawled_at FROM events WHERE event_id % 4 = 0",
    "prices": "SELECT o_custkey AS tool_id, o_orderstatus = 'O' AS is_active, CASE WHEN o_totalprice > 250000 THEN o_orderdate END AS last_success_at FROM orders",
    "tasks": """SELECT c_custkey AS task_tool_id, CASE c_custkey % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'queued' WHEN 2 THEN 'processing' WHEN 3 THEN 'done' ELSE 'sync_failed' END AS task_status, c_custkey % 4 AS attempts, 3 AS max_attempts,
        CASE WHEN c_nationkey % 2 = 0 THEN TIMESTAMP '1998-06-01 00:00:00' WHEN c_nationkey % 3 = 0 THEN TIMESTAMP '1999-06-01 00:00:00' END AS next_retry_at, CASE WHEN c_nationkey % 2 = 1 THEN TIMESTAMP '1998-06-01 00:00:00' ELSE TIMESTAMP '1999-06-01 00:00:00' END AS lease_expires_at,
        CASE WHEN c_custkey % 13 = 0 THEN TIMESTAMP '1998-01-01 00:00:00' END AS dead_letter_at, CASE WHEN c_acctbal < 3000 THEN TIMESTAMP '1997-01-01 00:00:00' ELSE TIMESTAMP '1998-12-01 00:00:00' END AS task_updated_at FROM customer WHERE c_custkey % 6 <> 5""",
}


def _part(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A stand-in table; Spark's columns of time have no zone, as in the files."""
    text = PARTS[name].replace("TIMESTAMP '", "TIMESTAMP_NTZ '").replace("VARCHAR(9)", "STRING")
    source = text.rpartition(" FROM ")[2].split()[0]
    return spark.sql(text.replace(f"FROM {source}", "FROM {source}"), source=table(spark, d, source))


def _with(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({PARTS[n]})" for n in names)


_PUBLISHED = "l.tool_id = t.id AND l.translation_status = 'published' AND l.published_at IS NOT NULL"
_FLAGS = f"""f AS (SELECT t.*, t.content_safety_status = 'safe' AS s0,
    EXISTS (SELECT 1 FROM assets a WHERE a.tool_id = t.id AND a.asset_kind = 'screenshot' AND a.is_current) AS s1,
    EXISTS (SELECT 1 FROM assets a WHERE a.tool_id = t.id AND a.asset_kind = 'screenshot' AND a.storage_bucket = 'a' AND a.is_current) AS s1b,
    EXISTS (SELECT 1 FROM assets a WHERE a.tool_id = t.id AND a.asset_kind = 'favicon' AND a.is_current) AS w0,
    EXISTS (SELECT 1 FROM localizations l WHERE {_PUBLISHED} AND trim(l.name) <> '' AND trim(coalesce(l.short_description, '')) <> '') AS s2,
    EXISTS (SELECT 1 FROM localizations l WHERE {_PUBLISHED} AND trim(coalesce(l.short_description, '')) <> '') AS s2b,
    EXISTS (SELECT 1 FROM localizations l WHERE {_PUBLISHED} AND trim(l.name) <> '' AND coalesce(l.name_review_status, 'legacy_unreviewed') NOT IN ('needs_review', 'rejected')) AS s3,
    EXISTS (SELECT 1 FROM features x WHERE x.tool_id = t.id) OR EXISTS (SELECT 1 FROM localizations l WHERE {_PUBLISHED} AND json_array_length(coalesce(l.feature_highlights, '[]')) > 0) AS s4,
    t.primary_category_id IS NOT NULL OR EXISTS (SELECT 1 FROM categories x WHERE x.tool_id = t.id) AS s5,
    EXISTS (SELECT 1 FROM sources x WHERE x.tool_id = t.id) AS s6,
    EXISTS (SELECT 1 FROM traffic x WHERE x.normalized_domain = t.normalized_domain) AS w1,
    EXISTS (SELECT 1 FROM states x WHERE x.normalized_domain = t.normalized_domain AND x.last_crawled_at IS NOT NULL) AS w2,
    t.pricing_model <> 'unknown' OR EXISTS (SELECT 1 FROM prices x WHERE x.tool_id = t.id AND x.is_active AND x.last_success_at IS NOT NULL) AS w3,
    t.category_classification_status = 'needs_manual' AS manual FROM tools t)"""
_ALL = ("tools", "assets", "localizations", "features", "categories", "sources", "traffic", "states", "prices")


def _flags(spark: SparkSession, d: str) -> DataFrame:
    return RD.lifecycle(*[_part(spark, d, n) for n in _ALL], bucket="a")


def _listed(*pairs: tuple[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {when} THEN '{name}' END" for name, when in pairs) + ")"


@query(f"""{_with(*_ALL)}, {_FLAGS}, r AS (SELECT *, {_listed(("content_safety", "NOT s0"), ("screenshot", "NOT s1"), ("published_localization", "NOT s2"), ("name_quality", "NOT s3"), ("key_feature", "NOT s4"), ("category", "NOT s5"), ("source_evidence", "NOT s6"))} AS blocking,
        {_listed(("favicon", "NOT w0"), ("traffic", "NOT w1"), ("domain_state", "NOT w2"), ("pricing", "NOT w3"), ("category_needs_manual", "manual"))} AS warnings FROM f),
    q AS (SELECT *, CASE WHEN blocking = '' THEN 'ready' ELSE 'blocked' END AS readiness FROM r)
    SELECT id, blocking, warnings, readiness, CASE WHEN readiness IS NOT DISTINCT FROM previous_readiness THEN previous_transition ELSE {NOW} END AS transitioned_at,
           CASE WHEN readiness = 'ready' AND status = 'pending_enrich' THEN 'pending_review' ELSE status END AS status FROM q""")
def enrichment_readiness(spark: SparkSession, d: str) -> DataFrame:
    """Twelve flags, what blocks, what warns, and when readiness last changed."""
    out = RD.readiness(_flags(spark, d), F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))
    return out.select("id", F.array_join("blocking", ",").alias("blocking"), F.array_join("warnings", ",").alias("warnings"), "readiness", "transitioned_at", "status")


@query(f"""{_with(*_ALL)}, {_FLAGS} SELECT id, {_listed(("content_safety", "NOT s0"), ("screenshot", "NOT s1b"), ("favicon", "NOT w0"), ("description", "NOT s2b"), ("key_features", "NOT s4"), ("category", "NOT s5 AND NOT manual"))} AS missing FROM f""")
def missing_requirements(spark: SparkSession, d: str) -> DataFrame:
    """What asset work still has to bring to each entry."""
    return _flags(spark, d).select("id", F.array_join(RD.missing_requirements(), ",").alias("missing"))


@query(f"""{_with(*_ALL, "tasks")}, {_FLAGS} SELECT id FROM f LEFT JOIN tasks ON task_tool_id = id
    WHERE status IN ('published', 'pending_enrich', 'pending_review') AND duplicate_of_tool_id IS NULL AND trim(normalized_domain) <> ''
    AND ((status IN ('pending_enrich', 'pending_review') AND NOT s0) OR NOT s1b OR NOT w0 OR NOT s2b OR NOT s4 OR NOT s5)
    AND (task_tool_id IS NULL OR (dead_letter_at IS NULL AND task_status IN ('failed', 'sync_failed') AND attempts < max_attempts AND (next_retry_at IS NULL OR next_retry_at <= {NOW}))
         OR (task_status = 'queued' AND dead_letter_at IS NULL) OR (task_status = 'processing' AND dead_letter_at IS NULL AND lease_expires_at <= {NOW}) OR (task_status = 'done' AND task_updated_at < {STALE}))""")
def asset_work(spark: SparkSession, d: str) -> DataFrame:
    """Active entries that lack assets and whose task may be queued."""
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    rows = _flags(spark, d).join(_part(spark, d, "tasks"), F.col("id") == F.col("task_tool_id"), "left")
    return rows.where(RD.is_active() & RD.lacks_assets() & RD.queueable(at("1999-01-01 00:00:00"), at("1997-06-01 00:00:00"))).select("id")


@query("""SELECT event_id, CASE WHEN raw IS NULL OR trim(raw) = '' OR event_type = 'error' THEN FALSE ELSE coalesce(json_extract_string(CASE WHEN json_valid(raw) THEN raw END, '$.backfill') = 'v1', FALSE) OR contains(raw, '"backfill":"v1"')
        OR coalesce(json_extract_string(CASE WHEN json_valid(raw) THEN raw END, '$.prompt_version') = 'p2' AND json_extract_string(CASE WHEN json_valid(raw) THEN raw END, '$.mode') = 'hierarchical', FALSE) END AS done FROM (
    SELECT event_id, event_type, CASE event_id % 6 WHEN 0 THEN '{"backfill": "v1"}' WHEN 1 THEN 'broken {"backfill":"v1"' WHEN 2 THEN '{"prompt_version":"p2","mode":"hierarchical"}' WHEN 3 THEN '{"prompt_version":"p2","mode":"flat"}' WHEN 4 THEN ' ' END AS raw FROM events)""")
def already_done(spark: SparkSession, d: str) -> DataFrame:
    """Classifications that need no second run."""
    k = F.col("event_id") % 6
    raw = F.when(k == 0, '{"backfill": "v1"}').when(k == 1, 'broken {"backfill":"v1"').when(k == 2, '{"prompt_version":"p2","mode":"hierarchical"}').when(k == 3, '{"prompt_version":"p2","mode":"flat"}').when(k == 4, " ")
    e = table(spark, d, "events").select("event_id", raw.alias("raw"), F.when(F.col("event_type") == "error", "failed").otherwise("auto_ok").alias("status"))
    return e.select("event_id", RD.already_done("raw", "status", "v1", "p2").alias("done"))


@query("""SELECT o_custkey, n_name, n_regionkey FROM (SELECT o_custkey, n_name, n_regionkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, n_name) AS rn
    FROM orders JOIN nation ON n_nationkey = o_orderkey % 40) WHERE rn = 1""")
def first_known_category(spark: SparkSession, d: str) -> DataFrame:
    """Of several proposed categories the first that is known."""
    n = table(spark, d, "nation")
    o = table(spark, d, "orders").join(F.broadcast(n.select("n_nationkey", "n_name")), F.col("o_orderkey") % 40 == F.col("n_nationkey"), "left").select("o_custkey", "o_orderpriority", "n_name")
    return RD.first_match(o, n.select("n_name", "n_regionkey"), ["o_custkey"], "n_name", "o_orderpriority").select("o_custkey", "n_name", "n_regionkey")


# -- queues -----------------------------------------------------------------------------------------


@query("""SELECT c_custkey, earliest FROM (SELECT c_custkey, min(coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END, o_orderdate + INTERVAL 30 DAY)) AS earliest, max(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) AS never FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    WHERE o_orderkey IS NULL OR o_orderstatus <> 'P' GROUP BY 1) ORDER BY never DESC, earliest, c_custkey LIMIT 500""")
def crawl_order(spark: SparkSession, d: str) -> DataFrame:
    """Entries never crawled come first, then those longest ago; a report of 500."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey")
    j = table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").where("o_orderkey IS NULL OR o_orderstatus <> 'P'")
    when = F.coalesce(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")), F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))
    g = j.groupBy("c_custkey").agg(F.min(when).alias("earliest"), F.max(F.col("o_orderkey").isNull()).alias("never"))
    return g.orderBy(F.desc("never"), F.asc_nulls_first("earliest"), "c_custkey").limit(500).select("c_custkey", "earliest")


@query("""WITH e AS (SELECT o_custkey, o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 <> 0 THEN 'u' || o_orderkey END AS url FROM orders)
    SELECT c_custkey, (SELECT url FROM e WHERE o_custkey = c_custkey AND url IS NOT NULL ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) AS best FROM customer""")
def best_evidence(spark: SparkSession, d: str) -> DataFrame:
    """The evidence of greatest confidence of each entry, null without any (O6): max_by, not a correlated top-k."""
    e = table(spark, d, "orders").where("o_orderkey % 3 <> 0")
    best = e.groupBy("o_custkey").agg(F.max_by(F.concat(F.lit("u"), F.col("o_orderkey").cast("string")), F.struct(F.col("o_totalprice"), -F.col("o_orderkey"))).alias("best"))
    return table(spark, d, "customer").join(best, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "best")


@query("""SELECT user_id, event_type, event_id, ts FROM (SELECT *, max(event_id) OVER (PARTITION BY user_id, CASE WHEN event_type IN ('error', 'click') THEN 'a' ELSE 'b' END) AS last FROM events) WHERE event_id = last AND event_type IN ('error', 'signup')""")
def failed_last_runs(spark: SparkSession, d: str) -> DataFrame:
    """Instances and workloads whose last run failed."""
    e = table(spark, d, "events").withColumn("workload", F.when(F.col("event_type").isin("error", "click"), "a").otherwise("b"))
    last = e.groupBy("user_id", "workload").agg(F.max_by(F.struct("event_type", "event_id", "ts"), "event_id").alias("l")).select("user_id", "l.*")
    return last.where(F.col("event_type").isin("error", "signup")).select("user_id", "event_type", "event_id", "ts")


@query("""SELECT l.l_orderkey, l.l_linenumber, c.c_name, n.n_name, r.r_name, p.p_name, s.s_name FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey JOIN part p ON p.p_partkey = l.l_partkey
    LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey AND s.s_acctbal > 5000 WHERE o.o_orderstatus = 'P'""")
def review_context(spark: SparkSession, d: str) -> DataFrame:
    """Six tables joined inner and one left (J13); small ones are broadcast by their size."""
    t = {n: table(spark, d, n) for n in ("lineitem", "orders", "customer", "nation", "region", "part", "supplier")}
    j = t["lineitem"].join(t["orders"].where("o_orderstatus = 'P'"), F.col("l_orderkey") == F.col("o_orderkey")).join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    j = j.join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).join(t["part"], F.col("p_partkey") == F.col("l_partkey"))
    return j.join(t["supplier"].where("s_acctbal > 5000"), F.col("s_suppkey") == F.col("l_suppkey"), "left").select("l_orderkey", "l_linenumber", "c_name", "n_name", "r_name", "p_name", "s_name")


@query("""SELECT * EXCLUDE (rn) FROM (SELECT o_orderkey AS id, 'queued' AS status, o_custkey AS owner, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') WHERE rn <= 50
    UNION ALL SELECT o_orderkey, 'dead', o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' ORDER BY o_orderdate, o_orderkey LIMIT 50)
    UNION ALL SELECT o_orderkey, lower(o_orderstatus), o_custkey FROM orders WHERE o_orderstatus <> 'F' OR o_orderpriority <> '1-URGENT'""")
def recovery_requeue(spark: SparkSession, d: str) -> DataFrame:
    """The fifty oldest dead letters of one cause are queued again, once."""
    o = table(spark, d, "orders")
    dead = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    rows = o.select(F.col("o_orderkey").alias("id"), F.when(dead, "dead").otherwise(F.lower("o_orderstatus")).alias("status"), F.col("o_custkey").alias("owner"), "o_orderdate")
    return W.recover(rows, F.col("status") == "dead", ["o_orderdate", "id"], 50).select("id", "status", "owner")


@query(f"""{_with("tasks")} SELECT task_tool_id, attempts + 1 AS attempts, CASE WHEN attempts + 1 >= max_attempts OR task_status = 'sync_failed' THEN 'dead' ELSE 'failed' END AS status,
    CASE WHEN attempts + 1 >= max_attempts OR task_status = 'sync_failed' THEN NULL ELSE {NOW} + to_minutes(CAST(CASE task_status WHEN 'queued' THEN 1440 WHEN 'processing' THEN CASE attempts + 1 WHEN 1 THEN 360 WHEN 2 THEN 1440 ELSE 4320 END WHEN 'done' THEN 360 ELSE least(60, pow(2, least(attempts + 1, 6))) END AS BIGINT)) END AS next_retry_at FROM tasks""")
def retry_schedule(spark: SparkSession, d: str) -> DataFrame:
    """Dead letters and the delay law of each kind of work."""
    t, n = _part(spark, d, "tasks"), F.col("attempts") + 1
    law = F.when(F.col("task_status") == "queued", W.retry_minutes("traffic", n)).when(F.col("task_status") == "processing", W.retry_minutes("assets", n)).when(F.col("task_status") == "done", W.retry_minutes("pricing", n)).otherwise(W.retry_minutes("rating", n))
    status = ST.after_failure(n, F.col("max_attempts"), F.col("task_status") != "sync_failed")
    now = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    return t.select("task_tool_id", n.alias("attempts"), status.alias("status"), F.when(status == "failed", now + F.make_dt_interval(mins=law)).alias("next_retry_at"))


@query("""SELECT c_custkey, CASE WHEN n >= 6 THEN 'exhausted' ELSE 'not_found' END AS status, CASE WHEN n < 6 THEN CAST(TIMESTAMP '1999-01-01 00:00:00' + to_hours(CAST(24 * pow(2, n - 1) AS BIGINT)) AS TIMESTAMP) END AS next_at FROM (SELECT c_custkey, c_custkey % 9 + 1 AS n FROM customer)""")
def discovery_backoff(spark: SparkSession, d: str) -> DataFrame:
    """Days between attempts double; after the last there is no next."""
    now = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    c = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 9).alias("attempts"))
    return W.discovery_backoff(c, now, most=6).select("c_custkey", "status", "next_at")


# -- writes -----------------------------------------------------------------------------------------


@query("""WITH o AS (SELECT c_custkey AS tool, c_nationkey AS term, CASE WHEN c_custkey % 5 = 0 THEN 'manual' ELSE 'auto' END AS source FROM customer WHERE c_custkey % 2 = 0
                     UNION ALL SELECT c_custkey, c_nationkey + 1, 'auto' FROM customer WHERE c_custkey % 3 = 0),
         n AS (SELECT DISTINCT o_custkey AS tool, o_orderkey % 25 AS term FROM orders WHERE o_orderstatus = 'P')
    SELECT tool, term, source FROM o WHERE source = 'manual' OR tool NOT IN (SELECT tool FROM n)
    UNION ALL SELECT tool, term, 'auto' FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.tool = n.tool AND o.term = n.term AND o.source = 'manual')""")
def replace_categories(spark: SparkSession, d: str) -> DataFrame:
    """Automatic rows of the entries that a batch names are replaced, manual ones stay."""
    c = table(spark, d, "customer")
    old = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("tool"), F.col("c_nationkey").cast("long").alias("term"), F.when(F.col("c_custkey") % 5 == 0, "manual").otherwise("auto").alias("source"))
    old = old.unionByName(c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("tool"), (F.col("c_nationkey") + 1).cast("long").alias("term"), F.lit("auto").alias("source")))
    new = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("tool"), (F.col("o_orderkey") % 25).alias("term"))
    return W.replace_automatic(old, new, ["tool"], ["term"])[0]


@query("""WITH n AS (SELECT DISTINCT o_custkey AS tool, o_orderkey % 25 AS term FROM orders WHERE o_orderstatus = 'P'), o AS (SELECT c_custkey AS tool, CAST(c_nationkey AS BIGINT) AS term FROM customer WHERE c_custkey % 2 = 0)
    SELECT coalesce(o.tool, n.tool) AS tool, coalesce(o.term, n.term) AS term, CASE WHEN n.tool IS NULL THEN 'removed' ELSE 'added' END AS event FROM (SELECT * FROM o WHERE tool IN (SELECT tool FROM n)) o FULL JOIN n ON o.tool = n.tool AND o.term = n.term WHERE o.tool IS NULL OR n.tool IS NULL""")
def replace_audit(spark: SparkSession, d: str) -> DataFrame:
    """One event for each row that a replacement adds or removes."""
    old = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("tool"), F.col("c_nationkey").cast("long").alias("term"), F.lit("auto").alias("source"))
    new = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("tool"), (F.col("o_orderkey") % 25).alias("term"))
    return W.replace_automatic(old, new, ["tool"], ["term"])[1].select("tool", "term", "event")


@query("""WITH f AS (SELECT l_orderkey AS tool, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS position, l_partkey AS feature FROM lineitem)
    SELECT tool, CAST(position AS INTEGER) AS position, feature FROM f WHERE position <= 6""")
def feature_positions(spark: SparkSession, d: str) -> DataFrame:
    """The first six features of each entry with their places."""
    l = table(spark, d, "lineitem")  # noqa: E741
    lists = l.groupBy(F.col("l_orderkey").alias("tool")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("features"))
    return W.positions(lists, ["tool"], "features", "feature", 6)


@query("""SELECT page_id, CASE WHEN published AND label = 'nsfw' THEN 'needs_review' ELSE label END AS status, CASE WHEN published AND label = 'nsfw' THEN list_append(evidence, 'proposed:nsfw')[1:12] ELSE evidence[1:12] END AS evidence FROM (
    SELECT page_id, page_id % 3 = 0 AS published, (['safe', 'nsfw', 'needs_review', 'nsfw'])[page_id % 4 + 1] AS label, list_transform(range(page_id % 15), lambda x: 'e' || x) AS evidence FROM pages)""")
def safety_decisions(spark: SparkSession, d: str) -> DataFrame:
    """A published entry is never taken down by a rule alone."""
    p = table(spark, d, "pages").select("page_id", (F.col("page_id") % 3 == 0).alias("published"), F.get(F.array(*map(F.lit, ("safe", "nsfw", "needs_review", "nsfw"))), (F.col("page_id") % 4).cast("int")).alias("label"),
        F.transform(F.expr("IF(page_id % 15 = 0, CAST(array() AS ARRAY<BIGINT>), sequence(0L, page_id % 15 - 1))"), lambda x: F.concat(F.lit("e"), x.cast("string"))).alias("evidence"))
    return p.select("page_id", *W.safety_decision("published", "label", "evidence"))


@query("""WITH r AS (SELECT user_id, event_type AS workload, event_id, ts, CASE WHEN event_id % 7 = 0 THEN 'failed' WHEN event_id % 11 = 0 THEN 'materialization_failed' WHEN event_id % 13 = 0 THEN 'stale' ELSE 'done' END AS outcome FROM events)
    SELECT user_id, workload, count(*) AS items, count(*) FILTER (WHERE outcome = 'failed') AS failed, count(*) FILTER (WHERE outcome = 'materialization_failed') AS materialization_failed, count(*) FILTER (WHERE outcome = 'stale') AS stale,
           CASE WHEN count(*) FILTER (WHERE outcome <> 'done') > 0 THEN 'degraded' ELSE 'ok' END AS status, min(ts) AS started_at, max(ts) AS finished_at FROM r GROUP BY 1, 2""")
def run_telemetry(spark: SparkSession, d: str) -> DataFrame:
    """Runs by instance and workload, degraded when anything failed or went stale."""
    k = lambda n: F.col("event_id") % n == 0
    e = table(spark, d, "events").withColumnRenamed("event_type", "workload").withColumn("outcome", F.when(k(7), "failed").when(k(11), "materialization_failed").when(k(13), "stale").otherwise("done"))
    return W.telemetry(e, ["user_id", "workload"], "outcome", "ts")


@query("""SELECT page_id, url, status, CASE WHEN status = 'ok' THEN substr(html, 1, 2000) END AS body FROM (SELECT page_id, url, html, CASE WHEN page_id % 5 = 0 THEN 'unsupported_type' WHEN length(html) > 4000 THEN 'too_large' ELSE 'ok' END AS status FROM pages)""")
def page_limits(spark: SparkSession, d: str) -> DataFrame:
    """Pages of a supported type and size; the rest keep only their status."""
    p = table(spark, d, "pages").withColumn("type", F.when(F.col("page_id") % 5 == 0, "image/png").otherwise("text/html; charset=utf-8"))
    out = W.limited_pages(p, "html", "type", 4000)
    return out.select("page_id", "url", "status", F.substring("body", 1, 2000).alias("body"))


@query("""SELECT user_id, event_id, CASE code WHEN 200 THEN CASE WHEN value > 10 THEN 'done' ELSE 'no_data' END WHEN 404 THEN 'no_data' WHEN 403 THEN 'forbidden' ELSE 'failed' END AS status FROM (SELECT user_id, event_id, value, (CASE event_id % 6 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 403 WHEN 3 THEN 429 WHEN 4 THEN 503 ELSE 200 END) AS code FROM events)""")
def payload_status(spark: SparkSession, d: str) -> DataFrame:
    """Status of a provider's answer; one without the month that was asked for has no data."""
    code = F.get(F.array(*map(F.lit, (200, 404, 403, 429, 503, 200))), (F.col("event_id") % 6).cast("int"))
    return table(spark, d, "events").select("user_id", "event_id", W.payload_status(code, F.col("value") > 10).alias("status"))


@query("""WITH a AS (SELECT user_id, min(value) - 1 AS dr FROM events WHERE event_type = 'view' AND user_id % 5 <> 0 GROUP BY 1), b AS (SELECT user_id, min(ts) AS born FROM events WHERE event_type = 'click' AND user_id % 2 = 0 GROUP BY 1)
    SELECT coalesce(a.user_id, b.user_id) AS user_id, CASE WHEN dr IS NOT NULL THEN least(greatest(dr * 100, 0), 100) END AS rating, born, CASE WHEN dr IS NULL THEN 'failed' ELSE 'done' END AS status FROM a FULL JOIN b ON a.user_id = b.user_id""")
def combined_observation(spark: SparkSession, d: str) -> DataFrame:
    """Rating and registration of a domain; the rating alone decides the status."""
    e = table(spark, d, "events")
    ratings = e.where("event_type = 'view' AND user_id % 5 <> 0").groupBy("user_id").agg(((F.min("value") - 1) * 100).alias("rating"))
    births = e.where("event_type = 'click' AND user_id % 2 = 0").groupBy("user_id").agg(F.min("ts").alias("born"))
    return W.combined(ratings, births, ["user_id"])


@query("""WITH o AS (SELECT user_id AS k, count(*) FILTER (WHERE event_type = 'view') AS checks, bool_or(event_type = 'purchase' AND value > 5) AS found, max(ts) AS last FROM events WHERE user_id % 3 <> 0 GROUP BY 1)
    SELECT c_custkey AS k, CASE WHEN o.k IS NULL THEN TRUE WHEN found THEN FALSE ELSE last <= TIMESTAMP '2024-01-13 00:00:00' END AS due FROM customer LEFT JOIN o ON o.k = c_custkey WHERE c_custkey < 150""")
def probe_due(spark: SparkSession, d: str) -> DataFrame:
    """Whether a month's release must be probed again: never seen, or not available and seen long ago."""
    e = table(spark, d, "events").where("user_id % 3 <> 0")
    seen = e.groupBy(F.col("user_id").alias("k")).agg(F.max((F.col("event_type") == "purchase") & (F.col("value") > 5)).alias("available"), F.max("ts").alias("checked_at"))
    keys = table(spark, d, "customer").where("c_custkey < 150").select(F.col("c_custkey").alias("k"))
    return ST.probe_due(keys, seen, ["k"], F.lit("2024-01-13 00:00:00").cast("timestamp_ntz"))
