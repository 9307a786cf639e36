"""Queries of rendering and escalation rules, AI traffic, and write plans of which most are valid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions import offers as O
from tally.functions import payload as P
from tally.operators import assignments as A
from tally.operators import state as ST
from tally.plans.batches import shared_folder
from tally.plans.catalog import query
from tally.sources import settings as SE
from tally.sources.tables import table


@query("""
    WITH o AS (SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'approved' ELSE 'manual_review' END AS review, CASE WHEN o_orderkey % 4 = 0 THEN 404 ELSE 200 END AS http, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'x' END AS html,
                      (['found', 'not_found', 'contact_sales'])[o_custkey % 3 + 1] AS page, o_custkey % 5 <> 0 AS strict, o_orderkey % 13 AS score, o_custkey % 2 = 0 AS none FROM orders)
    SELECT k, review <> 'approved' AND http = 200 AND html <> '' AND page IN ('found', 'not_found') AND strict AND (score < 8 OR none) AS render FROM o""")
def render_rules(spark: SparkSession, d: str) -> DataFrame:
    """Which pages a browser should render."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    page = F.get(F.array(F.lit("found"), F.lit("not_found"), F.lit("contact_sales")), (c % 3).cast("int"))
    errors = F.when(c % 2 == 0, F.array(F.lit("other"), F.lit("No public pricing plans found in text"))).otherwise(F.array(F.lit("other")))
    render = O.should_render(F.when(F.col("o_orderstatus") == "F", "approved").otherwise("manual_review"), F.when(k % 4 == 0, 404).otherwise(200), F.when(k % 9 == 0, "").otherwise("x"), page, c % 5 != 0, (k % 13).cast("int"), errors)
    return table(spark, d, "orders").select(k.alias("k"), render.alias("render"))


@query("""
    WITH l AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i, CASE l_partkey % 4 WHEN 0 THEN 'approved' WHEN 1 THEN 'manual_review' WHEN 2 THEN 'approved' END AS s, CAST(40 + l_suppkey % 50 AS INTEGER) AS c, 'm' || l_suppkey % 5 AS m FROM lineitem),
         a AS (SELECT *, coalesce(s = 'approved' AND c >= 60, FALSE) AS good FROM l WHERE i <= 3),
         g AS (SELECT k, count(*) AS n, min(CASE WHEN good THEN i END) AS first, max(CASE WHEN s IS NOT NULL THEN i END) AS last FROM a GROUP BY 1),
         o AS (SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'approved' ELSE 'manual_review' END AS review, CAST(45 + o_custkey % 50 AS INTEGER) AS conf, CASE WHEN o_custkey % 7 = 0 THEN 'not_found' ELSE 'found' END AS page, o_orderkey % 3 = 0 AS need FROM orders),
         j AS (SELECT o.*, coalesce(g.n, 0) AS n, g.first, coalesce(g.first, g.last) AS pick, (review <> 'approved' OR need) AND g.n > 0 AND page = 'found' AS asks FROM o LEFT JOIN g ON g.k = o.k)
    SELECT j.k, CASE WHEN asks AND pick IS NOT NULL THEN a.s WHEN asks AND need THEN 'manual_review' ELSE review END AS status, CASE WHEN asks AND pick IS NOT NULL THEN a.c WHEN asks AND need THEN least(conf, 55) ELSE conf END AS confidence,
           CASE WHEN asks AND pick IS NOT NULL THEN 'by model' WHEN asks AND need THEN 'rule|Rule extraction requires model verification: low, odd' ELSE 'rule' END AS errors, CASE WHEN asks AND pick IS NOT NULL THEN a.m END AS model, CAST(CASE WHEN asks THEN coalesce(first, n) ELSE 0 END AS INTEGER) AS asked
    FROM j LEFT JOIN a ON a.k = j.k AND a.i = j.pick""")
def escalation_rules(spark: SparkSession, d: str) -> DataFrame:
    """Which model's answer counts, how many were asked, and what needs a person (H21): an order's first lines are the models' answers."""
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    status = F.when(p % 4 == 1, "manual_review").when(p % 4 != 3, "approved")
    answer = F.struct(F.concat(F.lit("m"), (s % 5).cast("string")).alias("model"), status.alias("status"), (40 + s % 50).cast("int").alias("confidence"), F.array(F.lit("by model")).alias("errors"))
    answers = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", answer.alias("a")))), lambda x: x["a"]), 1, 3).alias("answers"))
    o = table(spark, d, "orders").join(answers, F.col("o_orderkey") == F.col("k"), "left")
    empty = F.from_json(F.lit("[]"), "array<struct<model:string,status:string,confidence:int,errors:array<string>>>")
    review, c = F.when(F.col("o_orderstatus") == "F", "approved").otherwise("manual_review"), F.col("o_custkey")
    out = O.escalated(review, (45 + c % 50).cast("int"), F.array(F.lit("rule")), F.when(c % 7 == 0, "not_found").otherwise("found"), F.col("o_orderkey") % 3 == 0, F.array(F.lit("low"), F.lit("odd")), F.coalesce("answers", empty))
    return o.select(F.col("o_orderkey").alias("k"), out.alias("x")).select("k", "x.status", "x.confidence", F.array_join("x.errors", "|").alias("errors"), "x.model", "x.asked")


@query("""
    WITH e AS (SELECT event_id AS k, user_id AS u, event_type AS t, round(value, 2) AS v FROM events)
    SELECT k, CASE WHEN k % 11 <> 0 THEN CAST(u * 10 AS DOUBLE) END AS total_visits, CASE WHEN k % 11 <> 0 AND k % 2 = 0 THEN 0.25 END AS referral_share, CASE WHEN k % 11 <> 0 AND k % 5 <> 0 THEN t END AS boundary,
           CASE WHEN k % 11 <> 0 THEN CASE WHEN k % 3 = 0 THEN 'bot ' || u || '=0.5,other=0.125' ELSE 'bot ' || u || '=0.5' END END AS sources, CASE WHEN k % 11 <> 0 THEN CASE WHEN k % 4 = 0 THEN '' ELSE t || ':2026-0' || (u % 9 + 1) || '-01' END END AS history,
           CASE WHEN k % 11 <> 0 THEN 'r' || u || '#' || (u % 7) || CASE WHEN k % 2 = 0 THEN ',s#' ELSE '' END END AS rankings, CASE WHEN k % 11 <> 0 THEN 200 END AS prompt_status, CASE WHEN k % 11 <> 0 AND k % 6 = 0 THEN 'late' END AS prompt_error, CASE WHEN k % 11 <> 0 THEN CAST(k % 3 AS INTEGER) END AS prompts FROM e""")
def ai_traffic_parts(spark: SparkSession, d: str) -> DataFrame:
    """All parts of AI traffic payloads (F49): sources and series that lack something are left out, odd kinds are null."""
    k, u, t = F.col("event_id"), F.col("user_id"), F.col("event_type")
    s = lambda x: x.cast("string")
    source = F.when(k % 3 == 0, ',{"Name":"other","Value":0.125}').otherwise(',{"Name":" ","Value":1},{"Name":"x","Value":"?"}')
    point = F.when(k % 4 == 0, '{"Date":"soon","Value":1}').otherwise(F.concat(F.lit('{"Date":"2026-0'), s(u % 9 + 1), F.lit('-17","Value":0.5},{"Date":"2026-01-01","Value":null}')))
    body = F.concat(
        F.lit('{"TotalVisits":'), s(u * 10), F.lit(',"ReferralTraffic":'), F.when(k % 2 == 0, "0.25").otherwise('"none"'), F.lit(',"Traffic":{"Distribution":{"Boundary":"'), F.when(k % 5 == 0, " ").otherwise(t), F.lit('","Chatbots":[{"Name":" bot '), s(u), F.lit('","Value":"0.5"}'), source,
        F.lit('],"Chart":[{"Name":"'), t, F.lit('","History":['), point, F.lit(']},{"Name":"","History":[]}]},"Split":[{"Name":"r'), s(u), F.lit('","Rank":'), s(u % 7), F.lit("}"), F.when(k % 2 == 0, ',{"Name":"s"}').otherwise(',{"Rank":1}'),
        F.lit(']},"TopPrompts":{"Status":200,"ErrorMessage":"'), F.when(k % 6 == 0, " late ").otherwise(""), F.lit('","Prompts":'), F.when(k % 3 == 0, "null").when(k % 3 == 1, '["a"]').otherwise('["a",{"b":1}]'), F.lit("}}"),
    )
    a = table(spark, d, "events").select("event_id", P.ai_traffic(F.when(k % 11 == 0, "[1]").otherwise(body)).alias("a"))
    joined = lambda x, f: F.array_join(F.transform(x, f), ",")
    return a.select(
        F.col("event_id").alias("k"), "a.total_visits", "a.referral_share", "a.boundary", joined("a.sources", lambda x: F.concat(x["name"], F.lit("="), s(x["share"]))).alias("sources"),
        joined("a.history", lambda x: F.concat(x["name"], F.lit(":"), F.array_join(F.transform(x["points"], lambda p: s(p["date"])), "+"))).alias("history"), joined("a.rankings", lambda x: F.concat(x["name"], F.lit("#"), F.coalesce(s(x["rank"]), F.lit("")))).alias("rankings"),
        F.col("a.top_prompts.status").cast("int").alias("prompt_status"), F.col("a.top_prompts.error").alias("prompt_error"), F.col("a.top_prompts.count").alias("prompts"),
    )


@query("""
    SELECT l_orderkey, list_sort(list_distinct(flatten(list(CASE WHEN n_nationkey IS NULL THEN [] ELSE [n_nationkey, n_regionkey + 100] END)))) AS ids, bool_or(n_nationkey IS NULL) AS invalid
    FROM lineitem LEFT JOIN nation ON l_suppkey % 27 = n_nationkey GROUP BY 1""")
def leaf_write_plans(spark: SparkSession, d: str) -> DataFrame:
    """Leaf and parent ids of each order's lines, of which most are known."""
    tree = table(spark, d, "nation").select(F.col("n_nationkey").alias("slug"), F.col("n_nationkey").alias("id"), (F.col("n_regionkey") + 100).alias("parent_id"))
    return ST.write_plan(table(spark, d, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 27).alias("leaf")), tree, "l_orderkey", "leaf")


_ASSIGNED = """old AS (SELECT o_custkey AS item, o_orderkey % 6 AS term_id, max(o_orderkey) AS run_id FROM orders GROUP BY 1, 2),
         o AS (SELECT item, term_id, run_id, run_id % 2 = 0 AS is_primary, run_id % 10 / 10.0 AS confidence, CASE WHEN run_id % 3 = 0 THEN 'manual' ELSE 'auto' END AS source, CASE WHEN run_id % 4 = 0 THEN 'verified' ELSE 'provisional' END AS decision_status,
                      CASE WHEN run_id % 5 <> 0 THEN run_id % 7 END AS reviewed_at, run_id % 11 AS updated_at, run_id % 11 AS assigned_at, 'e' || run_id AS evidence FROM old)"""


@query(f"""
    WITH {_ASSIGNED},
         lock AS (SELECT item, term_id AS locked FROM o WHERE is_primary AND source = 'manual' AND decision_status = 'verified' AND term_id <= 3 QUALIFY row_number() OVER (PARTITION BY item ORDER BY reviewed_at DESC NULLS LAST, updated_at DESC, term_id DESC) = 1),
         locks AS (SELECT * FROM lock WHERE locked > 0),
         p AS (SELECT c_custkey AS item, t AS term_id, 1000000 + c_custkey AS run_id, t = c_custkey % 8 AS prim, (c_custkey + t) % 10 / 10.0 AS confidence, 'new' AS evidence FROM customer, range(8) r(t) WHERE (c_custkey + t) % 3 <> 0),
         n AS (SELECT p.*, CASE WHEN prim AND locked IS NOT NULL THEN FALSE ELSE prim END AS is_primary,
                      CASE WHEN prim AND locked IS NOT NULL THEN 'superseded' WHEN confidence >= 0.8 THEN 'auto_accepted' WHEN confidence >= 0.5 THEN 'provisional' ELSE 'unresolved' END AS status FROM p LEFT JOIN locks ON locks.item = p.item)
    SELECT coalesce(o.item, n.item) AS item, coalesce(o.term_id, n.term_id) AS term_id, CASE WHEN k THEN o.run_id ELSE n.run_id END AS run_id, CASE WHEN k THEN o.is_primary ELSE n.is_primary END AS is_primary, CAST(CASE WHEN k THEN o.confidence ELSE n.confidence END AS DOUBLE) AS confidence,
           CASE WHEN k THEN o.decision_status ELSE n.status END AS decision_status, CASE WHEN k THEN o.source ELSE 'auto' END AS source, CASE WHEN k THEN o.evidence ELSE n.evidence END AS evidence,
           CASE WHEN k THEN o.assigned_at ELSE 99 END AS assigned_at, CASE WHEN n.item IS NOT NULL THEN 99 ELSE o.updated_at END AS updated_at
    FROM (SELECT o.*, n.item AS hit FROM o LEFT JOIN n ON n.item = o.item AND n.term_id = o.term_id) o FULL JOIN n ON n.item = o.item AND n.term_id = o.term_id, LATERAL (SELECT coalesce(o.source = 'manual', FALSE) OR n.item IS NULL AS k)""")
def assignment_writes(spark: SparkSession, d: str) -> DataFrame:
    """Every customer's categories after a run (M27): a person's decisions stay, a verified primary keeps new ones from competing."""
    old = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("item"), (F.col("o_orderkey") % 6).alias("term_id")).agg(F.max("o_orderkey").alias("run_id"))
    r = F.col("run_id")
    old = old.select(
        "item", "term_id", "run_id", (r % 2 == 0).alias("is_primary"), ((r % 10) / 10).alias("confidence"), F.when(r % 3 == 0, "manual").otherwise("auto").alias("source"), F.when(r % 4 == 0, "verified").otherwise("provisional").alias("decision_status"),
        F.when(r % 5 != 0, r % 7).alias("reviewed_at"), (r % 11).alias("updated_at"), (r % 11).alias("assigned_at"), F.concat(F.lit("e"), r.cast("string")).alias("evidence"),
    )
    terms = spark.range(6).select("id", F.when(F.col("id") <= 3, "primary_category").otherwise("capability").alias("dimension"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("item"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("t")).where("(item + t) % 3 <> 0")
    proposed = c.select("item", F.col("t").cast("long").alias("term_id"), (F.lit(1000000) + F.col("item")).alias("run_id"), (F.col("t") == F.col("item") % 8).alias("primary"), ((F.col("item") + F.col("t")) % 10 / 10).alias("confidence"), F.lit("new").alias("evidence"), F.lit(99).cast("long").alias("at"))
    return A.written_assignments(old, proposed, terms)


@query("""
    SELECT CASE event_type WHEN 'error' THEN 'error' ELSE 'info' END AS level, '{"level":"' || CASE event_type WHEN 'error' THEN 'error' ELSE 'info' END || '","message":"events.' || event_type || '","event":' || event_id || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',"note":"user \\"' || user_id || '\\""' END || '}' AS value FROM events""")
def event_log(spark: SparkSession, d: str) -> DataFrame:
    """Every event as a line of a JSON log, written in two runs and read back."""
    e, path = table(spark, d, "events"), shared_folder(spark, "log")
    note = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit('user "'), F.col("user_id").cast("string"), F.lit('"')))
    for half in (0, 1):
        part = e.where(F.col("event_id") % 2 == half)
        SE.write_log(SE.log_lines(part, F.col("event_type"), F.concat(F.lit("events."), F.col("event_type")), {"event": F.col("event_id"), "note": note}), path)
    return SE.read_log(spark, path)
