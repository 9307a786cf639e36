"""Queries of the whole market snapshot: customers are tools, monthly orders their traffic, events their ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.operators import state as ST
from tally.plans import market as M
from tally.plans.catalog import query
from tally.sources.tables import table

#: The stand-in tables, in terms that Spark SQL and DuckDB share.
PARTS = {
    "tools": """SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 9 THEN 'draft' ELSE 'published' END AS status, CASE WHEN c_acctbal >= 0 THEN 'safe' ELSE 'nsfw' END AS content_safety_status, CASE WHEN c_custkey % 12 = 0 THEN 1 END AS duplicate_of_tool_id,
        CASE WHEN c_custkey % 7 = 3 THEN 'rejected' WHEN c_custkey % 7 = 1 THEN 'pending' ELSE 'verified' END AS verification_status, CASE WHEN c_custkey % 8 = 7 THEN 'stale' ELSE 'fresh' END AS staleness_status, CONCAT(' D', c_custkey - c_custkey % 2) AS normalized_domain,
        CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END AS first_published_at, 'M' AS listed_at, CASE WHEN c_nationkey <> 3 THEN c_nationkey END AS primary_category_id FROM customer""",
    "traffic": """SELECT 'sw' AS source, CONCAT('d', o_custkey - o_custkey % 2) AS domain, CONCAT(EXTRACT(YEAR FROM o_orderdate), '-', CASE WHEN EXTRACT(MONTH FROM o_orderdate) < 7 THEN '01' ELSE '07' END, '-01') AS traffic_month, SUM(CAST(FLOOR(o_totalprice) AS BIGINT)) AS visits,
        CASE WHEN COUNT(*) % 3 <> 0 THEN MIN(CAST(FLOOR(o_totalprice / 10) AS BIGINT)) END AS ai_visits, CASE WHEN COUNT(*) % 3 <> 0 THEN 0.1 END AS gen_ai_share,
        CASE MIN(o_orderkey) % 4 WHEN 0 THEN '{"traffic_sources":{"search_organic":0.25,"search_paid":0.05}}' WHEN 1 THEN '{"search_traffic_share":0.4,"search_paid_traffic_share":0.0125}' WHEN 2 THEN '{"traffic_sources":{"search":2.5}}' END AS metrics_json FROM orders GROUP BY 2, 3""",
    "countries": """SELECT 'sw' AS source, CONCAT('d', o_custkey - o_custkey % 2) AS domain, CONCAT(EXTRACT(YEAR FROM o_orderdate), '-', CASE WHEN EXTRACT(MONTH FROM o_orderdate) < 7 THEN '01' ELSE '07' END, '-01') AS traffic_month, CONCAT('C', o_orderkey % 4) AS country_code, MIN(CAST(o_orderkey % 5 + 1 AS INT)) AS country_position,
        MAX(CAST(o_orderkey % 97 * 100 AS INT)) AS traffic_share_bps, CAST(NULL AS BIGINT) AS estimated_visits FROM orders GROUP BY 2, 3, 4""",
    "ratings": "SELECT CONCAT('d', user_id * 2) AS domain, CAST(ts AS DATE) AS observed_date, MAX(value) AS rating FROM events GROUP BY 1, 2",
    "checks": "SELECT 'sw' AS source, CONCAT(EXTRACT(YEAR FROM o_orderdate), '-', CASE WHEN EXTRACT(MONTH FROM o_orderdate) < 7 THEN '01' ELSE '07' END, '-01') AS traffic_month, CASE WHEN SUM(o_orderkey) % 7 = 0 THEN 'unavailable' ELSE 'available' END AS status FROM orders GROUP BY 2",
    "categories": "SELECT n_nationkey AS id FROM nation WHERE n_nationkey < 20 AND n_nationkey > 0",
}


def _part(spark: SparkSession, d: str, name: str) -> DataFrame:
    source = PARTS[name].partition(" FROM ")[2] if name in ("tools", "categories", "ratings") else "orders"
    source = source.split()[0]
    text = PARTS[name].replace("{", "{{").replace("}", "}}")
    return spark.sql(text.replace(f"FROM {source}", "FROM {source}"), source=table(spark, d, source))


def _built(spark: SparkSession, d: str) -> M.Snapshot:
    p = {n: _part(spark, d, n) for n in PARTS}
    return M.build(p["tools"], p["traffic"], p["countries"], p["ratings"], p["checks"], p["categories"], "sw")


_SNAP = ", ".join(f"{n} AS ({q})" for n, q in PARTS.items()) + """,
    seen AS (SELECT id AS tool_id, lower(trim(normalized_domain)) AS domain, primary_category_id FROM tools WHERE status = 'published' AND content_safety_status = 'safe' AND duplicate_of_tool_id IS NULL AND verification_status IN ('verified', 'pending') AND staleness_status IN ('fresh', 'aging')
             QUALIFY row_number() OVER (PARTITION BY lower(trim(normalized_domain)) ORDER BY coalesce(first_published_at, listed_at) NULLS FIRST, id) = 1),
    gated AS (SELECT DISTINCT traffic_month FROM traffic WHERE traffic_month IN (SELECT traffic_month FROM checks WHERE status = 'available')), m AS (SELECT max(traffic_month) AS now FROM gated), b AS (SELECT max(traffic_month) AS before FROM gated WHERE traffic_month < (SELECT now FROM m)),
    h AS (SELECT domain, max(observed_date) AS day, arg_max(rating, observed_date) AS dr FROM ratings GROUP BY 1),
    base AS (SELECT r.domain, r.rating, h.day - r.observed_date AS days FROM ratings r JOIN h ON h.domain = r.domain WHERE h.day - r.observed_date BETWEEN 20 AND 45 QUALIFY row_number() OVER (PARTITION BY r.domain ORDER BY abs(h.day - r.observed_date - 30), r.observed_date DESC) = 1),
    j AS (SELECT s.*, t.visits, t.ai_visits, t.gen_ai_share, t.metrics_json AS js, p.visits AS visits_before, p.ai_visits AS ai_before, h.dr, base.rating AS dr_base, base.days FROM seen s LEFT JOIN traffic t ON t.domain = s.domain AND t.traffic_month = (SELECT now FROM m) LEFT JOIN traffic p ON p.domain = s.domain AND p.traffic_month = (SELECT before FROM b)
          LEFT JOIN h ON h.domain = s.domain LEFT JOIN base ON base.domain = s.domain),
    w AS (SELECT *, coalesce(TRY_CAST(json_extract_string(js, '$.traffic_sources.search_organic') AS DOUBLE), TRY_CAST(json_extract_string(js, '$.search_organic_traffic_share') AS DOUBLE)) AS organic, coalesce(TRY_CAST(json_extract_string(js, '$.traffic_sources.search_paid') AS DOUBLE), TRY_CAST(json_extract_string(js, '$.search_paid_traffic_share') AS DOUBLE)) AS paid,
          coalesce(TRY_CAST(json_extract_string(js, '$.traffic_sources.search') AS DOUBLE), TRY_CAST(json_extract_string(js, '$.search_traffic_share') AS DOUBLE)) AS explicit FROM j),
    x AS (SELECT *, coalesce(explicit, CASE WHEN organic IS NOT NULL OR paid IS NOT NULL THEN coalesce(organic, 0) + coalesce(paid, 0) END) AS search FROM w),
    tool AS (SELECT *, CASE WHEN search BETWEEN 0 AND 1 THEN CAST(round(search * 10000.0) AS BIGINT) END AS search_share_bps, CASE WHEN organic BETWEEN 0 AND 1 THEN CAST(round(organic * 10000.0) AS BIGINT) END AS organic_share_bps, CASE WHEN paid BETWEEN 0 AND 1 THEN CAST(round(paid * 10000.0) AS BIGINT) END AS paid_share_bps, dr - dr_base AS dr_delta FROM x),
    country AS (SELECT t.tool_id, t.domain, t.primary_category_id, c.country_code, c.country_position, c.traffic_share_bps, CAST(round(t.visits * c.traffic_share_bps / 10000.0) AS BIGINT) AS estimated_visits, CAST(round(t.ai_visits * c.traffic_share_bps / 10000.0) AS BIGINT) AS estimated_ai_visits FROM tool t JOIN countries c ON c.domain = t.domain AND c.traffic_month = (SELECT now FROM m)),
    one AS (SELECT CASE WHEN primary_category_id IN (SELECT id FROM categories) THEN CAST(primary_category_id AS BIGINT) END AS category, country_code AS country, domain, max(estimated_visits) AS v, max(estimated_ai_visits) AS a FROM country GROUP BY 1, 2, 3),
    rollup_ AS (SELECT CAST(0 AS BIGINT) AS category, '' AS country, count(*) AS tool_count, NULL AS visits, NULL AS ai_visits, 0 AS unknown_visits, 0 AS unknown_ai_visits FROM tool HAVING count(*) > 0
        UNION ALL SELECT CAST(primary_category_id AS BIGINT), '', count(*), NULL, NULL, 0, 0 FROM tool WHERE primary_category_id IN (SELECT id FROM categories) GROUP BY 1
        UNION ALL SELECT 0, country, count(*), CAST(sum(v) AS BIGINT), CAST(sum(a) AS BIGINT), count(*) FILTER (WHERE v IS NULL), count(*) FILTER (WHERE a IS NULL) FROM one GROUP BY 2
        UNION ALL SELECT category, country, count(*), CAST(sum(v) AS BIGINT), CAST(sum(a) AS BIGINT), count(*) FILTER (WHERE v IS NULL), count(*) FILTER (WHERE a IS NULL) FROM one WHERE category IS NOT NULL GROUP BY 1, 2)"""

_COVERED = """SELECT (SELECT count(*) FROM tool) AS total_tools, (SELECT count(visits) FROM tool) AS traffic_tools, (SELECT count(search_share_bps) FROM tool) AS search_tools, (SELECT count(paid_share_bps) FROM tool) AS paid_tools, (SELECT count(ai_visits) FROM tool) AS ai_tools, (SELECT count(dr) FROM tool) AS dr_tools, (SELECT count(dr_delta) FROM tool) AS dr_comparable_tools,
    (SELECT count(primary_category_id) FROM tool) AS category_tools, (SELECT count(*) FROM country) AS country_rows, (SELECT count(DISTINCT tool_id) FROM country) AS country_tools, (SELECT count(DISTINCT country_code) FROM country) AS countries, (SELECT count(*) FROM country WHERE estimated_visits IS NULL) AS country_estimated_unknown_rows,
    (SELECT count(estimated_ai_visits) FROM country) AS country_ai_rows, (SELECT count(DISTINCT tool_id) FROM country WHERE estimated_ai_visits IS NOT NULL) AS country_ai_tools, (SELECT count(primary_category_id) FROM country) AS country_category_rows, 0 AS snapshot_catalog_eligibility_revision, 0 AS current_catalog_eligibility_revision,
    (SELECT count(*) FROM rollup_) AS facet_rollup_rows, (SELECT count(*) FROM rollup_ WHERE category = 0 AND country = '') AS facet_rollup_global_rows, (SELECT coalesce(sum(tool_count), 0) FROM rollup_ WHERE category = 0 AND country = '') AS facet_rollup_global_tools, (SELECT count(*) FROM rollup_ WHERE category > 0 AND country = '') AS facet_rollup_category_rows,
    (SELECT coalesce(sum(tool_count), 0) FROM rollup_ WHERE category > 0 AND country = '') AS facet_rollup_category_tools, (SELECT count(*) FROM rollup_ WHERE category = 0 AND country <> '') AS facet_rollup_country_rows, (SELECT coalesce(sum(tool_count), 0) FROM rollup_ WHERE category = 0 AND country <> '') AS facet_rollup_country_tools,
    (SELECT coalesce(sum(unknown_visits), 0) FROM rollup_ WHERE category = 0 AND country <> '') AS facet_rollup_country_estimated_unknown_rows, (SELECT coalesce(sum(unknown_ai_visits), 0) FROM rollup_ WHERE category = 0 AND country <> '') AS facet_rollup_country_ai_unknown_rows,
    (SELECT count(*) FROM rollup_ WHERE category > 0 AND country <> '') AS facet_rollup_category_country_rows, (SELECT coalesce(sum(tool_count), 0) FROM rollup_ WHERE category > 0 AND country <> '') AS facet_rollup_category_country_tools"""


@query(f"""WITH {_SNAP} SELECT tool_id, domain, visits, visits - visits_before AS visits_delta, CASE WHEN visits_before > 0 THEN round((visits - visits_before) / CAST(visits_before AS DOUBLE), 6) END AS visits_growth, search_share_bps, organic_share_bps, paid_share_bps,
    CAST(round(visits * search_share_bps / 10000.0) AS BIGINT) AS search_visits, ai_visits, ai_visits - ai_before AS ai_delta, dr, round(dr_delta, 6) AS dr_delta, round(dr_delta * 30.0 / nullif(days, 0), 6) AS dr_velocity FROM tool""")
def market_tools(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of every visible tool."""
    t = _built(spark, d).tools
    return t.select("tool_id", "domain", "visits", "visits_delta", F.round("visits_growth", 6).alias("visits_growth"), "search_share_bps", "organic_share_bps", "paid_share_bps", "search_visits", "ai_visits", "ai_delta", "dr", F.round("dr_delta", 6).alias("dr_delta"), F.round("dr_velocity", 6).alias("dr_velocity"))


@query(f"WITH {_SNAP} SELECT tool_id, country_code, country_position, traffic_share_bps, estimated_visits, estimated_ai_visits FROM country")
def market_countries(spark: SparkSession, d: str) -> DataFrame:
    """Modeled visits by country."""
    return _built(spark, d).countries.select("tool_id", "country_code", "country_position", "traffic_share_bps", "estimated_visits", "estimated_ai_visits")


@query(f"WITH {_SNAP} SELECT category, country, tool_count, visits, ai_visits, CAST(unknown_visits AS BIGINT) AS unknown_visits, CAST(unknown_ai_visits AS BIGINT) AS unknown_ai_visits FROM rollup_")
def market_rollups(spark: SparkSession, d: str) -> DataFrame:
    """Four grains of the snapshot."""
    return _built(spark, d).rollups


@query(f"WITH {_SNAP} {_COVERED}")
def market_coverage(spark: SparkSession, d: str) -> DataFrame:
    """The 28 counts of a snapshot (A3)."""
    return _built(spark, d).coverage


@query(f"""WITH {_SNAP}, c AS ({_COVERED}), k AS (SELECT unnest([{{'check': 'facet_rollup_global_rows', 'ok': facet_rollup_global_rows = 1}}, {{'check': 'facet_rollup_global_tools', 'ok': facet_rollup_global_tools = total_tools}}, {{'check': 'facet_rollup_category_tools', 'ok': facet_rollup_category_tools = category_tools}}, {{'check': 'facet_rollup_country_rows', 'ok': facet_rollup_country_rows = countries}},
    {{'check': 'facet_rollup_country_tools', 'ok': facet_rollup_country_tools = country_rows}}, {{'check': 'facet_rollup_country_ai_unknown_rows', 'ok': facet_rollup_country_ai_unknown_rows = country_rows - country_ai_rows}}, {{'check': 'facet_rollup_category_country_tools', 'ok': facet_rollup_category_country_tools = country_category_rows}},
    {{'check': 'search_tools', 'ok': search_tools >= greatest(1, (traffic_tools * 2500 + 9999) // 10000)}}, {{'check': 'dr_comparable_tools', 'ok': dr_comparable_tools >= greatest(1, (traffic_tools * 100 + 9999) // 10000)}}, {{'check': 'paid_tools', 'ok': paid_tools >= greatest(1, (traffic_tools * 2500 + 9999) // 10000)}}]) AS s FROM c)
    SELECT s['check'] AS "check", s.ok AS ok FROM k""")
def market_gates(spark: SparkSession, d: str) -> DataFrame:
    """Which equalities and gates of a built snapshot hold (G2, G3, G4); the driver sees one row of counts."""
    c = _built(spark, d).coverage.first().asDict()
    broken = {m.split("=")[0] for m in M.rollup_mismatches(c)} | {m.split(":")[0].split(" ")[0] for m in M.gate_failures(c)}
    names = ["facet_rollup_global_rows", "facet_rollup_global_tools", "facet_rollup_category_tools", "facet_rollup_country_rows", "facet_rollup_country_tools", "facet_rollup_country_ai_unknown_rows", "facet_rollup_category_country_tools", "search_tools", "dr_comparable_tools", "paid_tools"]
    return spark.createDataFrame([(n, n not in broken) for n in names], "check string, ok boolean")


@query(f"""WITH {_SNAP} SELECT 'dry_run' AS status, (SELECT now FROM m) AS traffic_month, (SELECT before FROM b) AS baseline_month, (SELECT count(*) FROM tool) AS total_tools, (SELECT count(visits) FROM tool) AS traffic_tools, (SELECT count(*) FROM country) AS country_rows, (SELECT count(DISTINCT tool_id) FROM country) AS country_tools""")
def market_preview(spark: SparkSession, d: str) -> DataFrame:
    """A dry run."""
    p = {n: _part(spark, d, n) for n in PARTS}
    return M.preview(p["tools"], p["traffic"], p["countries"], p["checks"], "sw")


@query("""SELECT o_custkey, y, CASE WHEN bool_or(o_orderstatus = 'F' AND (o_totalprice > 200000 OR o_orderkey % 3 = 0)) THEN 'available' ELSE 'unavailable' END AS status, count(*) AS attempts FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders) GROUP BY 1, 2""")
def release_status(spark: SparkSession, d: str) -> DataFrame:
    """A month is available once an observation is done and has visits or a rank."""
    o = table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), F.when(F.col("o_orderstatus") == "F", "done").otherwise("failed").alias("status"), F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice")).alias("visits"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey")).alias("global_rank"))
    return ST.release_gate(o, ["o_custkey", "y"])
