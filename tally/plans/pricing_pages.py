"""Queries of plans, pages, names, assets and identity.

Lines of an order stand in for a page's plans, parts for products; pages are the given ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions import offers as O
from tally.functions import pages as P
from tally.operators import claims as C
from tally.plans.catalog import query
from tally.sources.tables import table

NAMES = ["Free", "Pro Plan", "Plan 3", "pro plan", "Enterprise", "Team", "Scale"]
_LINES = """l AS (SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i, (['Free', 'Pro Plan', 'Plan 3', 'pro plan', 'Enterprise', 'Team', 'Scale'])[l_linenumber] AS name,
        CASE WHEN l_linenumber = 1 THEN 0 WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS amount, CASE l_suppkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'EUR' ELSE 'USD' END AS currency, CASE l_linenumber % 3 WHEN 0 THEN 'monthly' WHEN 1 THEN 'yearly' END AS itv,
        l_linenumber <> 1 AND l_partkey % 10 = 0 AS quote, CASE l_partkey % 4 WHEN 0 THEN '$9 per month' WHEN 1 THEN 'funding round' ELSE 'see page' END AS shown FROM lineitem)"""


def _plans(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem")  # noqa: E741
    amount = F.when(F.col("l_linenumber") == 1, 0).when(F.col("l_partkey") % 5 != 0, F.col("l_quantity").cast("int")).cast("decimal(38,18)")
    quote = (F.col("l_linenumber") != 1) & (F.col("l_partkey") % 10 == 0)
    p = F.struct(
        F.get(F.array(*map(F.lit, NAMES)), F.col("l_linenumber") - 1).alias("name"), F.when(quote, "custom_quote").otherwise("recurring").alias("kind"), amount.alias("amount"), F.when(F.col("l_suppkey") % 6 == 0, "").when(F.col("l_suppkey") % 6 == 1, "EUR").otherwise("USD").alias("currency"),
        F.when(F.col("l_linenumber") % 3 == 0, "monthly").when(F.col("l_linenumber") % 3 == 1, "yearly").alias("interval"), quote.alias("custom_quote"), F.when(F.col("l_partkey") % 4 == 0, "$9 per month").when(F.col("l_partkey") % 4 == 1, "funding round").otherwise("see page").alias("display_text"),
    )
    rows = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", p.alias("p"))))
    return l.groupBy(F.col("l_orderkey").alias("page")).agg(F.transform(rows, lambda x: x["p"]).alias("plans"))


_ERRORS = """e AS (SELECT page, unnest(list_filter([CASE WHEN shown = '$9 per month' AND (amount IS NULL OR currency = '') THEN 'Explicit price text missing structured amount/currency: ' || name END, CASE WHEN shown = '$9 per month' AND quote THEN 'Explicit price text marked as custom quote: ' || name END,
        CASE WHEN NOT quote AND amount IS NOT NULL AND currency = '' THEN 'Structured price missing currency: ' || name END], lambda x: x IS NOT NULL)) AS m FROM l),
    pe AS (SELECT page, array_to_string(list_sort(list(DISTINCT m)), '|') AS m FROM e GROUP BY 1),
    g AS (SELECT page, bool_or(quote OR coalesce(amount > 0, FALSE)) AS paid, bool_or(name = 'Free') AS free, (['200', '404', '200'])[page % 3 + 1] AS code, count(DISTINCT nullif(currency, '')) AS currencies,
        count(*) FILTER (WHERE lower(name) NOT IN ('free', 'enterprise')) > count(DISTINCT CASE WHEN lower(name) NOT IN ('free', 'enterprise') THEN lower(name) END) AS twice, bool_or(name = 'Plan 3') AS generic, bool_or(shown = 'funding round') AS polluted FROM l GROUP BY 1),
    v AS (SELECT g.*, concat_ws('|', CASE WHEN code = '404' THEN 'HTTP 404' END, CASE WHEN code = '200' AND page % 5 = 0 THEN 'Final URL is not a strict pricing page' END, CASE WHEN code = '200' AND page % 7 = 0 THEN 'Final URL lost source context' END, pe.m, CASE WHEN NOT paid AND NOT free THEN 'No paid, free, or custom-quote plan found' END) AS errors FROM g LEFT JOIN pe USING (page))"""


@query(f"""WITH {_LINES}, {_ERRORS} SELECT page, errors, CASE WHEN errors = '' THEN 'approved' ELSE 'manual_review' END AS status, CASE WHEN errors = '' THEN 82 ELSE 45 END AS confidence,
    CASE WHEN errors <> '' THEN CASE WHEN page % 2 = 0 THEN 'browser_run_manual_review' ELSE 'manual_review' END WHEN page % 11 = 0 THEN CASE WHEN page % 2 = 0 THEN 'browser_run_openai' ELSE 'openai' END ELSE CASE WHEN page % 2 = 0 THEN 'browser_run_rule' ELSE 'rule' END END AS stage FROM v""")
def plan_checks(spark: SparkSession, d: str) -> DataFrame:
    """Errors, verdict and stage of each page's plans."""
    k = F.col("page")
    p = _plans(spark, d).withColumn("errors", O.plan_errors("plans", F.when(k % 3 == 1, 404).otherwise(200), k % 5 != 0, k % 7 != 0))
    p = p.withColumn("v", O.verdict("plans", "errors"))
    return p.select("page", F.array_join("errors", "|").alias("errors"), "v.status", "v.confidence", O.final_stage("v.status", k % 11 == 0, F.lit("found"), k % 2 == 0).alias("stage"))


@query(f"""WITH {_LINES}, {_ERRORS} SELECT page, concat_ws('|', CASE WHEN twice THEN 'Duplicate plan names in extracted pricing' END, CASE WHEN currencies > 1 THEN 'Multiple currencies in extracted pricing' END) AS inconsistent,
    CASE WHEN page % 13 = 0 THEN '' ELSE concat_ws('|', CASE WHEN twice THEN 'duplicate_plan_names' END, CASE WHEN generic THEN 'generic_plan_name' END, CASE WHEN page % 30 < 18 THEN 'low_text_quality' END, CASE WHEN currencies > 1 THEN 'mixed_currencies' END, CASE WHEN polluted THEN 'polluted_price_context' END) END AS reasons FROM v""")
def plan_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Repeated names, several currencies, and why a model should look."""
    return _plans(spark, d).select("page", F.array_join(O.consistency_errors("plans"), "|").alias("inconsistent"), F.array_join(O.review_reasons("plans", F.col("page") % 30, F.col("page") % 13 != 0), "|").alias("reasons"))


@query(f"""WITH {_LINES} SELECT page, string_agg(name, ',' ORDER BY CASE WHEN coalesce(amount, 0) = 0 THEN 0 WHEN itv = 'monthly' THEN 1 WHEN itv = 'yearly' THEN 2 ELSE 3 END, coalesce(amount, 0), i) AS names FROM l GROUP BY 1""")
def plan_order(spark: SparkSession, d: str) -> DataFrame:
    """Plans as a page shows them: free, monthly, yearly, other."""
    return _plans(spark, d).select("page", F.array_join(F.transform(O.in_order("plans"), lambda p: p["name"]), ",").alias("names"))


@query(f"""WITH {_LINES}, k AS (SELECT page, i, name, amount, currency, trim(replace(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g'), 'plan', '')) AS key FROM l WHERE NOT quote AND amount IS NOT NULL AND currency <> ''),
    a AS (SELECT * FROM k WHERE i % 2 = 1 QUALIFY row_number() OVER (PARTITION BY page, key ORDER BY i DESC) = 1), b AS (SELECT * FROM k WHERE i % 2 = 0 QUALIFY row_number() OVER (PARTITION BY page, key ORDER BY i DESC) = 1),
    c AS (SELECT a.page, string_agg(a.name, ',' ORDER BY a.i) AS names FROM a JOIN b ON a.page = b.page AND a.key = b.key AND (a.amount <> b.amount OR a.currency <> b.currency) GROUP BY 1)
    SELECT p.page, coalesce(c.names, '') AS names FROM (SELECT DISTINCT page FROM l) p LEFT JOIN c USING (page)""")
def price_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Structured prices against visible ones, by comparable name."""
    odd = lambda r: F.filter("plans", lambda p, i: i % 2 == r)
    return _plans(spark, d).select("page", F.array_join(O.price_conflicts(odd(0), odd(1)), ",").alias("names"))


@query("""WITH o AS (SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN '' ELSE 'Plan ' || o_custkey % 9 || CASE WHEN o_custkey % 9 = 0 THEN ' Enterprise' ELSE '' END END AS name, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS amount,
        o_orderkey % 7 = 0 AS quote, CASE o_orderkey % 3 WHEN 0 THEN 'weekly' WHEN 1 THEN 'yearly' END AS itv, CASE o_orderkey % 6 WHEN 0 THEN '₹' WHEN 1 THEN 'eur' WHEN 2 THEN NULL ELSE 'US$' END AS symbol FROM orders),
      x AS (SELECT *, quote OR TRY_CAST(amount AS BIGINT) IS NULL AS q FROM o), y AS (SELECT *, CASE WHEN name <> '' THEN name WHEN q THEN 'Enterprise' ELSE 'Plan 1' END AS shown FROM x)
    SELECT id, shown AS name, trim(regexp_replace(lower(shown), '[^a-z0-9]+', '_', 'g'), '_') AS key, CASE WHEN q THEN 'custom_quote' ELSE 'recurring' END AS kind, CASE WHEN NOT q THEN CAST(amount AS BIGINT) END AS amount,
        CASE WHEN NOT q THEN CASE symbol WHEN '₹' THEN 'INR' WHEN 'eur' THEN 'EUR' ELSE 'USD' END END AS currency, CASE WHEN itv = 'yearly' THEN itv END AS itv, contains(lower(shown), 'enterprise') AS is_enterprise FROM y""")
def model_plans(spark: SparkSession, d: str) -> DataFrame:
    """Plans of a model's answer, put right."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    name = F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("Plan "), (c % 9).cast("string"), F.when(c % 9 == 0, " Enterprise").otherwise("")))
    amount = F.when(k % 5 == 0, None).when(k % 5 == 1, "n/a").otherwise(c.cast("string"))
    price = F.struct(F.lit("odd").alias("kind"), amount.alias("amount"), F.when(k % 6 == 0, "₹").when(k % 6 == 1, "eur").when(k % 6 != 2, "US$").alias("currency"), F.when(k % 3 == 0, "weekly").when(k % 3 == 1, "yearly").alias("billing_interval"), (k % 7 == 0).alias("custom_quote"))
    raw = F.to_json(F.array(F.struct(name.alias("name"), F.array(price).alias("prices"))))
    rows = table(spark, d, "orders").select(k.alias("id"), F.get(O.model_plans(raw), F.lit(0)).alias("p"))
    return rows.select("id", "p.name", "p.key", "p.kind", F.col("p.amount").cast("long").alias("amount"), "p.currency", F.col("p.interval").alias("itv"), "p.is_enterprise")


# -- pages ------------------------------------------------------------------------------------------


@query(r"""SELECT page_id, len(regexp_extract_all(html, '<a\s+[^>]*href="[^"]+"')) AS links FROM pages""")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    """Links of each page, from one parse (H1)."""
    return P.page_parts(table(spark, d, "pages")).select("page_id", F.size("links").cast("long").alias("links"))


@query()
def pricing_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Where each page's site may show prices (F26); tested on literal pages."""
    p = table(spark, d, "pages")
    parts = P.page_parts(p).join(p.select("page_id", "url"), "page_id").withColumn("sitemap", F.lit(None).cast("string"))
    return P.discover_pricing(parts)


@query("""SELECT p_partkey, ext, CASE ext WHEN '.png' THEN 'image/png' WHEN '.svg' THEN 'image/svg+xml' WHEN '.webp' THEN 'image/webp' WHEN '.jpg' THEN 'image/jpeg' ELSE 'image/x-icon' END AS mime, 'https://cdn.x/' || replace(p_name, ' ', '%20') || '/a%26b.png' AS address FROM (
    SELECT p_partkey, p_name, CASE p_size % 4 WHEN 0 THEN '.png' WHEN 1 THEN CASE WHEN p_partkey % 2 = 0 THEN '.jpg' ELSE '.svg' END ELSE '.ico' END AS ext FROM part)""")
def asset_names(spark: SparkSession, d: str) -> DataFrame:
    """Extension, type and public address of an asset."""
    n = F.col("p_size") % 4
    url = F.when(n == 0, "https://x.com/a.png?v=1").when((n == 1) & (F.col("p_partkey") % 2 == 0), "https://x.com/a.JPEG").when(n == 1, "https://x.com/a.svg").otherwise("https://x.com/a")
    rows = table(spark, d, "part").select("p_partkey", url.alias("url"), F.lit("").alias("kind"), F.concat("p_name", F.lit("/a&b.png")).alias("key"))
    return rows.select("p_partkey", O.asset_extension("url", "kind").alias("ext"), O.asset_mime("url", "kind").alias("mime"), O.asset_url(F.lit("cdn.x/"), "key").alias("address"))


@query("""SELECT user_id, event_id, CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN ts + INTERVAL 1 DAY WHEN 2 THEN ts END AS created FROM (SELECT user_id, event_id, date_trunc('second', ts) AS ts FROM events)""")
def registration_dates(spark: SparkSession, d: str) -> DataFrame:
    """Registration first, else creation; events without a date don't count."""
    at = F.date_trunc("second", "ts")
    event = lambda name, when: F.struct(F.lit(name).alias("eventAction"), F.date_format(when, "yyyy-MM-dd HH:mm:ss").alias("eventDate"))
    bad = F.struct(F.lit("registration").alias("eventAction"), F.lit("soon").alias("eventDate"))
    k = F.col("event_id") % 4
    events = F.when(k == 0, F.array(event("Created", at + F.expr("INTERVAL 9 DAYS")), event("Registration", at))).when(k == 1, F.array(bad, event("created", at + F.expr("INTERVAL 1 DAY")))).when(k == 2, F.array(event("last changed", at), event("registered", at))).otherwise(F.array(bad))
    e = table(spark, d, "events").select("user_id", "event_id", F.to_json(F.struct(events.alias("events"))).alias("raw"))
    return e.select("user_id", "event_id", O.created_at("raw").cast("timestamp_ntz").alias("created"))


@query("""WITH f AS (SELECT l_orderkey AS tool, l_linenumber, l_partkey, l_suppkey, (CASE WHEN l_linenumber % 2 = 0 THEN 'Feature ' ELSE 'FEATURE ' END) || l_suppkey % 4 AS name FROM lineitem),
         r AS (SELECT *, row_number() OVER (PARTITION BY tool ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM f), o AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY tool, lower(name) ORDER BY i) = 1)
    SELECT tool, string_agg(name, ',' ORDER BY i) AS names FROM o GROUP BY 1""")
def key_features(spark: SparkSession, d: str) -> DataFrame:
    """Features of a model's list, one of each name whatever its case."""
    l = table(spark, d, "lineitem")  # noqa: E741
    item = F.struct(F.concat(F.when(F.col("l_linenumber") % 2 == 0, "Feature ").otherwise("FEATURE "), (F.col("l_suppkey") % 4).cast("string")).alias("feature_name"))
    lists = l.groupBy(F.col("l_orderkey").alias("tool")).agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", item.alias("f")))), lambda x: x["f"])).alias("raw"))
    return lists.select("tool", F.array_join(F.transform(O.key_features("raw"), lambda f: f["name"]), ",").alias("names"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'tool-x' WHEN 1 THEN 'ring' WHEN 2 THEN trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') ELSE 'tool-' || p_partkey END AS base,
    CASE WHEN p_partkey % 4 IN (0, 1) THEN 'Ring' ELSE 'Tool' END AS fallback, trim(replace(lower(p_name), 'plan', '')) AS comparable, p_partkey % 4 = 1 AND contains(regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g'), 'ring') AS branded FROM part""")
def public_names(spark: SparkSession, d: str) -> DataFrame:
    """Slugs, names from domains, names for comparison."""
    k = F.col("p_partkey") % 4
    rows = table(spark, d, "part").select("p_partkey", F.when(k == 0, "Tool X-1a2b3c4d").otherwise("?").alias("canonical"), F.when(k <= 1, "www.ring.co.uk").otherwise("").alias("host"), F.when(k == 3, "").otherwise(F.col("p_name")).alias("title"), "p_name", k.alias("k"))
    return rows.select("p_partkey", O.public_slug_base("canonical", "host", "title", "p_partkey").alias("base"), O.fallback_name("host").alias("fallback"), O.comparable_name("p_name").alias("comparable"), ((F.col("k") == 1) & O.matches_brand("p_name", "host")).alias("branded"))


@query("""SELECT o_orderkey, k IN (0, 1, 2) AS marked, k <> 3 AND NOT (k = 1) AS ok FROM (SELECT o_orderkey, o_orderkey % 5 AS k FROM orders)""")
def backfill_marks(spark: SparkSession, d: str) -> DataFrame:
    """Marks of a backfill in raw texts, and results that may be written (F64)."""
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, '{"backfill":"v1"}').when(k == 1, 'cut {"backfill": "v1"').when(k == 2, '{"a":1,"backfill" : "v1"}').when(k == 3, '{"backfill":"v0"}')
    return table(spark, d, "orders").select("o_orderkey", O.backfill_marked(raw, "v1").alias("marked"), O.backfill_ok(F.when(k != 3, "root"), F.when(k == 1, " category_l2_unmatched:x").when(k == 2, "slow")).alias("ok"))


@query(r"""WITH c AS (SELECT p_partkey, 0 AS i, CASE p_partkey % 4 WHEN 0 THEN 'Home' WHEN 1 THEN 'Widget shop' WHEN 2 THEN 'Best ' || p_name || ' for you' ELSE p_name || ' | x' END AS name, 'json_ld' AS source, 95 AS score FROM part
        UNION ALL SELECT p_partkey, 1, p_name, 'title', 72 FROM part WHERE p_size % 3 <> 0 UNION ALL SELECT p_partkey, 2, 'Access denied', 'meta', 99 FROM part),
      v AS (SELECT *, score + CASE WHEN contains(replace(lower(name), ' ', ''), 'widget') THEN 15 ELSE 0 END AS s FROM c WHERE NOT regexp_matches(name, '(?i)^(home$|access denied)') AND NOT contains(name, '|') AND NOT (starts_with(name, 'Best ') AND len(string_split(name, ' ')) >= 4)),
      b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY least(100, s) DESC, i) = 1)
    SELECT p.p_partkey, coalesce(b.name, 'Widget') AS name, coalesce(b.source, 'domain_fallback') AS source, CASE WHEN s IS NULL THEN 45 ELSE least(100, s) END AS confidence, CASE WHEN s >= 85 THEN 'auto_approved' ELSE 'needs_review' END AS review FROM part p LEFT JOIN b USING (p_partkey)""")
def product_names(spark: SparkSession, d: str) -> DataFrame:
    """The best name among candidates, else the domain's."""
    k = F.col("p_partkey") % 4
    c = lambda name, source, score: F.struct(name.alias("name"), F.lit(source).alias("source"), F.lit(score).alias("score"))
    first = F.when(k == 0, "Home").when(k == 1, "Widget shop").when(k == 2, F.concat(F.lit("Best "), F.col("p_name"), F.lit(" for you"))).otherwise(F.concat("p_name", F.lit(" | x")))
    every = F.array(c(first, "json_ld", 95), F.when(F.col("p_size") % 3 != 0, c(F.col("p_name"), "title", 72)), c(F.lit("Access denied"), "meta", 99))
    rows = table(spark, d, "part").select("p_partkey", F.filter(every, lambda x: x.isNotNull()).alias("c"))
    return rows.select("p_partkey", O.product_name("c", F.lit("www.widget.com")).alias("n")).select("p_partkey", "n.*")


@query(r"""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'https://x.com/' || o_custkey || ',https://x.com/b' WHEN 1 THEN 'http://x.com/?a=1&b=' || o_custkey ELSE '' END AS locs FROM orders""")
def sitemap_addresses(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of sitemaps, whole or broken."""
    k, c = F.col("o_orderkey") % 3, F.col("o_custkey").cast("string")
    body = F.when(k == 0, F.concat(F.lit('<urlset xmlns="x"><url><loc> https://x.com/'), c, F.lit("</loc></url><url><LOC>https://x.com/b</LOC></url><url><loc>ftp://x</loc></url></urlset>"))).when(k == 1, F.concat(F.lit("<urlset><url><loc>http://x.com/?a=1&amp;b="), c, F.lit("</loc>")))
    return table(spark, d, "orders").select("o_orderkey", F.array_join(P.sitemap_locs(body), ",").alias("locs"))


# -- identity ---------------------------------------------------------------------------------------

_PARTS = """t AS (SELECT p_partkey AS id, p_brand AS brand, p_type AS kind, CASE WHEN p_size % 7 = 0 THEN 'id' || p_partkey // 40 END AS sid, lower(p_name) AS name, CASE WHEN p_size % 3 = 0 THEN 'team' ELSE '' END AS audience, CASE p_size % 2 WHEN 0 THEN 'monthly' ELSE 'yearly' END AS billing, p_size % 5 AS position,
        list_distinct(string_split(lower(p_name), ' ')) AS card, CASE WHEN p_size % 4 = 0 THEN [] ELSE ['a' || p_size % 6, 'b' || p_size % 4] END AS anchor, ['usd' || CAST(floor(p_retailprice / 40) AS BIGINT)] AS price FROM part),
    x AS (SELECT a.id AS candidate, b.id AS subject, a.sid IS NOT NULL AND a.sid = b.sid AS same, CASE WHEN a.name = b.name THEN 0.38 ELSE 0 END AS n, CASE WHEN a.audience <> '' AND a.audience = b.audience THEN 0.10 ELSE 0 END AS u, CASE WHEN a.billing = b.billing THEN 0.12 ELSE 0 END AS l, CASE abs(a.position - b.position) WHEN 0 THEN 0.04 WHEN 1 THEN 0.02 ELSE 0 END AS p,
            len(list_intersect(a.card, b.card)) AS ci, len(a.card) + len(b.card) AS cu, len(list_intersect(a.anchor, b.anchor)) AS ai, len(a.anchor) + len(b.anchor) AS au, len(list_intersect(a.price, b.price)) AS pi, 2 AS pu FROM t a JOIN t b ON a.brand = b.brand AND a.kind = b.kind WHERE a.id % 2 = 0 AND b.id % 2 = 1),
    s AS (SELECT candidate, subject, CASE WHEN same THEN 1.0 ELSE least(1.0, CAST(n + u + l + p AS DOUBLE) + 0.24 * ci / CAST(nullif(cu - ci, 0) AS DOUBLE) + CASE WHEN ai > 0 THEN 0.12 * ai / CAST(au - ai AS DOUBLE) ELSE 0 END + 0.16 * pi / CAST(pu - pi AS DOUBLE)) END AS score FROM x WHERE same OR n > 0 OR ci > 0 OR ai > 0 OR pi > 0)"""


def _parts(spark: SparkSession, d: str) -> DataFrame:
    size, none = F.col("p_size"), F.array().cast("array<string>")
    text = lambda *c: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in c])
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.when(size % 7 == 0, text("id", F.floor(F.col("p_partkey") / 40).cast("string"))).alias("structured_id"), F.lower("p_name").alias("name"), F.when(size % 3 == 0, "team").otherwise("").alias("audience"),
        F.when(size % 2 == 0, "monthly").otherwise("yearly").alias("billing"), (size % 5).alias("position"), F.array_distinct(F.split(F.lower("p_name"), " ")).alias("card"), F.when(size % 4 == 0, none).otherwise(F.array(text("a", (size % 6).cast("string")), text("b", (size % 4).cast("string")))).alias("anchor"),
        F.array(text("usd", F.floor(F.col("p_retailprice") / 40).cast("string"))).alias("price"),
    )


def _known(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    t = _parts(spark, d)
    candidates = t.where("id % 2 = 0").withColumnRenamed("id", "candidate")
    none = F.array().cast("array<string>")
    known = t.where("id % 2 = 1").withColumnRenamed("id", "subject").withColumn("structured_ids", F.when(F.col("structured_id").isNotNull(), F.array("structured_id")).otherwise(none)).withColumn("names", F.array("name"))
    return candidates, known.drop("structured_id", "name")


@query(f"WITH {_PARTS} SELECT candidate, subject, round(score, 6) AS score FROM s")
def identity_signals(spark: SparkSession, d: str) -> DataFrame:
    """All eight signals of every pair that shares an id, a name or a token."""
    return C.identity_scores(*_known(spark, d), ["brand", "kind"]).withColumn("score", F.round("score", 6))


@query(f"""WITH {_PARTS}, r AS (SELECT candidate, subject, score, row_number() OVER (PARTITION BY candidate ORDER BY score DESC, subject) AS rn FROM s),
    b AS (SELECT candidate, max(CASE WHEN rn = 1 THEN subject END) AS sb, max(CASE WHEN rn = 1 THEN score END) AS best, max(CASE WHEN rn = 2 THEN score END) AS second FROM r WHERE rn <= 2 GROUP BY 1), c AS (SELECT t.id AS candidate, b.sb, coalesce(b.best, 0) AS best, b.second FROM t LEFT JOIN b ON b.candidate = t.id WHERE t.id % 2 = 0)
    SELECT candidate, round(best, 6) AS best, CASE WHEN best < 0.62 THEN 'new' WHEN second >= 0.62 AND best - second < 0.08 THEN 'conflict' ELSE 'matched' END AS status, CASE WHEN best >= 0.62 AND NOT coalesce(second >= 0.62 AND best - second < 0.08, FALSE) THEN sb END AS subject FROM c""")
def identity_decisions(spark: SparkSession, d: str) -> DataFrame:
    """matched, conflict or new at the reference's thresholds, lone candidates included."""
    candidates, known = _known(spark, d)
    return C.resolve_identity(C.identity_shortlist(candidates, known, ["brand", "kind"]), candidates=candidates).withColumn("best", F.round("best", 6))


@query("""WITH c AS (SELECT o_custkey AS page_id, o_orderkey AS claim_id, o_orderkey % 9 AS k, o_orderkey % 7 AS e, o_orderkey % 2 = 0 AS norm FROM orders)
    SELECT page_id, claim_id, CASE WHEN e IN (0, 1, 2, 3) THEN 'unsupported' WHEN k = 4 THEN 'conflict' WHEN k IN (0, 1, 2, 5, 6, 7) THEN 'entailed' ELSE 'unsupported' END AS status, CASE WHEN e > 3 AND k IN (0, 1, 2, 5, 6, 7) THEN CASE WHEN norm THEN 98 ELSE 92 END ELSE 0 END AS confidence,
        CASE e WHEN 0 THEN 'claim has no evidence' WHEN 1 THEN 'evidence node is missing from DOM map' WHEN 2 THEN 'evidence is outside the selected pricing region' WHEN 3 THEN 'evidence quote cannot be located in its DOM node' ELSE
        CASE WHEN k = 4 THEN 'price evidence contains multiple ISO currencies' WHEN k = 8 THEN 'validator does not support claim type' WHEN k = 3 THEN 'raw claim is not entailed by its evidence' ELSE 'deterministic evidence rules passed' END END AS reason FROM c""")
def claim_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Claims joined with the nodes that their evidence names, and entailed or not."""
    from tally.operators import evidence as V

    o, k, e = table(spark, d, "orders"), F.col("o_orderkey") % 9, F.col("o_orderkey") % 7
    kinds = ["has_free_plan", "has_free_trial", "card_required", "has_custom_quote", "usage_rate", "starting_paid_price", "pricing_models", "free_allowance", "weather"]
    raws = ["true", '{"available":true}', "false", "true", '{"price_text":"$1","unit_raw":"query"}', '{"price_text":"USD 9"}', '["subscription","per_seat","hybrid"]', '{"quantity_raw":"5","unit_raw":"GB"}', "true"]
    quotes = ["A  Free plan", "14-day free trial", "No credit card required", "Call me", "$1 per query, 2 EUR or 3 GBP", "Starting at usd 9 monthly", "9 / month per seat", "5 gb included", "sunny"]
    pick = lambda x, i: F.get(F.array(*map(F.lit, x)), i.cast("int"))
    claims = o.select(F.col("o_custkey").alias("page_id"), F.col("o_orderkey").alias("claim_id"), pick(kinds, k).alias("claim_type"), pick(raws, k).alias("raw"), F.when(F.col("o_orderkey") % 2 == 0, "normalized").otherwise("failed").alias("normalization_status"))
    node = F.col("o_orderkey").cast("long")
    away = F.when(e == 2, -1 - node).otherwise(node)  # before the region, however large the keys get
    nodes = o.where(e != 1).select(F.col("o_custkey").alias("page_id"), away.alias("node"), F.when(e == 3, "other words").otherwise(F.concat(F.lit("x "), F.regexp_replace(F.upper(pick(quotes, k)), " +", "  "))).alias("text"))
    said = o.where(e != 0).select(F.col("o_custkey").alias("page_id"), F.col("o_orderkey").alias("claim_id"), F.lit(0).alias("place"), away.alias("node"), F.lit(0).alias("container"), pick(quotes, k).alias("quote"))
    regions = o.select(F.col("o_custkey").alias("page_id")).distinct().select("page_id", F.lit(0).alias("root"), F.lit((1 << 63) - 1).alias("end"))
    return V.validate(claims, said, nodes, regions)
