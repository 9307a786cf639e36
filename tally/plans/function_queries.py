"""Queries of single functions and small rules over whole tables, each against plain SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions import documents as H
from tally.functions import numbers as N
from tally.functions import payload as P
from tally.functions import pricing as PR
from tally.functions import text as X
from tally.operators import state as ST
from tally.operators import writes as W
from tally.plans.catalog import query
from tally.sources.tables import table

_NUMBERS = "SELECT event_id, value, CASE event_id % 8 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN '-3' WHEN 2 THEN 'x' WHEN 3 THEN 'NaN' WHEN 4 THEN CAST(event_id AS VARCHAR) || '.50' WHEN 5 THEN ' 12 ' WHEN 6 THEN NULL ELSE '1,290.500' END AS raw FROM events"


def _raw(e: DataFrame) -> DataFrame:
    k = F.col("event_id") % 8
    raw = F.when(k == 0, F.format_number("value", 2)).when(k == 1, "-3").when(k == 2, "x").when(k == 3, "NaN").when(k == 4, F.concat(F.col("event_id").cast("string"), F.lit(".50"))).when(k == 5, " 12 ").when(k == 7, "1,290.500")
    return e.withColumn("raw", F.when(k == 0, F.regexp_replace(raw, ",", "")).otherwise(raw))


@query(f"""SELECT event_id, CASE event_id % 8 WHEN 0 THEN round(value, 2) WHEN 1 THEN -3 WHEN 4 THEN event_id + 0.5 WHEN 5 THEN 12 END AS n, CASE event_id % 8 WHEN 0 THEN CAST(floor(round(value, 2)) AS BIGINT) WHEN 1 THEN 0 WHEN 4 THEN event_id WHEN 5 THEN 12 END AS i,
    CASE event_id % 8 WHEN 4 THEN CAST(event_id AS VARCHAR) || '.5' WHEN 5 THEN '12' WHEN 7 THEN '1290.5' END AS d FROM ({_NUMBERS})""")
def number_parsing(spark: SparkSession, d: str) -> DataFrame:
    """Numbers, integers and decimals from texts."""
    e = _raw(table(spark, d, "events"))
    text = N.decimal_string(N.to_decimal("raw"))
    return e.select("event_id", N.to_number("raw").alias("n"), N.to_integer("raw").alias("i"), F.when(F.col("event_id") % 8 != 0, text).alias("d"))


@query("""SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 0 THEN o_custkey * 1000.5 WHEN 1 THEN o_custkey * 1000000 WHEN 2 THEN o_custkey END AS DECIMAL(30, 2)) AS n, CASE o_orderkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' END AS country, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS before,
    CAST(CASE o_orderkey % 5 WHEN 0 THEN 0.75 WHEN 1 THEN 1.0 WHEN 2 THEN 0.0 WHEN 3 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS confidence, CASE WHEN o_custkey % 4 > 0 THEN 10 / CAST(o_custkey % 4 AS DOUBLE) ELSE 0 END AS ratio FROM orders""")
def number_rules(spark: SparkSession, d: str) -> DataFrame:
    """Quantities, country codes, months, confidence, safe division."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    q = F.when(k % 4 == 0, F.concat((F.col("o_custkey").cast("decimal(18,4)") * F.lit(1.0005).cast("decimal(8,4)")).cast("string"), F.lit("k"))).when(k % 4 == 1, F.concat(c, F.lit(" Million"))).when(k % 4 == 2, c).otherwise("many")
    code = F.when(k % 3 == 0, " us").when(k % 3 == 1, "Gb ").otherwise("usa")
    sure = F.when(k % 5 == 0, "75").when(k % 5 == 1, "120").when(k % 5 == 2, "-1").when(k % 5 == 3, "0.5").otherwise("n/a")
    exact = F.when(k % 4 == 0, (F.col("o_custkey") * F.lit(1000.5)).cast("decimal(30,2)")).otherwise(N.quantity(q).cast("decimal(30,2)"))
    return table(spark, d, "orders").select("o_orderkey", exact.alias("n"), N.country_code(code).alias("country"), N.previous_month(F.col("o_orderdate").cast("date")).alias("before"), N.confidence(sure).alias("confidence"), N.safe_div(F.lit(10), F.col("o_custkey") % 4).alias("ratio"))


@query("""SELECT p_partkey, p_partkey % 6 IN (0, 1, 4) AS strict, CASE p_partkey % 6 WHEN 0 THEN 135 WHEN 1 THEN 75 WHEN 2 THEN -50 WHEN 3 THEN -200 WHEN 4 THEN 70 ELSE -25 END AS score, CASE WHEN p_partkey % 3 = 0 THEN 90 WHEN p_partkey % 3 = 1 THEN 60 ELSE -1000 END AS contact, p_partkey % 2 = 0 AS same FROM part""")
def url_scores(spark: SparkSession, d: str) -> DataFrame:
    """What a URL promises: prices, a contact, the same context."""
    k = F.col("p_partkey")
    url = F.get(F.array(*map(F.lit, ("https://x.com/pricing", "https://x.com/#pricing", "https://x.com/", "https://x.com/blog/pricing", "https://x.com/en/plans?a=1", "https://x.com/a/b/c/d"))), (k % 6).cast("int"))
    contact = F.get(F.array(*map(F.lit, ("https://x.com/contact-sales", "https://x.com/a/b/demo", "https://x.com/pricing"))), (k % 3).cast("int"))
    final = F.when(k % 2 == 0, "https://x.com/writer/tools/pricing").otherwise("https://x.com/pricing")
    return table(spark, d, "part").select("p_partkey", X.is_strict_pricing_url(url).alias("strict"), X.pricing_url_score(url).cast("int").alias("score"), X.contact_url_score(contact).cast("int").alias("contact"), X.matches_context(F.lit("https://x.com/tools/writer"), final).alias("same"))


@query(r"""SELECT doc_id, CASE WHEN length(t) <= 60 THEN t ELSE rtrim(substr(t, 1, 59)) || '…' END AS clipped, t AS whole FROM (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)""")
def clipped_text(spark: SparkSession, d: str) -> DataFrame:
    """White space collapsed, and the start of a text."""
    return table(spark, d, "documents").select("doc_id", X.clip("text", 60).alias("clipped"), X.collapse("text").alias("whole"))


@query("""SELECT p_partkey, array_to_string(list_distinct_in_order, ',') AS parts, p_size % 3 AS n_common FROM (SELECT p_partkey, p_size, CASE WHEN p_size % 3 = 0 THEN ['a' || p_size, p_brand] ELSE ['a' || p_size, p_brand, 'b'] END AS list_distinct_in_order FROM part)""")
def cell_values(spark: SparkSession, d: str) -> DataFrame:
    """Cells of several values, distinct in order; sets in common."""
    a = F.concat(F.lit("a"), F.col("p_size").cast("string"))
    cell = F.concat(a, F.lit(" | "), F.col("p_brand"), F.lit(";;"), a, F.when(F.col("p_size") % 3 == 0, "").otherwise(",b "), F.lit(","))
    sets = F.size(F.array_intersect(F.sequence(F.lit(1), F.col("p_size") % 3), F.array(*map(F.lit, (1, 2, 3)))))
    common = F.when(F.col("p_size") % 3 == 0, 0).otherwise(sets)
    return table(spark, d, "part").select("p_partkey", F.array_join(X.split_multi(cell), ",").alias("parts"), common.alias("n_common"))


@query("""SELECT event_id, '{"a":' || event_id || ',"b":[1,2],"é":"' || event_type || '"}' AS canonical, sha256('{"a":' || event_id || ',"b":[1,2],"é":"' || event_type || '"}') AS hash, CASE WHEN event_id % 3 = 0 THEN '{"k":' || event_id || '}' END AS found, event_type || ' strasse ' || event_id AS folded FROM events""")
def canonical_documents(spark: SparkSession, d: str) -> DataFrame:
    """Canonical JSON and its hash, an object inside a text, folded names."""
    i = F.col("event_id").cast("string")
    raw = F.concat(F.lit('{ "é": "'), F.col("event_type"), F.lit('", "b": [1, 2],  "a": '), i, F.lit("}"))
    inside = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Sure: {no} {\"k\": "), i, F.lit("} {}"))).otherwise("nothing {here")
    name = F.concat(F.upper("event_type"), F.lit("—Straße™™ ").substr(1, 7), F.lit(" "), i)
    return table(spark, d, "events").select("event_id", H.canonical_json(raw).alias("canonical"), H.canonical_hash(raw).alias("hash"), H.json_object_in(inside).alias("found"), H.identity_text(name).alias("folded"))


@query("""SELECT o_orderkey, round(CASE WHEN o_orderkey % 2 = 0 THEN 0.2 + (o_custkey % 7) / 100.0 END, 6) AS search, round(CASE WHEN o_orderkey % 3 = 0 THEN 0.5 END, 6) AS social, CASE WHEN o_custkey % 2 = 0 THEN 'US' ELSE 'CA' END AS first, CASE WHEN o_custkey % 2 = 0 THEN CAST(floor((o_custkey % 100) / 100.0 * 10000 + 0.5) AS INTEGER) ELSE 2500 END AS bps,
    CASE WHEN o_custkey % 2 = 0 THEN 2 ELSE 1 END AS countries, 'word ' || o_custkey AS keyword, '{"a":' || o_custkey || '}' AS metrics, CASE WHEN o_custkey % 2 = 0 THEN 'US #' || o_custkey END AS rank FROM orders""")
def payload_parts(spark: SparkSession, d: str) -> DataFrame:
    """Channels, countries, keywords and metrics of a traffic payload."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda x: x.cast("string")
    channels = F.map_filter(F.create_map(F.lit("SearchOrganic"), F.when(k % 2 == 0, F.lit("0.2")), F.lit("SearchPaid"), F.when(k % 2 == 0, text((c % 7) / 100)), F.lit("Social"), F.when(k % 3 == 0, F.lit("0.5"))), lambda _, v: v.isNotNull())
    even = c % 2 == 0
    share = lambda code, v: F.struct(code.alias("CountryCode"), v.cast("double").alias("Value"))
    shares = F.when(even, F.array(share(F.lit("us"), (c % 100) / 100), share(F.lit("GB"), F.lit(0.1)), share(F.lit("?"), F.lit(0.1)))).otherwise(F.array(share(F.lit("zzz"), F.lit(0.1)), share(F.lit("CA"), F.lit(0.25)), share(F.lit("MX"), F.lit(2.0))))
    words = F.array(F.struct(F.lit(" ").alias("Name"), F.lit(1.0).alias("Volume"), F.lit(1.0).alias("EstimatedValue"), F.lit(1.0).alias("Cpc")), F.struct(F.concat(F.lit(" word "), text(c)).alias("Name"), F.lit(5.9).alias("Volume"), F.lit(None).cast("double").alias("EstimatedValue"), F.lit(1.0).alias("Cpc")))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", P.traffic_sources(channels).alias("s"), P.country_shares(shares).alias("c"), P.keywords(words).alias("w"), even.alias("even"))
    return o.select("o_orderkey", F.round("s.search", 6).alias("search"), F.round("s.social", 6).alias("social"), F.get("c", F.lit(0))["country"].alias("first"), F.get("c", F.lit(0))["bps"].alias("bps"), F.size("c").alias("countries"), F.get("w", F.lit(0))["name"].alias("keyword"),
        P.metrics_json(a=F.col("o_custkey"), b=F.lit(None).cast("int")).alias("metrics"), P.country_rank_text(F.when(F.col("even"), "US"), F.col("o_custkey")).alias("rank"))


@query("""WITH t AS (SELECT o_custkey AS site, date_trunc('month', o_orderdate) AS month, count(*) AS visits FROM orders GROUP BY 1, 2) SELECT site, strftime(month, '%Y-%m-01') AS month, visits, month = max(month) OVER (PARTITION BY site) AS newest FROM t""")
def payload_months(spark: SparkSession, d: str) -> DataFrame:
    """A payload's map of months to rows; engagement belongs to the newest."""
    o = table(spark, d, "orders").groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM-01").alias("m")).agg(F.count("*").alias("n"))
    logs = o.groupBy(F.col("o_custkey").alias("site")).agg(F.map_from_entries(F.collect_list(F.struct("m", "n"))).alias("visits"))
    rows = logs.select("site", F.array_max(F.map_keys("visits")).alias("_new"), F.explode("visits").alias("month", "visits"))
    return rows.select("site", "month", "visits", (F.col("month") == F.col("_new")).alias("newest"))


@query("""WITH p AS (SELECT l_orderkey AS page, bool_or(l_quantity > 10 AND l_linenumber > 1) AS paid, bool_or(l_linenumber = 1) AS free, min(CASE WHEN l_linenumber > 1 AND l_quantity > 10 THEN CASE WHEN l_linenumber % 2 = 0 THEN l_quantity ELSE 1000 + l_quantity END END) AS first FROM lineitem GROUP BY 1)
    SELECT page, CASE WHEN paid AND free THEN 'freemium' WHEN paid THEN 'paid' WHEN free THEN 'free' ELSE 'unknown' END AS model, free AS has_free_plan, CASE WHEN first IS NULL THEN 'none' WHEN first >= 1000 THEN 'yearly' ELSE 'monthly' END AS itv, CAST((first % 1000) * 100 AS BIGINT) AS starting_minor FROM p""")
def pricing_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Model, interval and starting price of a page's plans."""
    l = table(spark, d, "lineitem")  # noqa: E741
    n, q = F.col("l_linenumber"), F.col("l_quantity")
    plan = F.struct(F.when(n == 1, "Free").otherwise("Pro").alias("name"), F.when(n == 1, 0).when(q > 10, q).cast("int").alias("amount"), F.when(n % 2 == 0, "monthly").otherwise("yearly").alias("interval"), F.lit("flat").alias("kind"), F.lit("USD").alias("currency"), F.lit(False).alias("custom"))
    s = l.groupBy(F.col("l_orderkey").alias("page")).agg(PR.pricing_summary(F.collect_list(plan)).alias("s"))
    return s.select("page", "s.model", "s.has_free_plan", F.col("s.interval").alias("itv"), F.col("s.starting_minor").cast("long").alias("starting_minor"))


@query(r"""SELECT page_id, 'GET ' || left(sha256(page_id || ' x'), 0) || regexp_replace(url, '\s+', ' ', 'g') AS line, CASE WHEN length(url) > 6 THEN left(url, 4) || '***' || right(url, 2) ELSE '***' END AS hidden, left(sha256('select ' || page_id || ' from t'), 16) AS print FROM pages""")
def masked_values(spark: SparkSession, d: str) -> DataFrame:
    """Masks of secrets and fingerprints of statements."""
    sql = F.concat(F.lit("  select\n"), F.col("page_id").cast("string"), F.lit("\t from   t "))
    return table(spark, d, "pages").select("page_id", F.concat(F.lit("GET "), X.collapse("url")).alias("line"), X.masked("url").alias("hidden"), X.sql_fingerprint(sql).alias("print"))


# -- state rules ------------------------------------------------------------------------------------


@query("""SELECT c_custkey, CASE WHEN (old = '' OR c_custkey % 5 = 0) AND n.name IS NOT NULL THEN n.name WHEN old = '' OR c_custkey % 5 = 0 THEN old ELSE old END AS name FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS old FROM customer) c LEFT JOIN (SELECT s_suppkey, s_name AS name FROM supplier) n ON n.s_suppkey = c.c_custkey""")
def fill_blanks(spark: SparkSession, d: str) -> DataFrame:
    """The first value wins unless it is blank or awaits review (M9)."""
    old = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("name"), F.when(F.col("c_custkey") % 5 == 0, "needs_review").otherwise("ok").alias("state"))
    new = table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("name"))
    return ST.fill_blanks(old, new, ["c_custkey"], ["name"], "state").select("c_custkey", "name")


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey % 7 < 5 AND (o_orderstatus IN ('O', 'F') OR o_orderdate <= TIMESTAMP '1996-12-31 23:00:00')""")
def claimable_work(spark: SparkSession, d: str) -> DataFrame:
    """Work not started, failed, or stuck for an hour."""
    status = F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "F", "failed").otherwise("running")
    o = table(spark, d, "orders").select("o_orderkey", status.alias("status"), (F.col("o_orderkey") % 7).alias("attempts"), F.col("o_orderdate").alias("updated_at"))
    return ST.claimable(o, F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")).select("o_orderkey")


@query("""WITH o AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey AS k, CASE WHEN c_nationkey < 10 THEN 'NEW' ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 2 = 0)
    SELECT o.k, o.v, NOT (n.k IS NOT NULL AND n.v <> o.v) AS is_current FROM o LEFT JOIN n ON n.k = o.k UNION ALL SELECT n.k, n.v, TRUE FROM n LEFT JOIN o ON o.k = n.k WHERE o.k IS NULL OR o.v <> n.v""")
def current_rows(spark: SparkSession, d: str) -> DataFrame:
    """A changed value retires its row, an unchanged one touches nothing."""
    c = table(spark, d, "customer").withColumnRenamed("c_custkey", "k")
    old = c.where("k % 3 <> 0").select("k", F.col("c_mktsegment").alias("v"), F.lit(True).alias("is_current"))
    new = c.where("k % 2 = 0").select("k", F.when(F.col("c_nationkey") < 10, "NEW").otherwise(F.col("c_mktsegment")).alias("v"))
    return ST.current_rows(old, new, ["k"], ["v"])


@query("""SELECT 'same' AS pair, TRUE AS untouched UNION ALL SELECT 'changed', FALSE""")
def untouched_tables(spark: SparkSession, d: str) -> DataFrame:
    """Whether a table is as it was, rows counted."""
    o = table(spark, d, "orders")
    changed = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 7, F.lit(-1.0)).otherwise(F.col("o_totalprice")))
    return spark.createDataFrame([("same", ST.untouched(o, o.repartition(3))), ("changed", ST.untouched(o, changed))], "pair string, untouched boolean")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '["old"]' ELSE '["new"]' END AS highlights FROM customer""")
def feature_highlights(spark: SparkSession, d: str) -> DataFrame:
    """Highlights are filled only where none are stored."""
    k = F.col("c_custkey") % 3
    c = table(spark, d, "customer").select("c_custkey", F.when(k == 0, '["old"]').when(k == 1, "[]").alias("stored"), F.lit('["new"]').alias("fresh"))
    return c.select("c_custkey", W.highlights("stored", "fresh").alias("highlights"))


@query("""WITH n AS (SELECT user_id, CAST(ts AS DATE) AS day, max(CASE WHEN event_type = 'view' THEN event_id END) AS id FROM events GROUP BY 1, 2 HAVING max(CASE WHEN event_type = 'view' THEN event_id END) IS NOT NULL)
    SELECT c_custkey AS tool, n.day, e.value FROM customer JOIN n ON n.user_id = c_custkey JOIN events e ON e.event_id = n.id""")
def insert_select(spark: SparkSession, d: str) -> DataFrame:
    """Rows selected from two tables, the latest of each key (M6, M2)."""
    e = table(spark, d, "events").where("event_type = 'view'").select(F.col("user_id").alias("tool"), F.to_date("ts").alias("day"), "event_id", "value")
    last = e.groupBy("tool", "day").agg(F.max_by("value", "event_id").alias("value"))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("tool")).join(last, "tool")


# -- rules that the given pages don't exercise, on pages and texts derived from them -------------------


@query("""SELECT page_id, (['access_denied', 'anti_bot', 'error_page', 'anti_bot', 'empty_page', 'access_denied', 'captcha', 'access_denied', 'anti_bot', 'valid_product_page'])[page_id % 10 + 1] AS state FROM pages""")
def page_state_rules(spark: SparkSession, d: str) -> DataFrame:
    """Every rule of a page's state (H16): the given pages with other titles, markup, words and status codes."""
    k = F.col("page_id") % 10
    before = F.when(k == 0, "<title>Access denied</title>").when(k == 1, "<title>Just a moment...</title>").when(k == 2, "<title>404 not found</title>").otherwise("")
    after = F.when(k == 3, "<!-- cf_chl_opt -->").otherwise("")
    first = F.when(k == 5, "<p>You do not have permission to access this</p>").when(k == 6, "<p>Please verify you are human</p>").otherwise("")
    body = F.when(k == 4, "<p>x</p>").otherwise(F.concat(before, first, F.col("html"), after))
    rows = table(spark, d, "pages").select("page_id", body.alias("html"), F.when(k == 7, 403).when(k == 8, 429).otherwise(200).alias("code"))
    return H.page_state(rows, status_col="code").select("page_id", "state")


@query("""SELECT doc_id, (['nsfw', 'nsfw', 'needs_review', 'safe', 'safe', 'needs_review', 'needs_review'])[doc_id % 7 + 1] AS status, (['explicit_adult_product_signal', 'explicit_adult_product_signal', 'ambiguous_adult_context', 'safe_context_disambiguated', 'model_confirmed_safe', 'model_detected_adult_context', 'insufficient_content_safety_evidence'])[doc_id % 7 + 1] AS reason FROM documents""")
def content_safety_rules(spark: SparkSession, d: str) -> DataFrame:
    """Every verdict of content safety (H19), by words, host and a model's label."""
    from tally.functions.safety import content_safety

    k = F.col("doc_id") % 7
    text = F.when(k == 0, "an nsfw app").when(k == 2, "spicy adult chat").when(k == 3, "uncensored red team benchmark").when(k != 6, "a tool")
    host = F.when(k == 1, "www.pornify.ai").when(k != 6, "x.com")
    label, sure = F.when(k.isin(2, 4), "safe").when(k == 5, "nsfw"), F.when(k.isin(2, 4), 90).when(k == 5, 99)
    rows = table(spark, d, "documents").select("doc_id", text.alias("t"), host.alias("h"), label.alias("l"), sure.cast("int").alias("c"))
    return rows.select("doc_id", content_safety("t", "h", "l", "c").alias("s")).select("doc_id", "s.status", "s.reason")


@query("""SELECT u.user_id, u.day, coalesce(n, 0) AS errors FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events) u LEFT JOIN (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1, 2) e ON e.user_id = u.user_id AND e.day = u.day WHERE coalesce(n, 0) < 3""")
def daily_failure_budget(spark: SparkSession, d: str) -> DataFrame:
    """Users and days with fewer than three errors."""
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return e.groupBy("user_id", "day").agg(F.count_if(F.col("event_type") == "error").alias("errors")).where("errors < 3")


@query("""WITH e AS (SELECT user_id, event_id AS i, event_id % 7 AS k FROM events), r AS (SELECT user_id, coalesce(max(i) FILTER (WHERE k IN (3, 4)), -1) AS reset, arg_max(k, i) FILTER (WHERE k IN (3, 4)) AS how, max(i) FILTER (WHERE k = 2) AS b FROM e GROUP BY 1),
         p AS (SELECT e.user_id, max(i) FILTER (WHERE k = 0 AND i > reset) AS x, max(i) FILTER (WHERE k = 1 AND i > reset) AS y FROM e JOIN r USING (user_id) GROUP BY 1),
         s AS (SELECT r.*, x, y, CASE WHEN x IS NOT NULL OR y IS NOT NULL THEN '"a":{' || concat_ws(',', '"x":' || x, '"y":' || y) || '}' WHEN how = 4 THEN '"a":5' END AS a FROM r JOIN p USING (user_id))
    SELECT user_id, '{' || concat_ws(',', a, '"b":' || b) || '}' AS merged FROM s""")
def json_merge_paths(spark: SparkSession, d: str) -> DataFrame:
    """Merge patches of several paths, with removals and objects over scalars."""
    k, i = F.col("event_id") % 7, F.col("event_id").cast("string")
    patch = F.when(k == 0, F.concat(F.lit('{"a":{"x":'), i, F.lit("}}"))).when(k == 1, F.concat(F.lit('{"a":{"y":'), i, F.lit("}}"))).when(k == 2, F.concat(F.lit('{"b":'), i, F.lit("}"))).when(k == 3, '{"a":null}').when(k == 4, '{"a":5}').when(k == 5, "no json").otherwise("{}")
    return H.merge_in_order(table(spark, d, "events").select("user_id", "event_id", patch.alias("patch")), ["user_id"], "event_id", "patch")


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z' WHEN 1 THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '.000Z' WHEN 2 THEN strftime(ts, '%Y-%m-%d') || 'T00:00:00.000Z' END AS at FROM events""")
def iso_times(spark: SparkSession, d: str) -> DataFrame:
    """Times of any zone as UTC."""
    k, whole = F.col("event_id") % 4, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    raw = F.when(k == 0, F.concat(whole, F.lit("Z "))).when(k == 1, F.concat(whole, F.lit("+02:00"))).when(k == 2, F.date_format("ts", "yyyy-MM-dd")).otherwise("soon")
    return table(spark, d, "events").select("event_id", N.iso_timestamp(raw).alias("at"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'US' WHEN o_orderkey % 3 = 1 THEN 'GB' END AS first, CASE WHEN o_orderkey % 3 = 0 THEN 5000 WHEN o_orderkey % 3 = 1 THEN 2500 END AS bps FROM orders""")
def legacy_countries(spark: SparkSession, d: str) -> DataFrame:
    """Old wide columns where a payload has no valid country."""
    k = F.col("o_orderkey") % 3
    share = lambda c, v: F.struct(F.lit(c).alias("CountryCode"), F.lit(v).alias("Value"))
    parsed = F.when(k == 0, F.array(share("us", 0.5))).otherwise(F.array(share("?", 0.5), share("CA", 3.0)))
    legacy = F.when(k != 2, F.array(share("gb", 0.25)))
    rows = table(spark, d, "orders").select("o_orderkey", P.with_legacy_countries(parsed, legacy).alias("c"))
    return rows.select("o_orderkey", F.get("c", F.lit(0))["country"].alias("first"), F.get("c", F.lit(0))["bps"].alias("bps"))


@query("""SELECT o_orderkey, CASE WHEN k > 0 THEN 'write ' || o_custkey END AS job, CASE WHEN k = 2 THEN 6 WHEN k = 3 THEN 1 ELSE 0 END AS outputs, CASE WHEN k = 2 THEN 8 ELSE 0 END AS capabilities, k > 0 AS has_signal, CASE k WHEN 0 THEN '{}' WHEN 1 THEN '{"primary_job":{"value":"write ' || o_custkey || '","evidence_quotes":["q1","q2"]}}' END AS context
    FROM (SELECT o_orderkey, o_custkey, o_orderkey % 4 AS k FROM orders)""")
def product_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Profiles of products: only what has evidence stays."""
    from tally.operators import taxonomy as TX

    k = F.col("o_orderkey") % 4
    value = lambda v, n: F.struct(v.alias("value"), F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("q"), i.cast("string"))).alias("evidence"))
    bare = F.struct(F.lit("no proof").alias("value"), F.array().cast("array<string>").alias("evidence"))
    job = F.when(k > 0, value(F.concat(F.lit("write "), F.col("o_custkey").cast("string")), 3)).otherwise(bare)
    many = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: value(F.concat(F.lit("v"), i.cast("string")), 1))
    outputs = F.when(k == 2, F.to_json(F.concat(F.array(bare), many))).when(k == 3, F.to_json(value(F.lit("one"), 1)))
    raw = F.to_json(F.struct(F.to_json(job).alias("primary_job"), outputs.alias("primary_outputs"), F.when(k == 2, F.to_json(many)).alias("capabilities_raw")))
    rows = table(spark, d, "orders").select("o_orderkey", F.lit("https://x.com").alias("url"), raw.alias("raw")).withColumn("p", TX.product_profile("raw", "url"))
    return rows.select("o_orderkey", F.col("p.primary_job.value").alias("job"), F.coalesce(F.size("p.primary_outputs"), F.lit(0)).alias("outputs"), F.coalesce(F.size("p.capabilities"), F.lit(0)).alias("capabilities"), "p.has_signal", F.when(F.col("o_orderkey") % 4 < 2, TX.profile_context("p")).alias("context"))


@query("""SELECT event_id, concat_ws('|', CASE WHEN n = 'lost' THEN 'unknown normalization_status: lost' END, CASE WHEN n <> 'lost' AND p = 'published' AND v <> 'entailed' THEN 'publishable claims must be entailed by evidence' END,
    CASE WHEN n = 'not_applicable' AND t = 'usage_rate' THEN 'normalization is not_applicable only for presence claims, not usage_rate' END) AS errors FROM (
    SELECT event_id, (['normalized', 'not_applicable', 'lost'])[event_id % 3 + 1] AS n, CASE WHEN event_id % 5 = 0 THEN 'pending' ELSE 'entailed' END AS v, CASE WHEN event_id % 2 = 0 THEN 'published' ELSE 'not_eligible' END AS p, CASE WHEN event_id % 7 < 3 THEN 'usage_rate' ELSE 'has_free_plan' END AS t FROM events)""")
def claim_state_rules(spark: SparkSession, d: str) -> DataFrame:
    """Unknown values are told alone; only claims of presence do without normalization."""
    from tally.operators import claims as C

    k = F.col("event_id")
    e = table(spark, d, "events").select("event_id", F.get(F.array(*map(F.lit, ("normalized", "not_applicable", "lost"))), (k % 3).cast("int")).alias("normalization_status"), F.when(k % 5 == 0, "pending").otherwise("entailed").alias("validation_status"),
        F.lit("auto_verified").alias("decision_status"), F.lit("active").alias("lifecycle_status"), F.when(k % 2 == 0, "published").otherwise("not_eligible").alias("publication_status"), F.when(k % 7 < 3, "usage_rate").otherwise("has_free_plan").alias("kind"))
    return e.select("event_id", F.array_join(C.claim_errors("kind"), "|").alias("errors"))


@query("""SELECT doc_id, 2 AS n_plans, 0 AS least, 'Free' AS first, 'Starter' AS second, doc_id % 90 + 1 AS amount, CASE WHEN doc_id % 2 = 0 THEN 'monthly' ELSE 'yearly' END AS itv FROM documents WHERE doc_id % 3 = 0""")
def text_plan_rules(spark: SparkSession, d: str) -> DataFrame:
    """Plans in texts that name prices (H12, O7, O8): free ones first, unfit contexts left out."""
    i = F.col("doc_id")
    starter = F.concat(F.lit("Choose a plan. Starter $"), (i % 90 + 1).cast("string"), F.when(i % 2 == 0, " per month for one. ").otherwise(" yearly for one. "), F.lit("x" * 300), F.lit(" Free $0 forever. "), F.lit("y" * 300))
    text = F.when(i % 3 == 0, starter).when(i % 3 == 1, " save 10% with coupon $5 now").otherwise("nothing")
    got = PR.text_plans(table(spark, d, "documents").select("doc_id", text.alias("text")), "doc_id", "text")
    at = lambda n: F.get("plans", F.lit(n))
    return got.select("doc_id", F.size("plans").alias("n_plans"), at(0)["amount"].cast("int").alias("least"), at(0)["plan"].alias("first"), at(1)["plan"].alias("second"), at(1)["amount"].cast("long").alias("amount"), at(1)["interval"].alias("itv"))
