"""Queries of model answers in their wrappings and of registrations by way of the bootstrap."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions import addresses as AD
from tally.functions import offers as O
from tally.functions.answers import CANDIDATE, FIELDS, PATHS, unwrapped
from tally.operators import extractions as EX
from tally.operators import registries as G
from tally.operators import writes as W
from tally.plans.batches import written
from tally.plans.catalog import query
from tally.sources.tables import table

#: What a wrapped answer looks like, by event; {t} and {u} stand for its type and user.
SHAPES = [
    '{"title":"{t}","user":{u}}',
    '{"result":{"data":{"title":"{t}","key_features":[{u}]}}}',
    '{"choices":[{"message":{"content":"{\\"category_l1\\":\\"{t}\\",\\"title\\":\\"n{u}\\"}"}}]}',
    '{"choices":[{"message":{"content":null,"reasoning":"first {\\"category_l1\\": \\"x\\"} then {\\"category_l2\\": \\"{t}\\", \\"title\\": \\"late {u}\\"} so"}}]}',
    '{"choices":[{"message":{"content":"I conclude category_l1 = \\"Dev-{t}\\" and category_l2: \\"C{u}\\""}}]}',
    '{"response":"{\\"title\\": \\"{t}\\"}","output":{"title":"second"}}',
    '{"output":{"note":"none"},"data":{"json":{"message":{"content":{"description":"deep {u}","title":"{t}"}}}}}',
    '{"note":"{t}","data":[{"title":"in a list"}],"n":{u}}',
    '"{\\"title\\": \\"text {t}\\"}"',
    '"nothing of {t}"',
    "[{u}]",
    "not json {t}",
    '{"choices":[{"text":"x","result":{"title":null,"category_l1":"{t}"}}],"title2":{u}}',
]
_HAS = f"(json_type(j) = 'OBJECT' AND len(list_intersect(json_keys(j), {FIELDS!r})) > 0)"
_TEXT = rf"""CASE WHEN json_valid(s) AND json_type(CASE WHEN json_valid(s) THEN s ELSE '0' END) = 'OBJECT' THEN s
        WHEN len(list_filter(regexp_extract_all(s, '{CANDIDATE}'), lambda x: json_valid(x))) > 0 THEN list_filter(regexp_extract_all(s, '{CANDIDATE}'), lambda x: json_valid(x))[-1]
        WHEN regexp_matches(s, '(?i)category_l1\s*[:=]\s*["''][a-z0-9][a-z0-9-]{{0,119}}["'']') THEN
            CASE WHEN regexp_matches(s, '(?i)category_l2\s*[:=]\s*["''][a-z0-9][a-z0-9-]{{0,119}}["'']')
                 THEN '{{"category_l1":"' || lower(regexp_extract(s, '(?i)category_l1\s*[:=]\s*["'']([a-z0-9][a-z0-9-]{{0,119}})["'']', 1)) || '","category_l2":"' || lower(regexp_extract(s, '(?i)category_l2\s*[:=]\s*["'']([a-z0-9][a-z0-9-]{{0,119}})["'']', 1)) || '"}}'
                 ELSE '{{"category_l1":"' || lower(regexp_extract(s, '(?i)category_l1\s*[:=]\s*["'']([a-z0-9][a-z0-9-]{{0,119}})["'']', 1)) || '"}}' END END"""


def _payload_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN '{s.replace(chr(39), chr(39) * 2)}'" for i, s in enumerate(SHAPES))
    return f"replace(replace(CASE event_id % {len(SHAPES)} {cases} END, '{{t}}', event_type), '{{u}}', CAST(user_id AS VARCHAR))"


@query(f"""
    WITH RECURSIVE p AS (SELECT event_id, {_payload_sql()} AS t FROM events),
         tops AS (SELECT event_id, CASE WHEN json_valid(t) THEN CAST(t AS JSON) END AS j FROM p),
         open(event_id, path, j) AS (
             SELECT event_id, CAST([] AS INTEGER[]), j FROM tops WHERE json_type(j) = 'OBJECT'
             UNION ALL
             SELECT event_id, list_append(path, CAST(i AS INTEGER)), c FROM (
                 SELECT event_id, path, i, CASE WHEN json_type(c) = 'VARCHAR' THEN (SELECT CAST({_TEXT} AS JSON) FROM (SELECT c->>'$' AS s)) ELSE c END AS c, json_type(c) = 'VARCHAR' AS said FROM (
                     SELECT event_id, path, i, json_extract(j, ({PATHS!r})[i + 1]) AS c FROM open, range({len(PATHS)}) r(i) WHERE json_type(j) = 'OBJECT' AND NOT {_HAS})) x
             WHERE len(path) < 6 AND (json_type(c) = 'OBJECT') AND (NOT said OR i <> 3 AND {_HAS.replace("(j)", "(c)")})),
         hits AS (SELECT event_id, path, j FROM open WHERE {_HAS} QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY path) = 1),
         said AS (SELECT event_id, j, CASE WHEN json_type(j) = 'VARCHAR' THEN (SELECT CAST({_TEXT} AS JSON) FROM (SELECT j->>'$' AS s)) END AS x FROM tops),
         a AS (SELECT s.event_id, h.path, coalesce(h.j, CASE WHEN json_type(s.j) = 'OBJECT' THEN s.j END, s.x, CAST('{{}}' AS JSON)) AS j FROM said s LEFT JOIN hits h ON h.event_id = s.event_id)
    SELECT event_id, {_HAS} AS found, CAST(len(path) AS INTEGER) AS level, j->>'$.title' AS title, j->>'$.category_l1' AS category_l1, j->>'$.category_l2' AS category_l2, CAST(len(json_keys(j)) AS INTEGER) AS n_keys FROM a""")
def unwrapped_answers(spark: SparkSession, d: str) -> DataFrame:
    """The object that was asked for, out of thirteen kinds of wrapping (F54, F55), by VARIANT functions."""
    shape = F.get(F.array(*map(F.lit, SHAPES)), (F.col("event_id") % len(SHAPES)).cast("int"))
    payload = F.replace(F.replace(shape, F.lit("{t}"), F.col("event_type")), F.lit("{u}"), F.col("user_id").cast("string"))
    rows = unwrapped(table(spark, d, "events").select("event_id", payload.alias("payload")), "payload")
    field = lambda k: F.try_variant_get("answer.answer", f"$.{k}", "string").alias(k)
    keys = F.size(F.json_object_keys(F.to_json("answer.answer"))).alias("n_keys")
    return rows.select("event_id", "answer.found", "answer.level", field("title"), field("category_l1"), field("category_l2"), keys)


#: A bootstrap as the registry publishes it; pairs that aren't two lists are passed over.
BOOTSTRAP = '{"version":"1.0","services":[[["com","net"],["https://a.test/com//","https://b.test/com/"]],[[".UK"],["https://uk.test"]],[["co.uk"],["https://co.test/v1/"," "]],[["dev"],[" "]],[["com"],["https://late.test"]],["io"],[["io"],"x"]]}'
_DOMAINS = "c AS (SELECT c_custkey AS k, 'shop' || c_custkey // 3 || (['.com', '.co.uk', '.me.uk', '.dev', '.io', '.net'])[c_custkey % 6 + 1] AS domain, c_custkey // 3 AS g, c_custkey % 6 AS s FROM customer)"


@query(f"""
    WITH {_DOMAINS},
         x AS (SELECT DISTINCT CASE WHEN s = 2 THEN 'me.uk' ELSE domain END AS d, CASE WHEN s = 2 THEN 0 ELSE g END AS g, s FROM c),
         u AS (SELECT d, g, s, place, CASE WHEN s IN (0, 5) THEN (['https://a.test/com', 'https://b.test/com'])[place + 1] WHEN s = 1 THEN 'https://co.test/v1' ELSE 'https://uk.test' END || '/domain/' || d AS url
               FROM x, (VALUES (0), (1)) v(place) WHERE (s IN (0, 5) OR (s IN (1, 2) AND place = 0))),
         a AS (SELECT *, (['200', '404', '500', '200', NULL])[(g + place) % 5 + 1] AS code FROM u),
         e AS (SELECT d, min(CASE WHEN code IN ('200', '404') THEN place END) AS first, max(place) AS n, arg_max(coalesce('RDAP HTTP ' || code, 'not answered'), place) AS last FROM a GROUP BY 1),
         r AS (SELECT x.d, e.n, e.last, a.code, CASE WHEN a.code = '200' AND x.g % 3 <> 0 THEN DATE '2020-01-01' + CAST(x.g % 1000 AS INTEGER) END AS born FROM x LEFT JOIN e ON e.d = x.d LEFT JOIN a ON a.d = x.d AND a.place = e.first)
    SELECT d AS domain, CASE WHEN code IS NULL THEN 'failed' WHEN born IS NOT NULL THEN 'done' ELSE 'no_data' END AS status, CAST(born AS VARCHAR) AS born,
           CASE WHEN code IS NULL THEN CASE WHEN n IS NULL THEN 'rdap_service_not_found:' || d ELSE 'rdap_query_failed:' || last END WHEN code = '404' THEN 'rdap_http_404' WHEN born IS NULL THEN 'created_at_not_found' END AS error FROM r
    UNION ALL SELECT '', 'failed', NULL, 'invalid_domain'""")
def rdap_registrations(spark: SparkSession, d: str) -> DataFrame:
    """Every customer's domain, asked at the services of its longest known suffix, by the addresses in turn (S12): answers of all kinds, services
    that aren't known, names that are no domains."""
    return _registrations(spark, d).select("domain", "status", F.date_format("created_at", "yyyy-MM-dd").alias("born"), "error")


def _registrations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    suffix = F.get(F.array(*map(F.lit, [".com", ".co.uk", ".me.uk", ".dev", ".io", ".net"])), (k % 6).cast("int"))
    name = F.concat(F.lit("https://www.shop"), F.floor(k / 3).cast("string"), suffix, F.lit("/page"))
    # Reading a domain costs more than a customer's few bytes tell Spark: they are dealt out first.
    dealt = table(spark, d, "customer").select("c_custkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    customers = dealt.select(name.alias("url")).unionByName(spark.range(1).select(F.lit("no domain").alias("url")))
    known = G.services(spark.range(1).select(F.lit(BOOTSTRAP).alias("document")), "document")
    asked = written(G.questions(customers, "url", known))  # read by the answers and by what resolves them
    g = F.coalesce(F.regexp_extract("domain", r"^shop(\d+)\.", 1).try_cast("long"), F.lit(0))
    code = F.get(F.array(F.lit(200), F.lit(404), F.lit(500), F.lit(200), F.lit(None)), ((g + F.col("place")) % 5).cast("int"))
    date = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (g % 1000).cast("int")), "yyyy-MM-dd")
    event = F.to_json(F.struct(F.array(F.struct(F.lit("registration").alias("eventAction"), date.alias("eventDate"))).alias("events")))
    answers = asked.where("url IS NOT NULL").select("url", code.alias("code"), F.when(g % 3 != 0, event).otherwise("{}").alias("payload"), F.lit(None).cast("string").alias("error"))
    return G.resolved(asked, answers, O.created_at("payload"))


@query(f"""
    WITH {_DOMAINS}, f AS (SELECT DISTINCT domain, g FROM c WHERE s = 1),
         b AS (SELECT domain, g, CASE (g % 5) WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 500 WHEN 3 THEN 200 END AS code FROM f),
         r AS (SELECT domain, CASE WHEN g % 2 = 0 THEN least(100.0, greatest(0.0, CAST(g % 130 - 10 AS DOUBLE))) END AS rating, CASE WHEN code = 200 AND g % 3 <> 0 THEN CAST(DATE '2020-01-01' + CAST(g % 1000 AS INTEGER) AS VARCHAR) END AS born FROM b)
    SELECT domain, rating, born, CASE WHEN rating IS NULL THEN 'failed' ELSE 'done' END AS status FROM r""")
def domain_observations(spark: SparkSession, d: str) -> DataFrame:
    """Ratings and registrations of the domains below co.uk as one observation."""
    births = written(_registrations(spark, d).where(F.col("domain").endswith(".co.uk")).select("domain", F.date_format("created_at", "yyyy-MM-dd").alias("born")))
    g = F.regexp_extract("domain", r"^shop(\d+)\.", 1).cast("long")
    ratings = births.select("domain", F.when(g % 2 == 0, (g % 130 - 10).cast("double")).alias("rating"))
    return W.combined(ratings, births, ["domain"]).select("domain", "rating", "born", "status")


@query("""
    WITH p AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS origin, regexp_replace(url, '[?#].*$', '') AS bare, page_id % 7 AS s FROM pages)
    SELECT page_id, CASE s WHEN 0 THEN origin || '/touch.png' WHEN 1 THEN regexp_replace(bare, '[^/]*$', '') || 'img/i.png?v=' || page_id WHEN 2 THEN 'https://cdn.test/x.svg' WHEN 3 THEN regexp_extract(origin, '^([a-z]+):', 1) || '://static.test/i.ico' WHEN 4 THEN origin || '/a/c.ico' ELSE origin || '/favicon.ico' END AS icon, s < 5 AS named,
           s <> 6 AND page_id % 5 <> 0 AND page_id % 11 <> 0 AS kept FROM p""")
def page_icons(spark: SparkSession, d: str) -> DataFrame:
    """Where every page's icon lies (H17) and whether what was fetched from there is kept."""
    k = F.col("page_id")
    tags = [
        '<link rel="icon" href="/i.png"><link rel=\'Apple-Touch-Icon\' href=\'/touch.png\'>', '<link href="" rel="icon"><LINK rel="shortcut icon" href="img/i.png?v={k}">', "<link rel=icon href=https://cdn.test/x.svg>",
        '<link rel="icon" href=" //static.test/i.ico ">', '<link rel="icon" href="/a/b/.././c.ico">', '<link rel="stylesheet" href="/s.css">', "",
    ]
    tag = F.replace(F.get(F.array(*map(F.lit, tags)), (k % 7).cast("int")), F.lit("{k}"), k.cast("string"))
    html = F.regexp_replace("html", "<head>", F.concat(F.lit("<head>"), F.regexp_replace(tag, r"([\\$])", r"\\$1")))
    p = table(spark, d, "pages").select("page_id", "url", html.alias("html"))
    body = F.when(k % 7 == 6, F.lit("")).otherwise(F.substring("html", 1, 50)).cast("binary")
    kept = AD.keeps_icon(F.when(k % 5 == 0, 404).otherwise(200), F.when(k % 11 == 0, "1048577").otherwise("x"), body)
    return p.select("page_id", AD.icon_or_usual("html", "url").alias("icon"), AD.icon_address("html", "url").isNotNull().alias("named"), kept.alias("kept"))


@query("""
    WITH a AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i, l_partkey % 6 AS s, 'u' || l_linenumber AS url, CASE WHEN l_suppkey % 3 > 0 THEN 'm' || l_suppkey % 3 END AS model, l_suppkey AS v FROM lineitem),
         f AS (SELECT k, min(CASE WHEN s IN (0, 1) THEN i END) AS first FROM a GROUP BY 1),
         e AS (SELECT a.k, string_agg(CASE WHEN s = 5 THEN url || ': timeout' ELSE url || '/' || coalesce(model, 'default') || ': empty_schema_result' END, ' | ' ORDER BY i) AS errors, bool_or(s <> 5 OR v % 2 = 0) AS again FROM a JOIN f USING (k) WHERE s NOT IN (0, 1) AND (first IS NULL OR i < first) GROUP BY 1)
    SELECT f.k, a.url, a.model, CASE a.s WHEN 0 THEN '{"category_l1":"c' || v || '","key_features":["x"]}' WHEN 1 THEN '{"category_l1":"d' || v || '","key_features":[]}' END AS answer, coalesce(e.errors, '') AS errors, CASE WHEN first IS NULL THEN again END AS retryable
    FROM f LEFT JOIN a ON a.k = f.k AND a.i = f.first LEFT JOIN e ON e.k = f.k""")
def first_extractions(spark: SparkSession, d: str) -> DataFrame:
    """The first attempt of each order's lines whose answer has the fields that were asked for (S17), and what went wrong before."""
    v = F.col("l_suppkey").cast("string")
    shape = (F.col("l_partkey") % 6).cast("int")
    payloads = ['{"category_l1":"c{v}","key_features":["x"]}', '{"choices":[{"message":{"content":"{\\"category_l1\\":\\"d{v}\\",\\"key_features\\":[]}"}}]}', '{"category_l1":" ","key_features":["x"]}', '{"category_l1":"only"}', "no json {v}", '{"category_l1":"late","key_features":[]}']
    payload = F.replace(F.get(F.array(*map(F.lit, payloads)), shape), F.lit("{v}"), v)
    a = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("k"), "l_linenumber", "l_partkey", "l_suppkey", F.concat(F.lit("u"), F.col("l_linenumber").cast("string")).alias("url"), F.when(F.col("l_suppkey") % 3 > 0, F.concat(F.lit("m"), (F.col("l_suppkey") % 3).cast("string"))).alias("model"),
        payload.alias("payload"), F.when(shape == 5, "timeout").alias("error"), F.when(shape == 5, F.col("l_suppkey") % 2 == 0).alias("retryable"),
    )
    out = EX.first_extraction(a, ["k"], ["l_linenumber", "l_partkey", "l_suppkey"], ["category_l1", "key_features"], ["key_features"], True)
    return out.withColumn("errors", F.array_join("errors", " | "))
