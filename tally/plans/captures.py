"""Queries of page snapshots: bundles, capture plans, stored objects.

Each order is a snapshot of its customer's pricing page, which lists the order's first two lines; order keys are their order in time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions import documents as H
from tally.operators import snapshots as S
from tally.plans.batches import shared_folder, written
from tally.plans.catalog import query
from tally.sources import objects as OB
from tally.sources.tables import table

_PAGES = """item AS (SELECT l_orderkey, string_agg((['Free', 'Pro', 'Team'])[l_linenumber % 3 + 1] || ' ' || (['$', '€', 'USD ', 'from '])[l_suppkey % 4 + 1] || CAST(floor(l_quantity / 25) * 25 AS INTEGER) || ' per month', '|' ORDER BY l_linenumber, l_suppkey, l_partkey) AS t
                  FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1),
         page AS (SELECT o_custkey AS source, o_orderkey AS seq, o_orderkey % 2 = 0 AS rendered, 'Pricing ' || coalesce(replace(t, '|', ' '), '') AS text,
                         '<html><body><main><h1>Pricing</h1><ul>' || coalesce('<li>' || replace(t, '|', '</li><li>') || '</li>', '') || '</ul></main></body></html>' AS html,
                         CASE WHEN o_orderkey % 6 <> 0 THEN '<html><body><div id="app"></div></body></html>' END AS original FROM orders LEFT JOIN item ON l_orderkey = o_orderkey),
         raw AS (SELECT source, seq, CASE WHEN rendered THEN 'rendered_html' ELSE 'html' END AS kind, html AS body FROM page UNION ALL SELECT source, seq, 'html', original FROM page WHERE rendered AND original IS NOT NULL
                 UNION ALL SELECT source, seq, 'text', text FROM page UNION ALL SELECT source, seq, 'structured_data', '{"page":' || source || '}' FROM page
                 UNION ALL SELECT source, seq, 'dom_map', CAST(to_json(regexp_extract_all(html, '<([a-z0-9]+)', 1)) AS VARCHAR) FROM page UNION ALL SELECT source, seq, 'screenshot', 'png:' || text FROM page WHERE seq % 9 = 0),
         part AS (SELECT source, seq, kind, octet_length(encode(body)) AS size, 'pricing/artifacts/' || kind || '/' || sha256(body) AS object_key FROM raw)"""


def _pages(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda words, i: F.get(F.array(*map(F.lit, words)), i)
    shown = F.concat(pick(["Free", "Pro", "Team"], F.col("l_linenumber") % 3), F.lit(" "), pick(["$", "€", "USD ", "from "], (F.col("l_suppkey") % 4).cast("int")), (F.floor(F.col("l_quantity") / 25) * 25).cast("int").cast("string"), F.lit(" per month"))
    items = table(spark, d, "lineitem").where("l_linenumber <= 2").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey", shown.alias("t")))), lambda x: x["t"]).alias("items"))
    pages = table(spark, d, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    listed = F.when(F.col("items").isNull(), "").otherwise(F.concat(F.lit("<li>"), F.array_join("items", "</li><li>"), F.lit("</li>")))
    k = F.col("o_orderkey")
    return pages.select(
        F.col("o_custkey").alias("source"), k.alias("seq"), (k % 2 == 0).alias("rendered"), F.concat(F.lit("Pricing "), F.coalesce(F.array_join("items", " "), F.lit(""))).alias("text"),
        F.concat(F.lit("<html><body><main><h1>Pricing</h1><ul>"), listed, F.lit("</ul></main></body></html>")).alias("html"), F.when(k % 6 != 0, '<html><body><div id="app"></div></body></html>').alias("original"),
    )


def _artifacts(spark: SparkSession, d: str) -> DataFrame:
    """All artifacts of all snapshots; every ninth has a screenshot."""
    structured = F.concat(F.lit('{"page":'), F.col("source").cast("string"), F.lit("}"))
    tags = F.to_json(F.regexp_extract_all("html", F.lit("<([a-z0-9]+)"), F.lit(1)))
    parts = S.parts_of(F.col("html"), F.col("rendered"), F.col("original"), F.col("text"), structured, tags)
    shot = F.array(F.struct(F.lit("screenshot").alias("artifact_type"), F.concat(F.lit("png:"), F.col("text")).alias("body"), F.lit("image/png").alias("content_type")))
    rows = _pages(spark, d).withColumn("parts", F.when(F.col("seq") % 9 == 0, F.concat(parts, shot)).otherwise(parts))
    return S.artifacts(rows.select("source", "seq", F.explode("parts").alias("part")).select("source", "seq", "part.*"))


@query(f"""
    WITH {_PAGES},
         b AS (SELECT source, seq, sha256('pricing-snapshot-v1' || chr(10) || string_agg(object_key, chr(10) ORDER BY object_key)) AS bundle_hash, count(*) AS parts, CAST(sum(size) AS BIGINT) AS bytes FROM part GROUP BY 1, 2)
    SELECT source, seq, bundle_hash, parts, bytes, '{{"currency_codes":' || CAST(to_json(list_sort(list_distinct(regexp_extract_all(text, '\\b(?:USD|EUR)\\b')))) AS VARCHAR) || ',"currency_symbols":' ||
           CAST(to_json(list_sort(list_distinct(regexp_extract_all(text, '[$€]')))) AS VARCHAR) || ',"diagnostic_only":true}}' AS context FROM b JOIN page USING (source, seq)""")
def snapshot_bundles(spark: SparkSession, d: str) -> DataFrame:
    """Bundle hash, parts, bytes and currencies of every snapshot (H9)."""
    made = S.bundles(_artifacts(spark, d), ["source", "seq"])
    shown = _pages(spark, d).select("source", "seq", S.currency_context(F.col("text")).alias("context"))
    return made.join(shown, ["source", "seq"])


@query(f"""
    WITH {_PAGES},
         r AS (SELECT source, seq, sha256(text) AS h, lag(sha256(text)) OVER (PARTITION BY source ORDER BY seq) AS p FROM page),
         f AS (SELECT source, seq, p IS NULL OR p <> h AS region_changed, p IS NULL OR p <> h OR seq % 50 = 0 AS run_extraction, p IS NULL OR p <> h OR seq % 9 = 0 AS capture_screenshot FROM r),
         known AS (SELECT DISTINCT object_key FROM part WHERE seq % 5 = 0),
         u AS (SELECT object_key, min(seq) AS seq FROM part JOIN f USING (source, seq) WHERE (kind <> 'screenshot' OR capture_screenshot) AND object_key NOT IN (SELECT object_key FROM known) GROUP BY 1)
    SELECT source, seq, region_changed, run_extraction, capture_screenshot, (SELECT count(*) FROM u WHERE u.seq = f.seq) AS uploads FROM f""")
def capture_plan(spark: SparkSession, d: str) -> DataFrame:
    """What each snapshot must do (H9): extract anew, take a screenshot, and how many objects it is the first to need.

    The previous region is found over ranges, so no source is one task; what every fifth snapshot holds is stored already.  Pages are
    made once: a region's hash is that of its text's artifact.  Keys are only compared, so they go without their folder, as base64; and only
    screenshots, of which some aren't wanted, meet the plan.
    """
    short = F.concat_ws("/", "artifact_type", F.base64(F.unhex("content_hash")))
    made = written(_artifacts(spark, d).select("source", "seq", "artifact_type", short.alias("object_key"), "byte_size"))
    hashed = made.where("artifact_type = 'text'").select("source", "seq", F.col("object_key").alias("region"))
    before = S.previous_in_key(hashed, ["source"], "seq", "region", "before", written)
    flags = S.capture_flags(F.col("before"), F.col("region"), F.col("seq") % 50 == 0, F.col("seq") % 9 == 0)
    plan = written(before.select("source", "seq", *[c.alias(n) for n, c in flags.items()]))
    stored = made.where("seq % 5 = 0").select("object_key").distinct()
    shots = made.where("artifact_type = 'screenshot'").join(plan.select("source", "seq", "capture_screenshot"), ["source", "seq"])
    others = made.where("artifact_type <> 'screenshot'").withColumn("capture_screenshot", F.lit(False))
    first = S.uploads(shots.unionByName(others), stored, "seq")
    n = first.groupBy("seq").agg(F.count("*").alias("uploads"))
    return plan.join(n, "seq", "left").select("source", "seq", "region_changed", "run_extraction", "capture_screenshot", F.coalesce("uploads", F.lit(0)).alias("uploads"))


def _objects(kind: str, body: Column, mime: str) -> list[Column]:
    return [F.concat(F.lit(f"{S.OBJECT_FOLDER}/{kind}/"), F.sha2(body, 256)).alias("object_key"), body.alias("body"), F.lit(mime).alias("content_type")]


@query(r"""
    WITH o AS (SELECT 'html' AS kind, html AS body FROM pages UNION ALL SELECT 'text', regexp_extract(html, '(?i)<title[^>]*>([\s\S]*?)</title>', 1) FROM pages UNION ALL SELECT 'html', html FROM pages WHERE page_id % 2 = 0)
    SELECT DISTINCT 'pricing/artifacts/' || kind || '/' || sha256(body) AS object_key, CAST(octet_length(encode(body)) AS BIGINT) AS byte_size, CASE kind WHEN 'html' THEN 'text/html' ELSE 'text/plain' END AS content_type, TRUE AS whole FROM o""")
def stored_objects(spark: SparkSession, d: str) -> DataFrame:
    """Every page and every title, put as objects by two jobs, of which the second repeats half of the first; read back and held
    against their keys (S20)."""
    pages, path = table(spark, d, "pages"), shared_folder(spark, "objects")
    html, title = F.col("html"), F.regexp_extract("html", H.TITLE, 1)
    OB.put(pages.select(*_objects("html", html, "text/html")).unionByName(pages.select(*_objects("text", title, "text/plain"))), path)
    OB.put(pages.where("page_id % 2 = 0").select(*_objects("html", html, "text/html")), path)
    held = OB.stored(spark, path).select(F.col("object_key").alias("_key"), (F.sha2("body", 256) == F.substring_index("object_key", "/", -1)).alias("whole"))
    return OB.index(spark, path).join(held, F.col("object_key") == F.col("_key")).drop("_key")
