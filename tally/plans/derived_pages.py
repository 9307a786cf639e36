"""Queries of pages with prices, derived from orders: elements, pricing regions, claims with their evidence.

An order is a page; its first four lines are rows of a table, whose second cell says something by the line's part.  SQL knows the page's
plan, so it states elements, scores and claims without parsing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions import documents as H
from tally.operators import page_claims as PC
from tally.plans.catalog import query
from tally.sources.tables import table

#: What the second cell says; {q} is a number.  The filler keeps the surroundings of one price free of the next.
SAYINGS = ["USD {q} per month", "EUR {q} per user monthly", "${q} per request", "Contact sales for a quote", "{q} day free trial", "No credit card required", "{q},000 credits per month free", "Free plan"]
FILLER = " lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore"

_CASES = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SAYINGS))
_PAGES = f"""line AS (SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS i, l_partkey % 8 AS kind, CAST(l_quantity AS INTEGER) + 1 AS q FROM lineitem),
    item AS (SELECT page, CAST(i AS INTEGER) AS i, kind, q, 'Row ' || chr(65 + CAST(i AS INTEGER)) AS name, replace(CASE kind {_CASES} END, '{{q}}', CAST(q AS VARCHAR)) || '{FILLER}' AS said FROM line WHERE i < 4),
    body AS (SELECT page, CAST(count(*) AS INTEGER) AS n, string_agg(name || ' ' || said, ' ' ORDER BY i) AS t FROM item GROUP BY 1),
    node AS (SELECT b.page, v.node, v.parent, coalesce(v.last, 6 + 3 * n) AS "end", v.tag, v.hidden, CAST(NULL AS INTEGER) AS table_row, CAST(NULL AS INTEGER) AS table_column, v.text FROM body b, LATERAL (VALUES
                (0, -1, 7 + 3 * n, 'html', FALSE, 'Home Pricing plans ' || t || CASE WHEN page % 3 = 0 THEN '' ELSE ' Privacy and cookie terms' END), (1, 0, 7 + 3 * n, 'body', FALSE, 'Home Pricing plans ' || t || CASE WHEN page % 3 = 0 THEN '' ELSE ' Privacy and cookie terms' END),
                (2, 1, 3, 'nav', FALSE, 'Home'), (3, 2, 3, 'a', FALSE, 'Home'), (4, 1, NULL, 'main', FALSE, 'Pricing plans ' || t), (5, 4, 5, 'h1', FALSE, 'Pricing plans'), (6, 4, NULL, 'table', FALSE, t),
                (7 + 3 * n, 1, 7 + 3 * n, 'footer', page % 3 = 0, CASE WHEN page % 3 = 0 THEN '' ELSE 'Privacy and cookie terms' END)) v(node, parent, last, tag, hidden, text)
             UNION ALL SELECT page, 7 + 3 * i, 6, 9 + 3 * i, 'tr', FALSE, i, NULL, name || ' ' || said FROM item
             UNION ALL SELECT page, 8 + 3 * i, 7 + 3 * i, 8 + 3 * i, 'td', FALSE, i, 0, name FROM item UNION ALL SELECT page, 9 + 3 * i, 7 + 3 * i, 9 + 3 * i, 'td', FALSE, i, 1, said FROM item)"""
_REGIONS = f"""scored AS (SELECT page, node, "end", text, CAST(least(len(regexp_extract_all(text, '{H.PRICE}')), 8) * 8 + least(len(regexp_extract_all(text, '{H.PLAN_WORDS}')), 12) * 2 - least(len(regexp_extract_all(text, '{H.SITE_WORDS}')), 8) * 5
                   + CASE WHEN tag = 'main' AND page % 2 = 0 THEN 14 ELSE 0 END + CASE WHEN tag IN ('main', 'table') THEN 3 ELSE 0 END AS INTEGER) AS score FROM node WHERE tag IN ('body', 'main', 'table')),
    region AS (SELECT page, node AS root, "end", score FROM scored WHERE score >= 12 QUALIFY row_number() OVER (PARTITION BY page ORDER BY score DESC, length(text), node) = 1 )"""


def _pages(spark: SparkSession, d: str) -> DataFrame:
    line = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("page_id"))
    kind, q = (F.col("l_partkey") % 8).cast("int"), (F.col("l_quantity").cast("int") + 1).cast("string")
    said = F.replace(F.get(F.array(*map(F.lit, SAYINGS)), kind), F.lit("{q}"), q)
    rows = F.slice(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", said.alias("said")))), 1, 4)
    cell = lambda x, i: F.concat(F.lit("<tr><td>Row "), F.char(i + 65), F.lit("</td><td>"), x["said"], F.lit(f"{FILLER}</td></tr>"))
    k = F.col("page_id")
    html = F.concat(
        F.lit('<html><body><nav><a href="/">Home</a></nav><main role="main" class="'), F.when(k % 2 == 0, "pricing").otherwise("content"), F.lit('"><h1>Pricing plans</h1><table>'), F.array_join(F.transform("rows", cell), ""),
        F.lit("</table></main><footer"), F.when(k % 3 == 0, " hidden").otherwise(""), F.lit(">Privacy and cookie terms</footer></body></html>"),
    )
    return line.agg(rows.alias("rows")).select("page_id", html.alias("html"))


@query(f"""WITH {_PAGES} SELECT page AS page_id, node, parent, "end", tag, hidden, table_row, table_column, CAST(length(text) AS INTEGER) AS n_text, sha256(text) AS text_hash FROM node""")
def derived_elements(spark: SparkSession, d: str) -> DataFrame:
    """Every element of every page (H2, H3) with its subtree and its place in the table."""
    return H.dom_nodes(_pages(spark, d)).select("page_id", "node", "parent", "end", "tag", "hidden", "table_row", "table_column", F.length("text").alias("n_text"), F.sha2("text", 256).alias("text_hash"))


@query(f"""
    WITH {_PAGES}, {_REGIONS},
         cell AS (SELECT n.page, n.node, '{{"attributes":' || CASE tag WHEN 'main' THEN '{{"role":"main"}}' ELSE '{{}}' END || ',"table_column":' || coalesce(CAST(table_column AS VARCHAR), 'null') || ',"table_row":' || coalesce(CAST(table_row AS VARCHAR), 'null')
                         || ',"tag":"' || tag || '","text":' || CAST(to_json(text) AS VARCHAR) || '}}' AS j FROM node n JOIN region r ON r.page = n.page AND n.node BETWEEN r.root AND r."end" WHERE text <> ''),
         h AS (SELECT page, count(*) AS n_nodes, sha256('[' || string_agg(j, ',' ORDER BY node) || ']') AS region_hash FROM cell GROUP BY 1)
    SELECT page AS page_id, root, "end", score, n_nodes, region_hash FROM region JOIN h USING (page)""")
def derived_regions(spark: SparkSession, d: str) -> DataFrame:
    """The best container of prices of each page (H4, O9) and the hash of what it shows."""
    regions = H.tree_hashes(H.tree_regions(H.page_trees(_pages(spark, d))))
    return regions.select("page_id", "root", "end", "score", "n_nodes", "region_hash")


@query(f"""
    WITH {_PAGES}, {_REGIONS},
         cell AS (SELECT i.page, 9 + 3 * i.i AS node, i.i, kind, q, length(said) AS size, said FROM item i JOIN region r USING (page)),
         least_of AS (SELECT page, kind, min_by(node, (size, node)) AS node, min_by(q, (size, node)) AS q FROM cell GROUP BY 1, 2),
         paid AS (SELECT page, min_by(node, (q, size, node)) AS node FROM cell WHERE kind <= 2 GROUP BY 1),
         start AS (SELECT page, min_by(node, (q, size, node)) AS node, min_by(q, (q, size, node)) AS q, min_by(kind, (q, size, node)) AS kind FROM cell WHERE kind <= 1 GROUP BY 1),
         usage AS (SELECT page, min_by(node, (size, q, node)) AS node, min_by(q, (size, q, node)) AS q FROM cell WHERE kind = 2 GROUP BY 1),
         model AS (SELECT r.page, coalesce(c.node, p.node) AS node, c.node IS NOT NULL AS quote, s.node IS NOT NULL AS sub, s.kind = 1 AS seat, u.node IS NOT NULL AS metered
                   FROM region r LEFT JOIN least_of c ON c.page = r.page AND c.kind = 3 LEFT JOIN paid p ON p.page = r.page LEFT JOIN start s ON s.page = r.page LEFT JOIN usage u ON u.page = r.page),
         claim AS (
             SELECT page, 'has_free_plan' AS claim_type, 'true' AS value, node, 'not_applicable' AS status, NULL AS error FROM least_of WHERE kind = 7 UNION ALL
             SELECT page, 'has_free_trial', '{{"available":true,"duration":"' || q || '","duration_unit":"day"}}', node, 'normalized', NULL FROM least_of WHERE kind = 4 UNION ALL
             SELECT page, 'card_required', 'false', node, 'not_applicable', NULL FROM least_of WHERE kind = 5 UNION ALL SELECT page, 'has_custom_quote', 'true', node, 'not_applicable', NULL FROM least_of WHERE kind = 3 UNION ALL
             SELECT page, 'free_allowance', '{{"quantity":"' || q || '000","unit":"credit","unit_family":"credit","period":"month"}}', node, 'normalized', NULL FROM least_of WHERE kind = 6 UNION ALL
             SELECT page, 'has_paid_pricing', 'true', node, 'not_applicable', NULL FROM paid UNION ALL SELECT page, 'starting_price_period', 'month', node, 'normalized', NULL FROM start UNION ALL
             SELECT page, 'starting_paid_price', '{{"amount":"' || q || '","currency":"' || CASE kind WHEN 0 THEN 'USD' ELSE 'EUR' END || '","amount_minor":' || q * 100 || ',"currency_exponent":2}}', node, 'normalized', NULL FROM start UNION ALL
             SELECT page, 'has_usage_pricing', 'true', node, 'not_applicable', NULL FROM usage UNION ALL SELECT page, 'usage_rate', '{{"amount":"' || q || '","unit":"request","unit_family":"operation"}}', node, 'failed', 'ambiguous_currency_symbol' FROM usage UNION ALL
             SELECT page, 'pricing_models', CAST(to_json(list_filter([CASE WHEN quote THEN 'custom_quote' END, CASE WHEN CAST(quote AS INT) + CAST(sub AS INT) + CAST(metered AS INT) > 1 THEN 'hybrid' END, CASE WHEN seat THEN 'per_seat' END,
                    CASE WHEN sub THEN 'subscription' END, CASE WHEN metered THEN 'usage_based' END], lambda x: x IS NOT NULL)) AS VARCHAR), node, 'normalized', NULL FROM model WHERE quote OR sub OR metered)
    SELECT c.page AS page_id, claim_type, value, c.node, status, error, r.root AS container, c.i AS table_row, 1 AS table_column, 'td' AS selector, c.said AS quote,
           sha256('{{"node_id":"n' || lpad(CAST(c.node + 1 AS VARCHAR), 6, '0') || '","quote":' || CAST(to_json(c.said) AS VARCHAR) || '}}') AS evidence_hash
    FROM (SELECT claim.*, cell.i, cell.said FROM claim JOIN cell ON cell.page = claim.page AND cell.node = claim.node) c JOIN region r ON r.page = c.page""")
def derived_claims(spark: SparkSession, d: str) -> DataFrame:
    """Positive claims of every page's region (H5, H7), each resting on the smallest element that supports it (H6)."""
    return PC.tree_claims(H.tree_regions(H.page_trees(_pages(spark, d))))
