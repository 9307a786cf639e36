"""Parts of pages, links and sitemaps.

A page is parsed once, in Arrow batches; what follows are columns, and candidates are rows.
"""

from __future__ import annotations

import html
import json
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .documents import page_slices
from .numbers import _c, to_decimal
from .offers import plan
from .text import contact_url_score, is_contact_url, is_pricing_fragment, is_strict_pricing_url, pricing_text_quality, pricing_url_score

# Elements that break lines or are no text, usual paths, types of products.
BREAKS = {"br", "p", "div", "li", "tr", "td", "th", "section", "article", "h1", "h2", "h3", "h4"}
SILENT = {"script", "style", "noscript", "svg"}
PRICING_PATHS = ["/pricing", "/plans", "/subscribe", "/subscription", "/subscriptions", "/upgrade", "/pricing-page", "/pricing-plans", "/plans-pricing", "/billing"]
CONTACT_PATHS = ["/contact-sales", "/book-a-demo", "/book-a-demo-call", "/request-demo", "/demo", "/contact", "/contact-us", "/enterprise"]
PRODUCT_TYPES = {"product", "softwareapplication", "webapplication", "mobileapplication", "webapp"}
LONGEST_TEXT = 60_000


class _Parts(HTMLParser):
    """Lines of text, link targets and JSON-LD scripts of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.links, self.scripts, self.silent, self.script = [[]], [], [], 0, None

    def handle_starttag(self, tag, attrs):
        given = {k: v or "" for k, v in attrs}
        if tag == "script" and given.get("type", "").lower() == "application/ld+json":
            self.script = []
        elif tag in SILENT:
            self.silent += 1
        elif tag == "a" and given.get("href"):
            self.links.append(given["href"])
        if tag in BREAKS:
            self.lines.append([])

    def handle_endtag(self, tag):
        if tag == "script" and self.script is not None:
            text = "".join(self.script).strip()
            self.scripts += [text] if text else []
            self.script = None
        elif tag in SILENT:
            self.silent = max(0, self.silent - 1)
        if tag in BREAKS:
            self.lines.append([])

    def handle_data(self, data):
        if self.script is not None:
            self.script.append(data)
        elif not self.silent:
            first, *rest = data.split("\n")
            self.lines[-1].append(first)
            self.lines += [[x] for x in rest]

    def text(self) -> str:
        clean = (" ".join("".join(x).split()) for x in self.lines)
        return "\n".join(x for x in clean if x)[:LONGEST_TEXT]


def _below(value, keys: tuple[str, ...]) -> Iterator[dict]:
    """A JSON value's objects: itself, items of lists, and what stands below the keys."""
    if isinstance(value, list):
        for item in value:
            yield from _below(item, keys)
    elif isinstance(value, dict):
        yield value
        for k in keys:
            if k in value:
                yield from _below(value[k], keys)


def _json(script: str):
    try:
        return json.loads(html.unescape(script))
    except ValueError:
        return None


def _offers(scripts: list[str]) -> list[dict]:
    out = []
    for script in scripts:
        for node in _below(_json(script), ("@graph", "offers")):
            spec = node.get("priceSpecification")
            price = node.get("price") or node.get("lowPrice") or (spec.get("price") if isinstance(spec, dict) else None)
            if price is not None:
                out.append({"name": str(node.get("name") or node.get("description") or ""), "price": str(price), "currency": str(node.get("priceCurrency") or "USD"), "node": json.dumps(node, ensure_ascii=False)})
    return out


def _names(scripts: list[str]) -> list[str]:
    out = []
    for script in scripts:
        for node in _below(_json(script), ("@graph", "mainEntity", "itemListElement")):
            kinds = node.get("@type")
            if {str(k or "").replace(" ", "").lower() for k in (kinds if isinstance(kinds, list) else [kinds])} & PRODUCT_TYPES and node.get("name"):
                out.append(" ".join(str(node["name"]).split())[:120])
    return list(dict.fromkeys(out))


OFFER = pa.struct([("name", pa.string()), ("price", pa.string()), ("currency", pa.string()), ("node", pa.string())])


def page_parts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each page: page_text (lines), links (absolute), offers and product names of its JSON-LD.

    Null pages have no text, links or offers; links that aren't valid are left out.
    """
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in page_slices(batches, "_html"):
            text, links, offers, names = [], [], [], []
            for url, body in zip(batch.column("_url").to_pylist(), batch.column("_html").to_pylist(), strict=True):
                parser = _Parts()
                parser.feed(body or "")
                parser.close()
                text.append(parser.text())
                found = []
                for href in parser.links:
                    try:
                        found.append(urljoin(url or "", href))
                    except ValueError:
                        continue
                links.append(found)
                offers.append(_offers(parser.scripts))
                names.append(_names(parser.scripts))
            columns = [batch.column("_id"), pa.array(text, pa.string()), pa.array(links, pa.list_(pa.string())), pa.array(offers, pa.list_(OFFER)), pa.array(names, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "page_text", "links", "offers", "product_names"])

    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    out = rows.mapInArrow(run, f"_id {kind}, page_text string, links array<string>, offers array<struct<name:string,price:string,currency:string,node:string>>, product_names array<string>")
    return out.withColumnRenamed("_id", id_col)


def offer_plans(offers, most: int = 6) -> Column:
    """Plans of a page's JSON-LD offers (F56): those with a price, the first six."""
    priced = F.filter(_c(offers), lambda o: to_decimal(o["price"]).isNotNull())
    named = lambda o: F.coalesce(F.nullif(F.trim(o["name"]), F.lit("")), F.lit("Listed plan"))
    return F.transform(F.slice(priced, 1, most), lambda o, i: plan(named(o), to_decimal(o["price"]), o["currency"], o["node"], i))


def sitemap_locs(body) -> Column:
    """Addresses of a sitemap."""
    found = F.regexp_extract_all(F.coalesce(_c(body), F.lit("")), F.lit(r"(?i)<(?:\w+:)?loc>\s*([^<]+?)\s*</(?:\w+:)?loc>"), F.lit(1))
    return F.filter(F.transform(found, lambda u: F.replace(u, F.lit("&amp;"), F.lit("&"))), lambda u: u.rlike("^https?://"))


def normal_url(x) -> Column:
    """A URL with a scheme; null if it has no host or another scheme than http and https."""
    u = F.when(_c(x).contains("://"), _c(x)).otherwise(F.concat(F.lit("https://"), _c(x)))
    return F.when(u.rlike(r"^(?i:https?)://[^/?#\s]+"), u)


def origin(x) -> Column:
    u = normal_url(x)
    return F.when(u.isNotNull(), F.concat(F.lower(F.regexp_extract(u, "^([A-Za-z]+)://", 1)), F.lit("://"), F.regexp_extract(u, "^[A-Za-z]+://([^/?#]+)", 1)))


def _discovered(pages: DataFrame, id_col: str, sources: list[Column], valid, score, most: int, keep_fragment: bool) -> DataFrame:
    """Candidates of each page: of its own host, valid, one of each address, the best first."""
    every = pages.select(id_col, origin("url").alias("_origin"), F.posexplode(F.concat(*sources)).alias("_place", "_u")).withColumn("_u", normal_url("_u"))
    own = every.where(F.col("_u").isNotNull() & (origin("_u") == F.col("_origin")))
    bare = F.substring_index("_u", "#", 1)
    own = own.withColumn("candidate", F.when(is_pricing_fragment("_u"), F.col("_u")).otherwise(bare) if keep_fragment else bare)
    good = own.where(valid("candidate")).withColumn("_key", F.regexp_replace("candidate", "/+$", ""))
    once = good.groupBy(id_col, "_key").agg(F.min_by("candidate", "_place").alias("candidate"), F.min("_place").alias("_place")).withColumn("score", score("candidate"))
    from tally.operators.evaluation import numbered

    return numbered(once, [id_col], [F.desc("score"), F.asc("_place")], most).select(id_col, "candidate", "score", "place")


def discover_pricing(pages: DataFrame, id_col: str = "page_id", most: int = 12) -> DataFrame:
    """Pages that may hold prices (F26): links, the page's own prices, the sitemap, usual paths.

    pages: id, url, links, page_text, sitemap (text or null).
    """
    usual = [F.concat(origin("url"), F.lit(p)) for path in PRICING_PATHS for p in (path, path + "/")]
    own = F.when(F.col("page_text").rlike(r"(?i)\bpricing|plans?\b"), F.array(F.concat(origin("url"), F.lit("/#pricing")))).otherwise(F.array().cast("array<string>"))
    return _discovered(pages, id_col, [F.col("links"), own, sitemap_locs("sitemap"), F.array(*usual)], is_strict_pricing_url, pricing_url_score, most, True)


def discover_contact(pages: DataFrame, id_col: str = "page_id", most: int = 8) -> DataFrame:
    """Pages where one asks for a price."""
    usual = [F.concat(origin("url"), F.lit(p)) for p in CONTACT_PATHS]
    return _discovered(pages, id_col, [F.col("links"), sitemap_locs("sitemap"), F.array(*usual)], is_contact_url, contact_url_score, most, False)


def best_page(fetched: DataFrame, id_col: str) -> DataFrame:
    """The page to take prices from.

    fetched: id, place (0: the source itself), kind (pricing or contact), final_url, status, page_text.  The source
    if it is strict and rich enough; else the best strict page by address and text, if its text has any
    quality; else the first page where one can ask; else not_found.
    """
    strict, quality = is_strict_pricing_url("final_url"), pricing_text_quality("page_text")
    rows = fetched.withColumns({"_strict": strict & (F.col("status") == 200), "_quality": quality, "_score": pricing_url_score("final_url") + quality})
    pick = F.struct("final_url", "status", "_quality", "_score")
    first = F.col("place") == 0
    source = F.when(first & F.col("_strict") & (F.col("_quality") >= 12), pick)
    # The source competes whether strict or not; others only when strict.
    rival = (F.col("kind") == "pricing") & (F.col("_strict") | (first & (F.col("status") == 200)))
    best = F.max_by(F.when(rival, F.struct("final_url", "_strict", "_quality")), F.when(rival, F.struct(F.col("_score"), -F.col("place"))))
    ask = (F.col("kind") == "contact") & (F.col("status") == 200) & (F.length("page_text") >= 80)
    g = rows.groupBy(id_col).agg(F.max(source).alias("s"), best.alias("b"), F.min_by("final_url", F.when(ask, F.col("place"))).alias("_any"), F.max(ask).alias("_asks"), F.min_by(F.when(ask, F.col("final_url")), F.when(ask, F.col("place"))).alias("c"), F.max_by("final_url", -F.col("place")).alias("o"))
    good = F.coalesce(F.col("b._strict") & (F.col("b._quality") > 0), F.lit(False))
    status = F.when(F.col("s").isNotNull(), "found").when(good, "found").when(F.col("c").isNotNull(), "contact_sales").otherwise("not_found")
    how = F.when(F.col("s").isNotNull(), "source_url").when(good, "candidate_scored").when(F.col("c").isNotNull(), "contact_or_demo").otherwise("none")
    chosen = F.when(F.col("s").isNotNull(), F.col("s.final_url")).when(good, F.col("b.final_url")).when(F.col("c").isNotNull(), F.col("c")).otherwise(F.coalesce("b.final_url", "o"))
    return g.select(id_col, chosen.alias("final_url"), status.alias("page_status"), how.alias("discovery"))
