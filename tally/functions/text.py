"""String, slug, domain and URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import _c, let

# Suffixes under which names are registered, path parts of pricing and contact pages.
THREE_LABEL_SUFFIXES = ["co.uk", "com.au", "co.jp", "co.in", "co.nz", "co.kr", "com.br", "com.cn", "com.sg", "com.hk", "co.za", "com.mx"]
PRICING_PARTS = ["pricing", "prices", "plans", "pricing-plans", "plans-pricing", "billing", "subscribe", "subscription", "subscriptions", "upgrade"]
CONTACT_PARTS = ["book-a-demo", "book-a-demo-call", "contact-sales", "request-demo", "schedule-demo", "demo", "contact", "contact-us", "enterprise", "sales"]
OTHER_PARTS = [
    "article", "articles", "blog", "buy", "cart", "careers", "case-study", "case-studies", "community", "docs", "guide", "help",
    "help-center", "issues", "legal", "news", "policy", "privacy", "privacy-policy", "resources", "release-note", "release-notes",
    "refund", "search", "shop", "store", "support", "terms", "terms-of-use",
]


def collapse(x) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(_c(x), F.lit("")), r"\s+", " "))


def slug(x, longest: int = 120) -> Column:
    """Lower-case words joined by hyphens; empty when longer than `longest`."""
    s = F.trim(F.regexp_replace(F.lower(F.coalesce(_c(x), F.lit(""))), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.regexp_replace(s, f"^.{{{longest + 1},}}$", "")  # names s once: a column named twice may be computed twice


def numbered_slug(base, n) -> Column:
    """The base for the first, base-2, base-3 and so on for the next."""
    return F.when(_c(n) <= 1, _c(base)).otherwise(F.concat_ws("-", _c(base), _c(n).cast("string")))


def clip(x, limit: int) -> Column:
    return let(collapse(x), lambda s: F.when(F.length(s) <= limit, s).otherwise(F.concat(F.rtrim(F.substring(s, 1, limit - 1)), F.lit("…"))))


def split_multi(x) -> Column:
    """Cells that hold several values, separated by | ; or ,: trimmed, distinct, in order."""
    parts = F.transform(F.split(F.coalesce(_c(x), F.lit("")), r"[|;,]+"), lambda p: F.trim(p))
    return F.array_distinct(F.filter(parts, lambda p: p != ""))


def domain(x) -> Column:
    """Host of a URL or bare name without www, user and port; empty if it isn't a domain."""
    s = F.trim(F.coalesce(_c(x), F.lit("")))
    s = F.regexp_replace(s, "^[^:/?#]*://", "")
    host = F.regexp_extract(s, "^([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_replace(host, r"^\.+|\.+$", "")), r"^www\.", "")
    return let(host, lambda h: F.when(h.rlike(r"^(?:[a-z0-9-]+\.)+[a-z]{2,63}$"), h).otherwise(F.lit("")))


def registrable(x) -> Column:
    """The last two labels, or three below a suffix that takes two."""
    last = lambda labels, n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), F.lit(n)), ".")
    labels = F.filter(F.split(_c(x), r"\."), lambda p: F.trim(p) != "")
    return let(labels, lambda p: F.when((F.size(p) >= 3) & last(p, 2).isin(THREE_LABEL_SUFFIXES), last(p, 3)).otherwise(last(p, 2)))


def path_parts(url) -> Column:
    path = F.coalesce(F.try_parse_url(_c(url), F.lit("PATH")), F.lit(""))
    return F.filter(F.split(F.lower(path), "/"), lambda p: p != "")


def fragment(url) -> Column:
    return F.lower(F.trim(F.coalesce(F.try_parse_url(_c(url), F.lit("REF")), F.lit(""))))


def is_bad_pricing_url(url) -> Column:
    bad = lambda p: p.isin(OTHER_PARTS) | p.endswith("-policy") | p.endswith("-terms") | p.startswith("api-") | p.endswith("-api")
    return F.exists(path_parts(url), bad)


def is_pricing_fragment(url) -> Column:
    f = fragment(url)
    return f.isin("pricing", "plans", "price", "billing", "subscribe", "subscription") | f.contains("pricing")


def is_strict_pricing_url(url) -> Column:
    part = lambda p: p.isin([*PRICING_PARTS, "price"]) | p.contains("pricing")
    return ~is_bad_pricing_url(url) & (is_pricing_fragment(url) | F.exists(path_parts(url), part))


def is_contact_url(url) -> Column:
    return ~is_bad_pricing_url(url) & F.exists(path_parts(url), lambda p: p.isin(CONTACT_PARTS))


def _sum(parts: Column, score) -> Column:
    return F.aggregate(parts, F.lit(0), lambda s, p: s + score(p))


def pricing_url_score(url) -> Column:
    parts = path_parts(url)
    depth = F.when(F.size(parts) == 1, 35).when(F.size(parts) == 2, 20).when(F.size(parts) >= 4, -25).otherwise(0)
    each = lambda p: (
        F.when(p.isin("pricing", "pricing-page", "pricing-plans", "plans-pricing"), 100)
        .when(p.contains("pricing"), 85)
        .when(p.isin("plans", "billing", "upgrade", "subscribe", "subscription", "subscriptions"), 55)
        .when(p.isin("enterprise", "contact-sales", "contact"), -20)
        .otherwise(0)
    )
    anchor = F.when(is_pricing_fragment(url), 75).otherwise(0)
    query = F.when(F.try_parse_url(_c(url), F.lit("QUERY")).isNotNull(), -5).otherwise(0)
    root = F.when(is_pricing_fragment(url), 75).otherwise(-50)
    return F.when(F.size(parts) == 0, root).when(is_bad_pricing_url(url), -200).otherwise(depth + _sum(parts, each) + anchor + query)


def contact_url_score(url) -> Column:
    parts = path_parts(url)
    each = lambda p: (
        F.when(p.isin("contact-sales", "book-a-demo", "book-a-demo-call", "request-demo", "schedule-demo"), 90)
        .when(p == "demo", 70).when(p.isin("enterprise", "sales"), 55).when(p.isin("contact", "contact-us"), 35).otherwise(0)
    )
    return F.when(~is_contact_url(url), -1000).otherwise(_sum(parts, each) - F.greatest(F.lit(0), F.size(parts) - 2) * 10)


def context_parts(url) -> Column:
    generic = [*PRICING_PARTS, "feature", "features", "product", "products", "en", "us", "www"]
    return F.filter(path_parts(url), lambda p: ~p.isin(generic) & (F.length(p) > 2))


def matches_context(source_url, final_url) -> Column:
    return F.size(F.array_except(context_parts(source_url), path_parts(final_url))) == 0


def pricing_text_quality(x) -> Column:
    """Prices count three, plan words one, site words minus two.  Word boundaries hold only at the ends of the lists."""
    s = F.lower(F.coalesce(_c(x), F.lit("")))
    n = lambda p: F.regexp_count(s, F.lit(p))
    plans = r"\bpricing|plans?|monthly|yearly|per month|per user|contact sales|enterprise\b"
    site = r"\bblog|privacy|terms|careers|cookie|shopping|purchase|cart\b"
    return n(r"\$\s?\d|usd\s?\d") * 3 + n(plans) - n(site) * 2


def masked(x, prefix: int = 4, suffix: int = 2) -> Column:
    s = _c(x)
    return F.when(F.length(s) > prefix + suffix, F.concat(F.substring(s, 1, prefix), F.lit("***"), F.right(s, F.lit(suffix)))).otherwise(F.lit("***"))


def sql_fingerprint(x) -> Column:
    return F.substring(F.sha2(F.trim(F.regexp_replace(_c(x), r"\s+", " ")), 256), 1, 16)


def compact_name(x) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(_c(x), F.lit(""))), "[^a-z0-9]+", "")
