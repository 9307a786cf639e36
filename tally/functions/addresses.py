"""Addresses in pages: attributes of tags, references resolved against a base, icons."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import _c

#: The largest icon that is kept.
ICON_BYTES = 1024 * 1024


def attribute(tag, name: str) -> Column:
    """An attribute's value in the text of a tag, quoted or bare; empty if it isn't there."""
    said = F.regexp_extract(_c(tag), rf"""(?i){re.escape(name)}\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", 1)
    return F.trim(F.regexp_replace(F.trim(said), """^["']+|["']+$""", ""))


def _without_dots(path: Column) -> Column:
    """A path with its . and .. steps taken."""
    steps = F.slice(F.split(path, "/"), 2, 10_000)
    last = F.element_at(steps, -1)
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda a, s: F.when(s == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).when(s == ".", a).otherwise(F.array_append(a, s)))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(last.isin(".", "..") & (F.size(kept) > 0), "/").otherwise(""))


def resolved_address(base, href) -> Column:
    """A reference as an absolute address, for http and https bases: another scheme as it is, //host, /path, ?query, #fragment, or a path
    beside the base's, dots taken; an empty one is the base.  Null if either is null."""
    b, h = _c(base), _c(href)
    scheme, host = F.regexp_extract(b, "^([A-Za-z][A-Za-z0-9+.-]*):", 1), F.regexp_extract(b, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    origin = F.concat(scheme, F.lit("://"), host)
    rest = F.regexp_replace(b, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    path = F.regexp_replace(rest, r"[?#][\s\S]*$", "")
    tail = F.regexp_extract(h, r"^[^?#]*([\s\S]*)$", 1)
    own = F.regexp_extract(h, "^([^?#]*)", 1)
    beside = F.concat(F.when(path == "", "/").otherwise(F.regexp_replace(path, "[^/]*$", "")), own)
    return (
        F.when(b.isNull() | h.isNull(), None).when(h == "", b).when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h).when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("#"), F.concat(origin, F.regexp_replace(rest, "#.*$", ""), h)).when(h.startswith("?"), F.concat(origin, path, h))
        .otherwise(F.concat(origin, _without_dots(F.when(h.startswith("/"), own).otherwise(beside)), tail))
    )


def icon_address(html, url) -> Column:
    """Where a page's icon lies: its first touch icon, else its first icon; null if it names none."""
    links = F.regexp_extract_all(F.coalesce(_c(html), F.lit("")), F.lit(r"(?i)<link\b[^>]*>"), F.lit(0))
    named = F.transform(links, lambda t: F.struct(F.lower(attribute(t, "rel")).alias("rel"), attribute(t, "href").alias("href")))
    icons = F.filter(named, lambda x: (x["href"] != "") & (x["rel"].contains("icon")))
    touch = F.filter(icons, lambda x: x["rel"].contains("apple-touch-icon"))
    return resolved_address(url, F.coalesce(F.get(touch, F.lit(0))["href"], F.get(icons, F.lit(0))["href"]))


def icon_or_usual(html, url) -> Column:
    return F.coalesce(icon_address(html, url), resolved_address(url, F.lit("/favicon.ico")))


def keeps_icon(code, declared, body) -> Column:
    """Whether a fetched icon is kept: a good answer whose declared and real sizes are within ICON_BYTES, and that isn't empty."""
    size = F.octet_length(_c(body))
    declared = F.coalesce(_c(declared).cast("string").try_cast("bigint"), F.lit(0))
    return F.coalesce(_c(code).between(200, 299) & (declared <= ICON_BYTES) & (size > 0) & (size <= ICON_BYTES), F.lit(False))
