"""Price claims of pages (H-5, H-7, H-8): element rows in, one row per claim out.

Positive claims only: what a region doesn't say is no claim.  Rules are columns over element rows;
the least element that supports a claim is an aggregation; only prices with their
surroundings come from a Python task, as they need match offsets.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions import documents as H
from tally.functions import numbers as N

# Wording of claims, units and their families, currencies.
FREE_PLAN = r"(?i)\b(?:free\s+(?:plan|tier|forever)|(?:plan|tier)\s+(?:is\s+)?free|free\s*[$€£¥₹]?\s*0)\b|(?<!\w)[$€£¥₹]?\s*0\s*(?:/|per\s+)(?:month|mo|year|yr)\b"
CUSTOM_QUOTE = r"(?i)\b(?:contact\s+(?:us|sales)|talk\s+to\s+sales|custom\s+(?:pricing|quote)|request\s+(?:a\s+)?quote)\b"
FREE_TRIAL = r"(?i)\b(?:(\d+)\s*[- ]?(day|week|month)s?\s+)?free\s+trial\b"
CARD = r"(?i)\b(?:credit|payment)\s+card\s+required\b"
NO_CARD = r"(?i)\bno\s+(?:credit|payment)\s+card\s+required\b|\bwithout\s+(?:a\s+)?(?:credit|payment)\s+card\b"
ALLOWANCE = r"(?i)(\d[\d,]*(?:\.\d+)?\s*(?:k|m|thousand|million)?)\s*(requests?|calls?|queries|tokens?|credits?|points?|minutes?|seconds?|hours?|images?|videos?|generations?|characters?|words?|seats?|users?|members?|gb|gigabytes?)\s*(?:(?:per|/)\s*(month|mo|year|yr|day))?\s*(?:free|included|at no cost)\b"
PRICE = re.compile(r"(?=[\dUEGCAJI$€£¥₹])(?:(?P<c1>USD|EUR|GBP|CAD|AUD|JPY|CNY|INR)\s*(?P<s1>US\$|CA\$|AU\$|[$€£¥₹])?\s*(?P<a1>\d[\d,]*(?:\.\d{1,4})?)|(?P<s2>US\$|CA\$|AU\$|[$€£¥₹])\s*(?P<a2>\d[\d,]*(?:\.\d{1,4})?)|(?P<a3>\d[\d,]*(?:\.\d{1,4})?)\s*(?P<c3>USD|EUR|GBP|CAD|AUD|JPY|CNY|INR)\b)", re.I)
PER_UNIT = r"(?i)(?:/|\bper\s+)(request|call|query|queries|token|seat|user|member|credit|point|minute|second|hour|image|video|generation|character|word|gb|gigabyte)s?\b"
RELATION = r"(?i)(?:/\s*(?:month|mo|year|yr)\b|\bper\s+(?:month|mo|year|yr)\b|\b(?:monthly|yearly|one[- ]time|lifetime)\b|\b(?:starts?|starting)\s+(?:from|at)\b|\b(?:price(?:d|s)?|costs?)\b|\bplans?\s+from\b)"
PERIOD = r"(?i)(?:/\s*|\bper\s+)?\b(month|mo|year|yr|monthly|yearly)\b"
SUBSCRIPTION = r"(?i)/\s*(?:month|mo|year|yr)\b|\bper\s+(?:month|year)\b|\b(?:monthly|yearly)\b"
ONE_TIME = r"(?i)\b(?:one[- ]time|lifetime)\b"
SEATS = ["seat", "user", "member"]
SYMBOLS = {"US$": "USD", "CA$": "CAD", "AU$": "AUD", "€": "EUR", "£": "GBP", "₹": "INR"}
PERIODS = {"mo": "month", "month": "month", "monthly": "month", "yr": "year", "year": "year", "yearly": "year", "day": "day", "week": "week"}
FAMILIES = {
    "operation": ["request", "call", "query"], "text": ["token", "character", "word"], "seat": ["seat", "user", "member"], "time": ["minute", "second", "hour"],
    "generation": ["image", "video", "generation"], "credit": ["credit", "point"], "storage": ["gigabyte"],
}


TRIAL_ONLY = r"(?i)\bfree\s+trial\b"
#: What an element can support, by words of which one must be there, and a pattern; an element that offers a trial offers no free plan.
TESTS = {
    "has_free_plan": (("free", "0"), FREE_PLAN), "has_free_trial": (("trial",), FREE_TRIAL), "no_card": (("card",), NO_CARD), "card": (("card",), CARD),
    "has_custom_quote": (("contact", "talk", "custom", "request"), CUSTOM_QUOTE), "free_allowance": (("free", "included", "at no cost"), ALLOWANCE),
}


def unit_name(x) -> Column:
    s = F.lower(F.trim(x))
    s = F.when(s == "queries", "query").when(s.isin("gb", "gigabytes"), "gigabyte").otherwise(F.regexp_replace(s, "s$", ""))
    return F.when(s.isin([u for v in FAMILIES.values() for u in v]), s)


def unit_family(x) -> Column:
    out = F.lit(None).cast("string")
    for family, units in FAMILIES.items():
        out = F.when(x.isin(units), family).otherwise(out)
    return out


def period_name(x) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(y) for kv in PERIODS.items() for y in kv]), F.lower(x))


def region_nodes(nodes: DataFrame, regions: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Elements with text inside each page's region."""
    r = regions.select(F.col(id_col).alias("_p"), F.col("root").alias("_root"), F.col("end").alias("_end"))
    return nodes.join(r, (F.col(id_col) == F.col("_p")) & F.col("node").between(F.col("_root"), F.col("_end"))).where("text <> ''").select(id_col, "node", "text")


def prices(nodes: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Prices of elements with 20 characters before and 50 after."""
    kind = nodes.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, node, text in zip(batch["_id"], batch["node"], batch["text"], strict=True):
                for m in PRICE.finditer(text):
                    near = text[max(0, m.start() - 20) : m.end() + 50]
                    rows.append((key, node, len(text), (m["a1"] or m["a2"] or m["a3"]).replace(",", ""), (m["c1"] or m["c3"] or "").upper(), m["s1"] or m["s2"] or "", " ".join(m[0].split()), near))
            yield pd.DataFrame(rows, columns=["_id", "node", "size", "raw", "code", "symbol", "price_text", "near"])

    found = nodes.select(F.col(id_col).alias("_id"), "node", "text").mapInPandas(run, f"_id {kind}, node int, size int, raw string, code string, symbol string, price_text string, near string")
    # Below a generator, which keeps the optimizer from copying the search for a unit into all that is made of it.
    said = F.struct(F.col("raw").try_cast("decimal(18,4)").alias("amount"), F.lower(F.nullif(F.regexp_extract("near", PER_UNIT, 1), F.lit(""))).alias("unit"))
    found = found.withColumnRenamed("_id", id_col).withColumn("_said", F.explode(F.array(said)))
    found = found.withColumns({"amount": F.col("_said.amount"), "unit": unit_name(F.col("_said.unit"))}).drop("_said").where("amount > 0")
    kinds = F.when(F.col("unit").isin(SEATS), "seat").when(F.col("unit").isNotNull(), "metered")
    return found.withColumn("kind", kinds).where(F.col("kind").isNotNull() | F.col("near").rlike(RELATION))


def currency_of(code, symbol) -> tuple[Column, Column]:
    """The currency, and why there is none: codes must agree with symbols, bare $ and ¥ are ambiguous."""
    known = F.try_element_at(F.create_map(*[F.lit(x) for kv in SYMBOLS.items() for x in kv]), symbol)
    clash = (code != "") & known.isNotNull() & (known != code)
    value = F.when(clash, None).when(code != "", code).otherwise(known)
    why = F.when(clash, "currency_code_symbol_conflict").when(value.isNotNull(), None).when(symbol.isin("$", "¥"), "ambiguous_currency_symbol").otherwise("missing_currency")
    return value, why


LOWER_TESTS = {name: re.compile(H.lower_classes(pattern)) for name, (_, pattern) in TESTS.items()}
LOWER_TRIAL = re.compile(H.lower_classes(TRIAL_ONLY))
#: For ASCII texts in upper case: half the time.
PRICE_UPPER = re.compile(PRICE.pattern, re.A)
SEEN = T.StructType([T.StructField(c, T.IntegerType() if c in ("node", "size", "at") else T.StringType()) for c in ("node", "size", "at", "raw", "code", "symbol", "near")])
FOUND = T.StructType([*(T.StructField(name, T.IntegerType()) for name in TESTS), T.StructField("prices", T.ArrayType(SEEN))])


class Found:
    """Where a pattern matches in a text and in any range of it that ends at blanks, from one search of the whole text."""

    def __init__(self, pattern: re.Pattern, text: str):
        self.pattern, self.text, self.matches = pattern, text, list(pattern.finditer(text))
        self.starts, self.ends = [m.start() for m in self.matches], [m.end() for m in self.matches]

    def within(self, start: int, end: int) -> list[tuple[int, re.Match]]:
        """The matches that a search of the range alone finds, each with what its places are counted from."""
        if not self.matches:
            return []
        i, j = bisect_left(self.starts, start), bisect_right(self.ends, end)
        if (i and self.ends[i - 1] > start) or (j < len(self.starts) and self.starts[j] < end):
            return [(start, m) for m in self.pattern.finditer(self.text[start:end])]
        return [(0, m) for m in self.matches[i:j]]


def _supported(text: str, elements: list[tuple[int, int, int]]) -> tuple[list[int | None], list[tuple]]:
    """The shortest, then first, of a page's elements (node, begin, length) that passes each test, and the prices of all."""
    low = H.ascii_lower(text)
    by_size = sorted(elements, key=lambda e: (e[2], e[0]))
    chosen: list[int | None] = []
    for name, (words, _) in TESTS.items():
        found = Found(LOWER_TESTS[name], low) if any(w in low for w in words) else None
        trial = Found(LOWER_TRIAL, low) if name == "has_free_plan" and found and found.matches and "trial" in low else None
        passes = lambda b, e: found.within(b, e) and not (trial and trial.within(b, e))  # noqa: B023, E731
        chosen.append(next((node for node, b, n in by_size if passes(b, b + n)), None) if found and found.matches else None)
    found, rows = Found(PRICE_UPPER, text.upper()) if text.isascii() else Found(PRICE, text), {}
    # Of prices that are the same with all that is near them only that of the shortest, then first, element can be chosen for a claim; of an
    # element's equal ones the first is.
    for node, begin, size in by_size if found.matches else ():
        end = begin + size
        for base, m in found.within(begin, end):
            a1, a2, a3, c1, c3, s1, s2 = (text[base + m.start(g) : base + m.end(g)] if m.start(g) >= 0 else "" for g in ("a1", "a2", "a3", "c1", "c3", "s1", "s2"))
            near = text[max(begin, base + m.start() - 20) : min(end, base + m.end() + 50)]
            rows.setdefault(((a1 or a2 or a3).replace(",", ""), (c1 or c3).upper(), s1 or s2, near), (node, size, base + m.start()))
    return chosen, [(*place, *said) for said, place in rows.items()]


@F.arrow_udf(FOUND)
def supported(texts: pa.Array, elements: pa.Array) -> pa.Array:
    """What the elements (node, begin, length) of each page support."""
    node, begin, length = (elements.values.field(i).to_pylist() for i in range(3))
    ends, chosen, rows, sizes = elements.offsets.to_pylist(), [], [], [0]
    for i, text in enumerate(texts.to_pylist()):
        at = slice(ends[i], ends[i + 1])
        least, found = _supported(text, list(zip(node[at], begin[at], length[at], strict=True)))
        chosen.append(least)
        rows += found
        sizes.append(len(rows))
    cells = list(zip(*rows, strict=True)) if rows else [()] * len(SEEN)
    names = SEEN.names
    prices = pa.StructArray.from_arrays([pa.array(c, pa.int32() if n in ("node", "size", "at") else pa.string()) for n, c in zip(names, cells, strict=True)], names)
    columns = [pa.array(c, pa.int32()) for c in zip(*chosen, strict=True)] if chosen else [pa.array([], pa.int32())] * len(TESTS)
    return pa.StructArray.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), prices)], [*TESTS, "prices"])


def tree_claims(regions: DataFrame, id_col: str = "page_id") -> DataFrame:
    """What `claims` and `with_evidence` tell of pages, from rows of tree_regions: each page by itself, nothing is shuffled."""
    places = F.transform(H.tree_elements(), lambda n: F.struct(n["node"].alias("node"), n["begin"].alias("begin"), n["length"].alias("length")))
    rows = regions.withColumn("_e", F.explode(F.array(places))).withColumn("_f", supported("text", "_e"))
    element = lambda node: F.get("nodes", node)
    cells = lambda name: F.struct(F.col(f"_f.{name}").alias("node"), *[H.text_in(element(F.col(f"_f.{name}"))).alias("text")] * (name in READ))
    rows = rows.withColumns({name: F.when(F.col(f"_f.{name}").isNotNull(), cells(name)) for name in TESTS})
    # unit_name of an empty text is null.
    unit = lambda p: F.regexp_extract(p["near"], PER_UNIT, 1)
    priced = lambda p: N.let(unit(p), lambda u: F.struct(p["raw"].try_cast("decimal(18,4)").alias("amount"), *[p[c].alias(c) for c in ("size", "node", "at", "code", "symbol", "near")], F.when(u != "", unit_name(u)).alias("unit")))
    kind = lambda p: F.when(p["unit"].isin(SEATS), "seat").when(p["unit"].isNotNull(), "metered")
    fit = lambda p: (p["amount"] > 0) & (p["unit"].isNotNull() | p["near"].rlike(RELATION))
    # Below a generator, as in `prices`.
    rows = rows.withColumn("_p", F.explode(F.array(F.filter(F.transform("_f.prices", priced), fit))))
    metered = lambda p: F.coalesce(kind(p) == "metered", F.lit(False))
    least = lambda keep, *order: F.array_min(F.transform(F.filter("_p", keep), lambda p: F.struct(*[p[c].alias(c) for c in order], *[p[c].alias(c) for c in ("at", "code", "symbol", "near", "unit")], kind(p).alias("kind"))))
    best = rows.withColumns({
        "paid": least(lambda p: F.lit(True), "amount", "size", "node"), "start": least(lambda p: ~metered(p), "amount", "size", "node"), "usage": least(metered, "size", "amount", "node"),
        "subscription": F.exists("_p", lambda p: p["near"].rlike(SUBSCRIPTION)), "one_time": F.exists("_p", lambda p: p["near"].rlike(ONE_TIME)),
    })
    found = _claimed(_told(_read(best)), [id_col, "text", "nodes", "root"])
    n = element(F.col("node"))
    place = F.struct(F.substring(H.text_in(n), 1, 1500).alias("quote"), n["table_row"].alias("table_row"), n["table_column"].alias("table_column"), _selector(n["attributes"], n["tag"]).alias("selector"))
    said = found.withColumn("_at", F.explode(F.array(place)))
    out = said.select(id_col, "claim_type", "value", "node", "status", "error", F.col("root").alias("container"), "_at.quote", "_at.table_row", "_at.table_column", "_at.selector")
    return out.withColumn("evidence_hash", _evidence_hash())


def claims(nodes: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(page, claim_type, value, node, status, error): values are JSON or plain text.

    nodes: region_nodes.  Of the elements that support a claim the shortest counts, then the first.
    """
    text, low = F.col("text"), F.lower("text")
    # A word that the pattern can't do without is looked for first.
    tests = {name: reduce(lambda a, b: a | b, [low.contains(w) for w in words]) & text.rlike(pattern) for name, (words, pattern) in TESTS.items()}
    tests["has_free_plan"] &= ~(low.contains("trial") & text.rlike(TRIAL_ONLY))
    # Each element is tested once, below a generator; what supports nothing isn't shuffled.
    tested = nodes.select(id_col, "node", "text", F.explode(F.array(F.struct(F.length("text").alias("n"), *[t.alias(name) for name, t in tests.items()]))).alias("_t"))
    tested = tested.where(reduce(lambda a, b: a | b, [F.col(f"_t.{name}") for name in tests]))
    least = lambda name: F.min_by(F.struct("node", *["text"] * (name in READ)), F.when(F.col(f"_t.{name}"), F.struct("_t.n", "node")))
    # Groups of the patterns are read here, below the join with prices, so that none is read again wherever it is used.
    found = _read(tested.groupBy(id_col).agg(*[least(name).alias(name) for name in tests]))

    p = prices(nodes, id_col)
    row = F.struct("node", "amount", "code", "symbol", "near", "kind", "unit")
    cheap, short = F.struct("amount", "size", "node"), F.struct("size", "amount", "node")
    flat, metered = F.coalesce(F.col("kind"), F.lit("")) != "metered", F.coalesce(F.col("kind"), F.lit("")) == "metered"
    best = p.groupBy(id_col).agg(
        F.min_by(F.struct("node"), cheap).alias("paid"), F.min_by(row, F.when(flat, cheap)).alias("start"), F.min_by(row, F.when(metered, short)).alias("usage"),
        F.max(F.col("near").rlike(SUBSCRIPTION)).alias("subscription"), F.max(F.col("near").rlike(ONE_TIME)).alias("one_time"),
    )
    return _claimed(found.join(_told(best), id_col, "full"), [id_col])


#: Claims whose values are read from the text.
READ = ("has_free_trial", "free_allowance")


def _read(found: DataFrame) -> DataFrame:
    """Adds the groups of the patterns in the texts of READ."""
    part = lambda c, p, i: F.nullif(F.regexp_extract(F.col(c)["text"], p, i), F.lit(""))
    return found.withColumns({f"_trial{i}": part("has_free_trial", FREE_TRIAL, i) for i in (1, 2)} | {f"_free{i}": part("free_allowance", ALLOWANCE, i) for i in (1, 2, 3)})


def _told(best: DataFrame) -> DataFrame:
    """Replaces the chosen prices, start and usage, by what is told of them."""

    def told(c: str, *more: Column) -> Column:
        """A chosen price, with its currency and its JSON: made once a page, not once a price."""
        value, why = currency_of(F.col(c)["code"], F.col(c)["symbol"])
        minor = F.col(c)["amount"] * F.when(value == "JPY", 1).otherwise(100)
        exact = value.isNotNull() & (minor == F.floor(minor))
        price = [N.decimal_string(F.col(c)["amount"]).alias("amount"), value.alias("currency"), F.when(exact, minor.cast("long")).alias("amount_minor"), F.when(exact, F.when(value == "JPY", 0).otherwise(2)).alias("currency_exponent")]
        kept = [F.col(c)[k].alias(k) for k in ("node", "kind", "unit")]
        period = period_name(F.nullif(F.regexp_extract(F.col(c)["near"], PERIOD, 1), F.lit("")))
        return F.when(F.col(c).isNotNull(), F.struct(*kept, F.to_json(F.struct(*price, *more)).alias("json"), why.alias("why"), period.alias("period"))).alias(c)

    rate_unit = F.col("usage")["unit"]
    return best.withColumns({"start": told("start"), "usage": told("usage", rate_unit.alias("unit"), unit_family(rate_unit).alias("unit_family"))})


def _claimed(every: DataFrame, keep: list[str]) -> DataFrame:
    """One row per claim from a page's chosen elements and prices."""
    no_error = F.lit(None).cast("string")

    made: list[Column] = []

    def claim(name: str, of: Column, value: Column, status="not_applicable", error: Column = no_error, when: Column | None = None) -> None:
        status = F.lit(status) if isinstance(status, str) else status
        cells = F.struct(F.lit(name).alias("claim_type"), value.cast("string").alias("value"), of["node"].alias("node"), status.alias("status"), error.alias("error"))
        made.append(F.when(of.isNotNull() if when is None else when, cells))

    yes = F.lit("true")
    trial, allow = F.col("has_free_trial"), F.col("free_allowance")
    unit = unit_name(F.col("_free2"))
    amount = N.decimal_string(N.quantity("_free1"))
    claim("has_free_plan", F.col("has_free_plan"), yes)
    claim("has_free_trial", trial, F.to_json(F.struct(F.lit(True).alias("available"), F.col("_trial1").alias("duration"), F.lower(F.col("_trial2")).alias("duration_unit"))), "normalized")
    card = F.coalesce(F.col("no_card"), F.col("card"))
    claim("card_required", card, F.when(F.col("no_card").isNotNull(), "false").otherwise("true"))
    claim("has_custom_quote", F.col("has_custom_quote"), yes)
    claim("free_allowance", allow, F.to_json(F.struct(amount.alias("quantity"), unit.alias("unit"), unit_family(unit).alias("unit_family"), period_name(F.col("_free3")).alias("period"))), "normalized")

    state = lambda c: F.when(F.col(c)["why"].isNull(), "normalized").otherwise("failed")
    claim("has_paid_pricing", F.col("paid"), yes, F.lit("not_applicable"))
    claim("starting_paid_price", F.col("start"), F.col("start")["json"], state("start"), F.col("start")["why"])
    claim("starting_price_period", F.col("start"), F.col("start")["period"], F.lit("normalized"), when=F.col("start")["period"].isNotNull())
    claim("has_usage_pricing", F.col("usage"), yes, F.lit("not_applicable"))
    claim("usage_rate", F.col("usage"), F.col("usage")["json"], state("usage"), F.col("usage")["why"])

    is_ = lambda c, name: F.when(F.coalesce(c, F.lit(False)), name)
    quote, metered_model = F.col("has_custom_quote"), F.col("usage").isNotNull()
    kinds = F.array(is_(F.col("subscription"), "recurring"), is_(metered_model, "metered"), is_(F.col("one_time"), "one_time"), is_(quote.isNotNull(), "custom_quote"))
    hybrid = F.size(F.filter(kinds, lambda x: x.isNotNull())) > 1
    models = F.array(
        is_(F.col("usage")["unit"].isin("credit", "point"), "credit_based"), is_(quote.isNotNull(), "custom_quote"), is_(hybrid, "hybrid"), is_(F.col("one_time"), "one_time"),
        is_(F.col("start")["kind"] == "seat", "per_seat"), is_(F.col("subscription"), "subscription"), is_(metered_model, "usage_based"),
    )
    models = F.filter(models, lambda x: x.isNotNull())
    source = F.struct(F.coalesce(quote["node"], F.col("paid")["node"]).alias("node"))
    claim("pricing_models", source, F.to_json(models), "normalized", when=F.size(models) > 0)
    return every.select(*keep, F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("c")).select(*keep, "c.*")


def _selector(attributes: Column, tag: Column) -> Column:
    classes = F.filter(F.split(F.coalesce(F.try_element_at(attributes, F.lit("class")), F.lit("")), r"\s+"), lambda c: c != "")
    ident = F.nullif(F.try_element_at(attributes, F.lit("id")), F.lit(""))
    hint = F.concat(tag, F.when(ident.isNotNull(), F.concat(F.lit("#"), ident)).otherwise(F.array_join(F.transform(F.slice(classes, 1, 2), lambda c: F.concat(F.lit("."), c)), "")))
    return F.substring(hint, 1, 500)


def _evidence_hash() -> Column:
    return F.sha2(F.to_json(F.struct(F.concat(F.lit("n"), F.lpad((F.col("node") + 1).cast("string"), 6, "0")).alias("node_id"), "quote")), 256)


def with_evidence(found: DataFrame, nodes: DataFrame, regions: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Adds what a claim rests on: the region's root, the element's text (1,500 characters at most), place in a table, a selector, and the
    hash of element and quote.

    found: claims; nodes: dom_nodes.  Only elements that a claim names are joined.
    """
    named = found.join(regions.select(F.col(id_col).alias("_p"), F.col("root").alias("container")), F.col(id_col) == F.col("_p")).drop("_p")
    at = nodes.select(F.col(id_col).alias("_p"), F.col("node").alias("_n"), F.substring("text", 1, 1500).alias("quote"), "table_row", "table_column", _selector(F.col("attributes"), F.col("tag")).alias("selector"))
    both = named.join(at, (F.col(id_col) == F.col("_p")) & (F.col("node") == F.col("_n"))).drop("_p", "_n")
    return both.withColumn("evidence_hash", _evidence_hash())
