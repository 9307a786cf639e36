"""Decisions of a taxonomy model: evidence, entity kinds, roots, leaves, capabilities.

A model's answer is a JSON text; lists in it may mix texts and objects, so items are read as texts and
objects among them once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.numbers import let, to_number
from tally.functions.text import clip, slug

# Kinds of entities, thresholds, list lengths and what an error page says.
ENTITY_KINDS = ["independent_product", "product_module", "feature_landing", "company_site", "app_or_extension", "regional_mirror", "duplicate_alias", "non_product", "unresolved"]
ENTITY_LEAST, LEAF_LEAST, CAPABILITY_LEAST, MOST_CAPABILITIES, MOST_ROOTS = 0.8, 0.35, 0.4, 8, 2
ERROR_PAGE = r"(?i)(?:unable\s+to\s+load\s+(?:site|page)|sorry[,\s]+you\s+have\s+been\s+blocked|invalid\s+ssl\s+certificate|error\s+code\s*52\d|access\s+denied|security\s+block\s+page|request\s+blocked|site\s+can(?:not|'t)\s+be\s+reached|temporarily\s+unavailable|origin\s+server\s+is\s+unreachable)"
ANSWER = """entity_kind string, entity_confidence string, entity_reason string, entity_evidence array<string>, l1_candidates array<string>, leaf_slug string, category_l2 string, slug string, confidence string,
    reason string, evidence array<string>, capability_slugs array<string>, capabilities array<string>"""


def answer(raw: str) -> Column:
    """A model's answer as a struct; text that isn't a JSON object gives nulls."""
    return F.from_json(raw, ANSWER)


def confidence(x, default: float) -> Column:
    """0..1, percentages from above one; `default` for what isn't a number."""
    v = to_number(x)
    v = F.when((v > 1) & (v <= 100), v / 100).otherwise(v)
    return F.coalesce(F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)), F.lit(default))


def evidence(items: Column, url: Column) -> Column:
    """Evidence with a quote (F58): source_url, node_id, quote of each item, a text or an object."""

    def read(x: Column) -> Column:
        return F.struct(x.alias("x"), F.from_json(F.when(x.startswith("{"), x), "quote string, text string, snippet string, source_url string, node_id string, selector string").alias("o"))

    def one(item: Column) -> Column:
        x, o = item["x"], item["o"]
        some = lambda *names: F.coalesce(*[F.nullif(o[n], F.lit("")) for n in names], F.lit(""))
        quote = F.when(x.startswith("{"), some("quote", "text", "snippet")).otherwise(x)
        return F.struct(clip(F.coalesce(F.nullif(some("source_url"), F.lit("")), url, F.lit("")), 500).alias("source_url"), clip(some("node_id", "selector"), 80).alias("node_id"), clip(quote, 280).alias("quote"))

    return F.filter(F.transform(F.transform(F.coalesce(items, F.array().cast("array<string>")), read), one), lambda e: e["quote"] != "")


def entity_decision(a: str, url: str) -> Column:
    """An entity's kind (F60): accepted only with enough confidence, evidence and no sign of an error page."""
    kind = F.regexp_replace(F.lower(F.trim(F.coalesce(F.col(f"{a}.entity_kind"), F.lit("")))), "-", "_")
    kind = F.when(kind.isin(ENTITY_KINDS), kind).otherwise("unresolved")
    sure, quotes = confidence(f"{a}.entity_confidence", 0.0), evidence(F.col(f"{a}.entity_evidence"), F.col(url))
    said = F.concat_ws(" ", F.coalesce(F.col(f"{a}.entity_reason"), F.lit("")), F.transform(quotes, lambda e: e["quote"]))
    wrong = said.rlike(ERROR_PAGE)
    accepted = (kind != "unresolved") & (sure >= ENTITY_LEAST) & (F.size(quotes) > 0) & ~wrong
    return F.struct(F.when(accepted, kind).otherwise("unresolved").alias("kind"), kind.alias("candidate_kind"), sure.alias("confidence"), F.slice(quotes, 1, 5).alias("evidence"), accepted.alias("accepted"), wrong.alias("error_page"))


def settled_entity(decision: str, kind: str, source: str) -> Column:
    """The kind to store: a manual one always wins, a manual `unresolved` too."""
    manual = F.lower(F.trim(F.coalesce(F.col(source), F.lit("")))) == "manual"
    old = F.lower(F.trim(F.coalesce(F.col(kind), F.lit("unresolved"))))
    return F.when(manual, F.when(old.isin(ENTITY_KINDS), old).otherwise("unresolved")).otherwise(F.col(f"{decision}.kind"))


def _named(answers: DataFrame, key: str, items: Column, names: tuple[str, ...], default: float, **more: Column) -> DataFrame:
    """Items of a list as rows: place, slug, confidence, the item itself, and more columns made of it.

    A list and an item are read once, below generators that keep the optimizer from copying the reading into all that is made of them:
    into the test for empty lists, which would make and parse an answer twice more.
    """
    rows = answers.select(key, "url", F.explode(F.array(items)).alias("_items")).select(key, "url", F.posexplode("_items").alias("place", "item"))
    thing = F.col("item").startswith("{")
    name = F.coalesce(*[F.nullif(F.get_json_object("item", f"$.{n}"), F.lit("")) for n in names])
    read = {"slug": slug(F.when(thing, name).otherwise(F.col("item"))), "_sure": F.when(thing, F.get_json_object("item", "$.confidence")), **more}
    rows = rows.withColumn("_read", F.explode(F.array(F.struct(*[c.alias(n) for n, c in read.items()]))))
    return rows.select(key, "url", "place", "item", "_read.slug", F.when(thing, confidence("_read._sure", default)).otherwise(0.5).alias("confidence"), *[f"_read.{n}" for n in more])


def _first(rows: DataFrame, key: str, order: list[Column], most: int) -> DataFrame:
    from tally.operators.evaluation import numbered

    return numbered(rows, [key], order, most)


def top_roots(answers: DataFrame, key: str, terms: DataFrame) -> DataFrame:
    """The first two different known roots of each answer (F61).  answers: key, url, answer; terms: slug,
    parent_slug (null at a root), a small dimension."""
    rows = _named(answers, key, F.col("answer.l1_candidates"), ("slug", "category_l1"), 0.55)
    known = rows.join(F.broadcast(terms.where("parent_slug IS NULL").select("slug")), "slug")
    once = known.groupBy(key, "slug").agg(F.min_by("confidence", "place").alias("confidence"), F.min("place").alias("_at"))
    return _first(once, key, [F.col("_at")], MOST_ROOTS).drop("_at")


def leaf_decision(answers: DataFrame, key: str, roots: DataFrame, terms: DataFrame) -> DataFrame:
    """The leaf of each answer, if it is a child of one of its roots, or such a root without children.

    Adds leaf, confidence and status (decide: auto_accepted, provisional, unresolved); answers without a valid leaf
    keep null and `unresolved`.
    """
    children = terms.where("parent_slug IS NOT NULL").select(F.col("parent_slug").alias("_root"), F.col("slug").alias("_leaf"))
    alone = terms.join(children, F.col("slug") == F.col("_root"), "left_anti").where("parent_slug IS NULL").select(F.col("slug").alias("_root"), F.col("slug").alias("_leaf"))
    inner = terms.where("parent_slug IS NOT NULL").select(F.col("parent_slug").alias("_inner")).distinct()
    pool = children.unionByName(alone).join(inner, F.col("_leaf") == F.col("_inner"), "left_anti")
    allowed = roots.select(key, F.col("slug").alias("_root")).join(F.broadcast(pool), "_root").select(key, "_leaf").distinct()
    said = answers.select(key, slug(F.coalesce(*[F.nullif(F.col(f"answer.{c}"), F.lit("")) for c in ("leaf_slug", "category_l2", "slug")])).alias("_said"), confidence("answer.confidence", 0.5).alias("_c"))
    j = said.join(allowed.withColumnRenamed("_leaf", "_said").withColumn("_ok", F.lit(True)), [key, "_said"], "left")
    sure = F.when(F.col("_ok"), F.col("_c"))
    return j.select(key, F.when(F.col("_ok"), F.col("_said")).alias("leaf"), sure.alias("confidence"), primary_status(sure).alias("status"))


def primary_status(sure: Column, accept: float = 0.85) -> Column:
    return F.when(sure >= max(LEAF_LEAST, min(accept, 1.0)), "auto_accepted").when(sure >= LEAF_LEAST, "provisional").otherwise("unresolved")


def capabilities(answers: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """The first eight different known capabilities that have confidence and evidence."""
    listed = F.coalesce("answer.capability_slugs", "answer.capabilities")
    quotes = evidence(F.from_json(F.get_json_object("item", "$.evidence"), "array<string>"), F.col("url"))
    rows = _named(answers, key, listed, ("slug", "capability"), 0.5, quotes=F.size(quotes))
    rows = rows.where(F.col("item").startswith("{") & (F.col("confidence") >= CAPABILITY_LEAST) & (F.col("quotes") > 0))
    valid = rows.join(F.broadcast(known.select("slug")), "slug")
    once = valid.groupBy(key, "slug").agg(F.min_by(F.struct("confidence", "quotes"), "place").alias("_b"), F.min("place").alias("_at"))
    return _first(once, key, [F.col("_at")], MOST_CAPABILITIES).select(key, "slug", "_b.confidence", F.least("_b.quotes", F.lit(5)).alias("quotes"), "place")


def merged_capabilities(decisions: DataFrame, key: str, chunk: str) -> DataFrame:
    """The strongest decision of each slug over several chunks, then the eight strongest."""
    best = decisions.groupBy(key, "slug").agg(F.max_by(F.struct("confidence", chunk), F.struct(F.col("confidence"), -F.col(chunk))).alias("_b")).select(key, "slug", "_b.*")
    return _first(best, key, [F.desc("confidence"), F.asc("slug")], MOST_CAPABILITIES)


# -- product profiles -------------------------------------------------------------------------------

PROFILE = "primary_job string, primary_outputs string, capabilities_raw string"


def evidenced(raw: Column, url: Column) -> Column:
    """A value and its evidence (F58) from an object {value|text, evidence|evidence_items}; null without both."""
    read = F.from_json(raw, "value string, text string, evidence array<string>, evidence_items array<string>")
    value = lambda o: clip(F.coalesce(F.nullif(o["value"], F.lit("")), o["text"], F.lit("")), 500)
    quotes = lambda o: F.slice(evidence(F.coalesce(o["evidence"], o["evidence_items"]), url), 1, 5)
    both = let(read, lambda o: F.struct(value(o).alias("value"), quotes(o).alias("evidence")))
    return let(both, lambda v: F.when((v["value"] != "") & (F.size(v["evidence"]) > 0), v))


def evidenced_list(raw: Column, url: Column, most: int) -> Column:
    """The first evidenced values of a JSON list; an object counts as a list of one."""
    items = F.when(raw.startswith("{"), F.array(raw)).otherwise(F.from_json(raw, "array<string>"))
    found = F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: evidenced(x, url)), lambda v: v.isNotNull())
    return F.slice(found, 1, most)


def product_profile(raw: str, url: str) -> Column:
    """A product's profile from a model's answer (F59): what it does, up to six outputs and eight capabilities, each with
    evidence; `has_signal` tells whether anything is left."""
    u = F.col(url)
    parts = lambda o: F.struct(evidenced(o["primary_job"], u).alias("primary_job"), evidenced_list(o["primary_outputs"], u, 6).alias("primary_outputs"), evidenced_list(o["capabilities_raw"], u, MOST_CAPABILITIES).alias("capabilities"))
    some = lambda items: F.coalesce(F.size(items), F.lit(0)) > 0
    signal = lambda v: v["primary_job"].isNotNull() | some(v["primary_outputs"]) | some(v["capabilities"])
    return let(let(F.from_json(raw, PROFILE), parts), lambda v: F.struct(*[v[c].alias(c) for c in ("primary_job", "primary_outputs", "capabilities")], signal(v).alias("has_signal")))


def profile_context(profile: str) -> Column:
    """A profile as compact JSON for a classifier: values with two quotes each."""
    short = lambda v: F.struct(v["value"].alias("value"), F.slice(F.transform(v["evidence"], lambda e: e["quote"]), 1, 2).alias("evidence_quotes"))
    some = lambda c: F.when(F.size(F.col(f"{profile}.{c}")) > 0, F.transform(F.col(f"{profile}.{c}"), short))
    return F.to_json(F.struct(F.when(F.col(f"{profile}.primary_job").isNotNull(), short(F.col(f"{profile}.primary_job"))).alias("primary_job"), some("primary_outputs").alias("primary_outputs"), some("capabilities").alias("capabilities_raw")))
