"""Queries of taxonomy decisions and their evaluation.

Labelled documents stand in for gold rows; a model's answers are built from orders and lines, as the JSON
texts that the operators read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.operators import evaluation as E
from tally.operators import taxonomy as X
from tally.plans.catalog import query
from tally.sources.tables import table

# -- evaluation -------------------------------------------------------------------------------------

_KIND = "CASE WHEN n_chars < 600 THEN 'short' WHEN n_chars < 1500 THEN 'middle' ELSE 'long' END"
_GOLD = f"""gold AS (SELECT l.doc_id AS tool_id, CASE WHEN quality = 1 THEN {_KIND} ELSE 'junk' END AS gold, CASE WHEN l.doc_id % 5 = 0 THEN ['middle', 'long'] ELSE [] END AS alternates, CASE WHEN l.doc_id % 3 = 0 THEN ['short', 'long'] ELSE [] END AS must_not,
        CASE l.doc_id % 3 WHEN 0 THEN ['a', 'b'] WHEN 1 THEN ['c'] ELSE [] END AS caps_ok, l.doc_id % 2 = 0 AS is_draft FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
    pred AS (SELECT doc_id AS tool_id, CASE WHEN doc_id % 11 = 0 THEN '' ELSE {_KIND} END AS pred, (doc_id % 100) / 100.0 AS confidence, (['provisional', 'auto_accepted', 'unresolved', 'provisional'])[doc_id % 4 + 1] AS dec,
        CASE WHEN doc_id % 2 = 0 THEN ['a', 'c'] ELSE ['b'] END AS caps FROM documents WHERE doc_id % 13 <> 0),
    old AS (SELECT doc_id AS tool_id, CASE WHEN doc_id % 6 = 0 THEN '' ELSE 'long' END AS primary_slug, CASE WHEN doc_id % 6 = 0 THEN '' WHEN doc_id % 3 = 0 THEN 'short' ELSE 'long' END AS leaf FROM documents WHERE doc_id % 7 <> 0),
    j AS (SELECT g.*, p.pred, p.confidence, p.dec, coalesce(p.caps, []) AS caps, coalesce(nullif(o.leaf, ''), nullif(o.primary_slug, '')) AS old, o.leaf, o.primary_slug FROM gold g LEFT JOIN pred p USING (tool_id) LEFT JOIN old o USING (tool_id)),
    k AS (SELECT *, coalesce(pred, '') <> '' AS present, coalesce(pred, '') <> '' AND (pred = gold OR list_contains(alternates, pred)) AS hit, coalesce(old = gold OR list_contains(alternates, old), FALSE) AS old_hit,
        coalesce(pred, '') <> '' AND (dec = 'auto_accepted' OR dec = 'provisional' AND confidence >= 0.85) AS aa FROM j)"""


def _judged(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") < 600, "short").when(F.col("n_chars") < 1500, "middle").otherwise("long").alias("kind"))
    k = lambda n: F.col("doc_id") % n
    none, some = F.array().cast("array<string>"), lambda *x: F.array(*map(F.lit, x))
    g = table(spark, d, "labels").join(docs, "doc_id")
    gold = g.select(F.col("doc_id").alias("tool_id"), F.when(F.col("quality") == 1, F.col("kind")).otherwise("junk").alias("gold"), F.when(k(5) == 0, some("middle", "long")).otherwise(none).alias("alternates"), F.when(k(3) == 0, some("short", "long")).otherwise(none).alias("must_not"),
        F.when(k(3) == 0, some("a", "b")).when(k(3) == 1, some("c")).otherwise(none).alias("capabilities_ok"), (k(2) == 0).alias("is_draft"))
    pred = docs.where(k(13) != 0).select(F.col("doc_id").alias("tool_id"), F.when(k(11) == 0, "").otherwise(F.col("kind")).alias("pred"), (k(100) / 100).alias("confidence"), F.get(some("provisional", "auto_accepted", "unresolved", "provisional"), k(4).cast("int")).alias("decision_status"), F.when(k(2) == 0, some("a", "c")).otherwise(some("b")).alias("capabilities"))
    old = docs.where(k(7) != 0).select(F.col("doc_id").alias("tool_id"), F.when(k(6) == 0, "").otherwise("long").alias("primary_slug"), F.when(k(6) == 0, "").when(k(3) == 0, "short").otherwise("long").alias("leaf"))
    return E.judged(gold, pred, old)


_RATE = "CASE WHEN {b} > 0 THEN round({a} / CAST({b} AS DOUBLE), 4) END AS {n}"


def _rates(*rows: tuple[str, str, str]) -> str:
    return ", ".join(_RATE.format(a=a, b=b, n=n) for n, a, b in rows)


_CLASSES = """c AS (SELECT gold AS label, count(*) AS support, count(*) FILTER (WHERE hit) AS tp, count(*) FILTER (WHERE present AND NOT hit) AS fn FROM k GROUP BY 1), w AS (SELECT pred AS label, count(*) AS fp FROM k WHERE present AND NOT hit GROUP BY 1),
    x AS (SELECT c.*, coalesce(w.fp, 0) AS fp FROM c LEFT JOIN w USING (label)), y AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END AS r FROM x)"""


@query(f"""WITH {_GOLD}, {_CLASSES},
    m AS (SELECT count(*) AS gold_n, count(*) FILTER (WHERE is_draft) AS gold_draft_n, count(*) FILTER (WHERE present) AS present, count(*) FILTER (WHERE hit) AS hits, count(*) FILTER (WHERE aa) AS auto_accepted_n, count(*) FILTER (WHERE aa AND hit) AS auto_hits,
        count(*) FILTER (WHERE present AND dec = 'unresolved') AS unresolved, count(*) FILTER (WHERE present AND dec = 'provisional') AS provisional, count(*) FILTER (WHERE present AND list_contains(must_not, pred)) AS must_not,
        CAST(sum(CASE WHEN len(caps_ok) > 0 THEN len(list_filter(caps, lambda x: list_contains(caps_ok, x))) ELSE 0 END) AS BIGINT) AS ctp, CAST(sum(CASE WHEN len(caps_ok) > 0 THEN len(list_filter(caps, lambda x: NOT list_contains(caps_ok, x))) ELSE 0 END) AS BIGINT) AS cfp,
        CAST(sum(CASE WHEN len(caps_ok) > 0 THEN len(list_filter(caps_ok, lambda x: NOT list_contains(caps, x))) ELSE 0 END) AS BIGINT) AS cfn, count(*) FILTER (WHERE old_hit) AS legacy_match_gold,
        count(*) FILTER (WHERE present AND old IS NOT NULL AND (pred = leaf OR pred = primary_slug)) AS same, count(*) FILTER (WHERE present AND old IS NOT NULL AND NOT (pred = leaf OR pred = primary_slug)) AS different, count(*) FILTER (WHERE hit AND NOT old_hit) AS better, count(*) FILTER (WHERE old_hit AND NOT hit AND present) AS worse FROM k),
    a AS (SELECT avg(p) AS mp, avg(r) AS mr FROM y)
    SELECT gold_n, gold_draft_n, present, gold_n - present AS missing, {_rates(("accuracy", "hits", "present"), ("accuracy_incl_missing", "hits", "gold_n"))}, round(mp, 4) AS macro_precision, round(mr, 4) AS macro_recall, round(CASE WHEN mp + mr > 0 THEN 2 * mp * mr / (mp + mr) ELSE 0 END, 4) AS macro_f1,
        auto_accepted_n, {_rates(("auto_accepted_precision", "auto_hits", "auto_accepted_n"), ("unresolved_rate", "unresolved", "gold_n"), ("provisional_rate", "provisional", "gold_n"), ("missing_rate", "(gold_n - present)", "gold_n"), ("must_not_rate", "must_not", "present"), ("manual_review_rate", "((gold_n - present) + unresolved + (present - auto_accepted_n))", "gold_n"), ("capability_precision", "ctp", "(ctp + cfp)"), ("capability_recall", "ctp", "(ctp + cfn)"))},
        round(2.0 * ctp / nullif(2 * ctp + cfp + cfn, 0), 4) AS capability_f1, legacy_match_gold, same, different, better, worse FROM m, a""")
def eval_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Accuracy, macro and micro figures, rates and the comparison with the old categories."""
    return E.metrics(_judged(spark, d))


@query(f"""WITH {_GOLD}, {_CLASSES} SELECT label, support, tp, fp, fn, round(p, 4) AS precision, round(r, 4) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 4) AS f1 FROM y""")
def eval_classes(spark: SparkSession, d: str) -> DataFrame:
    """The report's table of classes by support."""
    return E.class_table(_judged(spark, d))


@query(f"""WITH {_GOLD} SELECT gold, pred, count(*) AS n FROM k WHERE present AND NOT hit AND gold <> pred GROUP BY 1, 2 ORDER BY n DESC, gold, pred LIMIT 50""")
def eval_mismatches(spark: SparkSession, d: str) -> DataFrame:
    """The fifty most frequent confusions."""
    return E.mismatches(_judged(spark, d))


@query(f"""WITH {_GOLD} SELECT tool_id, hit AS match, aa AS auto_accepted, coalesce(present AND list_contains(must_not, pred), FALSE) AS must_not_hit, old_hit AS legacy_match, CASE WHEN present AND old IS NOT NULL THEN CASE WHEN pred = leaf OR pred = primary_slug THEN 'same' ELSE 'different' END END AS versus FROM k""")
def eval_rows(spark: SparkSession, d: str) -> DataFrame:
    """Every gold row with what was decided about it."""
    return _judged(spark, d).select("tool_id", "match", "auto_accepted", "must_not_hit", "legacy_match", "versus")


_RUN = """r AS (SELECT o_custkey AS tool_id, o_orderkey AS run_id, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '' ELSE lower(replace(o_orderpriority, ' ', '-')) END AS slug, o_orderkey % 101 / 100.0 AS confidence, o_orderkey % 4 AS caps FROM orders WHERE o_orderstatus = 'F'),
    l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY tool_id ORDER BY run_id DESC) = 1)"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs with the model's raw text: an object, an empty leaf, or no JSON at all."""
    k, name = F.col("o_orderkey"), F.initcap("o_orderpriority")
    caps = F.transform(F.expr("IF(o_orderkey % 4 = 0, CAST(array() AS ARRAY<BIGINT>), sequence(1L, o_orderkey % 4))"), lambda i: F.struct(F.concat(F.lit("Cap "), i.cast("string")).alias("slug"), F.lit(0.5).alias("confidence")))
    body = F.to_json(F.struct(F.struct(F.when(k % 7 == 0, "").otherwise(name).alias("slug"), (k % 101 / 100).alias("confidence")).alias("leaf_accepted"), F.concat(caps, F.slice(caps, 1, 1)).alias("capabilities_accepted")))
    return table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("tool_id"), k.alias("run_id"), F.when(k % 9 == 0, "not json").otherwise(body).alias("raw_output"))


@query(f"""WITH {_RUN} SELECT tool_id, run_id, coalesce(slug, '') AS pred, CASE WHEN slug IS NOT NULL THEN CAST(confidence AS DOUBLE) END AS confidence, CASE WHEN coalesce(slug, '') <> '' THEN 'provisional' ELSE 'unresolved' END AS decision_status,
    CASE WHEN slug IS NULL THEN '' ELSE array_to_string(list_transform(range(1, caps + 1), lambda i: 'cap-' || i), ',') END AS capabilities FROM l""")
def run_predictions(spark: SparkSession, d: str) -> DataFrame:
    """A prediction from each item's newest run."""
    return E.predictions_of_runs(_runs(spark, d)).withColumn("capabilities", F.array_join("capabilities", ","))


@query(f"""WITH {_RUN}, a AS (SELECT o_custkey AS tool_id, o_orderpriority AS pred, 0.5 AS confidence, 'provisional' AS dec FROM orders WHERE o_orderstatus = 'P' AND o_custkey % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
        c AS (SELECT o_custkey AS tool_id, array_to_string(list_sort(list(DISTINCT 'c' || o_orderkey % 3)), ',') AS caps FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
    SELECT tool_id, CASE WHEN l.run_id IS NOT NULL THEN coalesce(l.slug, '') ELSE coalesce(a.pred, '') END AS pred, CASE WHEN l.run_id IS NOT NULL THEN CASE WHEN coalesce(l.slug, '') <> '' THEN 'provisional' ELSE 'unresolved' END ELSE coalesce(a.dec, 'unresolved') END AS decision_status,
        CASE WHEN l.run_id IS NOT NULL THEN 'run' WHEN a.pred IS NOT NULL THEN 'assignment' ELSE 'capabilities' END AS source, CASE WHEN l.run_id IS NOT NULL THEN CASE WHEN l.slug IS NULL THEN '' ELSE array_to_string(list_transform(range(1, l.caps + 1), lambda i: 'cap-' || i), ',') END ELSE coalesce(c.caps, '') END AS capabilities
    FROM l FULL JOIN a USING (tool_id) FULL JOIN c USING (tool_id)""")
def assembled_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Newest run, else newest assignment, else capabilities alone."""
    o = table(spark, d, "orders")
    a = o.where("o_orderstatus = 'P' AND o_custkey % 3 <> 0").select(F.col("o_custkey").alias("tool_id"), F.col("o_orderkey").alias("assignment_id"), F.col("o_orderdate").alias("updated_at"), F.col("o_orderpriority").alias("pred"), F.lit(0.5).alias("confidence"), F.lit("provisional").alias("decision_status"))
    c = o.where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("tool_id"), F.concat(F.lit("c"), (F.col("o_orderkey") % 3).cast("string")).alias("capability"))
    out = E.assembled(E.predictions_of_runs(_runs(spark, d)), a, c)
    return out.select("tool_id", "pred", "decision_status", "source", F.array_join("capabilities", ",").alias("capabilities"))


@query("""WITH t AS (SELECT l_orderkey AS tool_id, l_partkey AS category_id, 's' || l_suppkey % 5 AS slug, CASE WHEN l_partkey % 3 = 0 THEN 'p' END AS parent, 's' || l_orderkey % 5 AS primary_slug FROM lineitem)
    SELECT tool_id, primary_slug, coalesce(arg_min(slug, category_id) FILTER (WHERE slug <> primary_slug AND parent IS NOT NULL), arg_min(slug, category_id) FILTER (WHERE slug <> primary_slug), primary_slug) AS leaf FROM (SELECT DISTINCT ON (tool_id, category_id) * FROM t ORDER BY slug) GROUP BY 1, 2""")
def legacy_leaves(spark: SparkSession, d: str) -> DataFrame:
    """The leaf that an item's old categories stand for."""
    name = lambda c: F.concat(F.lit("s"), (F.col(c) % 5).cast("string"))
    t = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("tool_id"), F.col("l_partkey").alias("category_id"), name("l_suppkey").alias("category_slug"), F.when(F.col("l_partkey") % 3 == 0, "p").alias("parent_slug"), name("l_orderkey").alias("primary_slug"))
    once = t.groupBy("tool_id", "category_id").agg(F.min_by(F.struct("category_slug", "parent_slug", "primary_slug"), "category_slug").alias("x")).select("tool_id", "category_id", "x.*")
    return E.legacy_leaf(once)


# -- decisions --------------------------------------------------------------------------------------


@query(r"""WITH o AS (SELECT o_orderkey AS id, (['Product-Module', 'company_site', 'spaceship', 'unresolved', 'non_product'])[o_orderkey % 5 + 1] AS k, o_orderkey % 11 * 10 AS c, o_orderkey % 3 AS q, o_orderkey % 17 = 0 AS bad FROM orders),
         x AS (SELECT id, CASE WHEN k = 'spaceship' THEN 'unresolved' ELSE replace(lower(k), '-', '_') END AS kind, CASE WHEN c > 1 AND c <= 100 THEN c / 100.0 ELSE least(c, 1) END AS conf, q, bad FROM o)
    SELECT id, kind AS candidate_kind, CAST(conf AS DOUBLE) AS confidence, CAST(q AS INTEGER) AS quotes, bad AND q > 0 AS error_page, kind <> 'unresolved' AND conf >= 0.8 AND q > 0 AND NOT bad AS accepted, CASE WHEN kind <> 'unresolved' AND conf >= 0.8 AND q > 0 AND NOT bad THEN kind ELSE 'unresolved' END AS kind,
           CASE WHEN id % 6 = 0 THEN CASE WHEN id % 4 = 0 THEN 'company_site' ELSE 'unresolved' END ELSE CASE WHEN kind <> 'unresolved' AND conf >= 0.8 AND q > 0 AND NOT bad THEN kind ELSE 'unresolved' END END AS settled FROM x""")
def entity_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Entity kinds, accepted only with confidence and evidence; manual ones win."""
    k = F.col("o_orderkey")
    kind = F.get(F.array(*map(F.lit, ("Product-Module", "company_site", "spaceship", "unresolved", "non_product"))), (k % 5).cast("int"))
    quote = F.when(k % 17 == 0, "Error code 521").otherwise("a quote")
    quotes = F.when(k % 3 == 0, F.array(F.lit(" "))).when(k % 3 == 1, F.array(quote)).otherwise(F.array(quote, F.to_json(F.struct(quote.alias("text"), F.lit("#x").alias("selector"))), F.lit("{}")))
    raw = F.to_json(F.struct(kind.alias("entity_kind"), (k % 11 * 10).alias("entity_confidence"), F.lit("because").alias("entity_reason"), quotes.alias("entity_evidence")))
    rows = table(spark, d, "orders").select(k.alias("id"), F.lit("https://x.com").alias("url"), X.answer(raw).alias("answer"), F.when(k % 4 == 0, "company_site").otherwise("odd").alias("old_kind"), F.when(k % 6 == 0, "manual").otherwise("auto").alias("old_source"))
    rows = rows.withColumn("decision", X.entity_decision("answer", "url"))
    return rows.select("id", "decision.candidate_kind", "decision.confidence", F.size("decision.evidence").alias("quotes"), "decision.error_page", "decision.accepted", "decision.kind", X.settled_entity("decision", "old_kind", "old_source").alias("settled"))


_TERMS = "terms AS (SELECT lower(r_name) AS slug, NULL AS parent_slug FROM region UNION ALL SELECT translate(lower(n_name), ' _', '--'), lower(r_name) FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_regionkey < 4)"
_ROOTS = """s AS (SELECT c_custkey AS id, i AS place, (['africa', 'mars', 'asia', 'africa', 'europe', 'middle-east', 'america'])[(c_custkey + i * 3) % 7 + 1] AS slug, (c_custkey * 7 + i) % 101 / 100.0 AS confidence FROM customer, range(4) t(i)),
    v AS (SELECT id, slug, min(place) AS p0, arg_min(confidence, place) AS confidence FROM s WHERE slug IN (SELECT slug FROM terms WHERE parent_slug IS NULL) GROUP BY 1, 2), roots AS (SELECT id, slug, confidence, row_number() OVER (PARTITION BY id ORDER BY p0) AS place FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY p0) <= 2)"""


def _terms(spark: SparkSession, d: str) -> DataFrame:
    r, n = table(spark, d, "region"), table(spark, d, "nation")
    roots = r.select(F.lower("r_name").alias("slug"), F.lit(None).cast("string").alias("parent_slug"))
    return roots.unionByName(n.where("n_regionkey < 4").join(r, F.col("r_regionkey") == F.col("n_regionkey")).select(F.translate(F.lower("n_name"), " _", "--").alias("slug"), F.lower("r_name").alias("parent_slug")))


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers as JSON: root candidates as objects, a leaf by name, capabilities as texts and objects."""
    k = F.col("c_custkey")
    names = F.array(*map(F.lit, ("Africa", "Mars", "Asia", "Africa", "Europe", "Middle East", "America")))
    root = lambda i: F.struct(F.get(names, ((k + i * 3) % 7).cast("int")).alias("slug"), ((k * 7 + i) % 101 / 100).alias("confidence"))
    cap = lambda i: F.struct(F.concat(F.lit("Brand#"), ((k + i) % 9 + 1).cast("string")).alias("slug"), ((k * 3 + i * 17) % 101 / 100).alias("confidence"), F.when((k + i) % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("seen"))).alias("evidence"))
    # A few bytes become an answer of a kilobyte and its items: customers are dealt out first, by the key of all that follows.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey").repartition(n, "c_custkey").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    raw = F.to_json(F.struct(F.array(*[root(i) for i in range(4)]).alias("l1_candidates"), F.col("n_name").alias("leaf_slug"), (k % 101 / 100).alias("confidence"), F.array(*[cap(i) for i in range(12)]).alias("capability_slugs")))
    return rows.select(k.alias("id"), F.lit("u").alias("url"), X.answer(raw).alias("answer"))


@query(f"WITH {_TERMS}, {_ROOTS} SELECT id, slug, CAST(confidence AS DOUBLE) AS confidence, CAST(place AS INTEGER) AS place FROM roots")
def taxonomy_roots(spark: SparkSession, d: str) -> DataFrame:
    """The first two known roots of each answer."""
    return X.top_roots(_answers(spark, d), "id", _terms(spark, d))


@query(f"""WITH {_TERMS}, {_ROOTS}, p AS (SELECT DISTINCT roots.id, coalesce(t.slug, roots.slug) AS leaf FROM roots LEFT JOIN terms t ON t.parent_slug = roots.slug),
         a AS (SELECT c_custkey AS id, translate(lower(n_name), ' _', '--') AS said, c_custkey % 101 / 100.0 AS c FROM customer JOIN nation ON n_nationkey = c_nationkey)
    SELECT a.id, p.leaf, CASE WHEN p.leaf IS NOT NULL THEN CAST(c AS DOUBLE) END AS confidence, CASE WHEN p.leaf IS NULL THEN 'unresolved' WHEN c >= 0.85 THEN 'auto_accepted' WHEN c >= 0.35 THEN 'provisional' ELSE 'unresolved' END AS status FROM a LEFT JOIN p ON p.id = a.id AND p.leaf = a.said""")
def taxonomy_leaves(spark: SparkSession, d: str) -> DataFrame:
    """The leaf of each answer below its own roots, and its status."""
    answers = _answers(spark, d)
    return X.leaf_decision(answers, "id", X.top_roots(answers, "id", _terms(spark, d)), _terms(spark, d))


@query("""WITH s AS (SELECT c_custkey AS id, i AS place, 'brand-' || ((c_custkey + i) % 9 + 1) AS slug, (c_custkey * 3 + i * 17) % 101 / 100.0 AS confidence, (c_custkey + i) % 4 <> 0 AS quoted FROM customer JOIN nation ON n_nationkey = c_nationkey, range(12) t(i)),
         v AS (SELECT id, slug, min(place) AS p0, arg_min(confidence, place) AS confidence FROM s WHERE quoted AND confidence >= 0.4 AND slug IN (SELECT lower(replace(p_brand, '#', '-')) FROM part) GROUP BY 1, 2)
    SELECT id, slug, CAST(confidence AS DOUBLE) AS confidence, 1 AS quotes, CAST(row_number() OVER (PARTITION BY id ORDER BY p0) AS INTEGER) AS place FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY p0) <= 8""")
def taxonomy_capabilities(spark: SparkSession, d: str) -> DataFrame:
    """Known capabilities with confidence and evidence, the first eight."""
    known = table(spark, d, "part").select(F.lower(F.replace("p_brand", F.lit("#"), F.lit("-"))).alias("slug")).distinct()
    return X.capabilities(_answers(spark, d), "id", known)


@query("""WITH b AS (SELECT l_orderkey, 's' || l_suppkey % 12 AS slug, max(l_discount) AS confidence, arg_max(l_linenumber, (l_discount, -l_linenumber)) AS l_linenumber FROM lineitem GROUP BY 1, 2)
    SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY confidence DESC, slug) AS INTEGER) AS place FROM b QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY confidence DESC, slug) <= 8""")
def merged_capabilities(spark: SparkSession, d: str) -> DataFrame:
    """The strongest decision of each slug over all chunks, then the eight strongest."""
    l = table(spark, d, "lineitem").select("l_orderkey", F.concat(F.lit("s"), (F.col("l_suppkey") % 12).cast("string")).alias("slug"), F.col("l_discount").alias("confidence"), "l_linenumber")  # noqa: E741
    return X.merged_capabilities(l, "l_orderkey", "l_linenumber")
