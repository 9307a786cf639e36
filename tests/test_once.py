"""Shared expressions are computed once: what a query reads out of a text isn't read again wherever it is used."""

import json

import __spark_entry__ as entry
from tally.functions import offers as O
from tally.operators import taxonomy as X

DATA = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return entry.queries()[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()


def test_capabilities_read_an_item_once(spark):
    """One reading of an item for each of its fields (F12), and customers dealt out before they become answers."""
    plan = plan_of(spark, "taxonomy_capabilities")
    assert plan.count("$.confidence") == plan.count("$.evidence") == 1
    assert "RepartitionByExpression [c_custkey" in plan


def test_roots_read_an_item_once(spark):
    """As F12: the same step."""
    plan = plan_of(spark, "taxonomy_roots")
    assert plan.count("$.confidence") == 1 and "RepartitionByExpression [c_custkey" in plan


def test_roots_make_an_answer_once(spark):
    """Testing for empty lists makes and parses no answer again, and a slug's text is made once."""
    plan = plan_of(spark, "taxonomy_roots")
    assert plan.count("from_json(") == plan.count("StructsToJsonEvaluator") == plan.count("[^a-z0-9]+") == 1


def test_names_of_odd_items(spark):
    """The first name with a text counts; what has none, no list or an overlong slug is no known root."""
    raw = ['{"l1_candidates":[{"slug":"","category_l1":"B  b","confidence":"80"},"-A-",{"slug":null},{"slug":"a"},"b b"]}', '{"l1_candidates":[]}', '{"l1_candidates":null}', "no json", None, json.dumps({"l1_candidates": ["x" * 121, "x" * 120]})]
    answers = spark.createDataFrame([(i, "u", r) for i, r in enumerate(raw)], "id int, url string, raw string").select("id", "url", X.answer("raw").alias("answer"))
    terms = spark.createDataFrame([("a", None), ("b-b", None), ("x" * 120, None), ("c", "a")], "slug string, parent_slug string")
    got = X.top_roots(answers, "id", terms).orderBy("id", "place").collect()
    assert [tuple(r) for r in got] == [(0, "b-b", 0.8, 1), (0, "a", 0.5, 2), (5, "x" * 120, 0.5, 1)]


def test_profiles_read_an_answer_once(spark):
    """A profile's answer is parsed once, each of its three fields once, and each list of evidence once (F16)."""
    plan = plan_of(spark, "product_profiles")
    assert plan.count("from_json(StructField(primary_job,") == 1 and plan.count("StructField(quote,") == 3


def test_profile_of_odd_answers(spark):
    raw = ['{"primary_job":{"value":" a  b ","evidence":["q",{"text":"t","selector":"#s"}," "]},"primary_outputs":{"text":"one","evidence_items":["e"]}}', '{"primary_job":{"value":"x"}}', "no json", None]
    got = spark.createDataFrame([(i, r, None) for i, r in enumerate(raw)], "i int, raw string, url string").select("i", X.product_profile("raw", "url").alias("p")).orderBy("i").collect()
    first = got[0].p
    assert (first.primary_job.value, [(e.node_id, e.quote) for e in first.primary_job.evidence]) == ("a b", [("", "q"), ("#s", "t")])
    assert [v.value for v in first.primary_outputs] == ["one"] and list(first.capabilities) == []
    assert [r.p.has_signal for r in got] == [True, False, False, False] and all(r.p.primary_job is None for r in got[1:])


def test_features_are_read_once(spark):
    """The list is parsed once, not once more for each of its items (F15); the first of a name stays, whatever its case."""
    assert plan_of(spark, "key_features").count("from_json") == 1
    items = [{"name": "A"}, {"feature_name": "a", "description": "x"}, {"name": " "}, {"name": "B"}, {"name": "b"}, {}]
    df = spark.createDataFrame([(json.dumps(items),), ("[]",), ("no json",), (None,)], "raw string").select(O.key_features("raw").alias("f"))
    assert [[x.name for x in r.f] for r in df.collect()] == [["A", "B"], [], [], []]


def test_conflicts_compare_names_once(spark):
    """Each side's names are made once: a pattern in the plan for each side, not for each use."""
    assert plan_of(spark, "price_conflicts").count("bplan") == 2


def test_domains_are_asked_once(spark):
    """Ratings and births come from one reading of what the services said."""
    plan = plan_of(spark, "domain_observations")
    assert "c_custkey" not in plan and "regexp_extract(payload" not in plan and plan.count("Relation") == 2


def test_cascade_streams_children(spark):
    """A delete's children stream past the hashed keys of what goes, once for each link and unsorted."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()["cascading_delete"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # Lines meet orders, orders customers: once for their own marks and once below the lines.
    assert "SortMergeJoin" not in plan and plan.count("ShuffledHashJoin") == 3
