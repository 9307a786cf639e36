"""The market snapshot on a small literal catalogue, and the payload, plan and safety functions."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tally.functions import payload as P
from tally.functions import pricing as PR
from tally.functions.safety import content_safety
from tally.plans import market as M
from tally.plans.catalog import market_snapshot


@pytest.fixture(scope="module")
def snapshot(spark):
    tool = "id int, status string, content_safety_status string, duplicate_of_tool_id int, verification_status string, staleness_status string, normalized_domain string, first_published_at string, listed_at string, primary_category_id int"
    tools = spark.createDataFrame([(1, "published", "safe", None, "verified", "fresh", " Market.example", None, "2026-01-01", 1), (2, "published", "safe", None, "pending", "aging", "market.example", "2026-02-01", None, 1), (3, "published", "nsfw", None, "verified", "fresh", "x.example", None, None, 1), (4, "published", "safe", None, "verified", "fresh", "orphan.example", None, None, 99)], tool)
    metrics = json.dumps({"traffic_sources": {"search_organic": 0.25, "search_paid": 0.05}})
    t = [("2026-05-01", 1000, 100, 0.10, None), ("2026-06-01", 2000, 300, 0.15, metrics), ("2026-07-01", 2500, 400, 0.2, metrics)]
    traffic = spark.createDataFrame([("sw", "market.example", *r) for r in t], "source string, domain string, traffic_month string, visits bigint, ai_visits bigint, gen_ai_share double, metrics_json string")
    countries = spark.createDataFrame([("sw", "market.example", "2026-06-01", "US", 1, 6000, None), ("sw", "market.example", "2026-06-01", "GB", 2, 2000, None)], "source string, domain string, traffic_month string, country_code string, country_position int, traffic_share_bps int, estimated_visits bigint")
    d = dt.date
    ratings = spark.createDataFrame([("market.example", d(2026, 6, 1), 40.0), ("market.example", d(2026, 6, 25), 45.0), ("market.example", d(2026, 7, 1), 46.0)], "domain string, observed_date date, rating double")
    checks = spark.createDataFrame([("sw", "2026-05-01", "available"), ("sw", "2026-06-01", "available"), ("sw", "2026-07-01", "unavailable")], "source string, traffic_month string, status string")
    tables = (tools, traffic, countries, ratings, checks, spark.createDataFrame([(1,), (2,)], "id int"))
    return tables, M.build(*tables, "sw")


def test_snapshot_values(snapshot):
    s = snapshot[1]
    assert (s.month, s.baseline) == ("2026-06-01", "2026-05-01")
    r = {x.tool_id: x for x in s.tools.collect()}
    assert set(r) == {1, 4}
    a = r[1]
    assert (a.visits, a.visits_delta, a.visits_growth) == (2000, 1000, 1.0)
    assert (a.search_share_bps, a.organic_share_bps, a.paid_share_bps, a.search_visits, a.paid_visits) == (3000, 2500, 500, 600, 100)
    assert (a.ai_delta, a.ai_growth, a.dr_delta, a.dr_velocity) == (200, 2.0, 6.0, 6.0)
    assert r[4].visits is None and r[4].visits_growth is None
    assert {(x.country_code, x.traffic_share_bps, x.estimated_visits, x.estimated_ai_visits) for x in s.countries.collect()} == {("US", 6000, 1200, 180), ("GB", 2000, 400, 60)}


def test_rollups_and_coverage(snapshot):
    s = snapshot[1]
    got = {(x.category, x.country): (x.tool_count, x.visits) for x in s.rollups.collect()}
    assert got == {(0, ""): (2, None), (1, ""): (1, None), (0, "US"): (1, 1200), (0, "GB"): (1, 400), (1, "US"): (1, 1200), (1, "GB"): (1, 400)}
    c = s.coverage.first().asDict()
    assert (c["total_tools"], c["traffic_tools"], c["country_rows"], c["country_tools"], c["dr_comparable_tools"]) == (2, 1, 2, 1, 1)
    assert M.gate_failures(c) == []
    assert M.gate_failures(c, c | {"total_tools": 3}) == ["total_tools: 2 after 3"]
    assert "country_tools: 0 of at least 1" in M.gate_failures(c | {"country_tools": 0})
    # A tool of an unknown category is in no category's rollup, which the equalities tell.
    assert len(c) == 28 and M.rollup_mismatches(c) == ["facet_rollup_category_tools=1 expected=2"]
    assert M.rollup_mismatches(c | {"category_tools": 1, "current_catalog_eligibility_revision": 5}) == ["current_catalog_eligibility_revision=5 expected=0"]
    assert M.coverage_payload(c)["dr_baseline_window_days"] == [20, 45]


def test_a_named_month_passes_the_gate(snapshot):
    tables = snapshot[0]
    assert M.build(*tables, "sw", "2026-07-01").tools.where("tool_id = 1").first().visits == 2500
    with pytest.raises(ValueError, match="released"):
        M.build(*tables, "other")


def test_rollup_unknown_is_not_zero(spark):
    rows = [(0, "a", 1, "US", 1, 0, 0), (1, "b", 1, "US", 1, None, None), (0, "a", 1, "CA", 2, 0, 0), (1, "b", 1, "GB", 2, None, None)]
    c = spark.createDataFrame(rows, "tool_id int, domain string, primary_category_id int, country_code string, country_position int, estimated_visits bigint, estimated_ai_visits bigint")
    m = spark.createDataFrame([(0, 1), (1, 1)], "tool_id int, primary_category_id int")
    got = {(x.category, x.country): (x.tool_count, x.visits, x.ai_visits, x.unknown_visits, x.unknown_ai_visits) for x in M.facet_rollups(m, c, spark.createDataFrame([(1,)], "id int")).collect()}
    assert got[(0, "")] == got[(1, "")] == (2, None, None, 0, 0)
    assert got[(0, "US")] == got[(1, "US")] == (2, 0, 0, 1, 1)
    assert got[(0, "CA")] == (1, 0, 0, 0, 0) and got[(0, "GB")] == (1, None, None, 1, 1)


def test_payload_functions(spark):
    df = spark.range(1).select(F.create_map(F.lit("SearchOrganic"), F.lit("0.2"), F.lit("SearchPaid"), F.lit("0.1"), F.lit("Social"), F.lit("0.3"), F.lit("SocialPaid"), F.lit("9")).alias("m"))
    s = df.select(P.traffic_sources("m").alias("s")).first().s
    assert (s.search, s.social, s.direct) == (pytest.approx(0.3), 0.3, None)
    df = spark.createDataFrame([([("us", 0.33335), ("?", 0.1), ("GB", 2.0), ("CA", 0.25)],)], "x array<struct<CountryCode:string,Value:double>>")
    assert [tuple(x) for x in df.select(P.country_shares("x").alias("c")).first().c] == [("US", 1, 3334), ("CA", 4, 2500)]
    assert df.select(*P.wide_countries("x")).first().top_country_5 is None
    k = spark.createDataFrame([([(" a ", 5.9, None, 1.0), ("", 1.0, 1.0, 1.0)],)], "x array<struct<Name:string,Volume:double,EstimatedValue:double,Cpc:double>>")
    assert [tuple(x) for x in k.select(P.keywords("x").alias("c")).first().c] == [("a", 5, None, 1.0)]
    assert spark.range(1).select(P.metrics_json(a=F.lit(1), b=F.lit(None).cast("int")).alias("j")).first().j == '{"a":1}'
    h = spark.createDataFrame([([("bot", [("2026-06-11", 0.5), ("bad", 0.1)]), ("none", [])],)], "x array<struct<Name:string,History:array<struct<Date:string,Value:double>>>>")
    assert [(x.name, [(str(p.date), p.share) for p in x.points]) for x in h.select(P.ai_history("x").alias("c")).first().c] == [("bot", [("2026-06-01", 0.5)])]


def test_text_plans(spark):
    text = "Choose a plan. Starter $9 per month for one. Team USD 99 yearly per seat. " + "x" * 300 + " Free $0 forever. " + "y" * 300 + " save 10% with coupon $5 now"
    got = PR.text_plans(spark.createDataFrame([(1, text), (2, "nothing"), (3, None)], "id int, text string"), "id", "text").collect()
    assert len(got) == 1
    plans = [(p.plan, float(p.amount), p.currency) for p in got[0].plans]
    assert plans[0] == ("Free", 0.0, "USD") and ("Team", 99.0, "USD") in plans and all(a != 5.0 for _, a, _ in plans)


@pytest.mark.parametrize(
    ("plans", "want"),
    [
        ([("Free", 0, None, None, "USD", False), ("Pro", 29, "monthly", None, "USD", False)], ("freemium", True, "monthly", 2900)),
        ([("Pro", 290, "yearly", None, "USD", False)], ("paid", False, "yearly", 29000)),
        ([("API", 1, None, "usage", "USD", False)], ("usage_based", False, "usage", 100)),
        ([("Custom", None, None, None, None, True)], ("contact", False, "custom", None)),
        ([], ("unknown", False, "none", None)),
    ],
)
def test_pricing_summary(spark, plans, want):
    df = spark.createDataFrame([(plans,)], "p array<struct<name:string,amount:int,interval:string,kind:string,currency:string,custom:boolean>>")
    s = df.select(PR.pricing_summary("p").alias("s")).first().s
    assert (s.model, s.has_free_plan, s.interval, s.starting_minor) == want


@pytest.mark.parametrize(
    ("text", "host", "label", "conf", "status", "reason"),
    [
        ("an nsfw app", "x.com", None, None, "nsfw", "explicit_adult_product_signal"),
        ("a tool", "www.pornify.ai", None, None, "nsfw", "explicit_adult_product_signal"),
        ("spicy adult chat", "x.com", "safe", 90, "needs_review", "ambiguous_adult_context"),
        ("uncensored red team benchmark", "x.com", None, None, "safe", "safe_context_disambiguated"),
        ("a tool", "x.com", "safe", 90, "safe", "model_confirmed_safe"),
        ("a tool", "x.com", "nsfw", 99, "needs_review", "model_detected_adult_context"),
        (None, None, None, None, "needs_review", "insufficient_content_safety_evidence"),
    ],
)
def test_content_safety(spark, text, host, label, conf, status, reason):
    df = spark.createDataFrame([(text, host, label, conf)], "t string, h string, l string, c int")
    s = df.select(content_safety("t", "h", "l", "c").alias("s")).first().s
    assert (s.status, s.reason) == (status, reason)


def test_snapshot_counts_every_visible_customer(spark, tmp_path):
    """A hundred visible customers of one nation and segment, one of them twice; no cap."""
    d = str(tmp_path)
    rows = [(i, 1, "A", float(i)) for i in range(1, 101)] + [(1, 1, "A", 2.0), (200, 1, "A", -1.0)]
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double").write.parquet(f"{d}/customer.parquet")
    spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string").write.parquet(f"{d}/nation.parquet")
    orders = spark.createDataFrame([(i, y, 2.0 if y == 1998 else 1.0) for i in range(1, 201) for y in (1997, 1998)], "o_custkey long, y int, o_totalprice double")
    orders.select("o_custkey", F.make_date("y", F.lit(5), F.lit(1)).cast("timestamp_ntz").alias("o_orderdate"), "o_totalprice").write.parquet(f"{d}/orders.parquet")
    assert [tuple(r) for r in market_snapshot(spark, d).collect()] == [("N", "A", 100, 20000, 10000, 1.0)]
