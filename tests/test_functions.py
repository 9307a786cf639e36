"""Fixed expectations for the column functions."""

import json

import pytest
from pyspark.sql import functions as F

from tally.functions import documents as H
from tally.functions import numbers as N
from tally.functions import text as X


def value(spark, column, **cells):
    df = spark.range(1)
    for k, v in cells.items():
        df = df.withColumn(k, v if not isinstance(v, str | int | float | type(None)) else F.lit(v))
    return df.select(column.alias("x")).first()[0]


@pytest.mark.parametrize(("share", "bps"), [(1.0000000000000007, 10000), (1.00001, None), (0.33335, 3334), (0.1, 1000), (0.25, 2500), (-0.1, None), (0.0, 0), (None, None)])
def test_share_to_bps(spark, share, bps):
    assert value(spark, N.share_to_bps("s"), s=F.lit(share).cast("double")) == bps


@pytest.mark.parametrize(("visits", "bps", "n"), [(10000, 3334, 3334), (12000, 2500, 3000), (16000, 2500, 4000), (1, 5000, 1), (1, 4999, 0)])
def test_visits_from_bps(spark, visits, bps, n):
    assert value(spark, N.visits_from_bps("v", "b"), v=visits, b=bps) == n


@pytest.mark.parametrize(("raw", "n"), [("12.9", 12), ("-3", 0), ("x", None), ("NaN", None), ("Infinity", None), (None, None)])
def test_to_integer(spark, raw, n):
    assert value(spark, N.to_integer("r"), r=F.lit(raw).cast("string")) == n


def test_money(spark):
    assert value(spark, N.amount_minor(F.lit("2.675").cast("decimal(10,3)"))) == 268
    assert value(spark, N.amount_minor(F.lit("2.665").cast("decimal(10,3)"))) == 266
    assert value(spark, N.decimal_string(N.to_decimal(F.lit("1,290.500")))) == "1290.5"
    assert value(spark, N.to_decimal(F.lit("-1"))) is None
    assert [float(value(spark, N.quantity(F.lit(q)))) for q in ("2.5k", "3 million", "1,000")] == [2500, 3_000_000, 1000]


def test_dates(spark):
    assert str(value(spark, N.month_start(F.lit("2026-06-17T10:00:00Z")))) == "2026-06-01"
    assert value(spark, N.month_start(F.lit("2026-99-01"))) is None
    assert value(spark, N.month_start(F.lit("soon"))) is None
    assert str(value(spark, N.previous_month(F.lit("2026-03-31").cast("date")))) == "2026-02-01"


def test_growth_and_velocity(spark):
    assert value(spark, N.growth_rate("a", "b"), a=2000, b=1000) == 1.0
    assert value(spark, N.growth_rate("a", "b"), a=2000, b=0) is None
    assert value(spark, N.velocity_30d("a", "b", "d"), a=46, b=40, d=30) == 6.0
    assert value(spark, N.search_share(F.lit(None).cast("double"), F.lit(0.25), F.lit(0.05))) == pytest.approx(0.3)
    assert value(spark, N.search_share(*[F.lit(None).cast("double")] * 3)) is None


@pytest.mark.parametrize(
    ("raw", "domain", "registrable"),
    [("https://www.Example.co.uk:8080/a?b", "example.co.uk", "example.co.uk"), ("user@shop.example.com", "shop.example.com", "example.com"), ("localhost", "", ""), ("", "", ""), ("a.b.example.org.", "a.b.example.org", "example.org")],
)
def test_domains(spark, raw, domain, registrable):
    assert value(spark, X.domain("r"), r=raw) == domain
    assert value(spark, X.registrable(X.domain("r")), r=raw) == registrable


@pytest.mark.parametrize(
    ("url", "strict", "score"),
    [("https://x.com/pricing", True, 135), ("https://x.com/", False, -50), ("https://x.com/#pricing", True, 75), ("https://x.com/blog/pricing", False, -200), ("https://x.com/en/plans?a=1", True, 70), ("https://x.com/a/b/c/d", False, -25)],
)
def test_pricing_urls(spark, url, strict, score):
    assert value(spark, X.is_strict_pricing_url("u"), u=url) is strict
    assert value(spark, X.pricing_url_score("u"), u=url) == score


def test_contact_urls(spark):
    assert value(spark, X.contact_url_score("u"), u="https://x.com/contact-sales") == 90
    assert value(spark, X.contact_url_score("u"), u="https://x.com/a/b/demo") == 60
    assert value(spark, X.contact_url_score("u"), u="https://x.com/pricing") == -1000
    assert value(spark, X.matches_context("a", "b"), a="https://x.com/tools/writer", b="https://x.com/writer/tools/pricing") is True
    assert value(spark, X.matches_context("a", "b"), a="https://x.com/tools/writer", b="https://x.com/pricing") is False


def test_slugs_and_lists(spark):
    assert value(spark, X.slug("s"), s="  Émile & Co. -- AI!  ") == "mile-co-ai"
    assert value(spark, X.slug("s"), s="a" * 121) == ""
    assert value(spark, X.split_multi("s"), s="a| b;a,,c") == ["a", "b", "c"]
    assert value(spark, X.numbered_slug("s", "n"), s="x", n=3) == "x-3"


def test_unicode_and_json(spark):
    assert value(spark, H.identity_text("s"), s="Ｐｒｏ Straße™") == "pro strassetm"
    assert value(spark, H.canonical_json("s"), s='{"b": 1, "a": [1, 2]}') == '{"a":[1,2],"b":1}'
    assert value(spark, H.canonical_json("s"), s="{") is None
    assert value(spark, H.json_object_in("s"), s='Sure: {bad} then {"a": {"b": 1}} end') == '{"a":{"b":1}}'
    rows = spark.createDataFrame([(1, 1, '{"a":{"x":1,"y":2},"k":[1]}'), (1, 2, "junk"), (1, 3, '{"a":{"x":null},"b":3}')], "g int, o int, p string")
    assert H.merge_in_order(rows, ["g"], "o", "p", "m").first().m == '{"a":{"y":2},"b":3,"k":[1]}'


PAGE = """<html><head><title> Acme &mdash; Plans </title><meta name="description" content="Fine tools"></head><body>
<nav><section>Pricing $1 plans monthly</section></nav>
<section class="pricing"><h2>Plans</h2><div>Pro $29 per month</div><div hidden>Secret $1</div>
<table><tr><th>Plan</th><th>Price</th></tr><tr><td>Team</td><td>USD 99 monthly</td></tr></table></section><script>var x = "$5";</script></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<title>Access denied</title>"), (3, "<p>hi</p>"), (4, None)], "page_id bigint, html string")
    assert {r.page_id: r.s for r in H.page_state(df, out="s").collect()} == {1: "valid_product_page", 2: "access_denied", 3: "empty_page", 4: "empty_page"}
    assert df.select(H.page_title("html"), H.meta_content("html", "description")).first()[1] == "Fine tools"
    nodes = H.dom_nodes(df).where("page_id = 1").orderBy("node").collect()
    by = {n.node: n for n in nodes}
    for n in nodes:  # a tree in document order: the end of a subtree covers all its children
        if n.parent >= 0:
            assert n.parent < n.node and n.end <= by[n.parent].end
    cells = [(n.table_row, n.table_column, n.text) for n in nodes if n.tag in ("td", "th")]
    assert cells == [(0, 0, "Plan"), (0, 1, "Price"), (1, 0, "Team"), (1, 1, "USD 99 monthly")]
    assert "Secret" not in by[0].text and "$5" not in by[0].text
    best = H.pricing_regions(H.dom_nodes(df)).collect()
    assert len(best) == 1 and best[0].page_id == 1 and by[best[0].root].tag == "section" and "Team" in best[0].text


def test_merge_in_order_equals_a_fold(spark):
    """Scalars over objects, objects over scalars, removals, empty objects and texts that aren't JSON."""
    import random

    def fold(old, new):
        if not isinstance(new, dict):
            return new
        out = dict(old) if isinstance(old, dict) else {}
        for k, v in new.items():
            if v is None:
                out.pop(k, None)
            else:
                out[k] = fold(out.get(k), v)
        return out

    rng = random.Random(3)

    def patch(depth=0):
        if depth and rng.random() < 0.5:
            return rng.choice([None, 1, "x", [1, {"a": None}], {}])
        return {k: patch(depth + 1) for k in rng.sample("abc", rng.randrange(0, 3))} if depth < 3 else None

    rows, want = [], {}
    for key in range(60):
        state = None
        for _ in range(rng.randrange(0, 7)):
            p = patch()
            rows.append((key, len(rows), json.dumps(p)))
            state = fold(state, p)
        rows.append((key, len(rows), rng.choice([None, "no json"])))
        want[key] = None if state is None else json.dumps(state, sort_keys=True, separators=(",", ":"))
    df = spark.createDataFrame(rows, "k int, o int, p string").repartition(3)
    got = {r.k: r.m for r in H.merge_in_order(df, ["k"], "o", "p", "m").collect()}
    assert got == want


def test_dom_nodes_cost_the_same_at_any_depth():
    """What is around a node is what its ancestors say, and isn't looked up through all of them."""
    import random
    import time

    rng, p = random.Random(3), H._Nodes()
    p.feed("".join(rng.choice(["<table>", "<tr>", "<td>", "<th>", "<div>", "</table>", "</tr>", "</td>", "</div>", "x"]) for _ in range(600)))
    p.close()
    rows = cells = 0
    for n in p.nodes:
        up, at = [], n["parent"]
        while at >= 0:
            up.append(p.nodes[at])
            at = p.nodes[at]["parent"]
        above = lambda c: next((a[c] for a in up if a[c] is not None), None)  # noqa: B023, E731
        if n["tag"] == "table":
            assert n["table_row"] is None and n["table_column"] is None
        elif n["tag"] == "div":
            assert (n["table_row"], n["table_column"]) == (above("table_row"), above("table_column"))
        rows, cells = rows + (n["tag"] == "tr"), cells + (n["tag"] in ("td", "th"))
    assert rows > 20 and cells > 20

    def took(depth: int) -> float:
        began = time.process_time()
        H._Nodes().feed("<div>" * depth)
        return time.process_time() - began

    assert min(took(6000) for _ in range(3)) < 12 * min(took(1000) for _ in range(3))  # in proportion: 6 times; squared: 36


def test_regions_without_texts(spark):
    html = "<body><main class='pricing'><p>$5 per month</p><p>Free plan $9 per month</p></main><nav><div>$1 $2 $3 $4 pricing plans</div></nav></body>"
    nodes = H.dom_nodes(spark.createDataFrame([(1, html), (2, "<p>x</p>"), (3, None)], "page_id bigint, html string"))
    cells = lambda df: [(r.page_id, r.root, r.end, r.score) for r in df.collect()]
    light = H.pricing_regions(nodes, with_text=False)
    assert cells(light) == cells(H.pricing_regions(nodes)) and len(cells(light)) == 1 and "text" not in light.columns
