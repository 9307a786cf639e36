"""Price claims on literal pages."""

import hashlib
import json
import random
import re

from tally.functions import documents as H
from tally.operators import page_claims as PC

PAGES = [
    (1, "<main><h1>Pricing plans</h1><p>Free plan available.</p><p>14-day free trial. No credit card required.</p><div>Pro USD 29 per month</div><div>API $0.02 per request</div><div>1,000 credits per month free</div><p>Enterprise: contact sales for custom pricing</p></main>"),
    (2, "<main><h1>Pricing plans billing</h1><p>Team plan EUR 10 per user monthly</p></main>"),
    (3, "<main><h1>Pricing plans billing</h1><p>Only $29 monthly</p></main>"),
    (4, "<main><p>A page about cats and their habits.</p></main>"),
    (5, None),
]


def test_claims(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, html string")
    nodes = H.dom_nodes(pages)
    got = {}
    for r in PC.claims(PC.region_nodes(nodes, H.pricing_regions(nodes))).collect():
        got.setdefault(r.page_id, {})[r.claim_type] = (r.value, r.status, r.error)
    assert set(got) == {1, 2, 3}
    one = got[1]
    assert one["has_free_plan"][0] == one["has_custom_quote"][0] == one["has_paid_pricing"][0] == one["has_usage_pricing"][0] == "true"
    assert json.loads(one["has_free_trial"][0]) == {"available": True, "duration": "14", "duration_unit": "day"}
    assert one["card_required"][0] == "false"
    assert json.loads(one["free_allowance"][0]) == {"quantity": "1000", "unit": "credit", "unit_family": "credit", "period": "month"}
    assert json.loads(one["starting_paid_price"][0]) == {"amount": "29", "currency": "USD", "amount_minor": 2900, "currency_exponent": 2}
    assert one["starting_price_period"][0] == "month"
    assert one["usage_rate"][1:] == ("failed", "ambiguous_currency_symbol") and json.loads(one["usage_rate"][0])["unit"] == "request"
    assert json.loads(one["pricing_models"][0]) == ["custom_quote", "hybrid", "subscription", "usage_based"]
    assert json.loads(got[2]["pricing_models"][0]) == ["per_seat", "subscription"]
    assert got[3]["starting_paid_price"][1:] == ("failed", "ambiguous_currency_symbol")


def test_region_hashes(spark):
    """Text, places and some attributes count; classes, ids and what lies outside the region don't."""
    page = '<nav>{nav}</nav><main class="{cls}" role="{role}"><h1>Pricing plans billing</h1><table><tr><td>Pro</td><td>USD {n} per month</td></tr></table></main>'
    rows = [(1, page.format(nav="a", cls="x", role="main", n=9)), (2, page.format(nav="b", cls="y", role="main", n=9)), (3, page.format(nav="a", cls="x", role="region", n=9)), (4, page.format(nav="a", cls="x", role="main", n=10)), (5, "<main>cats</main>")]
    nodes = H.dom_nodes(spark.createDataFrame(rows, "page_id bigint, html string"))
    regions = H.pricing_regions(nodes)
    got = {r.page_id: (r.n_nodes, r.region_hash) for r in H.region_hashes(nodes, regions).collect()}
    assert set(got) == {1, 2, 3, 4} and got[1] == got[2] and len({h for _, h in got.values()}) == 3
    cells = [{"attributes": {"role": "main"}, "table_column": None, "table_row": None, "tag": "main", "text": "Pricing plans billing Pro USD 9 per month"}]
    cells += [{"attributes": {}, "table_column": c, "table_row": r, "tag": t, "text": x} for t, r, c, x in (("h1", None, None, "Pricing plans billing"), ("table", None, None, "Pro USD 9 per month"), ("tr", 0, None, "Pro USD 9 per month"), ("td", 0, 0, "Pro"), ("td", 0, 1, "USD 9 per month"))]
    assert got[1] == (6, hashlib.sha256(json.dumps(cells, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest())


def test_evidence(spark):
    html = '<main><h1>Pricing plans billing</h1><table><tr><td>Pro</td><td class="a  b c">USD 9 "per" month</td></tr></table><p id="q">Contact sales</p></main>'
    nodes = H.dom_nodes(spark.createDataFrame([(1, html)], "page_id bigint, html string"))
    regions = H.pricing_regions(nodes)
    got = {r.claim_type: r for r in PC.with_evidence(PC.claims(PC.region_nodes(nodes, regions)), nodes, regions).collect()}
    quote = got["has_custom_quote"]
    assert (quote.quote, quote.selector, quote.table_row, quote.container) == ("Contact sales", "p#q", None, 0)
    assert quote.evidence_hash == hashlib.sha256(b'{"node_id":"n000007","quote":"Contact sales"}').hexdigest() and quote.node == 6
    assert all(r.quote and r.evidence_hash for r in got.values())


def test_patterns_are_searched_once(spark):
    """Each pattern stands once in the plan, however often what it finds is used."""
    nodes = H.dom_nodes(spark.createDataFrame(PAGES, "page_id bigint, html string"))
    plan = PC.claims(PC.region_nodes(nodes, H.pricing_regions(nodes)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("query|queries|token") == 1  # a price's unit
    assert plan.count("contact\\s+(?:us|sales)") == 1
    assert plan.count("gigabytes?)") == 4  # an allowance: one test, three groups


def test_claims_of_prices_alone(spark):
    """A page without any other claim keeps those of its prices, and one without prices its others."""
    rows = spark.createDataFrame([(1, 0, "Team EUR 10 monthly"), (2, 0, "Contact sales"), (3, 0, "nothing")], "page_id bigint, node int, text string")
    got = {(r.page_id, r.claim_type) for r in PC.claims(rows).collect()}
    assert {(1, "starting_paid_price"), (1, "has_paid_pricing"), (2, "has_custom_quote")} <= got and all(k != 3 for k, _ in got)


def _odd_pages(seed: int, n: int) -> list[str]:
    """Pages of pieces that fit and that don't: open and stray tags, references, raw text, prices across elements."""
    rng = random.Random(seed)
    tags = ["<main>", "</main>", "<div class='x'>", '<div class="Plans a" id="q">', "</div>", "<section>", "</section>", "<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", '<p aria-label="a b">', "</p>", "<nav>", "</nav>", "<P Hidden>", "<br>", '<img alt="1 > 0">', "<footer\n>", "</footer >", "<ul>", "</ul>"]
    texts = ["USD", " 5 ", "per", " month", "pricing plans", "contact", "\nsales", "$9 per user", "1,000 credits free", "privacy", "sign", " in", "EUR 10 monthly", "Free plan", "14-day free trial", "no credit card required", "été ½ 5 EUR", "a > b", "\t", "ſign in", "20 USD 30", "custom pricing"]
    rare = ["&amp;", "&nbsp;$3", "<", "< 5", "<script>USD 5</script>", "<!-- x -->", "<br/>", "</", "<title>plans</title>", "<a href=x>", "</div x>"]
    page = lambda: "".join(rng.choice(rng.choices([tags, texts, rare], [10, 10, rng.choice([0, 1])])[0]) for _ in range(rng.randint(1, 60)))
    return ["<body>" * rng.randint(0, 1) + page() for _ in range(n)]


def test_plain_markup_is_read_as_the_parser_reads_it():
    plain = 0
    for page in _odd_pages(7, 1500):
        want = H._Nodes()
        want.feed(page)
        want.close()
        got = H.parsed(page)
        cells = lambda p: [(n["tag"], n["parent"], n["end"], n["attributes"], n["hidden"], n["table_row"], n["table_column"], p.text(n)) for n in p.nodes]
        assert cells(got) == cells(want), page
        plain += not got.rawdata and page.count("<") > 3 and "&" not in page
    assert plain > 200


def test_counts_of_any_range():
    """Words that cross a range's ends don't count, those inside do, as if the range were searched alone."""
    rng = random.Random(8)
    for _ in range(300):
        words = [rng.choice(["USD", "5", "per", "month", "contact", "sales", "20", "EUR", "plans", "sign", "in", "été", "custom", "pricing", "x"]) for _ in range(25)]
        text, edges = " ".join(words), [0]
        for w in words:
            edges.append(edges[-1] + len(w) + 1)
        counts = H.Counts(text)
        for i in range(0, 25, 4):
            for j in range(i + 1, 26, 3):
                part = text[edges[i] : edges[j] - 1]
                want = tuple(len(re.findall(p.removeprefix("(?i)"), part, re.I)) for p in (H.PRICE, H.PLAN_WORDS, H.SITE_WORDS))
                assert counts.within(edges[i], edges[j] - 1) == want, part


def test_trees_tell_what_elements_tell(spark):
    """Regions and hashes found page by page are those found by joins of elements; nothing is shuffled."""
    pages = spark.createDataFrame([*enumerate(_odd_pages(9, 400)), *((1000 + i, h) for i, h in PAGES)], "page_id bigint, html string")
    nodes = H.dom_nodes(pages).cache()
    regions = H.pricing_regions(nodes, with_text=False)
    want = regions.join(H.region_hashes(nodes, regions), "page_id")
    got = H.tree_hashes(H.tree_regions(H.page_trees(pages))).select(*want.columns)
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(map(tuple, want.collect())) and len(rows) > 40
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_trees_claim_what_elements_claim(spark):
    """Claims and evidence found page by page are those found by joins of elements; nothing is shuffled (F1)."""
    pages = spark.createDataFrame([*enumerate(_odd_pages(10, 600)), *((1000 + i, h) for i, h in PAGES)], "page_id bigint, html string")
    nodes = H.dom_nodes(pages).cache()
    regions = H.pricing_regions(nodes, with_text=False)
    want = PC.with_evidence(PC.claims(PC.region_nodes(nodes, regions)), nodes, regions)
    got = PC.tree_claims(H.tree_regions(H.page_trees(pages))).select(*want.columns)
    # Of equal prices of one element the rows don't say which counts; the trees say the first.
    ties = {r.page_id for r in PC.prices(PC.region_nodes(nodes, regions)).groupBy("page_id", "node", "amount").count().where("count > 1").collect()}
    rows = lambda df: sorted(str(r) for r in df.collect() if r.page_id not in ties)
    told = rows(got)
    assert told == rows(want) and len(told) > 200 and len(ties) < 200 and {r.claim_type for r in got.collect()} == {r.claim_type for r in want.collect()}
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_first_of_equal_prices(spark):
    page = "<main><h1>Pricing plans billing</h1><p>EUR 9 per user, USD 9 per user</p></main>"
    rows = PC.tree_claims(H.tree_regions(H.page_trees(spark.createDataFrame([(1, page)], "page_id bigint, html string")))).collect()
    assert [json.loads(r.value)["currency"] for r in rows if r.claim_type == "starting_paid_price"] == ["EUR"]
