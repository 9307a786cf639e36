"""Pages, plans and discovery on literal pages."""

from pyspark.sql import functions as F

from tally.functions import offers as O
from tally.functions import pages as P

PAGE = """<html><head><script type="application/ld+json">{"@graph":[{"@type":"SoftwareApplication","name":"Acme  Writer","offers":[{"name":"Pro","price":"1,200.50","priceCurrency":"EUR"},{"price":0}]}]}</script>
<script>var x = "<p>no</p>";</script><style>p{}</style></head><body><h1>Our plans</h1><p>Fine &amp; good<br>prices</p>
<a href="/pricing/#top">a</a><a href="https://www.acme.com/plans">b</a><a href="https://other.com/pricing">c</a><a href="/blog/pricing">d</a><a href="/demo">e</a></body></html>"""


def test_page_parts(spark):
    got = {r.page_id: r for r in P.page_parts(spark.createDataFrame([(1, "https://acme.com/x", PAGE), (2, None, None)], "page_id int, url string, html string")).collect()}
    assert got[1].page_text == "Our plans\nFine & good\nprices\nabcde"
    assert got[1].links[0] == "https://acme.com/pricing/#top" and len(got[1].links) == 5 and got[1].product_names == ["Acme Writer"]
    assert [(o.name, o.price, o.currency) for o in got[1].offers] == [("Pro", "1,200.50", "EUR")]
    assert (got[2].page_text, got[2].links, got[2].offers) == ("", [], [])


def test_offer_plans_and_discovery(spark):
    rows = P.page_parts(spark.createDataFrame([(1, "https://acme.com/x", PAGE)], "page_id int, url string, html string")).withColumns({"url": F.lit("https://acme.com/x"), "sitemap": F.lit("<urlset><url><loc>https://acme.com/upgrade?a=1</loc></url></urlset>")})
    plan = rows.select(P.offer_plans("offers").alias("p")).first().p[0]
    assert (plan.name, plan.key, float(plan.amount), plan.currency, plan.custom_quote) == ("Pro", "pro", 1200.5, "EUR", False)
    got = [r.candidate for r in P.discover_pricing(rows).orderBy("place").collect()]
    assert got[0].rstrip("/") == "https://acme.com/pricing" and len(got) <= 12 and "https://acme.com/upgrade?a=1" in got and "https://acme.com/#pricing" in got
    assert not any("other.com" in u or "blog" in u for u in got)
    assert "https://acme.com/demo" in [r.candidate for r in P.discover_contact(rows).collect()]


def test_best_page(spark):
    rich = "pricing plans $1 $2 $3 per month"
    rows = [("a", 0, "pricing", "https://x.com/pricing", 200, rich), ("a", 1, "pricing", "https://x.com/plans", 200, rich * 3), ("b", 0, "pricing", "https://x.com/", 200, ""), ("b", 1, "pricing", "https://x.com/pricing", 200, rich), ("b", 2, "pricing", "https://x.com/plans", 404, rich),
            ("c", 0, "pricing", "https://x.com/", 500, ""), ("c", 5, "contact", "https://x.com/demo", 200, "y" * 90), ("c", 6, "contact", "https://x.com/contact", 200, "y" * 90), ("d", 0, "pricing", "https://x.com/", 500, "")]
    got = {r.k: (r.final_url, r.page_status, r.discovery) for r in P.best_page(spark.createDataFrame(rows, "k string, place int, kind string, final_url string, status int, page_text string"), "k").collect()}
    assert got == {"a": ("https://x.com/pricing", "found", "source_url"), "b": ("https://x.com/pricing", "found", "candidate_scored"), "c": ("https://x.com/demo", "contact_sales", "contact_or_demo"), "d": ("https://x.com/", "not_found", "none")}


def test_names(spark):
    df = spark.createDataFrame([("Acme Writer | Write fast", "acme-writer.co.uk"), ("Just a moment", "x.com")], "t string, h string")
    got = [(r.p, r.f, r.n) for r in df.select(O.title_parts("t").alias("p"), O.fallback_name("h").alias("f"), O.name_problem("t").alias("n")).collect()]
    assert got == [(["Acme Writer", "Write fast"], "Acme Writer", "unsplit_page_title"), (["Just a moment"], "X", "anti_bot_name")]


def test_a_slice_of_pages_is_bounded():
    """What a task parses at a time holds a bounded number of bytes, whatever the Arrow batch."""
    import pyarrow as pa

    from tally.functions import documents as H

    pages = ["x" * 1_000_000, None, "", "y" * 400_000, "z" * 200_000, "ü" * 1_000_000, "w"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(pages)], names=["_id", "_html"]).slice(1)
    got = list(H.page_slices([batch], "_html"))
    assert [b.column("_id").to_pylist() for b in got] == [[1, 2, 3, 4], [5], [6]]
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches([batch]))
    assert list(H.page_slices([batch.slice(0, 0)], "_html")) == []
