"""Rendering, escalation and AI traffic on literal rows."""

import pytest
from pyspark.sql import functions as F

from tally.functions import offers as O
from tally.functions import payload as P

ANSWERS = "array<struct<model:string,status:string,confidence:int,errors:array<string>>>"


@pytest.mark.parametrize(
    ("row", "want"),
    [
        (("manual_review", 200, "<p>", "found", True, 3, []), True),
        (("manual_review", 200, "<p>", "not_found", True, 20, ["x", "No public pricing plans found"]), True),
        (("manual_review", 200, "<p>", "found", True, 8, ["x"]), False),
        (("approved", 200, "<p>", "found", True, 3, []), False),
        (("manual_review", 404, "<p>", "found", True, 3, []), False),
        (("manual_review", 200, None, "found", True, 3, []), False),
        (("manual_review", 200, "<p>", "contact_sales", True, 3, []), False),
        (("manual_review", 200, "<p>", "found", False, 3, []), False),
        (("manual_review", None, "<p>", "found", True, 3, None), False),
    ],
)
def test_rendering(spark, row, want):
    df = spark.createDataFrame([row], "r string, h int, t string, p string, s boolean, n int, e array<string>")
    assert df.select(O.should_render("r", "h", "t", "p", "s", "n", "e").alias("x")).first().x is want


def test_escalation(spark):
    good, weak, bad, none = ("a", "approved", 90, []), ("b", "approved", 59, ["w"]), ("c", "manual_review", 95, ["v"]), ("d", None, None, None)
    cases = [
        ((["approved", 80, "found", False], [good]), ("approved", 80, None, 0, ["rule"])),  # nothing to ask
        ((["manual_review", 80, "found", False], [good, bad]), ("approved", 90, "a", 1, [])),
        ((["manual_review", 80, "found", False], [weak, none, good]), ("approved", 90, "a", 3, [])),
        ((["manual_review", 80, "found", False], [weak, bad]), ("manual_review", 95, "c", 2, ["v"])),
        ((["manual_review", 80, "found", False], [bad, weak, none]), ("approved", 59, "b", 3, ["w"])),  # the last that answered
        ((["approved", 80, "found", True], [none]), ("manual_review", 55, None, 1, ["rule", "Rule extraction requires model verification: x, y"])),
        ((["approved", 30, "found", True], [none, none]), ("manual_review", 30, None, 2, ["rule", "Rule extraction requires model verification: x, y"])),
        ((["manual_review", 80, "not_found", True], [good]), ("manual_review", 80, None, 0, ["rule"])),
        ((["manual_review", 80, "found", True], []), ("manual_review", 80, None, 0, ["rule"])),
    ]
    df = spark.createDataFrame([(i, *head, answers) for i, ((head, answers), _) in enumerate(cases)], f"i int, r string, c int, p string, n boolean, a {ANSWERS}")
    x = O.escalated("r", "c", F.array(F.lit("rule")), "p", "n", F.array(F.lit("x"), F.lit("y")), "a")
    for r in df.select("i", x.alias("x")).collect():
        assert (r.x.status, r.x.confidence, r.x.model, r.x.asked, r.x.errors) == cases[r.i][1], cases[r.i][0]


def test_ai_traffic(spark):
    whole = """{"TotalVisits":"1200","ReferralTraffic":0.5,"Traffic":{"Distribution":{"Boundary":" global ","Chatbots":[{"Name":"a","Value":0.7},{"Name":"","Value":1},{"Name":"b","Value":"x"}],
        "Chart":[{"Name":"a","History":[{"Date":"2026-05-09","Value":1},{"Date":"no","Value":1}]},{"Name":"b","History":[]}]},"Split":[{"Name":"a","Rank":2},{"Name":" ","Rank":1},{"Name":"c"}]},
        "TopPrompts":{"Status":1,"ErrorMessage":"e","Prompts":[1,{"x":2}]}}"""
    rows = spark.createDataFrame([(0, whole), (1, "{}"), (2, "[]"), (3, None), (4, "{oops"), (5, '{"Traffic":7,"TopPrompts":[],"TotalVisits":{"a":1}}')], "i int, d string")
    got = {r.i: r.a for r in rows.select("i", P.ai_traffic("d").alias("a")).collect()}
    a = got[0]
    assert (a.total_visits, a.referral_share, a.boundary, [tuple(s) for s in a.sources], [tuple(r) for r in a.rankings]) == (1200.0, 0.5, "global", [("a", 0.7)], [("a", 2), ("c", None)])
    assert [(s.name, [(str(p.date), p.share) for p in s.points]) for s in a.history] == [("a", [("2026-05-01", 1.0)])] and tuple(a.top_prompts) == (1, "e", 2)
    for i in (1, 5):
        b = got[i]
        assert (b.boundary, b.sources, b.history, b.rankings, tuple(b.top_prompts)) == (None, [], [], [], (None, None, 0))
    assert got[2] is got[3] is got[4] is None and got[5].total_visits is None
