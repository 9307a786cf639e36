"""Addresses against the standard library; the first good extraction on literal attempts."""

import itertools
import json
from urllib.parse import urljoin

from pyspark.sql import functions as F

from tally.functions import addresses as A
from tally.operators import extractions as E

BASES = ["https://x.com", "https://x.com/", "http://x.com/a/b/c?q=1#f", "https://x.com/a/b/", "https://x.com?z"]
HREFS = ["", "i.png", "./i.png", "../i.png", "../../../i.png", "/i.png?v=1#z", "/a/./b/../c", "//cdn.y/i", "https://z/i.ico", "data:image/png;base64,AA", "?p=2", "#top", "a/../../b?x=/../y", "..", ".", "img/"]


def test_resolving(spark):
    rows = spark.createDataFrame(list(itertools.product(BASES, HREFS)), "b string, h string")
    for r in rows.select("b", "h", A.resolved_address("b", "h").alias("x")).collect():
        assert r.x == urljoin(r.b, r.h), (r.b, r.h)
    assert spark.createDataFrame([(None, "a"), ("https://x.com", None)], "b string, h string").select(A.resolved_address("b", "h").alias("x")).collect() == [(None,), (None,)]


def test_icons(spark):
    pages = [
        ('<link rel="icon" href="/i.png"><link rel="apple-touch-icon-precomposed" href="/t.png">', "/t.png"), ("<LINK REL='Shortcut Icon' HREF=' f.ico '>", "/f.ico"), ('<link rel="icon" href=""><link rel=icon href=/b.ico>', "/b.ico"),
        ('<link rel="stylesheet" href="/s.css">', None), ('<a rel="icon" href="/no">', None), (None, None), ("", None),
    ]
    rows = spark.createDataFrame([(h, w) for h, w in pages], "h string, w string").select("w", A.icon_address("h", F.lit("https://x.com/")).alias("x"), A.icon_or_usual("h", F.lit("https://x.com/p/q")).alias("y"))
    for r in rows.collect():
        assert r.x == (r.w and "https://x.com" + r.w) and (r.w or r.y == "https://x.com/favicon.ico")


def test_icons_that_are_kept(spark):
    big = bytearray(A.ICON_BYTES + 1)
    rows = [(200, None, b"x", True), (299, "7", b"x", True), (300, None, b"x", False), (None, None, b"x", False), (200, str(A.ICON_BYTES + 1), b"x", False), (200, "many", b"x", True), (200, None, b"", False), (200, None, None, False), (200, None, big, False), (200, None, big[:-1], True)]
    for r in spark.createDataFrame(rows, "c int, d string, b binary, w boolean").select("w", A.keeps_icon("c", "d", "b").alias("x")).collect():
        assert r.x is r.w


def test_first_extraction(spark):
    good, other = '{"category_l1":"a","key_features":[1]}', '{"data":{"category_l1":"b","key_features":[2]}}'
    rows = [
        ("one", 1, 1, "u1", "m1", None, "timeout " + "x" * 300, False), ("one", 1, 2, "u1", None, '{"category_l1":""}', None, None), ("one", 2, 1, "u2", "m1", other, None, None), ("one", 3, 1, "u3", "m1", good, None, None),
        ("fails", 1, 1, "u1", "m", None, "gone", False), ("again", 1, 1, "u1", "m", None, "gone", False), ("again", 2, 1, "u2", "m", "oops", None, None), ("kept", 1, 1, "u1", "m", good, "late", True), ("empty", 1, 1, "u", "m", '{"category_l1":"a","key_features":[]}', None, None),
    ]
    df = spark.createDataFrame(rows, "k string, p int, q int, url string, model string, payload string, error string, retryable boolean")
    got = {r.k: r for r in E.first_extraction(df, ["k"], ["p", "q"], ["category_l1", "key_features"]).collect()}
    one = got["one"]
    assert (one.url, one.model, json.loads(one.answer), one.retryable) == ("u2", "m1", {"category_l1": "b", "key_features": [2]}, None)
    assert one.errors == ["u1: timeout " + "x" * 212, "u1/default: empty_schema_result"]
    assert (got["fails"].url, got["fails"].answer, got["fails"].errors, got["fails"].retryable) == (None, None, ["u1: gone"], False)
    assert got["again"].retryable is True and got["again"].errors == ["u1: gone", "u2/m: empty_schema_result"] and got["kept"].errors == ["u1: late"] and got["empty"].url is None
    some = {r.k: r.url for r in E.first_extraction(df, ["k"], ["p", "q"], ["category_l1", "key_features"], ["key_features"], True).collect()}
    assert some["empty"] == "u"
    any_ = {r.k: r.url for r in E.first_extraction(df, ["k"], ["p", "q"], []).collect()}
    assert (any_["one"], any_["again"]) == ("u1", None)
