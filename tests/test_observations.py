"""Answers in wrappings against a plain recursion; registrations against a plain search."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tally.functions.answers import CANDIDATE, FIELDS, object_in_text, unwrapped
from tally.functions.offers import created_at
from tally.operators import registries as G


def in_text(text):
    try:
        if isinstance(whole := json.loads(text), dict):
            return whole
    except ValueError:
        pass
    for found in reversed(re.findall(CANDIDATE, text)):
        try:
            return json.loads(found)
        except ValueError:
            continue
    said = {k: m[1].lower() for k in ("category_l1", "category_l2") if (m := re.search(k + r"""\s*[:=]\s*["']([a-z0-9][a-z0-9-]{0,119})["']""", text, re.I))}
    return said if "category_l1" in said else None


def places(x):
    first = x["choices"][0] if isinstance(x.get("choices"), list) and x["choices"] else None
    if isinstance(first, dict):
        if isinstance(first.get("message"), dict):
            yield from (first["message"].get(k) for k in ("content", "reasoning", "reasoning_content"))
        yield first
    yield from (x.get(k) for k in ("content", "reasoning", "reasoning_content", "result", "json", "output", "data", "response", "message"))


def search(x, depth=6):
    """The first answer, depth first."""
    if isinstance(x, str):
        x = in_text(x)
        return x if x is not None and set(FIELDS) & set(x) else None
    if not isinstance(x, dict):
        return None
    if set(FIELDS) & set(x):
        return x
    return next((a for y in places(x) if (a := search(y, depth - 1)) is not None), None) if depth else None


def plain(text):
    try:
        x = json.loads(text)
    except (TypeError, ValueError):
        return {}
    if isinstance(x, str):
        return in_text(x) or {}
    found = search(x)
    return found if found is not None else x if isinstance(x, dict) else {}


def shape(rng, depth):
    """A random payload: wrappers, lists, texts that hold objects, fields that are null."""
    if depth == 0 or rng.random() < 0.15:
        leaf = {rng.choice(["title", "category_l1", "category_l2", "note", "n"]): rng.choice(["v", None, 1, [], "x y"])}
        return rng.choice([leaf, leaf, json.dumps(leaf), f"so {json.dumps(leaf)} or {{bad}} end", 'Category_L1 = "Dev-Tools" then category_l2: "C1"', "text", 5, None, [leaf]])
    kind = rng.randrange(4)
    if kind == 0:
        return {"choices": rng.choice([[], [shape(rng, 0)], [{"message": {rng.choice(["content", "reasoning", "other"]): shape(rng, depth - 1)}}], [{rng.choice(["message", "result"]): shape(rng, depth - 1)}]])}
    keys = rng.sample(["content", "reasoning", "reasoning_content", "result", "json", "output", "data", "response", "message", "note"], rng.randrange(1, 4))
    return {k: shape(rng, depth - 1) for k in keys}


def test_unwrapping(spark):
    rng = random.Random(8)
    texts = [json.dumps(shape(rng, rng.randrange(5))) for _ in range(400)] + [None, "", "oops", "{", '{"title":1}', '"', "[]", "null", "7", json.dumps({"data": {"data": {"data": {"data": {"data": {"data": {"title": "six deep"}}}}}}})]
    rows = unwrapped(spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id int, p string, answer_ int"), "p").select("id", "answer.found", "answer.level", F.to_json("answer.answer").alias("a"), "answer_").collect()
    for r in rows:
        want = plain(texts[r.id])
        assert json.loads(r.a) == want, texts[r.id]
        assert r.found == bool(set(FIELDS) & set(want))
    assert rows[-1].level == 6 and sum(r.found for r in rows) > 150


def test_depth_is_bounded(spark):
    deep = json.dumps({"data": {"result": {"title": "x"}}})
    got = unwrapped(spark.createDataFrame([(deep,)], "p string"), "p", "got", 1).select("got.found", F.to_json("got.answer").alias("a")).first()
    assert not got.found and json.loads(got.a) == json.loads(deep)


@pytest.mark.parametrize("text", [None, "", "{}", '{"a":{"category_l1":"x"}}', 'x {"category_l1": } {"category_l2": "b"} y', "CATEGORY_L1:'A-b' CATEGORY_L2='9'", "category_l2 = 'only'"])
def test_objects_in_texts(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(F.to_json(object_in_text(F.col("t"))).alias("a")).first().a
    assert (got and json.loads(got)) == (None if text is None else in_text(text))


def test_registrations(spark):
    """The longest suffix, the first of equal ones, addresses in turn, every end; nulls, repeats, odd bootstraps."""
    doc = '{"services":[[["com"],["https://a.test/","https://b.test"]],[["uk"],["https://uk.test"]],[[".CO.UK"],["https://co.test//"]],[["com"],["https://late.test"]],[["dev"],[""]],["io"],[["io"],"x"],[["net"],["https://n.test"],["more"]]]}'
    known = G.services(spark.createDataFrame([(doc,), ("{}",), (None,), ("oops",)], "doc string"), "doc")
    assert {r.suffix: r.urls for r in known.collect()} == {"com": ["https://a.test/", "https://b.test"], "uk": ["https://uk.test"], "co.uk": ["https://co.test//"], "dev": []}
    names = ["https://www.one.com/x", "one.com", "two.com", "three.com", "four.com", "five.com", "sub.x.co.uk", "y.me.uk", "a.dev", "b.io", None, "?", "silent.com"]
    asked = G.questions(spark.createDataFrame([(n,) for n in names], "url string"), "url", known)
    urls = sorted((r.domain, r.place, r.url) for r in asked.collect() if r.url)
    assert ("one.com", 0, "https://a.test/domain/one.com") in urls and ("x.co.uk", 0, "https://co.test/domain/x.co.uk") in urls and ("me.uk", 0, "https://uk.test/domain/me.uk") in urls and len(urls) == 14
    good, none = '{"events":[{"eventAction":"registration","eventDate":"2020-01-02"}]}', "{}"
    a, b = "https://a.test/domain/", "https://b.test/domain/"
    said = [(a + "one.com", 200, good, None), (a + "two.com", 404, None, None), (b + "two.com", 200, good, None), (a + "three.com", 500, None, None), (b + "three.com", 200, good, None), (a + "four.com", None, None, "timeout"), (b + "four.com", 503, None, "x" * 400), (a + "five.com", 200, none, None), ("https://co.test/domain/x.co.uk", 200, good, None), ("https://uk.test/domain/me.uk", 500, None, None)]
    got = {r.domain: (r.status, str(r.created_at)[:10], r.error) for r in G.resolved(asked, spark.createDataFrame(said, "url string, code int, payload string, error string"), created_at("payload")).collect()}
    assert got == {
        "one.com": ("done", "2020-01-02", None), "two.com": ("no_data", "None", "rdap_http_404"), "three.com": ("done", "2020-01-02", None), "four.com": ("failed", "None", "rdap_query_failed:" + "x" * 300),
        "five.com": ("no_data", "None", "created_at_not_found"), "x.co.uk": ("done", "2020-01-02", None), "me.uk": ("failed", "None", "rdap_query_failed:RDAP HTTP 500"), "a.dev": ("failed", "None", "rdap_service_not_found:a.dev"),
        "b.io": ("failed", "None", "rdap_service_not_found:b.io"), "": ("failed", "None", "invalid_domain"), "silent.com": ("failed", "None", "rdap_query_failed:not answered"),
    }
