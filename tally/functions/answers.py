"""Answers of models in whatever wrapping they come: the object that was asked for, found without Python."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of an object that was asked for, where wrappings keep what they wrap, in the order in which it is looked for.
FIELDS = [
    "category_l1", "category_l2", "title", "product_name", "page_title", "name_confidence", "name_source", "name_evidence", "content_safety_label",
    "content_safety_confidence", "content_safety_evidence", "description", "favicon_href", "key_features",
]
SAID = ["content", "reasoning", "reasoning_content"]
WRAPPERS = ["result", "json", "output", "data", "response", "message"]
CANDIDATE = r'\{[^{}]*"category_l[12]"[^{}]*\}'
PROSE = r"""(?i)category_l%s\s*[:=]\s*["']([a-z0-9][a-z0-9-]{0,119})["']"""
PATHS = [*[f"$.choices[0].message.{k}" for k in SAID], "$.choices[0]", *[f"$.{k}" for k in [*SAID, *WRAPPERS]]]


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _asked_for(v: Column) -> Column:
    """Whether an object has one of the fields, be it null."""
    return _is(v, "OBJECT") & reduce(lambda a, b: a | b, [F.try_variant_get(v, f"$.{k}", "variant").isNotNull() for k in FIELDS])


def object_in_text(text: Column) -> Column:
    """The object that a text holds, as VARIANT: the whole text if it is one; else the last flat object in it that names a
    category and can be parsed; else what a sentence says of the categories; else null."""
    whole = F.try_parse_json(F.trim(text))
    flat = F.filter(F.transform(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), F.try_parse_json), lambda v: v.isNotNull())
    one, two = (F.lower(F.nullif(F.regexp_extract(text, PROSE % n, 1), F.lit(""))) for n in (1, 2))
    said = F.when(one.isNotNull() & two.isNotNull(), F.to_variant_object(F.struct(one.alias("category_l1"), two.alias("category_l2")))).when(one.isNotNull(), F.to_variant_object(F.struct(one.alias("category_l1"))))
    return F.when(_is(whole, "OBJECT"), whole).when(F.size(flat) > 0, F.element_at(flat, -1)).otherwise(said)


def unwrapped(df: DataFrame, payload: str, out: str = "answer", depth: int = 6) -> DataFrame:
    """Adds `out`: struct (found, level, answer VARIANT) of a column of JSON texts.

    An object with one of FIELDS is an answer.  Others are looked into, up to `depth` levels, at PATHS: what the first choice's message
    says, the first choice, what the object says, its wrappers; the first answer in that order, depth first, counts.  A text inside is
    searched by `object_in_text` and not unwrapped further.  A payload that is itself a text gives what it holds, answer or not; an object
    without an answer in it gives itself; what is neither, an empty object.  found tells whether it is an answer, level how deep it lay.

    Each row is searched by itself, level by level in arrays: no shuffle, no Python.
    """
    top = F.try_parse_json(F.col(payload))
    node = lambda path, v: F.struct(path.alias("path"), v.alias("v"))
    rows = df.withColumn("_top", top).withColumn("_open0", F.when(_is(F.col("_top"), "OBJECT"), F.array(node(F.array().cast("array<int>"), F.col("_top")))).otherwise(F.array().cast("array<struct<path:array<int>,v:variant>>")))
    for level in range(depth + 1):
        # A text stands for the object in it, and isn't looked into.
        held = lambda n: node(n.path, F.when(_is(n.v, "STRING"), object_in_text(F.try_variant_get(n.v, "$", "string"))).otherwise(n.v))
        rows = rows.withColumn(f"_hits{level}", F.filter(F.transform(f"_open{level}", held), lambda n: _asked_for(n.v)))
        if level < depth:
            inside = lambda n: F.filter(F.array(*[node(F.array_append(n.path, F.lit(i)), F.try_variant_get(n.v, p, "variant")) for i, p in enumerate(PATHS)]), lambda c: _is(c.v, "OBJECT") | _is(c.v, "STRING") & (F.element_at(c.path, -1) != PATHS.index("$.choices[0]")))
            closed = lambda n: _is(n.v, "OBJECT") & ~_asked_for(n.v)
            rows = rows.withColumn(f"_open{level + 1}", F.flatten(F.transform(F.filter(f"_open{level}", closed), inside)))
    hits = F.concat(*[F.col(f"_hits{level}") for level in range(depth + 1)])
    rows = rows.withColumn("_hits", hits).withColumn("_first", F.array_min(F.transform("_hits", lambda n: n.path)))
    best = F.filter("_hits", lambda n: n.path == F.col("_first"))[0].v
    text = object_in_text(F.try_variant_get("_top", "$", "string"))
    empty = F.parse_json(F.lit("{}"))
    answer = F.when(F.size("_hits") > 0, best).when(_is(F.col("_top"), "OBJECT"), F.col("_top")).when(_is(F.col("_top"), "STRING"), F.coalesce(text, empty)).otherwise(empty)
    rows = rows.withColumn("_answer", answer)
    found = F.struct(_asked_for(F.col("_answer")).alias("found"), F.size("_first").alias("level"), F.col("_answer").alias("answer"))
    return rows.withColumn(out, found).select(*df.columns, out)
