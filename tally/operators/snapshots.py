"""Snapshots of pages: content-addressed artifacts, bundles, and what a new snapshot must capture (H9)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Kinds of artifacts, how long they are kept, where they lie, what counts as a currency, the bundle's format.
ARTIFACT_TYPES = ["html", "rendered_html", "text", "structured_data", "dom_map", "screenshot"]
RETENTION_CLASSES = ["published_evidence", "review_evidence", "gold_evidence", "changed_snapshot", "diagnostic", "ephemeral"]
OBJECT_FOLDER = "pricing/artifacts"
CURRENCY_CODE = r"(?i)\b(?:USD|EUR|GBP|CAD|AUD|JPY|CNY|INR)\b"
CURRENCY_SYMBOL = r"US\$|CA\$|AU\$|[$€£¥₹]"
FORMAT_VERSION = "pricing-snapshot-v1"


def parts_of(html: Column, rendered: Column, original: Column, text: Column, structured: Column, dom_map: Column) -> Column:
    """The parts of one snapshot: array of (artifact_type, body, content_type).

    A rendered page is kept beside the page as it was sent, where that is known; otherwise it stands alone.
    """
    part = lambda kind, body, mime: F.struct(kind.alias("artifact_type"), body.alias("body"), F.lit(mime).alias("content_type"))
    page, rendered = "text/html; charset=utf-8", F.coalesce(rendered, F.lit(False))
    pages = F.when(rendered & original.isNotNull(), F.array(part(F.lit("html"), original, page), part(F.lit("rendered_html"), html, page)))
    pages = pages.otherwise(F.array(part(F.when(rendered, "rendered_html").otherwise("html"), html, page)))
    return F.concat(pages, F.array(part(F.lit("text"), text, "text/plain; charset=utf-8"), part(F.lit("structured_data"), structured, "application/json"), part(F.lit("dom_map"), dom_map, "application/json")))


def artifacts(parts: DataFrame, retention: str = "changed_snapshot", state: str = "default") -> DataFrame:
    """Adds hash, key, size, class and state to rows with artifact_type and body (text or binary; null counts as empty).

    An unknown type fails the job when a row has it, an unknown class at once.
    """
    if retention not in RETENTION_CLASSES:
        raise ValueError(f"unknown retention class: {retention}")
    body = F.coalesce(F.col("body").cast("binary"), F.lit(b""))
    kind = F.when(F.col("artifact_type").isin(ARTIFACT_TYPES), F.col("artifact_type")).otherwise(F.raise_error(F.concat(F.lit("unknown artifact type: "), F.coalesce("artifact_type", F.lit("null")))).cast("string"))
    hashed = parts.withColumns({"content_hash": F.sha2(body, 256), "byte_size": F.octet_length(body).cast("long")})
    return hashed.withColumns({"object_key": F.concat_ws("/", F.lit(OBJECT_FOLDER), kind, "content_hash"), "retention_class": F.lit(retention), "state_key": F.lit(state or "default")})


def currency_context(text: Column) -> Column:
    """JSON of the currency codes and symbols that a text shows, for diagnosis only."""
    found = lambda pattern: F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))))
    codes = F.array_sort(F.array_distinct(F.transform(found(CURRENCY_CODE), F.upper)))
    return F.to_json(F.struct(codes.alias("currency_codes"), found(CURRENCY_SYMBOL).alias("currency_symbols"), F.lit(True).alias("diagnostic_only")))


def bundles(made: DataFrame, keys: list[str]) -> DataFrame:
    """One row a snapshot: hash of its sorted object keys under the format's name, number of parts, bytes.  Equal parts, in any order,
    give equal hashes."""
    named = F.array_join(F.sort_array(F.collect_list("object_key")), "\n")
    return made.groupBy(*keys).agg(F.sha2(F.concat(F.lit(FORMAT_VERSION + "\n"), named), 256).alias("bundle_hash"), F.count("*").alias("parts"), F.sum("byte_size").alias("bytes"))


def previous_in_key(rows: DataFrame, keys: list[str], order: str, value: str, out: str, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Adds `out`: `value` of the row before within the keys (null for the first), by ranges of `order` (unique within the keys), so
    that a hot key runs over many tasks.  `write` stores the ranges."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = write(rows.repartitionByRange(n, *keys, order).withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy(*keys, "_range").orderBy(order)
    marked = ranged.withColumns({"_before": F.lag(value).over(inside), "_first": F.row_number().over(inside) == 1})
    last = ranged.groupBy(*keys, "_range").agg(F.max_by(F.struct(value), order)[value].alias("_last"))
    last = last.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"), F.lag("_last").over(Window.partitionBy(*keys).orderBy("_range")).alias("_behind"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.col("_range") == F.col("_r"))
    return marked.join(last, same).select(*rows.columns, F.when(F.col("_first"), F.col("_behind")).otherwise(F.col("_before")).alias(out))


def capture_flags(previous: Column, current: Column, pipeline_changed: Column, visual_fallback: Column) -> dict[str, Column]:
    """What a snapshot must do: a region is new if there is none to compare with or its hash differs."""
    changed = previous.isNull() | (previous == "") | ~previous.eqNullSafe(current)
    return {"region_changed": changed, "run_extraction": changed | F.coalesce(pipeline_changed, F.lit(False)), "capture_screenshot": changed | F.coalesce(visual_fallback, F.lit(False))}


def uploads(made: DataFrame, stored: DataFrame, snapshot: str) -> DataFrame:
    """What must be uploaded: of each object key that isn't stored (one column object_key) one row, with the first snapshot that has it.

    made: artifacts with their snapshot and capture_screenshot; screenshots count only where one is captured.  Keys combine before the
    shuffle, so an object that a third of all snapshots share is one row a task.
    """
    wanted = made.where((F.col("artifact_type") != "screenshot") | F.col("capture_screenshot"))
    first = wanted.groupBy("object_key").agg(F.min(snapshot).alias(snapshot), F.any_value("artifact_type").alias("artifact_type"), F.any_value("byte_size").alias("byte_size"), F.count("*").alias("holders"))
    return first.join(stored.select(F.col("object_key")), "object_key", "left_anti")
