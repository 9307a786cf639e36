"""The first good extraction of several attempts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.answers import unwrapped


def has_fields(answer: Column, required: list[str], lists: list[str] = (), empty_lists: bool = False) -> Column:
    """Whether a VARIANT object has all required fields with a value that isn't blank; with `empty_lists` those in `lists` may be empty
    lists.  Without required fields any object but the empty one will do."""
    kind = lambda k: F.coalesce(F.schema_of_variant(F.try_variant_get(answer, f"$.{k}", "variant")), F.lit("VOID"))
    text = lambda k: F.trim(F.coalesce(F.try_variant_get(answer, f"$.{k}", "string"), F.lit("")))

    def one(k: str) -> Column:
        blank = (kind(k) == "VOID") | ((kind(k) == "STRING") & (text(k) == "")) | text(k).isin("[]", "{}")
        return F.when(kind(k).startswith("ARRAY"), F.lit(True) if empty_lists and k in lists else text(k) != "[]").otherwise(~blank)

    if not required:
        return F.coalesce(F.to_json(answer) != "{}", F.lit(False))
    return F.coalesce(reduce(lambda a, b: a & b, [one(k) for k in required]), F.lit(False))


def first_extraction(attempts: DataFrame, keys: list[str], order: list[str], required: list[str], lists: list[str] = (), empty_lists: bool = False) -> DataFrame:
    """Of each key's attempts in their order (addresses, then models) the first whose payload, unwrapped, has the required fields.

    attempts: keys, order, url, model, payload (JSON text or null), error, retryable.  Returns keys, url, model, answer (JSON text), errors (what went
    wrong before it, or altogether, in order), retryable (of a key without a good attempt: whether any may be tried again, else null).
    An attempt with an error has no payload that counts; one that lacks fields failed by `empty_schema_result` and may be tried again.
    """
    rows = unwrapped(attempts, "payload", "_a").withColumn("_good", F.col("error").isNull() & has_fields(F.col("_a.answer"), required, lists, empty_lists))
    rows = rows.withColumn("_place", F.struct(*order)).withColumn("_answer", F.to_json("_a.answer"))
    said = F.when(F.col("error").isNull(), F.concat("url", F.lit("/"), F.coalesce("model", F.lit("default")), F.lit(": empty_schema_result"))).otherwise(F.concat("url", F.lit(": "), F.substring("error", 1, 220)))
    g = rows.groupBy(*keys).agg(
        F.min_by(F.struct("url", "model", "_answer"), F.when(F.col("_good"), F.col("_place"))).alias("_b"), F.min(F.when(F.col("_good"), F.col("_place"))).alias("_first"),
        F.array_sort(F.collect_list(F.when(~F.col("_good"), F.struct(F.col("_place").alias("at"), said.alias("said"), (F.col("error").isNull() | F.coalesce("retryable", F.lit(True))).alias("again"))))).alias("_failed"),
    )
    before = F.when(F.col("_first").isNull(), F.col("_failed")).otherwise(F.filter("_failed", lambda x: x["at"] < F.col("_first")))
    found = F.col("_first").isNotNull()
    return g.select(
        *keys, F.when(found, F.col("_b.url")).alias("url"), F.when(found, F.col("_b.model")).alias("model"), F.when(found, F.col("_b._answer")).alias("answer"),
        F.transform(before, lambda x: x["said"]).alias("errors"), F.when(~found, F.exists("_failed", lambda x: x["again"])).alias("retryable"),
    )
