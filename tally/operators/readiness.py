"""Enrichment readiness: what an entry of the catalogue has, lacks and waits for.

Every part is reduced to one row of flags for each key before it is joined, so a hot key combines
early and no join multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names in reports, in their order, and the flag that each stands for.
BLOCKING = {"content_safety": "has_content_safety", "screenshot": "has_screenshot", "published_localization": "has_localization", "name_quality": "has_name_quality", "key_feature": "has_features", "category": "has_category", "source_evidence": "has_source"}
WARNINGS = {"favicon": "has_favicon", "traffic": "has_traffic", "domain_state": "has_domain_state", "pricing": "has_pricing"}
REQUIREMENTS = {"content_safety": "has_content_safety", "screenshot": "has_site_screenshot", "favicon": "has_favicon", "description": "has_description", "key_features": "has_features", "category": "has_category"}


def is_active() -> Column:
    """The active catalogue."""
    return F.col("status").isin("published", "pending_enrich", "pending_review") & F.col("duplicate_of_tool_id").isNull() & (F.trim("normalized_domain") != "")


def lifecycle(tools: DataFrame, assets: DataFrame, localizations: DataFrame, features: DataFrame, categories: DataFrame, sources: DataFrame, traffic: DataFrame, states: DataFrame, prices: DataFrame, bucket: str) -> DataFrame:
    """Adds the flags (P10) to tools.

    assets, localizations, features, categories, sources and prices have tool_id; traffic and states
    have normalized_domain.  A part's rows without a key give no flag.
    """
    published = (F.col("translation_status") == "published") & F.col("published_at").isNotNull()
    filled = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    reviewed = ~F.coalesce("name_review_status", F.lit("legacy_unreviewed")).isin("needs_review", "rejected")
    highlights = F.coalesce(F.json_array_length(F.coalesce("feature_highlights", F.lit("[]"))), F.lit(0)) > 0
    shot, icon = F.col("asset_kind") == "screenshot", F.col("asset_kind") == "favicon"
    parts = [
        (assets.where("is_current"), "tool_id", {"has_screenshot": shot, "has_site_screenshot": shot & (F.col("storage_bucket") == bucket), "has_favicon": icon}),
        (localizations.where(published), "tool_id", {"has_localization": filled("name") & filled("short_description"), "has_name_quality": filled("name") & reviewed, "has_description": filled("short_description"), "_highlights": highlights}),
        (features, "tool_id", {"_features": F.lit(True)}), (categories, "tool_id", {"_category": F.lit(True)}), (sources, "tool_id", {"has_source": F.lit(True)}),
        (traffic, "normalized_domain", {"has_traffic": F.lit(True)}), (states.where("last_crawled_at IS NOT NULL"), "normalized_domain", {"has_domain_state": F.lit(True)}),
        (prices.where("is_active AND last_success_at IS NOT NULL"), "tool_id", {"_priced": F.lit(True)}),
    ]
    out, every = tools, []
    for i, (part, key, flags) in enumerate(parts):
        own = part.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_k{i}")).agg(*[F.max(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])
        out = out.join(own, F.col("id" if key == "tool_id" else key) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        every += flags
    out = out.withColumns({n: F.coalesce(n, F.lit(False)) for n in every})
    return out.withColumns({
        "has_content_safety": F.coalesce(F.col("content_safety_status") == "safe", F.lit(False)), "has_features": F.col("_features") | F.col("_highlights"),
        "has_category": F.col("primary_category_id").isNotNull() | F.col("_category"), "has_pricing": F.coalesce(F.col("pricing_model") != "unknown", F.lit(False)) | F.col("_priced"),
        "category_needs_manual": F.coalesce(F.col("category_classification_status") == "needs_manual", F.lit(False)),
    }).drop("_features", "_highlights", "_category", "_priced")


def lacking(names: dict[str, str]) -> Column:
    """Names whose flag isn't set, in order."""
    return F.filter(F.array(*[F.when(~F.col(c), F.lit(n)) for n, c in names.items()]), lambda x: x.isNotNull())


def readiness(flags: DataFrame, now: Column) -> DataFrame:
    """Adds blocking, warnings, readiness and transitioned_at.

    flags also has previous_readiness and previous_transition; the time of transition changes only
    with the readiness.  An entry that is ready leaves `pending_enrich` for `pending_review`.
    """
    manual = F.when(F.col("category_needs_manual"), F.array(F.lit("category_needs_manual"))).otherwise(F.array().cast("array<string>"))
    out = flags.withColumns({"blocking": lacking(BLOCKING), "warnings": F.concat(lacking(WARNINGS), manual)})
    out = out.withColumn("readiness", F.when(F.size("blocking") == 0, "ready").otherwise("blocked"))
    same = F.col("previous_readiness").eqNullSafe(F.col("readiness"))
    out = out.withColumn("transitioned_at", F.when(same, F.col("previous_transition")).otherwise(now))
    return out.withColumn("status", F.when((F.col("readiness") == "ready") & (F.col("status") == "pending_enrich"), "pending_review").otherwise(F.col("status")))


def missing_requirements() -> Column:
    """What asset work still has to bring, in fixed order; a category that waits for a person is waived."""
    return F.filter(lacking(REQUIREMENTS), lambda x: (x != "category") | ~F.col("category_needs_manual"))


def lacks_assets() -> Column:
    """Whether any of the six branches asks for asset work."""
    unsafe = F.col("status").isin("pending_enrich", "pending_review") & ~F.col("has_content_safety")
    return unsafe | ~F.col("has_site_screenshot") | ~F.col("has_favicon") | ~F.col("has_description") | ~F.col("has_features") | ~F.col("has_category")


def queueable(now: Column, stale: Column) -> Column:
    """Whether an entry's task may be queued (P13): none yet, failed and due, queued, expired, or done long ago.

    Columns task_tool_id, task_status, attempts, max_attempts, next_retry_at, lease_expires_at,
    dead_letter_at, task_updated_at come from a left join.
    """
    alive, status = F.col("dead_letter_at").isNull(), F.col("task_status")
    failed = status.isin("failed", "sync_failed") & (F.col("attempts") < F.col("max_attempts")) & (F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= now))
    expired = (status == "processing") & (F.col("lease_expires_at") <= now)
    again = F.col("task_tool_id").isNull() | (alive & (failed | (status == "queued") | expired)) | ((status == "done") & (F.col("task_updated_at") < stale))
    return F.coalesce(again, F.lit(False))


def already_done(raw: str, status: str, backfill: str, prompt: str) -> Column:
    """Whether a classification came from this backfill or this prompt (P15): by its JSON, or by text where that isn't valid."""
    text = F.col(raw)
    said = (F.get_json_object(raw, "$.backfill") == backfill) | text.contains(f'"backfill":"{backfill}"') | ((F.get_json_object(raw, "$.prompt_version") == prompt) & (F.get_json_object(raw, "$.mode") == "hierarchical"))
    return F.coalesce((F.col(status) == "auto_ok") & (F.trim(text) != "") & said, F.lit(False))


def first_match(slugs: DataFrame, known: DataFrame, keys: list[str], slug: str, priority: str) -> DataFrame:
    """Of each key's slugs the known one that comes first (P19); keys without any are left out.  known: slug and other columns, a small dimension."""
    found = slugs.join(F.broadcast(known.withColumnRenamed(slug, "_slug")), F.col(slug) == F.col("_slug"))
    rest = [c for c in known.columns if c != slug]
    best = found.groupBy(*keys).agg(F.min_by(F.struct(slug, *rest), F.struct(priority, slug)).alias("_b"))
    return best.select(*keys, F.col(f"_b.{slug}").alias(slug), *[F.col(f"_b.{c}").alias(c) for c in rest])
