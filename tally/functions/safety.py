"""Content safety by rules (H-19): strong and weak signals, safe contexts, a model's label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import _c

# Patterns of adult products.
STRONG_DOMAIN = r"(?i)porn|porno|pornify|pornjoy|pornwork|hentai|nsfw|deepnude|nudify|undress|clothoff|rule34|sexchat|aiporn"
STRONG = {
    "porn": r"(?i)\b(?:ai\s*)?porn(?:ographic)?\b",
    "nsfw": r"(?i)\bnsfw\b",
    "hentai": r"(?i)\bhentai\b",
    "deepnude": r"(?i)\bdeep\s*nude\b|\bdeepnude\b",
    "nudify": r"(?i)\bnudif(?:y|ies|ied)\b",
    "undress-ai": r"(?i)\b(?:ai\s*)?undress(?:\s+(?:app|ai|photo|image|generator))?\b",
    "remove-clothes": r"(?i)\bremove\s+(?:her\s+|their\s+)?clothes\b",
    "erotic-content": r"(?i)\berotic(?:a|\s+(?:story|chat|content|image|roleplay))?\b",
    "sexting": r"(?i)\bsexting\b",
    "adult-generator": r"(?i)\badult\s+(?:content|image|video)\s+generator\b",
    "explicit-sexual": r"(?i)\b(?:nude|naked)\b.{0,50}\b(?:sex|sexual|generator|image|video)\b",
    "xxx": r"(?i)\bxxx\b",
    "chinese-porn": r"色情|成人视频|黄片|裸照|脱衣|成人图片",
}
WEAK = {
    "uncensored": r"(?i)\buncensored\b",
    "unrestricted": r"(?i)\bunrestricted\b",
    "spicy": r"(?i)\bspicy\b",
    "adult": r"(?i)\badult\b",
    "ai-girlfriend": r"(?i)\bai\s+girlfriend\b",
    "ai-boyfriend": r"(?i)\bai\s+boyfriend\b",
    "fantasy-companion": r"(?i)\b(?:fantasy|intimate)\s+(?:ai\s+)?(?:companion|chat)\b",
    "no-filter-roleplay": r"(?i)\b(?:no\s+filter|unfiltered)\b.{0,50}\b(?:roleplay|chat|image|video)\b",
}
SAFE_CONTEXT = r"(?i)\b(?:llm\s+safety|red\s+team|adversarial\s+attack|business\s+(?:domain\s+)?model|data\s+model|code\s+generation|application\s+model)\b"


def _signals(text: Column, kind: str, patterns: dict[str, str]) -> list[Column]:
    return [F.when(text.rlike(p), F.lit(f"{kind}:{label}")) for label, p in patterns.items()]


def content_safety(text, host, label=None, confidence=None) -> Column:
    """status, score, confidence, reason and evidence.

    Only strong rules reject; a model's word alone goes to a person.
    """
    t, h = F.coalesce(_c(text), F.lit("")), F.regexp_replace(F.lower(F.coalesce(_c(host), F.lit(""))), r"^www\.", "")
    model = F.regexp_replace(F.lower(F.trim(F.coalesce(F.lit(None).cast("string") if label is None else _c(label), F.lit("")))), "-", "_")
    stated = F.greatest(F.lit(0), F.least(F.lit(100), F.coalesce((F.lit(None) if confidence is None else _c(confidence)).try_cast("int"), F.lit(0))))
    there = lambda xs: F.filter(F.array(*xs), lambda x: x.isNotNull())
    strong = there([F.when(h.rlike(STRONG_DOMAIN), F.concat(F.lit("domain:"), h)), *_signals(t, "strong", STRONG)])
    weak = there(_signals(t, "weak", WEAK))
    n, safe = F.size(weak), t.rlike(SAFE_CONTEXT)

    def verdict(status: str, score, conf, reason, evidence: Column) -> Column:
        as_int = lambda x: (x if isinstance(x, Column) else F.lit(x)).cast("int")
        return F.struct(F.lit(status).alias("status"), as_int(score).alias("score"), as_int(conf).alias("confidence"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"), F.slice(evidence, 1, 12).alias("evidence"))

    signal = F.array(F.lit("model:nsfw"))
    return (
        F.when(F.size(strong) > 0, verdict("nsfw", F.least(F.lit(100), 95 + F.least(F.size(strong) - 1, F.lit(5))), 98, "explicit_adult_product_signal", strong))
        .when(model.isin("nsfw", "adult", "explicit"), verdict("needs_review", F.greatest(F.lit(75), stated), F.greatest(F.lit(70), stated), "model_detected_adult_context", F.concat(weak, signal)))
        .when(model.isin("uncertain", "needs_review", "unknown"), verdict("needs_review", F.greatest(F.lit(45), 40 + n * 12), F.greatest(F.lit(60), stated), "content_safety_uncertain", weak))
        .when((n > 0) & ~safe, verdict("needs_review", F.least(F.lit(85), 40 + n * 12), 72, "ambiguous_adult_context", weak))
        .when((model == "safe") & (stated >= 70), verdict("safe", F.when(n > 0, 15).otherwise(5), stated, F.when(n > 0, "safe_context_disambiguated").otherwise("model_confirmed_safe"), weak))
        .when((n > 0) & safe, verdict("safe", 15, 82, "safe_context_disambiguated", weak))
        .otherwise(verdict("needs_review", 25, F.greatest(F.lit(50), stated), "insufficient_content_safety_evidence", weak))
    )
