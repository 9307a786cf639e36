"""Claims against their evidence (H8, J19): evidence is joined with the nodes it names, then rules decide.

Claims, evidence, nodes and regions are tables; a claim's evidence is short, its quotes are put together by
aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.text import collapse

# Wording of prices, trials, quotes and usage; reasons in reports.
CODES = "USD|EUR|GBP|CAD|AUD|JPY|CNY|INR"
PRICE = rf"(?i)(?:{CODES}|US\$|CA\$|AU\$|[$€£¥₹])\s*\d|\d(?:[\d,.]*\d)?\s*(?:{CODES})\b"
UNITS = "request|call|quer(?:y|ies)|token|credit|point|minute|second|hour|image|video|generation|character|word|gb"
RELATION = rf"(?i)/\s*(?:month|mo|year|yr)\b|\bper\s+(?:month|mo|year|yr|seat|user|member|{UNITS})\b|\b(?:monthly|yearly|one[- ]time|lifetime|price(?:d|s)?|costs?)\b|\b(?:starts?|starting)\s+(?:from|at)\b|\bplans?\s+from\b"
USAGE = rf"(?i)(?:/|\bper\s+)(?:{UNITS})s?\b"
FREE = r"(?i)\bfree\s+(?:plan|tier|forever)\b|(?<!\w)[$€£¥₹]?\s*0\s*/\s*(?:month|year)\b"
TRIAL = r"(?i)\bfree\s+trial\b|\b\d+\s*[- ]?(?:day|week|month)s?\s+free\s+trial\b"
QUOTE = r"(?i)\bcontact\s+(?:us|sales)\b|\bcustom\s+(?:pricing|quote)\b|\brequest\s+(?:a\s+)?quote\b"
CARD, NO_CARD = r"(?i)\b(?:credit|payment)\s+card\s+required\b", r"(?i)\bno\s+(?:credit|payment)\s+card\s+required\b"
ALLOWANCE = r"(?i)\b(?:free|included|at no cost)\b"
MODELS = {
    "subscription": r"(?i)/\s*(?:month|year)|\b(?:monthly|yearly)\b|\bper\s+(?:month|year)\b", "per_seat": r"(?i)(?:/|\bper\s+)(?:seat|user|member)s?\b", "usage_based": USAGE,
    "credit_based": r"(?i)(?:/|\bper\s+)credits?\b", "one_time": r"(?i)\b(?:one[- ]time|lifetime)\b", "custom_quote": QUOTE,
}
REASONS = ["claim has no evidence", "evidence node is missing from DOM map", "evidence is outside the selected pricing region", "evidence quote cannot be located in its DOM node"]
SEVERAL, NOT_ENTAILED, UNKNOWN_TYPE, PASSED = "price evidence contains multiple ISO currencies", "raw claim is not entailed by its evidence", "validator does not support claim type", "deterministic evidence rules passed"


def _entailed(said: Column) -> Column:
    """Whether the evidence says what the claim (claim_type, raw) says; null for types without a rule."""
    raw, kind = F.col("raw"), F.col("claim_type")
    yes, no = raw == "true", raw == "false"
    part = lambda name: F.coalesce(F.get_json_object(raw, f"$.{name}"), F.lit(""))
    holds = lambda text: (text != "") & F.contains(F.lower(said), F.lower(text))
    labels = F.from_json(raw, "array<string>")
    shown = lambda x: F.coalesce(*[F.when(x == name, said.rlike(pattern)) for name, pattern in MODELS.items()], (x == "hybrid") & (F.size(F.filter(labels, lambda y: y != "hybrid")) > 1))
    unit = F.when(part("unit_raw") == "query", "quer(?:y|ies)").otherwise(F.concat(F.regexp_replace(part("unit_raw"), r"([^A-Za-z0-9 ])", r"\\$1"), F.lit("s?")))
    rules = {
        "has_free_plan": yes & said.rlike(FREE), "has_free_trial": (part("available") == "true") & said.rlike(TRIAL), "card_required": (no & said.rlike(NO_CARD)) | (yes & said.rlike(CARD) & ~said.rlike(NO_CARD)), "has_custom_quote": yes & said.rlike(QUOTE),
        "has_paid_pricing": yes & said.rlike(PRICE) & said.rlike(RELATION), "has_usage_pricing": yes & said.rlike(PRICE) & said.rlike(USAGE), "starting_paid_price": holds(part("price_text")) & said.rlike(RELATION), "starting_price_period": F.contains(F.lower(said), F.lower(raw)),
        "usage_rate": holds(part("price_text")) & (part("unit_raw") != "") & F.regexp_like(said, F.concat(F.lit(r"(?i)\b"), unit, F.lit(r"\b"))) & said.rlike(USAGE), "free_allowance": holds(part("quantity_raw")) & holds(part("unit_raw")) & said.rlike(ALLOWANCE),
        "pricing_models": (F.size(labels) > 0) & F.forall(labels, lambda x: F.coalesce(shown(x), F.lit(False))),
    }
    out = None
    for name, rule in rules.items():
        hit = F.coalesce(rule, F.lit(False))
        out = F.when(kind == name, hit) if out is None else out.when(kind == name, hit)
    return out


def validate(claims: DataFrame, evidence: DataFrame, nodes: DataFrame, regions: DataFrame) -> DataFrame:
    """status, confidence and reason of each claim.

    claims: page_id, claim_id, claim_type, raw (true, false, a text or JSON), normalization_status; evidence: page_id,
    claim_id, place, node, container, quote; nodes: page_id, node, text; regions: page_id, root, end (nodes root to
    end are the region).  Of several faults of the evidence the one of the first place counts.
    """
    e = evidence.join(nodes.select("page_id", "node", F.col("text").alias("_text")), ["page_id", "node"], "left").join(regions.select("page_id", "root", "end"), "page_id", "left")
    quote = collapse("quote")
    inside = F.coalesce(F.col("node").between(F.col("root"), F.col("end")) & (F.col("container") == F.col("root")), F.lit(False))
    fault = F.when(F.col("_text").isNull(), REASONS[1]).when(~inside, REASONS[2]).when((quote != "") & ~F.contains(F.lower(collapse("_text")), F.lower(quote)), REASONS[3])
    e = e.select("page_id", "claim_id", "place", quote.alias("_q"), fault.alias("_fault"))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "_q"))), lambda x: x["_q"]), " ")
    g = e.groupBy("page_id", "claim_id").agg(said.alias("_said"), F.min_by("_fault", F.when(F.col("_fault").isNotNull(), F.col("place"))).alias("_fault"))
    j = claims.join(g, ["page_id", "claim_id"], "left")
    codes = F.size(F.array_distinct(F.transform(F.regexp_extract_all("_said", F.lit(rf"(?i)\b({CODES})\b"), F.lit(1)), lambda c: F.upper(c))))
    fault = F.when(F.col("_said").isNull(), REASONS[0]).otherwise(F.col("_fault"))
    several = F.col("claim_type").isin("starting_paid_price", "usage_rate") & (codes > 1)
    ok = _entailed(F.col("_said"))
    status = F.when(fault.isNotNull(), "unsupported").when(several, "conflict").when(ok, "entailed").otherwise("unsupported")
    reason = F.when(fault.isNotNull(), fault).when(several, SEVERAL).when(ok.isNull(), UNKNOWN_TYPE).when(ok, PASSED).otherwise(NOT_ENTAILED)
    sure = F.when(status == "entailed", F.when(F.col("normalization_status").isin("normalized", "not_applicable"), 98).otherwise(92)).otherwise(0)
    return j.select("page_id", "claim_id", status.alias("status"), sure.alias("confidence"), reason.alias("reason"))
