"""Plans and their checks, names, assets and small payloads.

A plan is a struct with one price; a page's plans are a short array, so its checks are expressions over
that array and need no join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import _c, let, to_decimal
from .pricing import currency, interval, unit
from .text import collapse, registrable

# Messages, patterns and scores of the reference's reports.
PRICE_TEXT = r"(?i)(?:US\$|\$|₹|USD|EUR|GBP|INR)\s*\d|\d(?:[\d,]*\d)?(?:\.\d{1,4})?\s*(?:USD|EUR|GBP|INR)"
POLLUTED = r"\b(raise[sd]?|funding|students?|graduates?|academy|this month only|additional cost|traditional)\b"
KINDS, INTERVALS = ["recurring", "one_time", "usage", "custom_quote"], ["monthly", "yearly", "one_time", "usage", "custom"]
NAME_RULES = [
    ("anti_bot_name", r"(?i)^(?:just\s+(?:a\s+moment|wait)|checking\s+your\s+browser|verify\s+(?:you\s+are\s+human|your\s+identity)|attention\s+required|security\s+check)\b"),
    ("access_denied_name", r"(?i)^(?:access\s+denied|forbidden|unauthorized|request\s+(?:was\s+)?blocked|error\s*403)\b"),
    ("error_page_name", r"(?i)^(?:404|not\s+found|page\s+not\s+found|500|internal\s+server\s+error|service\s+unavailable)\b"),
    ("generic_page_name", r"(?i)^(?:home|homepage|welcome|index|default\s+page)$"),
]
MARKETING, TITLE_SPLIT = r"(?i)^(?:best|free|online|official)\b", r"\s+(?:\||[–—·])\s+|\s+-\s+|:\s+"
NAME_AUTO = 85
ASSET_TYPES = [("image/png", ".png"), ("image/svg", ".svg"), ("image/webp", ".webp"), ("image/jpeg", ".jpg"), ("image/jpg", ".jpg"), ("image/x-icon", ".ico"), ("image/vnd.microsoft.icon", ".ico")]
MIME = {".png": "image/png", ".svg": "image/svg+xml", ".webp": "image/webp", ".jpg": "image/jpeg"}


def snippet(x, limit: int) -> Column:
    return F.trim(F.substring(collapse(x), 1, limit))


def plan_key(name) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(_c(name)), "[^a-z0-9]+", "_"), "^_+|_+$", ""), 1, 80)


def comparable_name(x) -> Column:
    """A plan's name for comparison: words of letters and digits without `plan` (F32)."""
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(_c(x), F.lit(""))), "[^a-z0-9]+", " "))
    return F.trim(F.regexp_replace(F.regexp_replace(words, r"\bplan\b", ""), r"\s+", " "))


def plan(name, amount, symbol, context, index) -> Column:
    """A plan from a price on a page (H13); without an amount it is a quote on request."""
    quote, text = _c(amount).isNull(), F.coalesce(_c(context), F.lit(""))
    kind = F.when(quote, "custom_quote").when(text.rlike(r"(?i)one[- ]?time|lifetime"), "one_time").otherwise("recurring")
    shown = snippet(name, 80)
    shown = F.when(shown != "", shown).when(quote, "Enterprise").otherwise(F.concat(F.lit("Plan "), _c(index).cast("string")))
    return F.struct(
        shown.alias("name"), plan_key(shown).alias("key"), kind.alias("kind"), _c(amount).cast("decimal(38,18)").alias("amount"), F.when(~quote, currency(symbol)).alias("currency"), F.when(kind == "recurring", interval(text)).alias("interval"),
        unit(text).alias("unit"), quote.alias("custom_quote"), text.rlike("(?i)from|starting").alias("starting_at"), shown.rlike("(?i)enterprise|contact").alias("is_enterprise"), snippet(text, 180).alias("display_text"),
    )


MODEL_PLAN = """name string, source_plan_key string, is_enterprise boolean, prices array<struct<kind:string,amount:string,currency:string,billing_interval:string,unit:string,custom_quote:boolean,starting_at:boolean,display_text:string>>"""


def model_plans(raw) -> Column:
    """Plans of a model's JSON array (F57): the first price of each counts; unknown kinds and intervals are put right."""

    def one(p: Column, i: Column) -> Column:
        price = F.get(p["prices"], F.lit(0))
        amount = to_decimal(F.nullif(price["amount"], F.lit("")))
        quote = F.coalesce(price["custom_quote"], F.lit(False)) | amount.isNull() | F.coalesce(price["kind"] == "custom_quote", F.lit(False))
        usual = F.when(quote, "custom_quote").otherwise("recurring")
        name = snippet(p["name"], 80)
        name = F.when(name != "", name).when(quote, "Enterprise").otherwise(F.concat(F.lit("Plan "), (i + 1).cast("string")))
        key = snippet(p["source_plan_key"], 80)
        return F.struct(
            name.alias("name"), F.when(key != "", key).otherwise(plan_key(name)).alias("key"), F.when(price["kind"].isin(KINDS), price["kind"]).otherwise(usual).alias("kind"), F.when(~quote, amount).alias("amount"), F.when(~quote, currency(F.coalesce(price["currency"], F.lit("USD")))).alias("currency"),
            F.when(price["billing_interval"].isin(INTERVALS), price["billing_interval"]).alias("interval"), F.nullif(snippet(price["unit"], 40), F.lit("")).alias("unit"), quote.alias("custom_quote"), F.coalesce(price["starting_at"], F.lit(False)).alias("starting_at"),
            (F.coalesce(p["is_enterprise"], F.lit(False)) | name.rlike("(?i)enterprise|contact")).alias("is_enterprise"), snippet(price["display_text"], 180).alias("display_text"),
        )

    return F.transform(F.from_json(_c(raw), f"array<struct<{MODEL_PLAN}>>".replace(" string", ":string").replace(" boolean", ":boolean").replace("prices array", "prices:array")), one)


def in_order(plans) -> Column:
    """Free plans, then monthly, yearly and other ones, cheap ones first (O8); equal ones keep their order."""
    amount = lambda p: F.coalesce(p["amount"], F.lit(0).cast("decimal(38,18)"))
    rank = lambda p: F.when(amount(p) == 0, 0).when(p["interval"] == "monthly", 1).when(p["interval"] == "yearly", 2).otherwise(3)
    keyed = F.transform(_c(plans), lambda p, i: F.struct(rank(p).alias("r"), amount(p).alias("a"), i.alias("i"), p.alias("p")))
    return F.transform(F.array_sort(keyed), lambda x: x["p"])


def _messages(items: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(items, lambda m: m.isNotNull())))


def price_errors(plans) -> Column:
    """Prices whose text and structure disagree."""

    def one(p: Column) -> Column:
        said, name = F.coalesce(p["display_text"], F.lit("")).rlike(PRICE_TEXT), snippet(p["name"], 80)
        quote, known = p["custom_quote"] | (p["kind"] == "custom_quote"), F.coalesce(p["currency"], F.lit("")) != ""
        say = lambda when, text: F.when(when, F.concat(F.lit(text), name))
        return F.array(
            say(said & (p["amount"].isNull() | ~known), "Explicit price text missing structured amount/currency: "),
            say(said & quote, "Explicit price text marked as custom quote: "),
            say(~quote & p["amount"].isNotNull() & ~known, "Structured price missing currency: "),
        )

    return _messages(F.flatten(F.transform(_c(plans), one)))


def several_currencies(plans) -> Column:
    """Whether an array of plans names more than one currency."""
    return F.size(F.array_distinct(F.filter(F.transform(_c(plans), lambda p: p["currency"]), lambda c: F.coalesce(c, F.lit("")) != ""))) > 1


def repeated_names(plans, allowed: list[str]) -> Column:
    """Whether a name stands twice, but for some."""
    names = F.filter(F.transform(_c(plans), lambda p: F.lower(F.trim(p["name"]))), lambda n: (n != "") & ~n.isin(allowed))
    return F.size(F.array_distinct(names)) < F.size(names)


def consistency_errors(plans) -> Column:
    return _messages(F.array(F.when(repeated_names(plans, ["free", "enterprise", "custom"]), "Duplicate plan names in extracted pricing"), F.when(several_currencies(plans), "Multiple currencies in extracted pricing")))


def _first_prices(plans) -> Column:
    """Comparable name to the last public price of that name."""
    public = F.filter(_c(plans), lambda p: ~p["custom_quote"] & p["amount"].isNotNull() & (F.coalesce(p["currency"], F.lit("")) != ""))
    named = F.transform(public, lambda p: F.struct(comparable_name(p["name"]).alias("k"), p["amount"].alias("amount"), p["currency"].alias("currency"), p["name"].alias("name")))
    return F.filter(named, lambda p: p["k"] != "")


def _last_of_each(prices: Column) -> Column:
    return let(prices, lambda every: F.filter(every, lambda p, i: ~F.exists(F.slice(every, i + 2, F.size(every)), lambda q: q["k"] == p["k"])))


def price_conflicts(structured, visible) -> Column:
    """Names whose structured price differs from the visible one."""
    a, b = _last_of_each(_first_prices(structured)), _last_of_each(_first_prices(visible))
    differs = lambda p, q: (q["k"] == p["k"]) & ~((q["amount"] == p["amount"]) & (q["currency"] == p["currency"]))
    return let(b, lambda shown: F.transform(F.filter(a, lambda p: F.exists(shown, lambda q: differs(p, q))), lambda p: p["name"]))


def review_reasons(plans, text_score, found) -> Column:
    """Why a rule's plans should be checked by a model (H14); none for pages that weren't found."""
    p = _c(plans)
    text = lambda x: F.coalesce(x["display_text"], F.lit(""))
    some = lambda f: F.exists(p, lambda x: F.coalesce(f(x), F.lit(False)))
    reasons = F.array(
        F.when(some(lambda x: F.lower(F.trim(x["name"])).rlike(r"^plan\s+\d+$")), "generic_plan_name"), F.when(repeated_names(p, ["free", "enterprise"]), "duplicate_plan_names"), F.when(_c(text_score) < 18, "low_text_quality"),
        F.when(some(lambda x: F.length(text(x)) > 140), "long_price_context"), F.when(some(lambda x: F.lower(text(x)).rlike(POLLUTED)), "polluted_price_context"),
        F.when(some(lambda x: text(x).contains("₹") & ~x["currency"].eqNullSafe(F.lit("INR"))), "currency_mismatch"), F.when(several_currencies(p), "mixed_currencies"),
    )
    return F.when(~_c(found), F.array().cast("array<string>")).when(F.size(p) == 0, F.array(F.lit("rules_found_no_plans"))).otherwise(_messages(reasons))


def plan_errors(plans, status, strict, in_context) -> Column:
    """All errors of a page's plans, in order of the checks."""
    p, code = _c(plans), _c(status)
    paid = F.exists(p, lambda x: x["custom_quote"] | F.coalesce(x["amount"] > 0, F.lit(False)))
    free = F.exists(p, lambda x: F.lower(x["name"]) == "free")
    first = F.array(F.when((code < 200) | (code >= 400), F.concat(F.lit("HTTP "), code.cast("string"))), F.when((code == 200) & ~_c(strict), "Final URL is not a strict pricing page"), F.when((code == 200) & ~_c(in_context), "Final URL lost source context"), F.when(F.size(p) == 0, "No public pricing plans found"))
    last = F.array(F.when((F.size(p) > 0) & ~paid & ~free, "No paid, free, or custom-quote plan found"))
    return F.filter(F.concat(first, price_errors(p), last), lambda m: m.isNotNull())


def verdict(plans, errors) -> Column:
    """Review status and confidence of a page."""
    good = (F.size(_c(errors)) == 0) & (F.size(_c(plans)) > 0)
    return F.struct(F.when(good, "approved").otherwise("manual_review").alias("status"), F.when(good, 82).when(F.size(_c(plans)) > 0, 45).otherwise(25).alias("confidence"))


def final_stage(status, by_model, page_status, by_browser) -> Column:
    """The stage that a page's prices came from."""
    stage = F.when(_c(status) != "approved", "manual_review").when(_c(by_model), "openai").when(F.trim(_c(page_status)) == "contact_sales", "contact_sales").otherwise("rule")
    return F.when(_c(by_browser) & (stage != "contact_sales"), F.concat(F.lit("browser_run_"), stage)).otherwise(stage)


# Below this quality a page's text is worth rendering; below this confidence a better model is asked; what is left of
# confidence where a check was needed and no model answered.
RENDER_BELOW, LEAST_CONFIDENCE, UNCHECKED_CONFIDENCE = 8, 60, 55


def should_render(review, http_status, html, page_status, strict, score, errors) -> Column:
    """Whether a page should be rendered by a browser (H21): it was found, at a strict address, isn't approved, and its text is poor or no
    plans were seen in it."""
    poor = (_c(score) < RENDER_BELOW) | F.exists(_c(errors), lambda e: e.contains("No public pricing plans found"))
    seen = (_c(http_status) == 200) & (F.coalesce(_c(html), F.lit("")) != "") & _c(page_status).isin("found", "not_found")
    return F.coalesce((_c(review) != "approved") & seen & _c(strict) & poor, F.lit(False))


def escalated(review, confidence, errors, page_status, needs_check, reasons, answers) -> Column:
    """What models make of a page (H21): struct (status, confidence, errors, model, asked).

    answers: array of (model, status, confidence, errors), the cheapest model first; a null status is an empty answer.  Models are asked in
    turn until one approves with enough confidence; else the last that answered counts.  They are asked at all only for pages that were
    found and that the rules don't approve or that need a check.  A check that nobody answered makes the page a matter for a person.
    """
    r, n, said = _c(review), _c(confidence), F.filter(_c(answers), lambda a: a["status"].isNotNull())
    asks = F.coalesce(((r != "approved") | _c(needs_check)) & (F.size(_c(answers)) > 0) & (_c(page_status) == "found"), F.lit(False))
    good = lambda a: F.coalesce((a["status"] == "approved") & (a["confidence"] >= LEAST_CONFIDENCE), F.lit(False))
    first = F.get(F.filter(F.transform(_c(answers), lambda a, i: F.struct(good(a).alias("good"), (i + 1).alias("n"))), lambda x: x["good"]), F.lit(0))["n"]
    final = F.coalesce(F.get(F.filter(said, good), F.lit(0)), F.try_element_at(said, F.lit(-1)))
    out = lambda s, c, e, m: F.struct(s.alias("status"), c.cast("int").alias("confidence"), e.alias("errors"), m.alias("model"), F.when(asks, F.coalesce(first, F.size(_c(answers)))).otherwise(0).alias("asked"))
    none = F.lit(None).cast("string")
    unsure = F.concat(_c(errors), F.array(F.concat(F.lit("Rule extraction requires model verification: "), F.array_join(_c(reasons), ", "))))
    by_rule = out(r, n, _c(errors), none)
    return F.when(asks & final.isNotNull(), out(final["status"], final["confidence"], final["errors"], final["model"])).when(asks & _c(needs_check), out(F.lit("manual_review"), F.least(n, F.lit(UNCHECKED_CONFIDENCE)), unsure, none)).otherwise(by_rule)


# -- names, assets, small payloads ------------------------------------------------------------------


def brand_label(host) -> Column:
    return F.lower(F.trim(F.substring_index(registrable(host), ".", 1)))


def fallback_name(host) -> Column:
    """A name from the domain (F39): words between hyphens, their first letters raised."""
    parts = F.filter(F.split(brand_label(host), "[-_]+"), lambda p: p != "")
    raised = F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1000)))
    return F.coalesce(F.nullif(F.substring(F.array_join(raised, " "), 1, 120), F.lit("")), F.lit("Tool"))


def compact(x) -> Column:
    return F.regexp_replace(F.lower(_c(x)), "[^a-z0-9]+", "")


def matches_brand(name, host) -> Column:
    a, b = compact(name), compact(brand_label(host))
    return (a != "") & (b != "") & (a.contains(b) | b.contains(a))


def name_problem(x) -> Column:
    """Why a text can't be a product's name; empty if it can."""
    name = snippet(x, 160)
    out = F.when(name == "", "empty_name")
    for reason, pattern in NAME_RULES:
        out = out.when(name.rlike(pattern), reason)
    out = out.when(F.length(name) > 80, "name_too_long").when(name.contains("|") | name.rlike(r"\s[–—]\s"), "unsplit_page_title")
    return out.when(name.rlike(MARKETING) & (F.size(F.split(name, r"\s+")) >= 4), "marketing_page_title").otherwise("")


def title_parts(title) -> Column:
    parts = F.transform(F.split(snippet(title, 200), TITLE_SPLIT), lambda p: F.regexp_replace(snippet(p, 120), r"^[ \-|–—:·]+|[ \-|–—:·]+$", ""))
    return F.filter(parts, lambda p: p != "")


def product_name(candidates, host) -> Column:
    """The best of array<struct<name, source, score>> and its review status.

    A name that matches the domain's brand gains 15, long ones lose; of equals the first counts; without a
    valid one the name comes from the domain.
    """
    fit = F.filter(_c(candidates), lambda c: name_problem(c["name"]) == "")
    score = lambda c: c["score"] + F.when(matches_brand(c["name"], host), 15).otherwise(0) - F.when(F.length(c["name"]) > 50, 15).otherwise(0) - F.when(F.size(F.split(c["name"], r"\s+")) > 8, 10).otherwise(0)
    rated = F.transform(fit, lambda c, i: F.struct(F.greatest(F.lit(0), F.least(F.lit(100), score(c))).alias("score"), (-i).alias("place"), c["name"].alias("name"), c["source"].alias("source")))
    best = F.array_max(rated)
    sure = F.coalesce(best["score"], F.lit(45))
    return F.struct(F.coalesce(best["name"], fallback_name(host)).alias("name"), F.coalesce(best["source"], F.lit("domain_fallback")).alias("source"), sure.alias("confidence"), F.when(sure >= NAME_AUTO, "auto_approved").otherwise("needs_review").alias("review"))


def asset_extension(url, content_type) -> Column:
    kind, out = F.lower(F.coalesce(_c(content_type), F.lit(""))), None
    for name, extension in ASSET_TYPES:
        out = F.when(kind.contains(name), extension) if out is None else out.when(kind.contains(name), extension)
    ending = F.replace(F.lower(F.regexp_extract(F.coalesce(F.try_parse_url(_c(url), F.lit("PATH")), F.lit("")), r"(?i)\.(ico|png|svg|jpg|jpeg|webp)$", 1)), F.lit("jpeg"), F.lit("jpg"))
    return out.otherwise(F.when(ending != "", F.concat(F.lit("."), ending)).otherwise(".ico"))


def asset_mime(url, content_type) -> Column:
    kind = F.lower(F.trim(F.substring_index(F.coalesce(_c(content_type), F.lit("")), ";", 1)))
    extension, out = asset_extension(url, F.lit("")), F.when(kind.startswith("image/"), kind)
    for name, mime in MIME.items():
        out = out.when(extension == name, mime)
    return out.otherwise("image/x-icon")


def asset_url(base, key) -> Column:
    """The public address of an object; each segment of its key is encoded."""
    b = F.regexp_replace(F.coalesce(_c(base), F.lit("")), "/+$", "")
    b = F.when(b.rlike("^https?://"), b).otherwise(F.concat(F.lit("https://"), b))
    path = F.array_join(F.transform(F.split(_c(key), "/"), lambda p: F.replace(F.url_encode(p), F.lit("+"), F.lit("%20"))), "/")
    return F.when(F.coalesce(_c(base), F.lit("")) != "", F.concat_ws("/", b, path))


def created_at(raw) -> Column:
    """When a domain was registered (F41): the first event named registration, else created, creation or registered."""
    events = F.from_json(_c(raw), "events array<struct<eventAction:string,eventDate:string>>")["events"]
    dated = F.filter(F.transform(events, lambda e: F.struct(F.lower(e["eventAction"]).alias("what"), e["eventDate"].try_cast("timestamp").alias("at"))), lambda e: e["at"].isNotNull())
    first = lambda *names: F.get(F.filter(dated, lambda e: e["what"].isin(*names)), F.lit(0))["at"]
    return F.coalesce(first("registration"), first("created", "creation", "registered"))


def key_features(raw, most: int = 6) -> Column:
    """Names and descriptions of a JSON array, the first of each name, whatever its case."""
    items = F.from_json(_c(raw), "array<struct<name:string,feature_name:string,description:string,feature_description:string>>")
    some = lambda a, b, n: snippet(F.coalesce(F.nullif(a, F.lit("")), b), n)
    named = F.filter(F.transform(items, lambda f: F.struct(some(f["name"], f["feature_name"], 120).alias("name"), some(f["description"], f["feature_description"], 240).alias("description"))), lambda f: f["name"] != "")
    # A name is the first of its kind where it stands at the place of the first like it; the lowered names and the list are made once.
    lowered = lambda every: let(F.transform(every, lambda f: F.lower(f["name"])), lambda low: F.filter(every, lambda f, i: F.array_position(low, F.get(low, i)) == i + 1))
    first = let(named, lowered)
    return F.slice(F.coalesce(first, F.array().cast("array<struct<name:string,description:string>>")), 1, most)


def backfill_marked(raw, version: str) -> Column:
    """Whether a model's raw text carries this backfill's mark (F64)."""
    text = F.coalesce(_c(raw), F.lit(""))
    return text.contains(f'"backfill":"{version}"') | text.contains(f'"backfill": "{version}"') | F.coalesce(F.get_json_object(text, "$.backfill") == version, F.lit(False))


def backfill_ok(root, error) -> Column:
    """Whether a new category may be written (F64): a root is needed, and no invented leaf."""
    return (F.coalesce(_c(root), F.lit("")) != "") & ~F.trim(F.coalesce(_c(error), F.lit(""))).startswith("category_l2_unmatched")


def public_slug(x) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(_c(x), F.lit("")))), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.regexp_replace(F.substring(s, 1, 120), "-+$", "")


def public_slug_base(canonical, host, title, key) -> Column:
    """The base of a public slug (F30): the canonical slug without its hash, else the domain's label, the title, the
    canonical slug as it is, the key."""
    tries = [F.regexp_replace(F.lower(F.trim(_c(canonical))), "-[0-9a-f]{8}$", ""), F.substring_index(registrable(host), ".", 1), _c(title), _c(canonical)]
    return F.coalesce(*[F.nullif(public_slug(t), F.lit("")) for t in tries], F.concat(F.lit("tool-"), _c(key).cast("string")))
