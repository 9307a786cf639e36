"""Traffic payloads: channel shares, geographies, keywords, AI traffic, compact metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import _c, country_code, month_start, share_to_bps, to_integer, to_number

# Channels as the provider spells them, and what they are called here.
CHANNELS = {
    "social": "Social", "social_organic": "SocialOrganic", "social_paid": "SocialPaid", "paid_referrals": "Paid Referrals", "mail": "Mail", "search": "Search",
    "search_organic": "SearchOrganic", "search_paid": "SearchPaid", "direct": "Direct", "referrals": "Referrals", "display_ads": "DisplayAds", "gen_ai": "GenAi", "affiliate": "Affiliate",
}


def _present(*parts: Column) -> Column:
    """Sum of what is there; null if nothing is."""
    known = F.filter(F.array(*parts), lambda x: x.isNotNull())
    return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda s, x: s + x))


def traffic_sources(sources) -> Column:
    """Channel shares from a map of raw values; totals are explicit, else the sum of their parts."""
    raw = {name: to_number(F.try_element_at(_c(sources), F.lit(key)).cast("string")) for name, key in CHANNELS.items()}
    raw["social"] = F.coalesce(raw["social"], _present(raw["social_organic"], raw["social_paid"]))
    raw["search"] = F.coalesce(raw["search"], _present(raw["search_organic"], raw["search_paid"]))
    return F.struct(*[c.alias(name) for name, c in raw.items()])


def country_shares(shares) -> Column:
    """Valid (country, position, bps) of an array of (CountryCode, Value); positions may have gaps."""
    placed = F.transform(_c(shares), lambda x, i: F.struct(country_code(x["CountryCode"]).alias("country"), (i + 1).alias("position"), share_to_bps(x["Value"]).alias("bps")))
    return F.filter(placed, lambda x: x["country"].isNotNull() & x["bps"].isNotNull())


def keywords(raw) -> Column:
    named = F.filter(_c(raw), lambda k: F.trim(F.coalesce(k["Name"], F.lit(""))) != "")
    return F.transform(named, lambda k: F.struct(F.trim(k["Name"]).alias("name"), to_integer(k["Volume"]).alias("volume"), to_number(k["EstimatedValue"]).alias("estimated_traffic"), to_number(k["Cpc"]).alias("cpc")))


def ai_history(chart) -> Column:
    """Series of (date, share) points; points without a month or share, and series without points, go."""
    def points(series: Column) -> Column:
        made = F.transform(series["History"], lambda p: F.struct(month_start(p["Date"]).alias("date"), to_number(p["Value"]).alias("share")))
        return F.filter(made, lambda p: p["date"].isNotNull() & p["share"].isNotNull())

    made = F.transform(_c(chart), lambda s: F.struct(F.trim(s["Name"]).alias("name"), points(s).alias("points")))
    return F.filter(made, lambda s: (s["name"] != "") & (F.size(s["points"]) > 0))


def metrics_json(**parts: Column) -> Column:
    """An object without null fields."""
    return F.to_json(F.struct(*[c.alias(name) for name, c in parts.items()]))


def country_rank_text(country, rank) -> Column:
    return F.when(_c(country).isNotNull() & _c(rank).isNotNull(), F.concat(_c(country), F.lit(" #"), _c(rank).cast("string")))


def wide_countries(shares, n: int = 5) -> list[Column]:
    """Wide columns top_country_i and its share; null past the end."""
    out = []
    for i in range(n):
        out.append(F.upper(F.trim(F.get(_c(shares), F.lit(i))["CountryCode"])).alias(f"top_country_{i + 1}"))
        out.append(to_number(F.get(_c(shares), F.lit(i))["Value"]).alias(f"top_country_{i + 1}_traffic_share"))
    return out


def with_legacy_countries(parsed, legacy) -> Column:
    """Countries of a payload (F52): the parsed ones if any is valid, else the old wide columns', as (country, position, bps).

    parsed, legacy: arrays of (CountryCode, Value).
    """
    own = country_shares(parsed)
    old = F.filter(country_shares(legacy), lambda x: x["bps"].isNotNull())
    return F.when(F.coalesce(F.size(own), F.lit(0)) > 0, own).otherwise(F.coalesce(old, own))


#: A provider's details of AI traffic; values are read as texts, so that one of another kind is null and not an error.
AI_DETAILS = """TotalVisits string, ReferralTraffic string, Traffic struct<Distribution:struct<Boundary:string,Chatbots:array<struct<Name:string,Value:string>>,
    Chart:array<struct<Name:string,History:array<struct<Date:string,Value:string>>>>>,Split:array<struct<Name:string,Rank:string>>>,
    TopPrompts struct<Status:string,ErrorMessage:string,Prompts:array<string>>"""


def ai_traffic(details) -> Column:
    """AI traffic of a JSON object (F49): visits, referral share, boundary, sources, history, rankings, prompts; null if it isn't an object.

    Sources need a name and a share, rankings a name, series a name and a point with a month and a share; blank texts are null, lists
    that are missing empty.
    """
    d = F.from_json(_c(details), AI_DETAILS)
    text = lambda x: F.nullif(F.trim(F.coalesce(x, F.lit(""))), F.lit(""))
    spread, prompts = d["Traffic"]["Distribution"], d["TopPrompts"]
    sources = F.transform(F.coalesce(spread["Chatbots"], F.array()), lambda x: F.struct(text(x["Name"]).alias("name"), to_number(x["Value"]).alias("share")))
    rankings = F.transform(F.coalesce(d["Traffic"]["Split"], F.array()), lambda x: F.struct(text(x["Name"]).alias("name"), to_integer(x["Rank"]).alias("rank")))
    said = F.struct(to_integer(prompts["Status"]).alias("status"), text(prompts["ErrorMessage"]).alias("error"), F.coalesce(F.size(prompts["Prompts"]), F.lit(0)).alias("count"))
    made = F.struct(
        to_number(d["TotalVisits"]).alias("total_visits"), to_number(d["ReferralTraffic"]).alias("referral_share"), text(spread["Boundary"]).alias("boundary"),
        F.filter(sources, lambda x: x["name"].isNotNull() & x["share"].isNotNull()).alias("sources"), F.coalesce(ai_history(spread["Chart"]), ai_history(F.from_json(F.lit("[]"), "array<struct<Name:string,History:array<struct<Date:string,Value:string>>>>"))).alias("history"),
        F.filter(rankings, lambda x: x["name"].isNotNull()).alias("rankings"), said.alias("top_prompts"),
    )
    return F.when(F.trim(_c(details)).startswith("{") & F.try_parse_json(_c(details)).isNotNull(), made)
