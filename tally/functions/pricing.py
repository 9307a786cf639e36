"""Prices in text and plans (H-12 to H-15): matches with offsets need Python, the rest are columns."""

from __future__ import annotations

import re
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import _c, amount_minor

# Plan names in order, prices, words that make a context unfit.
PLAN_NAMES = ["Free", "Basic", "Starter", "Lite", "Plus", "Pro", "Professional", "Premium", "Creator", "Team", "Business", "Growth", "Scale", "Enterprise"]
PRICE = re.compile(r"(?:(?P<c1>US\$|\$|₹|USD|EUR|GBP|INR)\s*(?P<a1>\d{1,7}(?:,\d{2,3})*(?:\.\d{1,4})?)|(?P<a2>\d{1,7}(?:,\d{2,3})*(?:\.\d{1,4})?)\s*(?P<c2>USD|EUR|GBP|INR))", re.I)
UNFIT = re.compile(r"\b(under|shopping|purchase|cart|invoice|discount|save|coupon|refund|tax|blog|privacy|terms|per image|token|credit|api call|api pricing|model price)\b")
YEARLY = r"(?i)/\s*yr\b|per year|yearly|annually|annual|/year|\byr\b"
MONTHLY = r"(?i)/\s*mo\b|per month|monthly|/month|\bmo\b"


def interval(context) -> Column:
    return F.when(_c(context).rlike(YEARLY), "yearly").when(_c(context).rlike(MONTHLY), "monthly")


def unit(context) -> Column:
    s = F.lower(_c(context))
    return F.when(s.contains("per user") | s.contains("/user"), "user").when(s.contains("per seat") | s.contains("/seat"), "seat")


def currency(symbol) -> Column:
    s = F.replace(F.replace(F.replace(F.upper(F.coalesce(_c(symbol), F.lit("$"))), F.lit("US$"), F.lit("USD")), F.lit("$"), F.lit("USD")), F.lit("₹"), F.lit("INR"))
    return F.when(s.isin("USD", "EUR", "GBP", "INR"), s).otherwise("USD")


def price_matches(texts: DataFrame, id_col: str, text_col: str, before: int = 260, after: int = 220) -> DataFrame:
    """One row for each price in a text, with its place, context and the plan name nearest before it."""
    kind = texts.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["_id"], batch["_text"], strict=True):
                for m in PRICE.finditer(text or ""):
                    try:
                        amount = Decimal((m["a1"] or m["a2"]).replace(",", ""))
                    except InvalidOperation:
                        continue
                    context = text[max(0, m.start() - before) : m.end() + after]
                    lower = text[max(0, m.start() - before) : m.start()].lower()
                    name = max(PLAN_NAMES, key=lambda n: lower.rfind(n.lower()))
                    rows.append((key, m.start(), amount, m["c1"] or m["c2"], context, name if name.lower() in lower else None, bool(UNFIT.search(context.lower()))))
            yield pd.DataFrame(rows, columns=["_id", "place", "amount", "symbol", "context", "plan", "unfit"])

    found = texts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInPandas(run, f"_id {kind}, place int, amount decimal(18,4), symbol string, context string, plan string, unfit boolean")
    return found.withColumnRenamed("_id", id_col)


def text_plans(texts: DataFrame, id_col: str, text_col: str, most: int = 6) -> DataFrame:
    """The first plans of each text: fit contexts, one per name, amount and interval, free ones first."""
    m = price_matches(texts, id_col, text_col).where("NOT unfit")
    m = m.select(id_col, "place", F.coalesce("plan", F.lit("Plan")).alias("plan"), "amount", currency("symbol").alias("currency"), interval("context").alias("interval"), unit("context").alias("unit"))
    one = m.groupBy(id_col, F.lower("plan").alias("_p"), "amount", "interval").agg(F.min_by(F.struct("place", "plan", "currency", "unit"), "place").alias("x"))
    rank = F.when(F.col("amount") == 0, 0).when(F.col("interval") == "monthly", 1).when(F.col("interval") == "yearly", 2).otherwise(3)
    plans = F.collect_list(F.struct(F.col("x.place").alias("place"), rank.alias("rank"), "amount", "interval", F.col("x.plan").alias("plan"), F.col("x.currency").alias("currency"), F.col("x.unit").alias("unit")))
    first = one.groupBy(id_col).agg(F.slice(F.array_sort(plans), 1, most).alias("plans"))
    return first.select(id_col, F.array_sort(F.transform("plans", lambda p: F.struct(p["rank"].alias("rank"), p["amount"].alias("amount"), p["place"].alias("place"), p["plan"].alias("plan"), p["interval"].alias("interval"), p["currency"].alias("currency"), p["unit"].alias("unit")))).alias("plans"))


def pricing_summary(plans) -> Column:
    """Model, interval and starting price of array<struct<name, amount, interval, kind, currency, custom>>."""
    p = _c(plans)
    paid = F.filter(p, lambda x: ~F.coalesce(x["custom"], F.lit(False)) & (x["amount"] > 0))
    free = F.exists(p, lambda x: F.coalesce(x["amount"] == 0, F.lit(False)) | (F.lower(x["name"]) == "free"))
    custom = (F.size(p) > 0) & F.forall(p, lambda x: F.coalesce(x["custom"], F.lit(False)))
    usage = (F.size(paid) > 0) & F.forall(paid, lambda x: F.coalesce(x["kind"] == "usage", F.lit(False)))
    any_paid = F.size(paid) > 0
    model = F.when(any_paid & free, "freemium").when(any_paid & usage, "usage_based").when(any_paid, "paid").when(custom, "contact").when(free, "free").otherwise("unknown")
    order = F.array_sort(F.transform(paid, lambda x: F.struct(F.when(x["interval"] == "monthly", 0).when(x["interval"] == "yearly", 1).otherwise(2).alias("r"), x["amount"].alias("amount"), x["interval"].alias("interval"), x["currency"].alias("currency"))))
    first = F.get(order, F.lit(0))
    per = F.when(first["interval"].isin("monthly", "yearly"), first["interval"]).when(usage, "usage").when(custom, "custom").otherwise("none")
    return F.struct(model.alias("model"), free.alias("has_free_plan"), per.alias("interval"), amount_minor(first["amount"]).alias("starting_minor"), first["currency"].alias("currency"))
