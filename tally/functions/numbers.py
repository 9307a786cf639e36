"""Numeric, date and conversion expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where the value is computed once, however often the body names it.

    A Column is an expression and not a value: named twice it may be computed twice, and within a lambda over an array once for each item.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def to_number(x) -> Column:
    """Text or number as a double; what isn't a number, and NaN, is null."""
    v = _c(x).try_cast("double")
    return F.when(~F.isnan(v), v)


def to_integer(x) -> Column:
    """Truncated and never below zero; infinities are null."""
    v = to_number(x)
    return F.when(F.abs(v) < float("inf"), F.greatest(F.lit(0).cast("long"), v.cast("long")))


def to_decimal(x) -> Column:
    """Money as decimal(38,18): separators go, negative and malformed amounts are null."""
    v = F.regexp_replace(F.trim(_c(x).cast("string")), ",", "").try_cast("decimal(38,18)")
    return F.when(v >= 0, v)


def decimal_string(x) -> Column:
    """A decimal without trailing zeros."""
    s = _c(x).cast("string")
    return F.when(s.contains("."), F.regexp_replace(F.regexp_replace(s, "0+$", ""), r"\.$", "")).otherwise(s)


def amount_minor(x, exponent: int = 2) -> Column:
    """Minor units, rounded half to even."""
    return F.bround(_c(x).cast("decimal(38,18)") * (10**exponent)).cast("long")


def quantity(x) -> Column:
    """'2.5k', '3 million', '1,000' as a decimal."""
    s, pattern = F.lower(F.trim(_c(x))), r"^(\d[\d,]*(?:\.\d+)?)\s*(k|m|thousand|million)?$"
    n = F.regexp_replace(F.regexp_extract(s, pattern, 1), ",", "").try_cast("decimal(38,6)")
    unit = F.regexp_extract(s, pattern, 2)
    return n * F.when(unit.isin("k", "thousand"), 1_000).when(unit.isin("m", "million"), 1_000_000).otherwise(1)


def month_start(x) -> Column:
    """The first day of the month that a text begins with (YYYY-MM), null if there is none."""
    found = F.regexp_extract(_c(x).cast("string"), r"^(\d{4}-\d{2})", 1)
    return F.try_to_date(F.concat(F.nullif(found, F.lit("")), F.lit("-01")), "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.concat(F.nullif(found, F.lit("")), F.lit("-01")).try_cast("date")


def previous_month(day) -> Column:
    return F.trunc(F.add_months(_c(day), -1), "MM").cast("date")


def share_to_bps(share) -> Column:
    """Observed share to basis points, half up; a hair above one counts as one, more is null."""
    s = _c(share)
    return F.when(s.between(0, 1.000001), F.floor(F.least(s, F.lit(1.0)) * 10000 + 0.5).cast("int"))


def round_bps(share) -> Column:
    """Stored share to basis points, only within [0, 1]."""
    s = _c(share)
    return F.when(s.between(0, 1), F.round(s * 10000.0).cast("long"))


def visits_from_bps(visits, bps) -> Column:
    """Integer half-up estimate."""
    return F.floor((_c(visits) * _c(bps) + 5000) / 10000).cast("long")


def modeled_visits(visits, bps) -> Column:
    return F.round(_c(visits) * _c(bps) / 10000.0).cast("long")


def growth_rate(now, before) -> Column:
    """Null unless the baseline is positive."""
    b = _c(before)
    return F.when(b > 0, (_c(now) - b) / b.cast("double"))


def velocity_30d(latest, base, days) -> Column:
    return (_c(latest) - _c(base)) * 30.0 / F.nullif(_c(days), F.lit(0))


def search_share(explicit, organic, paid) -> Column:
    """The explicit share; else organic plus paid, a missing one as zero; else null."""
    parts = F.when(_c(organic).isNotNull() | _c(paid).isNotNull(), F.coalesce(_c(organic), F.lit(0.0)) + F.coalesce(_c(paid), F.lit(0.0)))
    return F.coalesce(_c(explicit), parts)


def rating(x) -> Column:
    return F.when(_c(x).isNotNull(), F.least(F.greatest(_c(x), F.lit(0.0)), F.lit(100.0)))


def country_code(x) -> Column:
    code = F.upper(F.trim(_c(x)))
    return F.when(code.rlike("^[A-Z]{2}$"), code)


def confidence(x) -> Column:
    """0..1; numbers above one and up to a hundred are percentages."""
    v = to_number(x)
    v = F.when((v > 1) & (v <= 100), v / 100).otherwise(v)
    return F.coalesce(F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))


def safe_div(a, b) -> Column:
    return F.when(_c(b) > 0, _c(a) / _c(b).cast("double")).otherwise(F.lit(0.0))


def f1(p, r) -> Column:
    return F.when(_c(p) + _c(r) > 0, 2 * _c(p) * _c(r) / (_c(p) + _c(r))).otherwise(F.lit(0.0))


def iso_utc(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def iso_timestamp(x) -> Column:
    """A text's time as ISO 8601 in UTC with milliseconds and Z (F12); a text without a zone is in the session's, null if
    it is no time."""
    text = F.trim(_c(x).cast("string"))
    at = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
