"""Settings with bounds, and a log of JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX = "spark.tally."

# Defaults and bounds (None: unbounded) of limits, intervals and thresholds.
BOUNDS: dict[str, tuple] = {
    "limit": (20, None, None), "concurrency": (5, None, None), "max_retries": (2, None, None), "poll_interval_seconds": (300, None, None), "release_probe_start_day": (7, 1, 28), "release_probe_interval_seconds": (21_600, 900, None),
    "release_queue_limit": (5_000, 1, None), "asset_limit": (5, None, None), "domain_state_limit": (50, None, None), "domain_state_max_age_days": (30, None, None), "pricing_limit": (20, None, None), "pricing_timeout_seconds": (20, None, None),
    "taxonomy_enabled": (True, None, None), "taxonomy_limit": (20, 1, None), "taxonomy_interval_seconds": (300, 300, None), "taxonomy_concurrency": (3, 1, 8), "auto_accept_confidence": (0.5, 0.35, 1.0), "provider_backoff_seconds": (21_600, 900, None),
    "claims_shadow": (False, None, None), "claims_publish": (False, None, None),
}


def _parsed(text: str | None, default):
    """The text as a value of the default's kind; the default where it is missing, blank or no such value."""
    text = (text or "").strip()
    if isinstance(default, bool):
        return text.lower() in ("1", "true", "yes", "on") if text else default
    try:
        return type(default)(text)
    except ValueError:
        return default


def settings(spark: SparkSession) -> dict[str, int | float | bool]:
    """All settings by name, from the session's spark.tally.<name>, each within its bounds."""
    out = {}
    for name, (default, low, high) in BOUNDS.items():
        value = _parsed(spark.conf.get(PREFIX + name, None), default)
        if low is not None:
            value = max(low, value)
        if high is not None:
            value = min(high, value)
        out[name] = value
    return out


def log_lines(rows: DataFrame, level: Column, message: Column, fields: dict[str, Column]) -> DataFrame:
    """(level, value): a line of JSON for each row: level, message, then the fields that aren't null.  A level that is neither info nor
    error counts as info."""
    kind = F.when(level == "error", "error").otherwise("info")
    return rows.select(kind.alias("level"), F.to_json(F.struct(kind.alias("level"), message.alias("message"), *[c.alias(n) for n, c in fields.items()])).alias("value"))


def write_log(lines: DataFrame, path: str) -> None:
    """Appends lines as text, errors apart from the rest."""
    lines.write.mode("append").partitionBy("level").text(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(level, value) of all lines written to a path."""
    return spark.read.schema("value string, level string").text(path).select("level", "value")
