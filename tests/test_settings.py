"""Settings within their bounds; a log of JSON lines."""

import json

import pytest
from pyspark.sql import functions as F

from tally.sources import settings as S


@pytest.mark.parametrize(
    ("name", "text", "want"),
    [
        ("limit", None, 20), ("limit", "7", 7), ("limit", "seven", 20), ("limit", " ", 20), ("release_probe_start_day", "40", 28), ("release_probe_start_day", "-3", 1), ("taxonomy_concurrency", "99", 8), ("taxonomy_interval_seconds", "5", 300),
        ("auto_accept_confidence", "0.1", 0.35), ("auto_accept_confidence", "7", 1.0), ("auto_accept_confidence", "0.6", 0.6), ("claims_shadow", "TRUE", True), ("claims_shadow", "no", False), ("taxonomy_enabled", None, True), ("taxonomy_enabled", "0", False),
    ],
)
def test_settings(spark, name, text, want):
    if text is not None:
        spark.conf.set(S.PREFIX + name, text)
    try:
        got = S.settings(spark)
        assert got[name] == want and type(got[name]) is type(want) and set(got) == set(S.BOUNDS)
    finally:
        spark.conf.unset(S.PREFIX + name)


def test_log(spark, tmp_path):
    rows = spark.createDataFrame([("error", "a", 1, None), ("debug", "b\n\"é", None, "x"), (None, None, None, None)], "l string, m string, n int, t string")
    lines = S.log_lines(rows, F.col("l"), F.col("m"), {"n": F.col("n"), "t": F.col("t")})
    for _ in range(2):
        S.write_log(lines, str(tmp_path / "log"))
    got = sorted((r.level, r.value) for r in S.read_log(spark, str(tmp_path / "log")).collect())
    assert [(level, json.loads(v)) for level, v in got[::2]] == [("error", {"level": "error", "message": "a", "n": 1}), ("info", {"level": "info", "message": "b\n\"é", "t": "x"}), ("info", {"level": "info"})] and got[::2] == got[1::2]
