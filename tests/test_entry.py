"""The driver's contract: every query runs on the smallest tables, and agrees with its SQL."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
NAMES = [n for n in entry.catalog.QUERIES]


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    sql = entry.oracle_sql().get(name)
    if sql:
        got = duck.execute(sql)
        names = [c[0] for c in got.description]
        assert sorted(names) == columns
        assert rows == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in got.fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_claim_evidence_of_large_keys(spark, tmp_path):
    """Orders beyond a million, and beyond 32 bits, keep their verdicts."""
    from pyspark.sql import functions as F

    from tally.plans.catalog import QUERIES

    step = 63 * 2 * 10**8  # keeps the remainders by 9, 7 and 2
    orders = spark.range(126).select(F.col("id").alias("o_orderkey"), (F.col("id") % 5).alias("o_custkey"))
    for name, add in (("small", 0), ("large", step)):
        orders.withColumn("o_orderkey", F.col("o_orderkey") + add).write.parquet(f"{tmp_path}/{name}/orders.parquet")
    small, large = ({(r.page_id, r.claim_id - add): (r.status, r.confidence, r.reason) for r in QUERIES["claim_evidence"](spark, f"{tmp_path}/{name}").collect()} for name, add in (("small", 0), ("large", step)))
    assert small == large and len({v[2] for v in small.values()}) == 8
