"""What the training-data operators share: written tables, bit filters, running sums."""

from __future__ import annotations

import math
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space of the contracts: space and \x09 to \x0D.
SPACE = r"[\x20\x09-\x0D]+"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Only where the session names no such folder and runs in one process, as in tests, a temporary one is made;
    on a cluster that raises, since executors would not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession):
    """Whole texts go to Python in jobs run here: batches by bytes, not by rows."""
    old = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, "4m")
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, old)


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends there, so lost
    executors cost a reread, and no later stage repeats the work or sees another partitioning."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    with small_batches(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df under names that nothing inside an operator uses, and the inside name of each column."""
    names = {c: f"_in{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def restored(df: DataFrame, names: dict[str, str], *results: Column) -> DataFrame:
    """The columns under their own names, then the results; a column named like a result gives way to it."""
    out = df.select(*names.values(), *results)
    taken = {c.lower() for c in out.columns[len(names) :]}
    return out.select(*[F.col(i).alias(c) for c, i in names.items() if c.lower() not in taken], *out.columns[len(names) :])


def bits_for(n: int, most: int, per_key: int = 16) -> int:
    """log2 of the bits of a filter for n keys; `most` is the proven bound of what is broadcast."""
    return min(most, max(10, math.ceil(math.log2(max(1, n) * per_key))))


def bit_words(hashes: DataFrame, column: str, log2_bits: int) -> DataFrame:
    """A Bloom filter with one hash as rows (word, bits): at most 2**log2_bits / 64 rows, whatever
    the input.  A full filter lets everything pass, which costs time but never changes a result."""
    at = F.col(column).bitwiseAND(F.lit((1 << log2_bits) - 1))
    one = F.expr(f"shiftleft(1L, cast(({column} & 63) AS INT))")
    return hashes.select(F.shiftright(at, 6).alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def with_bit(df: DataFrame, hash_column: Column, words: DataFrame, log2_bits: int, flag: str) -> DataFrame:
    """Adds `flag`: whether the row's hash may be in the filter.  The filter's size is bounded by
    log2_bits, so it is broadcast."""
    h, w = f"{flag}_h", f"{flag}_w"
    bits = F.broadcast(words.select(F.col("word").alias(w), F.col("bits").alias(f"{flag}_b")))
    out = df.withColumn(h, hash_column)
    out = out.join(bits, F.shiftright(F.col(h).bitwiseAND(F.lit((1 << log2_bits) - 1)), 6) == F.col(w), "left")
    test = F.coalesce(F.expr(f"getbit({flag}_b, cast(({h} & 63) AS INT)) = 1"), F.lit(False))
    return out.withColumn(flag, test).drop(h, w, f"{flag}_b")


def leave_out(df: DataFrame, gone: DataFrame, key: Column, log2_most: int = 24) -> DataFrame:
    """Rows of df whose key isn't in `gone` (one string column).  Only rows that a bounded bit filter
    lets through are shuffled and joined; all others stay where they are."""
    named = materialize(gone.select(F.col(gone.columns[0]).alias("_gone")).distinct(), "gone")
    bits = bits_for(named.count(), log2_most)
    words = bit_words(named.select(F.xxhash64("_gone").alias("_h")), "_h", bits)
    marked = with_bit(df.withColumn("_key", key), F.xxhash64("_key"), words, bits, "_maybe")
    stay = marked.where("NOT _maybe").select(*df.columns)
    return stay.unionByName(marked.where("_maybe").join(named, F.col("_key") == F.col("_gone"), "left_anti").select(*df.columns))


def among(df: DataFrame, column: str, ids: DataFrame, log2_most: int = 24) -> DataFrame:
    """Rows of df whose `column` is in `ids` (one column, written): only rows that a bounded bit filter
    lets through are shuffled."""
    bits = bits_for(ids.count(), log2_most)
    words = bit_words(ids.select(F.xxhash64(ids.columns[0]).alias("_h")), "_h", bits)
    marked = with_bit(df, F.xxhash64(column), words, bits, "_maybe").where("_maybe").select(*df.columns)
    return marked.join(ids.select(F.col(ids.columns[0]).alias("_in")), F.col(column) == F.col("_in"), "left_semi")


def bit_array(hashes: DataFrame, column: str, log2_bits: int):
    """The same filter as a broadcast numpy array of 2**log2_bits bits for Python tasks."""
    table = np.zeros(max(1, (1 << log2_bits) >> 6), np.uint64)
    words = bit_words(hashes, column, log2_bits).toArrow()
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(table)


def bit_arrays(hashes: DataFrame, column: str, levels: list[tuple[Column, int]]) -> list:
    """Filters of the rows that fulfil each condition, with the log2 of each filter's bits; one job for all."""
    marks = F.array(*[F.struct(F.lit(i).alias("level"), F.when(when, F.col(column).bitwiseAND(F.lit((1 << bits) - 1))).alias("at")) for i, (when, bits) in enumerate(levels)])
    rows = hashes.select(F.explode(marks).alias("m")).where("m.at IS NOT NULL").select("m.level", F.shiftright("m.at", 6).alias("word"), F.expr("shiftleft(1L, cast((m.at & 63) AS INT))").alias("bit"))
    words = rows.groupBy("level", "word").agg(F.bit_or("bit").alias("bits")).toArrow()
    level, word, value = (words.column(c).to_numpy() for c in ("level", "word", "bits"))
    out = []
    for i, (_, bits) in enumerate(levels):
        table, mine = np.zeros(max(1, (1 << bits) >> 6), np.uint64), level == i
        table[word[mine]] = value[mine].astype(np.int64).view(np.uint64)
        out.append(hashes.sparkSession.sparkContext.broadcast(table))
    return out


def test_bits(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes may be in the filter."""
    h = hashes.astype(np.uint64, copy=False)
    word = (h & np.uint64(len(table) * 64 - 1)) >> np.uint64(6)
    return (table[word.astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) == 1


test_bits.__test__ = False  # not a test


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, partitions: int | None = None) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows of the same keys that come earlier in `order`.

    A window over a hot key would run in one task.  Here rows are range-partitioned by keys and
    order, summed inside each range, and shifted by the sums of the ranges before (one row for each
    range and key).  df should be cheap to compute: range partitioning samples it first.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy(*keys, "_range").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row for each range and one for each key more: small, and checked by construction.
    shifts = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"),
                           F.coalesce(F.sum("_total").over(before.partitionBy(*keys)), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = local.join(F.broadcast(shifts), same)
    return joined.withColumn(out, F.col("_local") + F.col("_shift")).drop("_local", "_shift", "_range", "_r", *[f"_k{i}" for i in range(len(keys))])


def near_labels(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node within four links.  Equal labels mean connected nodes; nodes of
    one component may still have several.  Cheaper than `components` where that is enough."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "near")
    for _ in range(2):  # one link, then two, then four
        up = label.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        label = materialize(label.join(up, F.col("component") == F.col("_n"), "left").select("node", F.least("component", F.coalesce("_c", "component")).alias("component")), "near")
    return label


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list by alternating large and small stars.

    Returns (node, component), component being the smallest node reachable; nodes without an edge
    are left out.  Every step is an aggregation with partial sums and a join between two written
    tables, so a hub's edges are spread over tasks; nothing is collected.
    """
    pairs = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    now = materialize(pairs, "edges")
    mark = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "star")
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        large = materialize(large, "edges")
        # Small star: each node b points to its smaller neighbours a; link them all to the least one.
        low = materialize(large.groupBy("b").agg(F.min("a").alias("m")), "star")
        small = large.join(low, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x < y")
        now = materialize(small.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark or new[0] == 0:
            break
        mark = new
    top = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return top.union(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
