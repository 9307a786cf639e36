"""Exact deduplication by progressive refinement, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bit_words, bits_for, materialize, with_bit

#: The survivors' filter has at most 2**24 bits: 262,144 rows of 16 bytes are what is broadcast.
MOST_BITS = 24


def normalized(text: Column) -> Column:
    """Text with each run of ASCII white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None, prefix: int = 128) -> DataFrame:
    """Groups rows whose normalised texts are identical.

    1. One scan gives every row's length and the hash of its first `prefix` characters.  Lengths
       that occur once are out; of the rest, prefixes that occur once within their length are out.
    2. The surviving (length, prefix) pairs become a bit filter of bounded size.  A second scan
       computes the hash of the full content only for rows that pass the filter, and only ids
       and hashes are shuffled: never a text.
    3. Full hashes (SHA-256) are grouped; the smallest id of a group stays.

    Returns one row per input row: id, keep_id, group_size, kept, and the columns of `carry`
    (name -> expression over the input row and over `_norm`, the normalised text).

    Null and empty texts are equal to each other.  Rows without an id never become keep_id unless
    all of their group lack one.  Rows that repeat both id and text are all flagged kept if
    theirs is the smallest id: they count in group_size, and nothing tells them apart.  An empty
    input gives an empty result.  Other columns of the input, whatever their names, don't matter.
    """
    extra = carry or {}
    rows = docs.select(F.col(id_col).alias("_id"), normalized(F.col(text_col)).alias("_norm"))
    sized = rows.select(F.length("_norm").alias("_len"), F.xxhash64(F.substring("_norm", 1, prefix)).alias("_prefix"))
    pairs = materialize(sized.groupBy("_len", "_prefix").agg(F.count("*").alias("_n")), "prefixes")
    lengths = pairs.groupBy("_len").agg(F.sum("_n").alias("_m")).where("_m > 1").select("_len")
    alive = materialize(pairs.where("_n > 1").join(lengths, "_len", "left_semi").select(F.xxhash64("_len", "_prefix").alias("_h")), "survivors")
    bits = bits_for(alive.count(), MOST_BITS)

    known = rows.withColumn("_len", F.length("_norm")).withColumn("_p", F.xxhash64(F.substring("_norm", 1, prefix)))
    known = with_bit(known, F.xxhash64("_len", "_p"), bit_words(alive, "_h", bits), bits, "_alive")
    full = F.when(F.col("_alive"), F.sha2("_norm", 256))
    # A row that is alone gets a key of its own, so that such rows don't meet in one task.
    alone = F.concat_ws("/", F.lit("alone"), F.coalesce(F.col("_id").cast("string"), F.lit("")), "_p", "_len")
    hashed = known.select("_id", "_len", F.coalesce(full, alone).alias("_key"), F.col("_alive"), *[e.alias(k) for k, e in extra.items()])
    groups = hashed.where("_alive").groupBy("_len", "_key").agg(F.min("_id").alias("_keep"), F.count("*").alias("_size"))
    # Grouped by length and hash but joined by hash alone: the sides are dealt out anew, so Spark can split a hot group.
    groups = groups.where("_size > 1").select(F.col("_key").alias("_gkey"), "_keep", "_size")
    found = hashed.join(groups, F.col("_key") == F.col("_gkey"), "left")
    keep = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return found.select(
        F.col("_id").alias(id_col), keep.alias("keep_id"), F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"), *extra,
    )
