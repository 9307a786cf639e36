"""A Merkle manifest of a dataset: leaves, roots of groups, one root, and a proof for each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Nodes that become one parent, and levels that one block holds: 8**3 = 512 leaves, 32 KB of hex text.
FAN, DEPTH, HEX = 8, 3, 64
BLOCK = FAN**DEPTH


def digest(*values: Column) -> Column:
    """SHA-256 in hex of the values one after another, each `-` if null, else UTF-8 byte count, `:`, value."""
    framed = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*framed), 256)


def proof_sha256(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s.left, s.right)), ""), 256)


def folded_root(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s.left, node, s.right), 256))


def _slice(level: Column, start: Column, length: Column) -> Column:
    """`length` digests of a level from number `start` on; the level is hex text as bytes, so this is a fixed-width substring."""
    return F.substring(level, (start * HEX + 1).cast("int"), (length * HEX).cast("int"))


def _parents(level: Column) -> Column:
    """The next level: every eight digests become one, the last ones fewer."""

    def hashed(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.octet_length(level) / (FAN * HEX)).cast("int") - 1)
        return F.array_join(F.transform(runs, lambda r: F.sha2(_slice(level, r * FAN, F.lit(FAN)), 256)), "").cast("binary")

    return F.transform(F.array(level), hashed)[0]  # names the level, so that it is made once


def _levels(blocks: DataFrame) -> DataFrame:
    """Adds to each block its higher levels, how many lie below its top, and the top's digest."""
    for k in range(DEPTH):
        blocks = blocks.withColumn(f"_l{k + 1}", _parents(F.col(f"_l{k}")))
    # A group of more leaves than a block holds goes on above: all its blocks, however few their leaves, have full depth.
    depth = F.lit(DEPTH)
    for k in reversed(range(DEPTH)):
        depth = F.when(F.col("_n") <= FAN**k, k).otherwise(depth)
    tops = F.array(*[F.col(f"_l{k}") for k in range(DEPTH + 1)])
    return blocks.withColumn("_depth", depth).withColumn("_top", F.element_at(tops, F.col("_depth") + 1).cast("string")).drop(f"_l{DEPTH}")


def _path(at: Column) -> Column:
    """Siblings of the member `at` of a block, level by level: the substrings that flank it within its run of eight."""
    steps = []
    for k in range(DEPTH):
        node = F.floor(at / FAN**k).cast("int")
        inside = node % FAN
        level = F.col(f"_l{k}")
        steps.append(F.struct(_slice(level, node - inside, inside).cast("string").alias("left"), _slice(level, node + 1, FAN - 1 - inside).cast("string").alias("right")))
    return F.slice(F.array(*steps), F.lit(1), F.col("_depth"))


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds `_pos`, the place within `_g` in the given order, and `_n`, the group's size; written.

    Rows are dealt out by ranges and numbered within them, so a hot group runs over many tasks; one row for each group and
    range tells how many come before.
    """
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = nodes.repartitionByRange(n, "_g", *order).sortWithinPartitions("_g", *order)
    ranged = materialize(ranged.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranged")
    parts = ranged.groupBy("_g", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_m"))
    group = Window.partitionBy("_g")  # a group has one row for each range at most
    before = F.sum("_m").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    parts = materialize(parts.select(F.col("_g").alias("_pg"), F.col("_range").alias("_pr"), (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_m").over(group).alias("_n")), "parts")
    placed = ranged.join(parts, F.col("_g").eqNullSafe(F.col("_pg")) & (F.col("_range") == F.col("_pr")))
    return placed.withColumn("_pos", F.col("_at") + F.col("_shift")).drop("_pg", "_pr", "_range", "_at", "_shift")


def _climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From numbered nodes (_g, _n, _pos, _node, _carry) to (_g, _carry, _leaf, _root, _path) of each, and (_g, _root) of each group.

    512 nodes in a row are a block, which keeps each level as one string.  The tops of a group's blocks are the nodes of the
    next climb, which knows a 512th of the rows.
    """
    nodes = nodes.withColumn("_block", F.floor(F.col("_pos") / BLOCK))
    members = F.sort_array(F.collect_list(F.struct("_pos", "_node", "_carry")))  # at most 512 of them
    blocks = nodes.groupBy("_g", "_n", "_block").agg(members.alias("_members"))
    level = F.array_join(F.col("_members._node"), "").cast("binary")
    blocks = materialize(_levels(blocks.select("_g", "_n", "_block", F.col("_members._carry").alias("_carried"), level.alias("_l0"))), "blocks")
    tops = blocks.select("_g", "_n", "_block", "_top")
    low, high = tops.where(F.col("_n") <= BLOCK), tops.where(F.col("_n") > BLOCK)
    path = "array<struct<left:string,right:string>>"
    above = low.select("_g", "_block", F.col("_top").alias("_root"), F.array().cast(path).alias("_above"))
    if not high.isEmpty():
        parents, _ = _climb(high.select("_g", F.ceil(F.col("_n") / BLOCK).alias("_n"), F.col("_block").alias("_pos"), F.col("_top").alias("_node"), F.col("_block").alias("_carry")))
        above = above.unionByName(parents.select("_g", F.col("_carry").alias("_block"), "_root", F.col("_path").alias("_above")))
    above = materialize(above, "above")
    known = above.select(F.col("_g").alias("_ug"), F.col("_block").alias("_ub"), "_root", "_above")
    joined = blocks.join(known, F.col("_g").eqNullSafe(F.col("_ug")) & (F.col("_block") == F.col("_ub")))
    rows = F.transform("_carried", lambda carry, at: F.struct(carry.alias("_carry"), _slice(F.col("_l0"), at, F.lit(1)).cast("string").alias("_leaf"), _path(at).alias("_path")))
    rows = joined.select("_g", "_root", "_above", F.explode(rows).alias("_row")).select("_g", "_row._carry", "_row._leaf", "_root", F.concat("_row._path", "_above").alias("_path"))
    return rows, above.where("_block = 0").select("_g", "_root")


def manifest(docs: DataFrame, columns: list[str], group_col: str, order_col: str, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row for each row of docs: order_col, the columns of `carry`, leaf, subroot, root, path.

    A leaf is the digest of `columns`.  In each group (`group_col`) leaves ascend by order_col (null first; equal ones by
    leaf, so the manifest doesn't depend on how rows are stored); every eight in a row become the digest of their hex texts, the
    last run also where it is shorter, until one is left, the subroot.  Subroots in the order of their groups (null first, by
    bytes) give the root in the same way.  `path` holds the siblings level by level from the leaf to the root, each the digests
    on the left and on the right: `folded_root` and `proof_sha256` read it.

    Texts are read once, where the leaves are made; only ids, digests and `carry` (name -> expression over the input row) are
    shuffled, and rows are grouped by blocks of 512 places, never by group.  Null and empty values have different digests.
    Rows that are equal in all `columns` have equal leaves and lie side by side.  Other columns, whatever their names, don't matter;
    an empty input gives an empty result.
    """
    extra = carry or {}
    kept = F.struct(F.col(order_col).alias("id"), *[e.alias(f"c{i}") for i, e in enumerate(extra.values())])
    leaves = docs.select(F.col(group_col).cast("string").alias("_g"), F.col(order_col).alias("_order"), digest(*[F.col(c) for c in columns]).alias("_node"), kept.alias("_carry"))
    rows, subroots = _climb(_numbered(materialize(leaves, "leaves"), ["_order", "_node"]).drop("_order"))
    # The roots of the groups are the leaves of one more tree.
    named = subroots.select(F.lit(0).alias("_g"), F.col("_g").alias("_order"), F.col("_root").alias("_node"), F.col("_g").alias("_carry"))
    top, _ = _climb(_numbered(materialize(named, "subroots"), ["_order"]).drop("_order"))
    top = materialize(top.select(F.col("_carry").alias("_tg"), F.col("_root").alias("_top"), F.col("_path").alias("_rest")), "top")
    whole = rows.join(top, F.col("_g").eqNullSafe(F.col("_tg")))
    named = [F.col(f"_carry.c{i}").alias(c) for i, c in enumerate(extra)]
    return whole.select(F.col("_carry.id").alias(order_col), *named, F.col("_leaf").alias("leaf"), F.col("_root").alias("subroot"), F.col("_top").alias("root"), F.concat("_path", "_rest").alias("path"))
