"""Interleaving of sources at target weights by Pfair scheduling."""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aside, restored, running_sum

#: A schedule of up to so many blocks is broadcast; a longer one is joined by (source, block).
BROADCAST_BLOCKS = 1 << 20


def integer_shares(weights: dict[str, float], period: int) -> dict[str, int]:
    """Weights as whole blocks of a period (largest remainder, at least one block each)."""
    total = sum(weights.values())
    exact = {s: period * w / total for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[: max(0, period - sum(out.values()))]:
        out[s] += 1
    return out


def exact_shares(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportion of the weights, which are binary fractions."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    unit = math.lcm(*(x.denominator for x in exact.values()))
    return {s: int(x * unit) for s, x in exact.items()}


def pfair(shares: dict[str, int]) -> Iterator[str]:
    """The source of each slot, without end.

    Block i (from 1) of a source with weight w = share / sum(shares) is released at slot
    floor((i - 1) / w) and due by ceil(i / w).  Of the released blocks the one with the earliest
    deadline goes next.  At every slot each source is less than one block from its weight.
    """
    total = sum(shares.values())
    given = dict.fromkeys(shares, 0)
    waiting = [(0, s) for s in sorted(shares)]  # by release
    ready: list[tuple[int, str]] = []  # by deadline
    for t in itertools.count():
        while waiting and waiting[0][0] <= t:
            s = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(given[s] + 1) * total // shares[s]), s))
        s = heapq.heappop(ready)[1]
        given[s] += 1
        heapq.heappush(waiting, (given[s] * total // shares[s], s))
        yield s


def pfair_period(shares: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each source's blocks in one period of sum(shares) slots, at whose end each source is
    exactly on its weight."""
    slots: dict[str, list[int]] = {s: [] for s in shares}
    for t, s in enumerate(itertools.islice(pfair(shares), sum(shares.values()))):
        slots[s].append(t)
    return slots


def phases(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[tuple[int, int, dict[str, int], dict[str, int], dict[str, list[int]]]]:
    """Phases (first slot, slots, first block by source, shares, slots by source).

    A phase lasts until a source has given its last block; those left share the next phase in
    proportion to their weights, so no block is dropped or repeated.  Sources of weight 0 wait for
    all others, then share alike.
    """
    done, slot = dict.fromkeys(blocks, 0), 0
    left = {s: n for s, n in blocks.items() if n}
    while left:
        live = {s: weights[s] for s in left if weights[s] > 0} or dict.fromkeys(left, 1)
        shares = exact_shares(live)
        slots: dict[str, list[int]] = {s: [] for s in live}
        for t, s in enumerate(pfair(shares)):
            slots[s].append(t)
            if len(slots[s]) == left[s]:
                break
        yield slot, t + 1, {s: done[s] for s in live}, shares, slots
        for s, own in slots.items():
            done[s] += len(own)
            left[s] -= len(own)
        left = {s: n for s, n in left.items() if n}
        slot += t + 1


def schedule(blocks: dict[str, int], weights: dict[str, float], period: int = 0) -> list[tuple[str, int, int, int, int, list[int]]]:
    """The phases as (source, first block, blocks, first slot, slots of the phase, slots of the blocks).

    `period` has no effect: weights aren't rounded, so nothing repeats.
    """
    return [(s, first[s], len(own), slot, length, own) for slot, length, first, _, slots in phases(blocks, weights) for s, own in sorted(slots.items()) if own]


def block_slots(blocks: dict[str, int], weights: dict[str, float]) -> pa.Table:
    """One row per block: source, block, release, deadline, slot."""
    columns: list[list] = [[], [], [], [], []]
    for slot, _, first, shares, slots in phases(blocks, weights):
        total = sum(shares.values())
        for s, own in slots.items():
            n = len(own)
            columns[0] += [s] * n
            columns[1] += range(first[s], first[s] + n)
            columns[2] += [slot + i * total // shares[s] for i in range(n)]
            columns[3] += [slot - (-(i + 1) * total // shares[s]) for i in range(n)]
            columns[4] += [slot + t for t in own]
    kinds = [pa.string(), *[pa.int64()] * 4]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["_s", "_b", "_release", "_deadline", "_slot"])


def mix_sources(docs: DataFrame, size_col: str, weights: dict[str, float] | None = None, temperature: float = 0.5, block_bytes: int = 1 << 20, period: int = 1000, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Gives every row its slot in a mixture of sources.

    A source's rows in id order are cut into blocks of block_bytes (a longer row takes
    several blocks); blocks are scheduled by `phases`, at weights that aren't rounded.  Without `weights`
    a source's target is its share of bytes to the power `temperature`.  Block numbers come from a
    distributed running sum, so a hot source is spread over tasks.  The driver sees one total for each
    source and makes one row for each block (30,000 at 30 GB).  `period` is kept for callers and has no effect.

    Returns the columns of docs, `block`, `release` and `deadline` (slots, within the
    whole mixture) and `slot`.  Ordering by (slot, id) gives the mixture.  A null source is a source
    of its own; sources missing in `weights` get the smallest weight given; a null size counts 0; rows that
    repeat an id keep the order of size, then of a hash of the row.  An empty input gives no rows.  A column of docs
    named like a result gives way to it; any other name is fine.
    """
    spark = docs.sparkSession
    docs, names = aside(docs)
    id_col, source_col, size_col = (names[c] for c in (id_col, source_col, size_col))
    sized = docs.withColumn("_source", F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")))
    sized = sized.withColumn("_size", F.coalesce(F.col(size_col).cast("long"), F.lit(0)))
    sized = sized.withColumn("_tie", F.xxhash64(*docs.columns))
    summed = running_sum(sized, ["_source"], [id_col, "_size", "_tie"], "_size", "_before")
    totals = {r[0]: int(r[1]) for r in sized.groupBy("_source").agg(F.sum("_size")).collect()}
    blocks = {s: max(1, -(-n // block_bytes)) for s, n in totals.items()}
    if weights is None:
        target = {s: max(1, n) ** temperature for s, n in totals.items()}
    else:
        target = {s: weights.get(s[1:], min(weights.values())) for s in totals}
    table = spark.createDataFrame(block_slots(blocks, target))
    if sum(blocks.values()) <= BROADCAST_BLOCKS:
        table = F.broadcast(table)
    block = F.least(F.floor(F.col("_before") / block_bytes), F.col("_last")).cast("long")
    last = spark.createDataFrame([(s, n - 1) for s, n in blocks.items()] or [("", 0)], "_s2 string, _last long")
    placed = summed.join(F.broadcast(last), F.col("_source") == F.col("_s2")).withColumn("_block", block).select(*docs.columns, "_block", "_source")
    joined = placed.join(table, (F.col("_source") == F.col("_s")) & (F.col("_block") == F.col("_b")))
    return restored(joined, names, F.col("_block").alias("block"), F.col("_release").alias("release"), F.col("_deadline").alias("deadline"), F.col("_slot").alias("slot"))
