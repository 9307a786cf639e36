"""Shards of near-equal bytes by histogram sort."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, materialize, restored


def _keys(ids: np.ndarray, seqs: np.ndarray) -> np.ndarray:
    """(id, sequence number) as 16 bytes that sort as the pair does."""
    pair = np.empty((len(ids), 2), ">u8")
    pair[:, 0] = ids.view(np.uint64) ^ np.uint64(1 << 63)
    pair[:, 1] = seqs.view(np.uint64)
    return np.frombuffer(pair.tobytes(), "S16")


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return (np.ascontiguousarray(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)) for c in ("_key", "_seq"))


def _histogram(probes: np.ndarray):
    """Rows and bytes between neighbouring probes: one row for each bucket met in a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, size = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(probes, _keys(*_columns(batch)), "right")
            n += np.bincount(at, minlength=len(n))
            np.add.at(size, at, batch.column("_size").to_numpy(zero_copy_only=False))
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(n[met]), pa.array(size[met])], names=["bucket", "n", "size"])

    return count


def _within(low: np.ndarray, high: np.ndarray, share: float):
    """A share of the keys inside the open intervals, picked by a hash of the key."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, seqs = _columns(batch)
            keys = _keys(ids, seqs)
            at = np.searchsorted(low, keys, "right") - 1
            inside = (at >= 0) & (keys < high[np.maximum(at, 0)])
            h = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (seqs.view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
            inside &= (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 < share
            yield pa.RecordBatch.from_arrays([pa.array(ids[inside]), pa.array(seqs[inside])], names=["_key", "_seq"])

    return pick


def splitters(rows: DataFrame, shards: int, tolerance: float, probes_each: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """Keys below which i / shards of all bytes lie, within `tolerance` of a shard's bytes.

    rows: (_key, _seq, _size).  Each round
    takes candidate keys from the open interval of each target, counts rows and bytes below every
    candidate exactly over all partitions, and keeps the closest pair around the target.  What
    reaches the driver is a histogram and candidates, both bounded by targets x probes_each.
    Returns the splitters and all candidates that were counted, ascending.
    """
    first = rows.agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
    n, total = int(first[0]), int(first[1])
    targets = np.array([total * i / shards for i in range(1, shards)])
    if not n:
        return np.array([], "S16"), np.array([], "S16")
    schema = "bucket long, n long, size long"
    bottom, top = b"\x00" * 16, b"\xff" * 16
    low, high = np.full(len(targets), bottom, "S16"), np.full(len(targets), top, "S16")
    low_size, high_size = np.zeros(len(targets), np.int64), np.full(len(targets), total, np.int64)
    low_rows, high_rows = np.zeros(len(targets), np.int64), np.full(len(targets), n, np.int64)
    known: set[bytes] = set()
    while True:
        miss = np.minimum(np.abs(low_size - targets), np.abs(high_size - targets)) > tolerance * total / shards
        open_ = miss & (high_rows - low_rows > 1)
        if not open_.any():
            break
        spans = sorted({(low[i], high[i]) for i in np.flatnonzero(open_)})
        between = int(sum({(low[i], high[i]): int(high_rows[i] - low_rows[i]) for i in np.flatnonzero(open_)}.values()))
        share = min(1.0, probes_each * len(spans) * max(1, open_.sum() // len(spans)) / max(1, between))
        picked = rows.mapInArrow(_within(np.array([a for a, _ in spans], "S16"), np.array([b for _, b in spans], "S16"), share), "_key long, _seq long").toPandas()
        fresh = np.unique(_keys(picked["_key"].to_numpy(np.int64), picked["_seq"].to_numpy(np.int64)))
        fresh = np.array([k for k in fresh.tolist() if k not in known], "S16")
        if not len(fresh):
            if share >= 1.0:  # no key strictly inside is left
                break
            probes_each *= 4
            continue
        counted = rows.mapInArrow(_histogram(fresh), schema).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).toPandas()
        per_n, per_size = np.zeros(len(fresh) + 1, np.int64), np.zeros(len(fresh) + 1, np.int64)
        per_n[counted["bucket"].to_numpy(np.int64)] = counted["n"]
        per_size[counted["bucket"].to_numpy(np.int64)] = counted["size"]
        below_n, below_size = per_n.cumsum()[:-1], per_size.cumsum()[:-1]
        known.update(fresh.tolist())
        for i in np.flatnonzero(open_):
            left = np.searchsorted(below_size, targets[i], "right") - 1
            if left >= 0 and below_n[left] > low_rows[i]:
                low[i], low_size[i], low_rows[i] = fresh[left], below_size[left], below_n[left]
            right = np.searchsorted(below_size, targets[i], "left")
            if right < len(fresh) and below_n[right] < high_rows[i]:
                high[i], high_size[i], high_rows[i] = fresh[right], below_size[right], below_n[right]
    found = np.where(np.abs(low_size - targets) <= np.abs(high_size - targets), low, high)
    return found, np.array(sorted(known), "S16")


def _place(cuts: np.ndarray):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(cuts, _keys(*_columns(batch)), "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], names=[*batch.schema.names, "_range"])

    return place


def shard_by_bytes(docs: DataFrame, size_col: str, shards: int = 16, key_col: str = "doc_id", tolerance: float = 0.002, ranges: int = 12) -> DataFrame:
    """Deals rows into `shards` key ranges of near-equal bytes (sum of `size_col`).

    Histogram sort: candidate boundaries are refined by exact byte counts over all partitions until
    each splitter is within `tolerance` of a shard's bytes (or a single row straddles the
    target); then one exchange moves every row to its place.  The key is (key_col, row number at
    reading), so rows that repeat a key, even a third of all, can be parted.  Each shard is dealt
    out as about `ranges` smaller ranges, whose exact row counts give gapless slots without one
    task for a whole shard.

    Returns the columns of docs, shard (int), slot (long, from 0 in key order).  Rows without a key
    come first; rows without a size count 0 bytes; an empty input gives no rows.  A column of docs named
    shard or slot gives way to the result; any other name is fine.
    """
    docs, names = aside(docs)
    key_col, size_col = names[key_col], names[size_col]
    kept = materialize(docs.withColumn("_key", F.coalesce(F.col(key_col).cast("long"), F.lit(-(1 << 63)))).withColumn("_size", F.coalesce(F.col(size_col).cast("long"), F.lit(0))).withColumn("_seq", F.monotonically_increasing_id()), "sized")
    rows = kept.select("_key", "_seq", "_size")
    cuts, keys = splitters(rows, shards, tolerance)
    # Probes that were counted anyway serve as inner boundaries, spread evenly over the rows.
    inner = keys[np.unique(np.linspace(0, len(keys) - 1, min(len(keys), shards * ranges)).astype(int))] if len(keys) else keys
    ends = np.unique(np.concatenate([cuts, inner]))
    counts = rows.mapInArrow(_histogram(ends), "bucket long, n long, size long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(len(ends) + 1, np.int64)
    n[counts["bucket"].to_numpy(np.int64)] = counts["n"]
    shard_of = np.searchsorted(np.sort(cuts), np.concatenate([[b"\x00" * 16], ends]).astype("S16"), "right")
    start = n.cumsum() - n
    first = {s: start[np.flatnonzero(shard_of == s)[0]] for s in np.unique(shard_of)}
    table = [(i, int(s), int(start[i] - first[s])) for i, s in enumerate(shard_of)]
    # One row for each range: at most shards x (ranges + 1) rows.
    places = docs.sparkSession.createDataFrame(table, "_r int, _shard int, _before long")
    placed = kept.mapInArrow(_place(ends), T.StructType([*kept.schema.fields, T.StructField("_range", T.IntegerType())]))
    inside = Window.partitionBy("_range").orderBy("_key", "_seq")
    numbered = placed.withColumn("_n", F.row_number().over(inside) - 1)
    out = numbered.join(F.broadcast(places), F.col("_range") == F.col("_r"))
    return restored(out, names, F.col("_shard").alias("shard"), (F.col("_before") + F.col("_n")).alias("slot"))
