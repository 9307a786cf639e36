"""Substring deduplication with a log-structured index of window fingerprints."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bit_array, bit_words, bits_for, materialize, shared_path, test_bits, with_bit
from .tokens import mix, slices, texts_in, word_hashes

#: Filters hold at most 2**26 bits (8 MB) in Python tasks and 2**24 bits in joins.
MOST_BITS, MOST_DOC_BITS = 26, 24
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


class Rolling:
    """Hashes of word ranges: sums of word hashes times powers, made independent of the place."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, words: np.ndarray) -> Rolling:
        if len(self.up) < len(words) + 1:
            n = len(words) * 5 // 4 + 2
            self.up, self.down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.multiply.accumulate(self.up), np.multiply.accumulate(self.down)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.up[: len(words)], dtype=np.uint64)])
        return self

    def ranges(self, start: np.ndarray, length) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.down[start])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    pad = -len(values) % width
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    blocks = np.concatenate([values, np.full(pad, top)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


class Runs:
    """Runs of windows that share a fingerprint, over some texts.

    A window's fingerprint is the least hash among the `gram`-word ranges inside it: equal windows
    have equal fingerprints, and neighbouring windows mostly share theirs, so one entry stands
    for a run of windows.
    """

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram
        self.rolling = Rolling()

    def of(self, texts: pa.Array):
        words, n = word_hashes(texts, False)
        begin = n.cumsum() - n
        roll = self.rolling.of(words)
        grams = roll.ranges(np.arange(max(0, len(words) - self.gram + 1)), self.gram)
        least = sliding_min(grams, self.window - self.gram + 1)
        many = np.maximum(n - self.window + 1, 0)  # windows of each text
        text = np.repeat(np.arange(len(texts)), many)
        start = np.arange(len(text)) - np.repeat(many.cumsum() - many, many)  # in the text
        at = start + begin[text]
        print_ = least[at] if len(at) else least[:0]
        new = np.ones(len(at), bool)
        new[1:] = (print_[1:] != print_[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
        whole = roll.ranges(at[first], count + self.window - 1) + count.astype(np.uint64)
        return roll, text[first], print_[first], whole, start[first], count, at[first]


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _entries(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = Runs(window, gram)
        for batch in slices(batches, "_text"):
            texts = batch.column("_text")
            _, text, print_, whole, start, count, _ = runs.of(texts)
            take = pa.array(text)
            yield pa.RecordBatch.from_arrays([_signed(print_), _signed(whole), batch.column("_id").take(take), batch.column("_row").take(take), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))], names=["fp", "whole", "_id", "_row", "start", "n"])

    return run


def _owner_keys(fp: np.ndarray, whole: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return mix(fp.view(np.uint64) ^ mix(whole.view(np.uint64) ^ mix(ids.view(np.uint64))))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        columns = (np.ascontiguousarray(b.column(c).to_numpy()) for c in ("fp", "whole", "owner"))
        yield pa.RecordBatch.from_arrays([_signed(_owner_keys(*columns))], names=["h"])


def _windows(window: int, gram: int, shared):
    """The single windows of the runs that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, table = Runs(window, gram), shared.value
        for batch in slices(batches, "_text"):
            texts = batch.column("_text")
            roll, text, print_, whole, start, count, at = runs.of(texts)
            ids = batch.column("_id").to_numpy().astype(np.int64)
            hit = test_bits(table, _owner_keys(print_, whole, ids[text]))
            text, print_, start, count, at = text[hit], print_[hit], start[hit], count[hit], at[hit]
            step = np.arange(count.sum()) - np.repeat(count.cumsum() - count, count)
            take = pa.array(np.repeat(text, count))
            words = roll.ranges(np.repeat(at, count) + step, window)
            yield pa.RecordBatch.from_arrays([_signed(np.repeat(print_, count)), _signed(words), batch.column("_id").take(take), batch.column("_row").take(take), pa.array((np.repeat(start, count) + step).astype(np.int32))], names=["fp", "h", "_id", "_row", "start"])

    return run


class FingerprintIndex:
    """A log-structured index in a shared folder: sorted immutable runs of (fingerprint, content hash of the run of
    windows, least id), and of each fingerprint's least and greatest content.

    Runs are Parquet, bucketed and sorted by their key, so the merge joins of a batch with the runs before
    neither shuffle nor sort them.  Two runs of one level are compacted by a merge join into one of the next; a
    run is complete once Spark has marked it so, and a wider complete run replaces the narrower ones, so a writer
    that dies leaves a valid index.  An index that is opened again holds what was added before.  One writer at a time.
    """

    ENTRY, SUMMARY = ("fp", "whole"), ("fp",)

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[tuple[int, int, int]] = []  # level, first and last batch
        jvm = spark._jvm.org.apache.hadoop.fs
        done = jvm.Path(f"{self.path}/run-*/entries/_SUCCESS")
        names = [s.getPath().getParent().getParent().getName() for s in done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done) or []]
        found = []
        for name in names:
            level, first, last, self.buckets = map(int, name.split("-")[1:])
            found.append((level, first, last))
        for level, first, last in sorted(found, key=lambda r: (r[1], -r[2])):
            if not self.runs or first > self.runs[-1][2]:
                self.runs.append((level, first, last))

    def _dir(self, run: tuple[int, int, int]) -> str:
        return f"{self.path}/run-{run[0]:02d}-{run[1]:06d}-{run[2]:06d}-{self.buckets}"

    def _table(self, run: tuple[int, int, int], kind: str) -> DataFrame:
        """A run as a bucketed table; Spark takes the buckets' order from the one file that each has."""
        name = f"run_{abs(hash(self._dir(run))):x}_{kind}"
        columns, by = ("fp BIGINT, whole BIGINT, owner BIGINT, last BIGINT", self.ENTRY) if kind == "entries" else ("fp BIGINT, low BIGINT, high BIGINT", self.SUMMARY)
        keys = ", ".join(by)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self._dir(run)}/{kind}'")
        return self.spark.table(name)

    def _write(self, rows: DataFrame, run: tuple[int, int, int], kind: str) -> None:
        by = self.ENTRY if kind == "entries" else self.SUMMARY
        name = f"write_{uuid.uuid4().hex}"
        rows.write.mode("overwrite").option("path", f"{self._dir(run)}/{kind}").bucketBy(self.buckets, *by).sortBy(*by).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # an external table: its files stay

    def _ordered(self, action):
        """Runs an action while Spark trusts the order of bucket files (each bucket has one)."""
        key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
        before = self.spark.conf.get(key, None)
        self.spark.conf.set(key, "true")
        try:
            return action()
        finally:
            self.spark.conf.unset(key) if before is None else self.spark.conf.set(key, before)

    def entries(self) -> DataFrame:
        """(fp, whole, owner) of all live runs; a content may stand in several."""
        out = None
        for r in self.runs:
            t = self._table(r, "entries").select("fp", "whole", "owner")
            out = t if out is None else out.unionByName(t)
        return out if out is not None else self.spark.createDataFrame([], "fp long, whole long, owner long")

    def add(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Adds a batch (fp, whole, _id, _row, start, n) whose ids are greater than those before.

        Returns its entries whose whole run a document with a smaller id holds, and the fingerprints
        under which the batch and the index hold different contents.
        """
        seq = self.runs[-1][2] + 1 if self.runs else 0
        run = (0, seq, seq)
        last = F.max("_id")
        # `last` only where ids differ: most contents have one holder.
        grouped = batch.groupBy("fp", "whole").agg(F.min("_id").alias("owner"), F.when(last > F.min("_id"), last).alias("last"))
        self._write(batch.groupBy("fp").agg(F.min("whole").alias("low"), F.max("whole").alias("high")), run, "summary")
        self._write(grouped, run, "entries")  # the last to be marked complete
        own, held = self._table(run, "entries"), [F.col("owner")]
        prints, low, high = self._table(run, "summary"), [F.col("low")], [F.col("high")]
        for i, r in enumerate(self.runs):
            t = self._table(r, "entries").select("fp", "whole", F.col("owner").alias(f"o{i}"))
            own, held = own.join(t.hint("merge"), ["fp", "whole"], "left"), [*held, F.col(f"o{i}")]
            t = self._table(r, "summary").select("fp", F.col("low").alias(f"l{i}"), F.col("high").alias(f"h{i}"))
            prints, low, high = prints.join(t.hint("merge"), "fp", "left"), [*low, F.col(f"l{i}")], [*high, F.col(f"h{i}")]
        least = F.least(*held) if len(held) > 1 else held[0]
        owners = own.select("fp", "whole", least.alias("owner"), F.coalesce("last", "owner").alias("last")).where("owner < last").select("fp", "whole", "owner")
        mixed = prints.where((F.least(*low) if len(low) > 1 else low[0]) < (F.greatest(*high) if len(high) > 1 else high[0])).select("fp")
        owners, mixed = self._ordered(lambda: (materialize(owners, "owners-before"), materialize(mixed, "mixed")))
        found = batch.join(owners, ["fp", "whole"]).where("owner < _id")
        found = materialize(found.select("_id", "_row", "start", "n"), "found")
        self.runs.append(run)
        self.compact()
        return found, mixed

    def compact(self) -> None:
        """Merges the last two runs as long as they are of one level."""
        while len(self.runs) > 1 and self.runs[-1][0] == self.runs[-2][0]:
            a, b = self.runs[-2:]
            run = (a[0] + 1, a[1], b[2])
            old, new = (self._table(r, "summary").select("fp", F.col("low").alias(f"l{i}"), F.col("high").alias(f"h{i}")) for i, r in enumerate((a, b)))
            merged = old.join(new.hint("merge"), "fp", "full").select("fp", F.least("l0", "l1").alias("low"), F.greatest("h0", "h1").alias("high"))
            self._ordered(lambda m=merged, r=run: self._write(m, r, "summary"))
            old, new = (self._table(r, "entries").select("fp", "whole", F.col("owner").alias(f"o{i}")) for i, r in enumerate((a, b)))
            merged = old.join(new.hint("merge"), ["fp", "whole"], "full").select("fp", "whole", F.least("o0", "o1").alias("owner"), F.lit(None).cast("long").alias("last"))
            self._ordered(lambda m=merged, r=run: self._write(m, r, "entries"))
            self.runs[-2:] = [run]


def _apply(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in(batches, "_text"):
            spans = batch.column("_spans").to_pylist() if "_spans" in batch.schema.names else [None] * len(texts)
            kept, total, gone = [], [], []
            for t, cut in zip(texts, spans, strict=True):
                words = (t or b"").split()
                total.append(len(words))
                if cut:
                    edge = np.zeros(len(words) + 1, np.int64)
                    a = np.array([(s["start"], s["n"]) for s in cut], np.int64)
                    np.add.at(edge, a[:, 0], 1)
                    np.add.at(edge, a[:, 0] + a[:, 1] + window - 1, -1)
                    stay = edge.cumsum()[:-1] == 0
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())], names=["_id", "text", "n_words", "n_removed"])

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = 10, batches: int = 3, index_path: str | None = None, history: DataFrame | None = None) -> DataFrame:
    """Removes each word that is covered by a window of `window` words whose word sequence also
    starts in a document with a smaller id.

    1. One scan gives the entries: runs of windows with one fingerprint, about one for every
       (window - gram) / 2 words, with a hash of all words of the run.
    2. Documents enter the index in batches of ascending id.  A batch is merge-joined with the
       sorted runs of earlier batches and its own; an entry whose whole run a smaller id holds is
       settled.
    3. Verification: where runs of different content share a fingerprint, the least holder of each
       content (found by a bit filter of bounded size in a second scan) gives its single
       windows; those are grouped by fingerprint and 64-bit hash of the 50 words (128 bits together).
    4. Only texts that lose words are shuffled, with their spans.

    With `index_path`, a folder that all executors share, the index stays there and later calls add to it:
    pass the documents of the calls before as `history` (of its texts only the holders that step 3 asks for
    are looked into), and only documents with greater ids as docs.  Without, the index lives in a new folder.

    Hot passages are aggregated with partial sums and joined from written tables, whose hot keys
    Spark can split; no group is collected.  All windows of whole texts count, as they are in the input.

    Returns id, text (kept words joined by one space), n_words, n_removed for each input row.  Null
    and empty texts have no words.  Rows that repeat an id are one document: they don't remove each
    other's words, and each loses its own.  Rows without an id lose nothing and remove nothing.
    """
    spark = docs.sparkSession
    light = lambda d: d.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")).withColumn("_row", F.xxhash64("_text"))
    rows = light(docs)
    known = rows.where("_id IS NOT NULL")
    index = FingerprintIndex(spark, index_path or shared_path(spark, "fingerprints"))
    if index.runs and history is None:
        raise ValueError("the index holds documents already: pass them as history")
    schema = "fp long, whole long, _id long, _row long, start int, n int"
    entries = materialize(known.mapInArrow(_entries(window, gram), schema), "entries")
    cuts = (known.agg(F.percentile_approx("_id", F.array(*[F.lit(i / batches) for i in range(1, batches)]), F.lit(1000))).first()[0] or []) if batches > 1 else []
    settled, mixes = [], []
    edges = [None, *sorted(set(cuts)), None]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        part = entries if low is None else entries.where(F.col("_id") > low)
        found, mixed = index.add(part if high is None else part.where(F.col("_id") <= high))
        settled.append(found)
        mixes.append(mixed)

    mixed = mixes[0]
    for m in mixes[1:]:
        mixed = mixed.unionByName(m)
    mixed = materialize(mixed.distinct().select(F.col("fp").alias("_fp")), "mixed-all")
    log2_fps = bits_for(mixed.count(), MOST_DOC_BITS)
    asked = with_bit(index.entries(), F.xxhash64("fp"), bit_words(mixed.select(F.xxhash64("_fp").alias("_h")), "_h", log2_fps), log2_fps, "_maybe").where("_maybe")
    owners = asked.join(mixed, F.col("fp") == F.col("_fp"), "left_semi").groupBy("fp", "whole").agg(F.min("owner").alias("owner"))
    owners = materialize(owners, "owners")
    keys = owners.mapInArrow(_keys, "h long")
    log2_bits = bits_for(owners.count(), MOST_BITS)
    shared = bit_array(keys, "h", log2_bits)
    spread = lambda d: d.mapInArrow(_windows(window, gram, shared), "fp long, h long, _id long, _row long, start int")
    single = spread(known).withColumn("_new", F.lit(True))
    if history is not None:
        single = single.unionByName(spread(light(history).where("_id IS NOT NULL")).withColumn("_new", F.lit(False)))
    single = materialize(single, "windows")
    held = materialize(single.groupBy("fp", "h").agg(F.min("_id").alias("_owner"), F.max("_id").alias("_last")).where("_owner < _last").select("fp", "h", "_owner"), "held")
    spans = single.where("_new").join(held, ["fp", "h"]).where("_owner < _id").select("_id", "_row", "start", F.lit(1).alias("n"))
    for part in settled:
        spans = spans.unionByName(part)
    spans = spans.groupBy(F.col("_id").alias("_did"), F.col("_row").alias("_drow")).agg(F.collect_list(F.struct("start", "n")).alias("_spans"))
    spans = materialize(spans, "spans")

    bits = bits_for(spans.count(), MOST_DOC_BITS)
    words = bit_words(spans.select(F.xxhash64("_did", "_drow").alias("_h")), "_h", bits)
    marked = with_bit(rows, F.xxhash64("_id", "_row"), words, bits, "_loses")
    out = T.StructType([T.StructField("_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    whole = marked.where("NOT _loses").select("_id", "_text").mapInArrow(_apply(window), out)
    some = marked.where("_loses").join(spans, (F.col("_id") == F.col("_did")) & (F.col("_row") == F.col("_drow")), "left").select("_id", "_text", "_spans").mapInArrow(_apply(window), out)
    return whole.unionByName(some).withColumnRenamed("_id", id_col)
