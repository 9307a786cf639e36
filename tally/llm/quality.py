"""Quality classifier: perplexity under a Kneser-Ney model of trusted text, by sharded count joins."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kneser_ney
from .common import bit_array, bits_for, materialize, shared_path, small_batches, test_bits
from .kneser_ney import _folder, _map, _save, _streams
from .tokens import mix, slices

#: Filters in Python tasks hold at most 2**26 bits (8 MB); a fuller one costs time, never rows.
MOST_BITS = 26


def _packed(a: np.ndarray) -> bytes:
    """Numbers as compressed bytes, the like bytes of all numbers together."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T).tobytes())


def _unpacked(raw: bytes, dtype: str) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)).astype("<u8"))


def _unpacked_keys(raw: bytes) -> np.ndarray:
    return _unpacked(raw, "<u8").cumsum(dtype=np.uint64)


#: Rows of a file that form a block.
BLOCK_ROWS = 8192


def _blocks(docs: DataFrame) -> DataFrame:
    """Adds _block: a run of rows of a file, named by the file as it is (path, size, time of change) and the run's place in it.

    However a scan splits its files, a row is in the same block; a file that changes between two scans has other blocks, whose
    answers are missing, and that raises.  Rows that don't come straight from Parquet files are written first.
    """
    block = F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time", F.floor(F.col("_metadata.row_index") / BLOCK_ROWS)).alias("_block")
    try:
        return docs.select(*docs.columns, block)
    except AnalysisException:
        return materialize(docs, "blocks").select(*docs.columns, block)


def _same_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in slices(batches, "_text"):
        blocks = batch.column("_block").to_numpy()
        edge = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]])) if len(blocks) else np.zeros(0, np.int64)
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(blocks)], strict=True):
            yield int(blocks[a]), batch.slice(a, b - a)


def _model_keys(model):
    """Hashes of the model's bigrams, from their shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = model.value.vocabulary.folder
        for batch in batches:
            for s in batch.column("shard").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(mix(np.asarray(_map(folder, f"pairs-{s}", "<u8"))).view(np.int64))], names=["h"])

    return run


def _asked(model, seen, stutter: bool, parts: int, flush: int = 3_000_000):
    """The different bigrams of each block that the model may know: one row for each block and count shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, table, held, size, now = model.value, seen.value, [], 0, None
        first = min(own.present)

        def rows() -> pa.RecordBatch:
            keys = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]))
            shard = np.searchsorted(own.bounds, keys, "right")
            edge = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(keys) else np.zeros(0, np.int64)
            blobs = [_packed_keys(k) for k in np.split(keys, edge[1:])] if len(keys) else [_packed_keys(keys)]  # every block asks
            shards = shard[edge].tolist() if len(keys) else [first]
            n = len(blobs)
            return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array([now % parts] * n, pa.int32()), pa.array([now] * n, pa.int64()), pa.array(blobs, pa.binary())], names=["shard", "part", "block", "keys"])

        for block, batch in _same_blocks(batches):
            if block != now or size > flush:
                if now is not None:
                    yield rows()
                held, size, now = [], 0, block
            ids, before, _ = _streams(own.vocabulary, batch.column("_text"), stutter)
            keys = np.unique((before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64))
            keys = keys[test_bits(table, mix(keys))]
            held.append(keys)
            size += len(keys)
        if now is not None:
            yield rows()

    return run


def _joined(model):
    """A count shard joined with the sorted bigrams that blocks ask of it: each is looked up by binary search in the shard's mapped array."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        out = []
        for raw in table.column("keys").to_pylist():
            keys = _unpacked_keys(raw)
            counts = model.value._pair(keys)
            met = counts > 0
            out.append((_packed_keys(keys[met]), _packed(counts[met].astype("<u4"))))
        return pa.table({"block": table.column("block"), "keys": pa.array([k for k, _ in out], pa.binary()), "counts": pa.array([c for _, c in out], pa.binary())})

    return run


def _write_answers(folder: str):
    """What a block's bigrams count in the model, as one file in the shared folder."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        block = int(key[0].as_py())
        keys = np.concatenate([_unpacked_keys(x) for x in table.column("keys").to_pylist()])
        counts = np.concatenate([_unpacked(x, "<u4") for x in table.column("counts").to_pylist()])
        keys, first = np.unique(keys, return_index=True)
        parts = [_packed_keys(keys), _packed(counts[first])]
        _save(folder, f"answers-{block}", np.frombuffer(len(parts[0]).to_bytes(8, "little") + parts[0] + parts[1], np.uint8))
        return pa.table({"block": pa.array([block]), "n": pa.array([len(keys)])})

    return run


def _answers(folder: str, block: int):
    """Counts of sorted bigram keys from a block's file; one that is missing raises."""
    raw = _map(folder, f"answers-{block}", "u1").tobytes()
    cut = 8 + int.from_bytes(raw[:8], "little")
    known, counts = _unpacked_keys(raw[8:cut]), _unpacked(raw[cut:], "<u4").astype(np.int64)

    def of(keys: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(keys), np.int64)
        i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[i] == keys, counts[i], 0)

    return of


def score(docs: DataFrame, model: kneser_ney.Model, stutter: bool = True) -> DataFrame:
    """Adds n_tokens and score (log10 probability of the text) to the rows of docs; _text is left out.

    The different bigrams of each block of documents are dealt out by count shard; a task joins its mapped
    shard with the sorted bigrams of many blocks (a shard that many blocks ask is given to several tasks); what
    a block asked for comes back as one sorted array, by which a second scan of the block scores its
    texts.  So a bigram is shuffled once for each block, not for each token, and only if a bit filter of
    bounded size says that the model may know it.  Words and contexts, which are few, are mapped.
    """
    spark = docs.sparkSession
    rows = _blocks(docs)
    shared = spark.sparkContext.broadcast(model)  # a few numbers for each shard
    folder = _folder(shared_path(spark, "quality")) if model.present else None
    if folder is not None:
        shards = spark.createDataFrame([(s,) for s in sorted(model.present)], "shard int").repartition(min(len(model.present), 64))
        seen = bit_array(shards.mapInArrow(_model_keys(shared), "h long"), "h", bits_for(model.distinct, MOST_BITS))
        size = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
        parts = max(1, math.ceil(size / 6 / len(model.present) / 2_000_000))
        asked = rows.select("_text", "_block").mapInArrow(_asked(shared, seen, stutter, parts), "shard int, part int, block long, keys binary")
        joined = asked.groupBy("shard", "part").applyInArrow(_joined(shared), "block long, keys binary, counts binary")
        with small_batches(spark):
            joined.groupBy("block").applyInArrow(_write_answers(folder), "block long, n long").write.format("noop").mode("overwrite").save()
    kept = [f for f in docs.schema.fields if f.name != "_text"]
    schema = T.StructType([*kept, T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts_of = None, lambda keys: np.zeros(len(keys), np.int64)
        for block, batch in _same_blocks(batches):
            if block != now and folder is not None:
                now, counts_of = block, _answers(folder, block)
            got = shared.value.score(batch.column("_text"), stutter, counts_of)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(got["n_tokens"].astype(np.int64)), pa.array(got["score"])], names=[f.name for f in schema])

    return rows.select(*[F.col(f.name) for f in kept], "_text", "_block").mapInArrow(run, schema)


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_trusted: int = 20_000, quantile: float = 0.995, slack: float = 0.6, least_cell: int = 40, carry: list[str] | None = None) -> DataFrame:
    """Scores every whole text and rejects those above their language's perplexity threshold.

    Trusted text: rows labelled quality 1 and toxic 0; of these at most `most_trusted` documents,
    those with the smallest hash of the id, so that the sample is bounded and repeatable.  Three
    quarters of it train an interpolated modified Kneser-Ney model; documents get their perplexity by
    sharded count joins (see score).  A word that repeats the one before it counts as unknown, else
    text that stutters would look fluent.  The last quarter, which the model hasn't seen, gives
    thresholds: for each language and length (powers of two of the token count) the
    `quantile` of perplexity, widened by `slack` of its distance from the median; cells with fewer
    than least_cell documents take the language's, and those the whole sample's.

    Returns id, lang, n_tokens, perplexity (log10 per token), threshold, accepted for each row, or, with
    `carry`, those columns of docs and _accepted.
    Null and empty texts have one token, their end; a null or unseen language takes
    the threshold of the whole sample; without any trusted text everything is accepted.  A row that repeats an id is
    scored by itself.  An empty input gives no rows.
    """
    trusted = labels.where("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_tid")).distinct()
    chosen = trusted.withColumn("_h", F.xxhash64("_tid")).orderBy("_h").limit(most_trusted)
    chosen = materialize(chosen.select("_tid", (F.pmod("_h", F.lit(4)) == 0).alias("_calibrates")), "trusted")
    extra = {f"_c{i}": c for i, c in enumerate(carry or [])}
    rows = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).cast("string").alias("_text"), *[F.col(c).alias(n) for n, c in extra.items()])
    # At most most_trusted rows of 9 bytes are broadcast.
    sample = materialize(rows.select("_id", "_lang", "_text").join(F.broadcast(chosen), F.col("_id") == F.col("_tid")), "trusted-text")
    model = kneser_ney.train(sample.where("NOT _calibrates"), "_text")

    per_token = (-F.col("score") / F.col("n_tokens")).alias("perplexity")
    band = F.least(F.floor(F.log2("n_tokens")), F.lit(12)).cast("int").alias("_band")
    held = materialize(score(sample.where("_calibrates").select("_id", "_lang", "_text"), model).select("_lang", per_token, band), "held-out")
    high, mid = F.percentile("perplexity", F.lit(quantile)), F.percentile("perplexity", F.lit(0.5))
    limit = (high + slack * (high - mid)).alias("_limit")
    enough = F.count("*").alias("_n")
    cells = held.groupBy(F.col("_lang").alias("_cl"), F.col("_band").alias("_cb")).agg(limit, enough).where(F.col("_n") >= least_cell)
    langs = held.groupBy(F.col("_lang").alias("_ll")).agg(limit.alias("_limit_lang"), enough).where(F.col("_n") >= least_cell).drop("_n")
    whole = held.agg(F.coalesce(limit, F.lit(float("inf"))).alias("_limit_all"))

    scored = score(rows, model).select("_id", "_lang", "n_tokens", per_token, band, *extra)
    # Thresholds: at most 13 rows for each language of a bounded sample.
    found = scored.join(F.broadcast(cells.drop("_n")), (F.col("_lang") == F.col("_cl")) & (F.col("_band") == F.col("_cb")), "left")
    found = found.join(F.broadcast(langs), F.col("_lang") == F.col("_ll"), "left").crossJoin(F.broadcast(whole))
    threshold = F.coalesce("_limit", "_limit_lang", "_limit_all")
    if carry is not None:
        return found.select(*[F.col(n).alias(c) for n, c in extra.items()], (F.col("perplexity") <= threshold).alias("_accepted"))
    return found.select(F.col("_id").alias(id_col), F.col("_lang").alias("lang"), "n_tokens", "perplexity", threshold.alias("threshold"), (F.col("perplexity") <= threshold).alias("accepted"))
