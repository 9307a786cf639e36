"""Interpolated modified Kneser-Ney bigram models, counted in Spark and read by memory-mapping.

The words of the training texts get dense ids: their rank among all 64-bit word hashes.  A bigram is
the 64-bit key (id of the first word, id of the second), which is exact.  Vocabulary and bigrams are
sharded by key; each shard is one sorted array in the shared folder, written by the
task that owns the shard and mapped, not loaded, by the tasks that score.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shared_path, small_batches
from .tokens import slices, word_hashes

#: Stands for the end of each text among the hashes of words.
END = np.uint64(2)
LOW = np.uint64(0xFFFFFFFF)
PAIR = np.dtype([("key", "<u8"), ("n", "<u4")])


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text's end among them, and tokens per text."""
    words, n = word_hashes(column, True)
    many = n + 1
    last = many.cumsum() - 1
    out, inside = np.empty(len(words) + len(n), np.uint64), np.ones(len(words) + len(n), bool)
    inside[last] = False
    out[inside], out[last] = words, END
    return out, many


def _folder(url: str) -> str:
    """A path that open() takes.  Memory maps need a shared folder that is mounted on the workers."""
    parts = urlparse(url)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"the shared folder must be mounted to be memory-mapped, not {parts.scheme}://; set spark.checkpoint.dir to a mounted path")
    return parts.path


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Written aside and renamed, so a retried or doubled task leaves one whole file."""
    os.makedirs(folder, exist_ok=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    array.tofile(part)
    os.rename(part, f"{folder}/{name}")


def _map(folder: str, name: str, dtype) -> np.ndarray:
    """A mapped array.  Every shard has a file, so a missing one means that the folder isn't shared: that
    raises, as zeros would be scored silently."""
    path, item = f"{folder}/{name}", np.dtype(dtype).itemsize
    size = os.path.getsize(path)  # raises if it isn't there
    if size % item:
        raise OSError(f"{path} holds {size} bytes, not whole items of {item}")
    return np.memmap(path, dtype, "r") if size else np.zeros(0, dtype)


def _make_room(maps: dict, most: int = 2048) -> None:
    """Forgets all maps when there are too many: a process may hold only so many, however many shards."""
    if len(maps) >= most:
        maps.clear()


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order].astype(np.int64), first)


def _blobs(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    """One row for each shard: keys sorted within it.  `shard` ascends with the keys."""
    edge = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else np.zeros(0, np.int64)
    ends = np.append(edge[1:], len(keys))[: len(edge)]
    rows = [(int(shard[a]), keys[a:b].tobytes(), counts[a:b].astype("<u4").tobytes()) for a, b in zip(edge, ends, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["shard", "keys", "counts"])


BLOBS = "shard int, keys binary, counts binary"


def _gather(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [np.frombuffer(x, "<u8") for x in table.column("keys").to_pylist()]
    counts = [np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()]
    return _summed(np.concatenate(keys), np.concatenate(counts))


def _count_words(bits: int, flush: int):
    """Counts of word hashes, combined in the task, dealt out by the top bits of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0

        def blobs() -> pa.RecordBatch:
            k, n = _summed(np.concatenate(keys), np.concatenate(counts))
            return _blobs(k, n, (k >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(k), np.int64))

        for batch in slices(batches, "_text"):
            k, n = np.unique(_tokens(batch.column("_text"))[0], return_counts=True)
            keys.append(k)
            counts.append(n)
            held += len(k)
            if held > flush:
                yield blobs()
                keys, counts, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        yield blobs()

    return run


@dataclass
class Vocabulary:
    """Sorted word hashes in 2**bits shards; a word's id is its rank."""

    folder: str
    bits: int
    start: list[int]  # first id of each shard, and the size of the vocabulary
    maps: dict[int, np.ndarray] = field(default_factory=dict)

    @property
    def size(self) -> int:
        return self.start[-1]

    def rank(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of word hashes; unknown words get the size of the vocabulary."""
        out = np.full(len(hashes), self.size, np.int64)
        shard = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        for s in np.unique(shard):
            if self.start[s] == self.start[s + 1]:  # no word, no file
                continue
            if s not in self.maps:
                _make_room(self.maps)
                self.maps[s] = _map(self.folder, f"words-{s}", "<u8")
            keys, at = self.maps[s], np.flatnonzero(shard == s)
            if len(keys):
                i = np.minimum(np.searchsorted(keys, hashes[at]), len(keys) - 1)
                hit = keys[i] == hashes[at]
                out[at[hit]] = i[hit] + self.start[s]
        return out

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        different, at = np.unique(hashes, return_inverse=True)
        return self.rank(different)[at]


def _streams(vocabulary: Vocabulary, column: pa.Array, stutter: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all tokens of the texts, of the tokens before them, and tokens per text.

    The start before a text has the id size + 1: no text holds it as a token.  With `stutter`, a
    word equal to the one before it counts as unknown.
    """
    hashes, n = _tokens(column)
    ids = vocabulary.ids(hashes)
    first = n.cumsum() - n
    if stutter:
        same = np.zeros(len(ids), bool)
        same[1:] = hashes[1:] == hashes[:-1]
        same[first] = False
        ids[same] = vocabulary.size
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[first] = vocabulary.size + 1
    return ids, before, n


def _count_pairs(vocabulary: Vocabulary, bounds: np.ndarray, flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0

        def blobs() -> pa.RecordBatch:
            k, n = _summed(np.concatenate(keys), np.concatenate(counts))
            return _blobs(k, n, np.searchsorted(bounds, k, "right"))

        for batch in slices(batches, "_text"):
            ids, before, _ = _streams(vocabulary, batch.column("_text"))
            k = (before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)
            k, n = np.unique(k, return_counts=True)
            keys.append(k)
            counts.append(n)
            held += len(k)
            if held > flush:
                yield blobs()
                keys, counts, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        yield blobs()

    return run


@dataclass
class Model:
    """Where the arrays lie, and the numbers that all of them share."""

    vocabulary: Vocabulary
    bounds: np.ndarray
    tokens: int  # N: training tokens, ends among them
    distinct: int  # different bigrams
    discount: tuple[np.ndarray, np.ndarray]  # of bigrams, of continuation counts; by count 0, 1, 2, 3+
    maps: dict[str, np.ndarray] = field(default_factory=dict)
    present: frozenset[int] = frozenset()  # shards of bigrams that have any

    def _shard(self, name: str, dtype) -> np.ndarray:
        if name not in self.maps:
            _make_room(self.maps)
            self.maps[name] = _map(self.vocabulary.folder, name, dtype)
        return self.maps[name]

    def _word(self, ids: np.ndarray) -> np.ndarray:
        """Rows of the words' table for sorted ids; zeros where there is none."""
        out = np.zeros(len(ids), WORD)
        start = np.array(self.vocabulary.start)
        cut = np.searchsorted(ids, start)
        for s in range(len(start) - 1):
            if cut[s] < cut[s + 1]:
                out[cut[s] : cut[s + 1]] = self._shard(f"table-{s}", WORD)[ids[cut[s] : cut[s + 1]] - start[s]]
        if self.tokens and len(ids) and ids[-1] == self.vocabulary.size + 1:  # the start is no word but has followers
            begin = self._shard("table-start", WORD)
            if len(begin):
                out[ids == self.vocabulary.size + 1] = begin[0]
        return out

    def _pair(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted bigram keys."""
        out = np.zeros(len(keys), np.int64)
        shard = np.searchsorted(self.bounds, keys, "right")
        for s in np.unique(shard):
            if s not in self.present:
                continue
            a, b = np.searchsorted(shard, s), np.searchsorted(shard, s, "right")
            table = self._shard(f"pairs-{s}", "<u8")
            if len(table):
                i = np.minimum(np.searchsorted(table, keys[a:b]), len(table) - 1)
                hit = table[i] == keys[a:b]
                counts = self._shard(f"counts-{s}", "u1")[i].astype(np.int64)
                big = self._shard(f"big-{s}", PAIR)
                full = np.flatnonzero(hit & (counts == 255))
                if len(full):
                    counts[full] = big["n"][np.searchsorted(big["key"], keys[a:b][full])]
                out[a:b] = np.where(hit, counts, 0)
        return out

    def score(self, column: pa.Array, stutter: bool = False, counts_of=None) -> dict[str, np.ndarray]:
        """Per text: n_tokens, n_known, base and score, the log10 probabilities of both models.

        counts_of: another way to the counts of sorted bigram keys than the mapped shards.
        """
        ids, before, n = _streams(self.vocabulary, column, stutter)
        size = self.vocabulary.size
        words, back = np.unique(ids, return_inverse=True)
        table = self._word(words)
        cont = table["cont"].astype(np.int64)
        d = self.discount[1]
        kinds = max(1, self.distinct)
        # Unigrams: continuation counts, discounted, over a uniform share for all words and the unknown.
        lower = np.maximum(cont - d[np.minimum(cont, 3)], 0) / kinds + self.rest / (size + 1)
        if not self.distinct:
            lower[:] = 1 / (size + 1)
        count = table["count"].astype(np.float64)
        base = np.log10((count + 1) / (self.tokens + size + 1))
        contexts, at = np.unique(before, return_inverse=True)
        after = self._word(contexts)
        d = self.discount[0]
        total = after["after"].astype(np.float64)
        free = (d[1] * after["n1"] + d[2] * after["n2"] + d[3] * after["n3"]) / np.maximum(total, 1)
        free[total == 0] = 1.0
        keys, pair_of = np.unique((before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64), return_inverse=True)
        c = (counts_of or self._pair)(keys)
        high = np.maximum(c - d[np.minimum(c, 3)], 0)
        p = high[pair_of] / np.maximum(total, 1)[at] + free[at] * lower[back]
        starts = np.concatenate([[0], n.cumsum()[:-1]]).astype(np.int64)
        return {
            "n_tokens": n,
            "n_known": np.add.reduceat((count > 0)[back].astype(np.int64), starts),
            "base_score": np.add.reduceat(base[back], starts),
            "score": np.add.reduceat(np.log10(p), starts),
        }

    @property
    def rest(self) -> float:
        """The share that discounting takes from the continuation counts."""
        return self.freed / max(1, self.distinct)

    freed: float = 0.0


#: A word's row: its count, the different words before it, and as a context its count and the words that follow once, twice, more.
WORD = np.dtype([("count", "<u4"), ("cont", "<u4"), ("after", "<u4"), ("n1", "<u4"), ("n2", "<u4"), ("n3", "<u4")])


def discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2, 3+ from the numbers of n-grams that
    occur 1, 2, 3 and 4 times; where those numbers allow none, 0.5, 1 and 1.5."""
    n1, n2, n3, n4 = n
    if min(n1, n2, n3) == 0:
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([min(max(x, 0.05 * i), i) for i, x in enumerate(d)])


def _write_words(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = int(key[0].as_py())
        keys, counts = _gather(table)
        _save(folder, f"words-{shard}", keys.astype("<u8"))
        _save(folder, f"freq-{shard}", np.minimum(counts, 0xFFFFFFFF).astype("<u4"))
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(keys)]), "total": pa.array([int(counts.sum())])})

    return run


def _heavy(folder: str, least: int):
    """(shard, place, count) of words that are at least `least` times in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.column("shard").to_pylist():
                freq = _map(folder, f"freq-{s}", "<u4")
                at = np.flatnonzero(freq >= least)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), s, np.int32)), pa.array(at.astype(np.int64)), pa.array(freq[at].astype(np.int64))], names=["shard", "place", "n"])

    return run


def _write_pairs(folder: str, starts: np.ndarray):
    """Writes a shard of bigrams; yields, dealt out by shards of the vocabulary, what the words'
    tables need: kind 0, of first words (id, count, n1, n2, n3), kind 1, of second words (id, n)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = int(key[0].as_py())
        keys, counts = _gather(table)
        _save(folder, f"pairs-{shard}", keys.astype("<u8"))
        _save(folder, f"counts-{shard}", np.minimum(counts, 255).astype("u1"))
        big = np.zeros(int((counts >= 255).sum()), PAIR)
        big["key"], big["n"] = keys[counts >= 255], np.minimum(counts[counts >= 255], 0xFFFFFFFF)
        _save(folder, f"big-{shard}", big)
        first = (keys >> np.uint64(32)).astype(np.int64)
        edge = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else np.zeros(0, np.int64)
        rows: list[tuple[int, int, bytes]] = []
        if len(edge):
            stat = np.stack([first[edge], np.add.reduceat(counts, edge), *(np.add.reduceat((counts == i if i < 3 else counts >= 3).astype(np.int64), edge) for i in (1, 2, 3))]).astype("<i8")
            second, n = np.unique(keys & LOW, return_counts=True)
            for kind, ids, block in ((0, stat[0], stat), (1, second.astype(np.int64), np.stack([second.astype(np.int64), n]).astype("<i8"))):
                cut = np.searchsorted(ids, starts)  # the last shard holds the start of texts
                for s in range(len(starts)):
                    a, b = cut[s], cut[s + 1] if s + 1 < len(starts) else len(ids)
                    if a < b:
                        rows.append((s, kind, np.ascontiguousarray(block[:, a:b].astype("<u4")).tobytes()))
        seen = [int((counts == i).sum()) for i in (1, 2, 3, 4)]
        rows.append((-1, 2, np.array([*seen, len(keys), shard], "<u8").tobytes()))
        return pa.table({"word_shard": pa.array([r[0] for r in rows], pa.int32()), "kind": pa.array([r[1] for r in rows], pa.int32()), "block": pa.array([r[2] for r in rows], pa.binary())})

    return run


def _write_table(folder: str, starts: np.ndarray):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = int(key[0].as_py())
        words = shard < len(starts) - 1
        base = int(starts[shard]) if words else int(starts[-1]) + 1
        n = int(starts[shard + 1] - starts[shard]) if words else 1
        out = np.zeros(n, WORD)
        if words and n:
            out["count"] = _map(folder, f"freq-{shard}", "<u4")
        for kind, raw in zip(table.column("kind").to_pylist(), table.column("block").to_pylist(), strict=True):
            block = np.frombuffer(raw, "<u4").reshape(5 if kind == 0 else 2, -1)
            at = block[0].astype(np.int64) - base
            for name, values in zip(("after", "n1", "n2", "n3") if kind == 0 else ("cont",), block[1:], strict=True):
                out[name][at] += values  # an id is once in a block
        _save(folder, f"table-{shard}" if words else "table-start", out)
        cont = out["cont"][out["cont"] > 0]
        return pa.table({"seen": pa.array([[int((cont == i).sum()) for i in (1, 2, 3, 4)] + [int((cont >= 3).sum())]], pa.list_(pa.int64()))})

    return run


def train(docs: DataFrame, text_col: str = "text", tokens_per_shard: int = 2_000_000, flush: int = 1_500_000) -> Model:
    """Counts a bigram model on all rows of docs, see _train."""
    with small_batches(docs.sparkSession):
        return _train(docs, text_col, tokens_per_shard, flush)


def _train(docs: DataFrame, text_col: str, tokens_per_shard: int, flush: int) -> Model:
    """Counts a bigram model on all rows of docs.

    Three Spark jobs: words, bigrams, and the words' tables.  Tasks combine their counts before
    the shuffle and send sorted blocks, one for each shard and flush; the number of shards grows
    with the number of tokens, and a frequent first word's bigrams are split by second word, so no shard
    outgrows a task.  What comes back to the driver is a few numbers for each shard.
    """
    spark = docs.sparkSession
    folder = _folder(shared_path(spark, "kneser-ney"))
    rows = docs.select(F.col(text_col).cast("string").alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    shards = max(1, size // 6 // tokens_per_shard)
    bits = max(0, min(16, int(shards).bit_length()))
    blobs = rows.mapInArrow(_count_words(bits, flush), BLOBS)
    sizes = blobs.groupBy("shard").applyInArrow(_write_words(folder), "shard int, n long, total long").collect()
    n = [0] * (1 << bits)
    for r in sizes:
        n[r["shard"]] = r["n"]
    tokens = sum(r["total"] for r in sizes)
    starts = [0, *np.cumsum(n).tolist()]
    vocabulary = Vocabulary(folder, bits, starts)
    # Bounds of the bigram shards: even id ranges, and for each frequent first word cuts by second word.
    share = max(1, tokens // max(1, int(shards)))
    held = [(i,) for i, x in enumerate(n) if x]
    frequent = spark.createDataFrame(held, "shard int").repartition(min(len(n), 64)).mapInArrow(_heavy(folder, max(1, share // 2)), "shard int, place long, n long").collect() if held else []
    cuts = {int(i) << 32 for i in np.linspace(0, vocabulary.size + 2, int(shards) + 1)[1:-1]}
    for r in [*[(starts[r["shard"]] + r["place"], r["n"]) for r in frequent], (vocabulary.size + 1, 0)]:
        pieces = -(-2 * r[1] // share)
        cuts |= {(int(r[0]) << 32) + vocabulary.size * j // max(1, pieces) for j in range(max(1, pieces))} | {(int(r[0]) + 1) << 32}
    bounds = np.array(sorted(cuts - {0}), np.uint64)
    pairs = rows.mapInArrow(_count_pairs(vocabulary, bounds, flush), BLOBS)
    begin = np.array(starts, np.int64)
    stats = pairs.groupBy("shard").applyInArrow(_write_pairs(folder, begin), "word_shard int, kind int, block binary")
    path = shared_path(spark, "kneser-ney-stats")
    stats.write.parquet(path)
    stats = spark.read.schema(stats.schema).parquet(path)
    numbers = [np.frombuffer(r[0], "<u8").astype(np.int64) for r in stats.where("word_shard < 0").select("block").collect()]
    seen = np.sum([x[:5] for x in numbers], axis=0) if numbers else np.zeros(5, np.int64)
    every = spark.createDataFrame([(i, 1, b"") for i in range(len(n))], stats.schema)  # shards of words that come in no bigram
    tables = stats.where("word_shard >= 0").unionByName(every).groupBy("word_shard").applyInArrow(_write_table(folder, begin), "seen array<long>").collect()
    cont = np.sum([r[0] for r in tables], axis=0) if tables else np.zeros(5, np.int64)
    d1, d2 = discounts(seen[:4].tolist()), discounts(cont[:4].tolist())
    freed = float(d2[1] * cont[0] + d2[2] * cont[1] + d2[3] * cont[4])
    return Model(vocabulary, bounds, tokens, int(seen[4]), (d1, d2), freed=freed, present=frozenset(int(x[5]) for x in numbers))


def score(docs: DataFrame, model: Model, text_col: str = "text", stutter: bool = False) -> DataFrame:
    """Adds n_tokens, n_known, base_score and score to the rows of docs; text_col is left out.

    With `stutter`, a word equal to the one before it is scored as an unknown word.  Null text
    counts as empty: one token, its end.  The arrays are mapped by each Python worker,
    so memory holds only pages that were touched.  A column of docs named like a result gives way to it.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_tokens", "n_known", "base_score", "score") and c != text_col])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few numbers for each shard
    kept = [f for f in docs.schema.fields if f.name != text_col]
    names = ["n_tokens", "n_known", "base_score", "score"]
    schema = T.StructType([*kept, *(T.StructField(x, T.LongType() if x[0] == "n" else T.DoubleType()) for x in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, "_text"):
            got = own.score(batch.column("_text"), stutter)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *(pa.array(got[x]) for x in names)], names=[f.name for f in schema])

    return docs.withColumn("_text", F.col(text_col).cast("string")).select(*[F.col(f.name) for f in kept], "_text").mapInArrow(run, schema)
