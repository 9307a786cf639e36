"""Packing of documents into token windows by lexical retrieval."""

from __future__ import annotations

import base64
import functools
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .tokens import texts_in


#: On a longer run of white space the fast library's pattern runs out of stack (at 10**6); such a run is searched for in long texts only.
LONG_SPACE = 100_000
#: Ids in a partition of related documents.
PARTITION_TOKENS = 4_000_000
_LONG_SPACE = re.compile(rf"(?<!\s)\s{{{LONG_SPACE}}}")
#: A pattern with a look-ahead, for which the fast library searches by backtracking, and one without, which it runs as an automaton.  They differ
#: only where several blanks stand before something else: the first takes all but the last of them.  Texts are cut there before the second.
LOOKING = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
#: What \s is in these patterns (Python's \s holds four more), as Arrow's and as Python's expressions write it.
_BLANKS_ARROW = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_BLANKS = re.sub(r"\\x\{(\w+)\}", lambda m: f"\\u{m[1]:0>4}", _BLANKS_ARROW)
_CUT = re.compile(rf"(?<=[{_BLANKS}])(?=[{_BLANKS}][^{_BLANKS}])")
#: Texts with a cut in fewer characters than this are searched whole, as cutting them costs more.
LEAST_PART = 16


class Tokens:
    """Ids as 16-bit bytes of texts, with a byte-level BPE of fewer than 65,536 ids.

    The ids are those of the reference tokenizer, the .json beside the ranks.  A faster library of the same
    ranks gives them, except for texts with an added token or a very long run of white space, which go
    through the reference tokenizer.  If the pattern is LOOKING, that library is given PLAIN, and the texts in parts.
    """

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        library = lambda p: tiktoken.Encoding("own", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.cuts = pattern == LOOKING
        self.encode = library(PLAIN if self.cuts else pattern)
        self.encode_whole = library(pattern) if self.cuts else self.encode
        self.reference_path = os.path.splitext(ranks_path)[0] + ".json"
        with open(self.reference_path, encoding="utf-8") as f:
            self.added = [x["content"] for x in json.load(f)["added_tokens"]]

    @functools.cached_property
    def reference(self) -> tokenizers.Tokenizer:
        return tokenizers.Tokenizer.from_file(self.reference_path)

    def of(self, text: str, runs: bool = True) -> bytes:
        """runs: whether the text may hold two blanks in a row."""
        if any(x in text for x in self.added) or (len(text) >= LONG_SPACE and _LONG_SPACE.search(text)):
            return array("H", self.reference.encode(text, add_special_tokens=False).ids).tobytes()
        parts = _CUT.split(text) if self.cuts and runs else [text]
        if len(parts) > 1 + len(text) // LEAST_PART:
            return array("H", self.encode_whole(text)).tobytes()
        return b"".join([array("H", self.encode(x)).tobytes() for x in parts])


@functools.lru_cache(maxsize=1)
def _tokens(ranks_path: str, pattern: str) -> Tokens:
    """A worker's own: the ranks are read once, not for each task."""
    return Tokens(ranks_path, pattern)


def _tokenize(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(ranks_path, pattern)
        for batch, texts in texts_in(batches, "_text"):
            runs = pc.match_substring_regex(batch.column("_text"), f"[{_BLANKS_ARROW}]{{2}}").to_pylist()
            ids = [tokens.of((t or b"").decode("utf-8", "replace"), r) + b"\0\0" for t, r in zip(texts, runs, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(ids, pa.binary()), batch.column("_lot")], names=["_id", "_ids", "_lot"])

    return run


def _distinct(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.unique with counts; a stable sort of 16-bit numbers is a radix sort, a third of its time."""
    if not len(a):
        return a, np.zeros(0, np.int64)
    a = np.sort(a, kind="stable")
    at = np.concatenate([[0], np.flatnonzero(a[1:] != a[:-1]) + 1, [len(a)]])
    return a[at[:-1]], at[1:] - at[:-1]


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(1 << 16, np.int64)
    docs = total = 0
    for batch in batches:
        for ids in batch.column("_ids").to_pylist():
            a = np.frombuffer(ids, "<u2")
            n[_distinct(a)[0]] += 1
            docs, total = docs + 1, total + len(a)
    met = np.flatnonzero(n)
    keys = np.concatenate([met, [-1, -2]])  # and the number of documents and of tokens
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.concatenate([n[met], [docs, total]]))], names=["token", "n"])


def _bm25(doc_tokens: float, count: np.ndarray, idf: np.ndarray, mean: float, k1: float = 1.2, b: float = 0.75) -> np.ndarray:
    return idf * count * (k1 + 1) / (count + k1 * (1 - b + b * doc_tokens / mean))


def _keys(idf: np.ndarray, mean: float):
    """Adds the key by which related documents meet: the four heaviest terms, the heaviest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for raw in batch.column("_ids").to_pylist():
                a = np.frombuffer(raw, "<u2")
                t, c = _distinct(a)
                w = _bm25(len(a), c, idf[t], mean)
                top = t[np.lexsort((t, -w))[:4]].tolist() + [0] * 4
                keys.append((top[0] << 48 | top[1] << 32 | top[2] << 16 | top[3]) - (1 << 63))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_ids"), batch.column("_lot"), pa.array(keys, pa.int64())], names=["_id", "_ids", "_lot", "_key"])

    return run


class Shard:
    """A BM25 inverted index over some documents; hands out each document once.

    Terms that many of the documents hold are kept as dense rows, the others as postings.
    """

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean: float):
        n = len(ids)
        self.used = np.zeros(n, bool)
        self.next = 0
        doc, term, weight = [], [], []
        self.terms = []
        for i, a in enumerate(ids):
            t, c = _distinct(a)
            self.terms.append(t)
            doc.append(np.full(len(t), i, np.int32))
            term.append(t)
            weight.append(_bm25(len(a), c.astype(np.float32), idf[t], mean).astype(np.float32))
        doc, term, weight = np.concatenate(doc), np.concatenate(term), np.concatenate(weight)
        df = np.bincount(term, minlength=1 << 16)
        common = np.flatnonzero(df * 16 > n)
        self.row = np.full(1 << 16, -1, np.int32)
        self.row[common] = np.arange(len(common))
        at = self.row[term]
        self.dense = np.zeros((len(common), n), np.float32)
        self.dense[at[at >= 0], doc[at >= 0]] = weight[at >= 0]
        doc, term, weight = doc[at < 0], term[at < 0], weight[at < 0]
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = doc[order], weight[order]
        self.start = np.searchsorted(term[order], np.arange((1 << 16) + 1))

    def scores(self, seed: int) -> np.ndarray:
        """The score of every document for the seed, which asks with all its terms."""
        t = self.terms[seed].astype(np.int64)
        rows = self.row[t]
        asked = np.zeros(len(self.dense), np.float32)
        asked[rows[rows >= 0]] = 1
        score = asked @ self.dense
        t = t[rows < 0]
        start, size = self.start[t], self.start[t + 1] - self.start[t]
        at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
        score += np.bincount(self.docs[at], self.weights[at], len(score)).astype(np.float32)
        return score

    def neighbours(self, seed: int) -> Iterator[int]:
        """Unused documents, the best match of the seed first; then the rest in their order."""
        score = self.scores(seed)
        score[self.used] = 0
        while score[i := int(score.argmax())] > 0:
            score[i] = 0
            if not self.used[i]:
                self.used[i] = True
                yield i
        while (i := self.first()) >= 0:
            yield i

    def first(self) -> int:
        """The first unused document in order, or -1."""
        while self.next < len(self.used):
            i, self.next = self.next, self.next + 1
            if not self.used[i]:
                self.used[i] = True
                return i
        return -1


def _fill(ids: list[np.ndarray], index: Shard, window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset); the seed of a window is the document
    that opens it, and its unused neighbours fill it; the last is cut and opens the next."""
    sequence = 0
    seed, at, fill = -1, 0, 0
    total = sum(map(len, ids))
    placed = 0
    asked = iter(())
    # What doesn't fill a whole window goes to windows of a power of two, which need no padding.
    sizes = [window] * (total // window) + [1 << k for k in range(window.bit_length() - 1, -1, -1) if (total % window) >> k & 1]
    while placed < total:
        if seed < 0 or at == len(ids[seed]):
            seed = next(asked, -1) if fill else -1
            if seed < 0:
                seed = index.first()
            at = 0
        if not fill:
            asked = index.neighbours(seed)
        take = min(len(ids[seed]) - at, sizes[sequence] - fill)
        yield seed, at, take, sequence, fill
        at, fill, placed = at + take, fill + take, placed + take
        if fill == sizes[sequence]:
            sequence, fill = sequence + 1, 0


def _pack(idf: np.ndarray, mean: float, window: int, shard_docs: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = (TaskContext.get().partitionId()) << 36
        sequences = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequences
            index = Shard(ids, idf, mean)
            rows = [(doc, start, n, zlib.crc32(ids[doc][start : start + n].astype("<u4").tobytes()), len(ids[doc]), base + sequences + seq, at) for doc, start, n, seq, at in _fill(ids, index, window)]
            columns = list(zip(*rows, strict=True))
            sequences += max(columns[5]) + 1 - base - sequences
            keys = pa.concat_arrays(held).take(pa.array(columns[0], pa.int64()))
            return pa.RecordBatch.from_arrays([keys, *(pa.array(c, pa.int64()) for c in columns[1:])], names=["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        held: list[pa.Array] = []
        ids: list[np.ndarray] = []
        size, lot = 0, None
        for batch in batches:
            for i, (raw, of) in enumerate(zip(batch.column("_ids").to_pylist(), batch.column("_lot").to_pylist(), strict=True)):
                if ids and of != lot:
                    yield flush()
                    held, ids, size = [], [], 0
                lot = of
                ids.append(np.frombuffer(raw, "<u2"))
                held.append(batch.column("_id").slice(i, 1))
                size += len(raw) // 2
                if len(ids) >= shard_docs or size >= shard_tokens:
                    yield flush()
                    held, ids, size = [], [], 0
        if ids:
            yield flush()

    return run


def pack(docs: DataFrame, ranks_path: str, pattern: str, window: int = 1024, shard_docs: int = 4096, shard_tokens: int = 16_000_000, id_col: str = "doc_id", text_col: str = "text", lot: Column | None = None) -> DataFrame:
    """Packs all documents into sequences of `window` ids by lexical retrieval.

    Ids come from a byte-level BPE (ranks_path, pattern), and a 0 ends each document.  The ids are
    also the terms of retrieval: document frequencies are counted over all documents (a table
    bounded by the vocabulary).  Related documents are brought together by a shuffle: the ids of all documents
    are range-partitioned and sorted by their heaviest BM25 terms (the heaviest first), wherever they were
    read.  The inverted index is sharded along that order: each task indexes up to shard_docs documents
    or shard_tokens ids at a time, so memory is bounded.  In a shard, the document that opens a window
    is its seed; its unused BM25 neighbours (the seed asks with all its terms) fill the window; the last
    is cut where the window ends and opens the next.  Neighbours whose heaviest terms differ may lie in
    other shards and are then not found.  What is left at a shard's end is cut at powers of two, so
    no sequence needs padding.

    With `lot`, an int of each row, documents are packed with those of their lot only, and sequence_id ascends with the lots: so
    an order of the input, such as a mixture's, is kept lot by lot.

    Returns one row per piece: id, start, length, ids_crc32 (unsigned, of 32-bit ids), doc_tokens,
    sequence_id, offset.  Null and empty texts are the id 0 alone.  Rows that repeat an id, and rows
    without one, are packed each by itself.  An empty input gives no pieces.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), (F.lit(0) if lot is None else F.coalesce(lot.cast("int"), F.lit(0))).alias("_lot"))
    kind = rows.schema["_id"].dataType.simpleString()
    tokens = materialize(rows.mapInArrow(_tokenize(ranks_path, pattern), f"_id {kind}, _ids binary, _lot int"), "ids", compression="zstd")
    counts = dict(tokens.select("_ids").mapInArrow(_document_counts, "token long, n long").groupBy("token").agg(F.sum("n")).collect())
    n, total = counts.pop(-1, 0), counts.pop(-2, 0)
    df = np.zeros(1 << 16)
    df[list(counts)] = list(counts.values())
    idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)
    mean = total / max(1, n)
    keyed = materialize(tokens.mapInArrow(_keys(idf, mean), f"_id {kind}, _ids binary, _lot int, _key long"), "keyed", compression="zstd")
    # Copies lie side by side; the id spreads even a large group of them over tasks.
    order = ["_lot", "_key", F.xxhash64("_ids"), F.xxhash64("_id")]
    together = keyed.repartitionByRange(max(1, -(-total // PARTITION_TOKENS)), *order).sortWithinPartitions(*order).select("_id", "_ids", "_lot")
    packed = together.mapInArrow(_pack(idf, mean, window, shard_docs, shard_tokens), f"_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return packed.withColumnRenamed("_id", id_col)
