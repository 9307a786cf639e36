"""Words and their hashes for Python tasks: whole texts, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MIX = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    h = h.astype(np.uint64) + MIX
    h = (h ^ (h >> np.uint64(30))) * _A
    h = (h ^ (h >> np.uint64(27))) * _B
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """bytes -> 64-bit hash; forgets all words when it holds too many."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: bytes | None, lower: bool) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+; bytes.split() and bytes.lower() know ASCII only, as asked."""
    return ((text or b"").lower() if lower else text or b"").split()


def texts_in(batches: Iterator[pa.RecordBatch], text: str, most: int = 1_500_000) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of the batches with at most `most` bytes of text, or one row, and their texts."""
    for batch in batches:
        texts = batch.column(text).cast(pa.large_binary()).to_pylist()
        start, size = 0, 0
        for i, t in enumerate(texts):
            n = len(t or b"")
            if i > start and size + n > most:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += n
        if start < len(texts):
            yield batch.slice(start), texts[start:]


#: Hash values of bytes, as they are and with A-Z lowered; white space counts nothing.
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_VALUES = np.where(_BLANK, np.uint64(0), mix(np.arange(1, 257, dtype=np.uint64)))
_LOWERED = _VALUES.copy()
_LOWERED[65:91] = _VALUES[97:123]
_RADIX = 0xD1342543DE82EF95
_PIECE = 1 << 17
_POWERS = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(_PIECE, _RADIX, np.uint64)]))


def word_hashes(column: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words [^\\x20\\x09-\\x0D]+ of the texts, one after another, and the number of each
    text's words (null: none).

    A word's hash is a polynomial in its bytes, so it is summed over pieces of bounded size, and
    a word of any length may run over several.
    """
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    begin = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[begin[0] : begin[-1]] if buffer is not None else np.zeros(0, np.uint8)
    begin, values = begin - begin[0], _LOWERED if lower else _VALUES
    edge = np.zeros(len(data) + 1, bool)
    edge[begin] = True
    hashes, places, open_ = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0  # open_: bytes so far of a word that goes on
    for at in range(0, len(data), _PIECE):
        part = data[at : at + _PIECE]
        ink = ~_BLANK[part]
        head = ink.copy()
        head[1:] &= ~ink[:-1] | edge[at + 1 : at + len(part)]
        goes_on = bool(open_ and ink[0] and not edge[at])
        new = np.flatnonzero(head)
        if goes_on:
            heads = new if len(new) and new[0] == 0 else np.concatenate([[0], new])
            new = new[1:] if len(new) and new[0] == 0 else new
        else:
            heads = new
        if len(heads):
            length = np.diff(np.append(heads, len(part)))
            place = np.arange(heads[0], len(part)) - np.repeat(heads, length)
            sums = np.add.reduceat(values[part[heads[0] :]] * _POWERS[place], heads - heads[0])
            if goes_on:
                hashes[-1][-1:] += sums[:1] * np.uint64(pow(_RADIX, open_, 1 << 64))
                sums = sums[1:]
            if len(new):
                hashes.append(sums)
                places.append(new + at)
        last = int(length[-1]) + (open_ if goes_on and len(heads) == 1 else 0) if len(heads) else 0
        open_ = last if ink[-1] else 0
    place = np.concatenate(places)
    return mix(np.concatenate(hashes)), np.diff(np.searchsorted(place, begin))


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 1_500_000) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most `most` bytes of text, or one row."""
    for batch in batches:
        ends = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the k-word shingles of each text, A-Z lowered, sorted within the text, one
    text after another; and the size of each text's set."""
    words, n = word_hashes(column, True)
    first = n.cumsum() - n
    short = np.flatnonzero((n > 0) & (n < k))
    many = np.where(n >= k, n - k + 1, n > 0)
    begin = many.cumsum() - many
    of = np.repeat(np.arange(len(n)), many)
    start = np.arange(len(of)) - np.repeat(begin - first, many)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    h = padded[start]
    for j in range(1, k):
        h = h * _A + padded[start + j]
    h = mix(h)
    for i in short:
        h[begin[i]] = shingles(words[first[i] : first[i] + n[i]], k)[0]
    for a, b in zip(begin.tolist(), (begin + many).tolist(), strict=True):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    return h[new], np.bincount(of[new], minlength=len(n))


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of k-word shingles; of fewer words, the whole sequence as one."""
    n = len(words)
    if n == 0:
        return words[:0]
    m = min(k, n)
    h = words[: n - m + 1].copy()
    for j in range(1, m):
        h = h * _A + words[j : n - m + 1 + j]
    if n < k:
        h = h + np.uint64(n)
    return np.unique(mix(h))
