"""Spelling variants: words one edit apart, grouped under their most frequent form."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_batches

#: Cells of the matrices that a task compares at a time, and the rows of a tile (fewer where words are very long).
CELLS, TILE = 1 << 22, 512
#: Intervals in which the place of an edit may lie.
PARTS = 3


def lowered(word: Column) -> Column:
    return F.translate(word, string.ascii_uppercase, string.ascii_lowercase)


def word_counts(docs: DataFrame, text: Column, least_length: int, least_count: int, changed: Column | None = None) -> DataFrame:
    """(word, n): the runs of Latin letters of at least `least_length` code points, A-Z lower-cased, in at least `least_count` places.

    `changed`, an expression over the input row and over `_word`, may stand for a word before it is counted.  Counts are
    combined in each task before the shuffle, so a hot word is one row for each task.  Null texts have no words.
    """
    # A run shorter than that has no longer word, and a run that is matched is matched whole.
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{least_length},}}"), F.lit(0))
    words = docs.withColumn("_word", F.explode(runs)).withColumn("_word", lowered(F.col("_word")))
    words = words.select((F.col("_word") if changed is None else changed).alias("word")).where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _entries(words: DataFrame) -> DataFrame:
    """Each word under the keys that it shares with any word one edit away.

    Let b be the longer length of a pair and p the length of the common prefix.  The edit may be taken to be at p, which lies
    in one of PARTS intervals [low, high] of the b places: then the first `low` and the last b - 1 - high code points are common.  A
    word looks for partners as the longer one or an equal one (b is its length) and as the shorter one.
    """
    places = []
    for more in (0, 1):
        b = F.col("_len") + more
        for part in range(PARTS):
            low, high = F.floor(b * part / PARTS).cast("int"), (F.floor(b * (part + 1) / PARTS) - 1).cast("int")
            tail = (b - 1 - high).cast("int")
            edges = F.xxhash64(b, F.lit(part), F.substring("word", F.lit(1), low), F.substring("word", F.col("_len") - tail + 1, tail))
            places.append(F.struct(edges.alias("key"), b.cast("int").alias("b"), low.alias("low"), high.alias("high")))
    words = words.withColumn("_len", F.char_length("word"))
    return words.select("word", "n", F.explode(F.array(*places)).alias("at")).select("word", "n", "at.*")


def _tiles(entries: DataFrame) -> DataFrame:
    """(b, low, high, members): what is compared at once.  A group of more words than a tile holds is split by a hash into tiles, and
    each pair of its tiles is a row of its own, so that a hot group is compared by many tasks."""
    rows = F.greatest(F.lit(4), F.least(F.lit(TILE), F.floor(F.lit(CELLS / 4) / F.col("b"))))
    sizes = entries.groupBy("key", "b", "low", "high").agg(F.count("*").alias("_m")).where("_m > 1")
    sizes = sizes.select(F.col("key").alias("_k"), F.col("b").alias("_b"), F.col("low").alias("_l"), F.ceil(F.col("_m") / rows).cast("int").alias("_tiles"))
    found = entries.join(sizes, (F.col("key") == F.col("_k")) & (F.col("b") == F.col("_b")) & (F.col("low") == F.col("_l")))
    found = found.withColumn("_tile", F.pmod(F.xxhash64("word"), F.col("_tiles")).cast("int"))
    found = found.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    found = found.withColumns({"_i": F.least("_tile", "_other"), "_j": F.greatest("_tile", "_other")}).withColumn("first", F.col("_tile") == F.col("_i"))
    members = found.groupBy("key", "b", "low", "high", "_i", "_j").agg(F.collect_list(F.struct("word", "n", "first")).alias("members"))
    return members.where("size(members) > 1").select("b", "low", "high", (F.col("_i") == F.col("_j")).alias("own"), "members")


def _matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words, padded with zeros on the right and on the left, and the words' lengths."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(words)), length)
    column = np.arange(len(points)) - np.repeat(length.cumsum() - length, length)
    left = np.zeros((len(words), width), np.uint32)
    left[row, column] = points
    right = np.zeros((len(words), width), np.uint32)
    right[row, width - np.repeat(length, length) + column] = points
    return left, right, length


def _run(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """In how many columns from the first on the rows agree, at most `most`."""
    differ = a != b
    first = differ.argmax(axis=1)
    return np.minimum(np.where(differ.any(axis=1), first, a.shape[1]), most)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs (word, near, near_n), both ways, of tiles (b, low, high, own, members)."""
    for batch in batches:
        b, low, high, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("b", "low", "high", "own"))
        members = batch.column("members")
        offsets = members.offsets.to_numpy().astype(np.int64)
        start = 0
        while start < batch.num_rows:  # as many tiles as a matrix holds
            stop, width = start + 1, int(b[start])
            while stop < batch.num_rows and (offsets[stop + 1] - offsets[start]) * max(width, int(b[stop])) <= CELLS:
                width, stop = max(width, int(b[stop])), stop + 1
            rows = members.values.slice(offsets[start], offsets[stop] - offsets[start])
            word, n, first = rows.field("word"), rows.field("n"), rows.field("first").to_numpy(zero_copy_only=False)
            sizes = np.diff(offsets[start : stop + 1])
            tile = np.repeat(np.arange(start, stop), sizes)
            left, right, length = _matrices(word.to_pylist(), width)
            right, found, rest = right[:, ::-1], [], np.arange(len(tile))
            for step in range(1, int(sizes.max())):  # each row with the one `step` below it, in all tiles at once
                rest = rest[: np.searchsorted(rest, len(tile) - step)]
                rest = x = rest[tile[rest] == tile[rest + step]]
                y = x + step
                t, longer = tile[x], np.maximum(length[x], length[y])
                use = (longer == b[t]) & (own[t] | (first[x] != first[y]))
                x, y, t, longer = x[use], y[use], t[use], longer[use]
                shorter = np.minimum(length[x], length[y])
                prefix = _run(left[x], left[y], shorter)
                near = prefix + _run(right[x], right[y], shorter) >= longer - 1
                near &= (prefix >= low[t]) & (prefix <= high[t])  # in the group of the interval that holds the edit, and in no other
                near &= (prefix < longer) | (longer > shorter)  # a word isn't near itself
                found.append(np.stack([x[near], y[near]]))
            pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
            one, two = pa.array(np.concatenate([pairs[0], pairs[1]])), pa.array(np.concatenate([pairs[1], pairs[0]]))
            yield pa.RecordBatch.from_arrays([word.take(one), word.take(two), n.take(two)], names=["word", "near", "near_n"])
            start = stop


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n), both ways and once each, for all words (word, n; each word once) that one inserted, deleted or replaced code point parts.

    Words meet in groups that share the code points around the interval of the edit (`_entries`); tiles of a group are compared as
    padded code-point matrices: two words are one edit apart where common prefix and common suffix reach the longer length minus one.
    """
    with small_batches(words.sparkSession):
        return materialize(_tiles(materialize(_entries(words), "entries")).mapInArrow(_compare, "word string, near string, near_n long"), "near")


def spelling_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """Groups the words (word, n; each word once) under forms.

    A word's form is its near word of largest n (ties: smallest in code-point order) if that n is at least `ratio` times the word's.
    Returns word, n, n_near, form, form_n (null without a form), root: the last of the forms that follow from one another, or the word.

    Rows whose word is null count for nothing, other columns don't matter, an empty input gives an empty result; the empty word is near
    the words of one code point.  Forms have ever larger counts, so chains end; roots follow by doubling, in as many rounds as the
    logarithm of the longest chain.
    """
    words = materialize(words.where("word IS NOT NULL").select("word", "n"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("_less"), F.col("near").alias("_near"))).alias("_best")
    near = near_words(words).groupBy(F.col("word").alias("_of")).agg(F.count("*").alias("_links"), best)
    form = F.when(-F.col("_best._less") >= ratio * F.col("n"), F.col("_best._near"))
    named = words.join(near, F.col("word") == F.col("_of"), "left").withColumn("form", form)
    named = materialize(named.select("word", "n", F.coalesce("_links", F.lit(0)).alias("n_near"), "form", F.when(F.col("form").isNotNull(), -F.col("_best._less")).alias("form_n")), "forms")
    chain = named.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        up = chain.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        ahead = materialize(chain.join(up, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("_moved")), "roots")
        chain = ahead.select("word", "root")
        if ahead.where("_moved").isEmpty():
            break
    roots = chain.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
    return named.join(roots, F.col("word") == F.col("_w"), "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("_r", "word").alias("root"))
