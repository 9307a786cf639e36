"""Exact token counts of every prefix of every text, by dynamic programming over a BPE vocabulary of pieces."""

from __future__ import annotations

import array
import functools
import itertools
import operator
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize
from .tokens import slices

MARK = "▁"


class PieceCounts(dict):
    """Stretch of text -> how the token count changes with each of its code points, as signed bytes.

    `learn` computes stretches and keeps them, about twice `most` code points of those last asked for.  A stretch begins where no
    piece of the vocabulary can reach across: before a space or run of spaces, and around a character that no longer piece holds.
    """

    def __init__(self, model: str, most: int = 5_000_000):
        import sentencepiece

        super().__init__()
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        #: Of two neighbours that form a piece, those of the highest score are merged first, the leftmost of equal ones.
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in plain}
        joined = {p for p in self.rank if len(p) > 1}
        ends = {(p[-3:], len(p)) for p in joined}
        #: By its last three (or two) characters, the lengths of pieces, longest first; and characters that follow one another in one.
        self.sizes = {e: tuple(sorted((n for _, n in g), reverse=True)) for e, g in itertools.groupby(sorted(ends), lambda x: x[0])}
        self.touching = {x + y for p in joined for x, y in itertools.pairwise(p)}
        if sp.normalize(" a  éﬁ ") != f"{MARK}{MARK}a{MARK}{MARK}éﬁ{MARK}" or any(MARK in p.lstrip(MARK) for p in joined):
            raise ValueError("counts of prefixes need a vocabulary that leaves texts as they are and joins spaces only to what follows")
        self.byte_fallback = any(sp.is_byte(i) for i in range(sp.get_piece_size()))
        self.alone = {c: self._alone(c) for c in "\n\t\r" if not any(c in p for p in joined)}
        lone = "".join(map(re.escape, self.alone))
        self.stretches = re.compile(f"{MARK}+[^{MARK}{lone}]*|[^{MARK}{lone}]+|[{lone}]" if lone else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.tokens = list(self.rank)
        self.number = {p: i for i, p in enumerate(self.tokens)}
        self.pairs: dict[int, bool] = {}
        self.old: dict[str, bytes] = {}
        self.held, self.most = 0, most

    def _alone(self, c: str) -> int:
        """Tokens of a character that stands for itself: as a piece one, else its bytes, or the unknown token."""
        return 1 if c in self.rank or not self.byte_fallback else len(c.encode("utf-8", "surrogatepass"))

    def _adjoin(self, a: int, b: int) -> bool:
        """Whether the tokens a and b can follow one another: merging their characters must end in just these two."""
        one, two, rank = self.tokens[a], self.tokens[b], self.rank
        parts = list(one + two)
        while one[-1] + two[0] in self.touching:
            score, at = min(((rank[x + y], i) for i, (x, y) in enumerate(itertools.pairwise(parts)) if x + y in rank), default=(0, -1))
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        else:
            parts = [one, two]  # no piece holds the characters on both sides
        if len(self.pairs) >= 1_000_000:
            self.pairs.clear()
        known = self.pairs[a << 32 | b] = parts == [one, two]
        return known

    def prefixes(self, stretch: str, count: list[int], last: list[int]) -> None:
        """Continues count and last, the number of tokens and the last token of each prefix of a stretch, to the whole stretch; [0] and
        [-1] are those of the empty prefix.

        The tokens of a prefix end in a token t, and what comes before t is tokenized as the shorter prefix is.  Of the pieces that
        the prefix ends in, one alone can follow the last token of that shorter prefix.
        """
        number, pairs, sizes = self.number.get, self.pairs.get, self.sizes.get
        for end in range(len(count), len(stretch) + 1):
            three, two = stretch[end - 3 : end] if end > 2 else "", stretch[end - 2 : end] if end > 1 else ""
            for size in sizes(three, ()) + sizes(two, ()):
                if size <= end and (piece := number(stretch[end - size : end])) is not None:
                    before = last[end - size]
                    known = pairs(before << 32 | piece) if before >= 0 else True
                    if known or known is None and self._adjoin(before, piece):
                        count.append(count[end - size] + 1)
                        break
            else:
                c = stretch[end - 1]
                piece = number(c)
                if piece is None:  # a character that isn't a piece
                    piece = self.number[c] = len(self.tokens)
                    self.tokens.append(c)
                count.append(count[end - 1] + self._alone(c))
            last.append(piece)

    def learn(self, stretches: set[str]) -> None:
        """Computes the stretches that aren't known; in their order, so that each goes on where the one before had the same prefix."""
        if self.held > self.most:  # those not asked for since the last time are forgotten
            self.old = dict(self)
            self.clear()
            self.held = 0
        before, count, last, old = "", [0], [-1], self.old
        for stretch in sorted(stretches.difference(self)):
            value = old.get(stretch)
            if value is None:
                same, both = 0, min(len(before), len(stretch))
                while same < both and before[same] == stretch[same]:
                    same += 1
                del count[same + 1 :], last[same + 1 :]
                self.prefixes(stretch, count, last)
                value = array.array("b", map(operator.sub, count[1:], count)).tobytes()  # raises beyond 127
                before = stretch
            self[stretch] = value
            self.held += len(stretch)

    def changes(self, texts: list[str]) -> list[bytes]:
        """How the token count of each text changes with each of its code points."""
        found = [self.stretches.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn(set(itertools.chain.from_iterable(found)))
        out = []
        for parts in found:
            whole = b"".join(map(self.__getitem__, parts))
            # The mark that stands before every text isn't a code point of it: its count comes with the first one.
            first = np.frombuffer(whole[:2], np.int8).sum(dtype=np.int64) if parts else 0
            out.append(int(first).to_bytes(1, signed=True) + whole[2:] if parts else b"")
        return out


@functools.lru_cache(maxsize=1)
def _piece_counts(model: str) -> PieceCounts:
    """A worker's own, so that what one task has computed serves the next; its size is bounded."""
    return PieceCounts(model)


def _counted(model: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _piece_counts(model)
        for whole in batches:
            for batch in slices(iter([whole]), "_text"):
                made = counts.changes(batch.column("_text").to_pylist())
                n = pa.array([int(np.frombuffer(c, np.int8).sum(dtype=np.int64)) for c in made], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_bytes"), n, pa.array(made, pa.binary())], names=["_id", "_bytes", "_n", "_changes"])

    return count


def token_prefixes(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A written table with one row for each row of docs: id, n_bytes (UTF-8), n_tokens, prefix_changes.

    `model` is the path of a vocabulary of pieces (byte-pair merges, texts left as they are); counts are those of its library without begin
    and end, special strings inside texts being ordinary text.  prefix_changes holds one signed byte for each code point: the sum of the
    first k is the exact token count of the text's first k code points, for every k.  `tokens_of` and `longest_within`
    answer from it; no text is encoded again.

    Texts are read once, in batches by bytes, and nothing is shuffled.  Words recur, so a task computes each stretch between spaces
    once, and forgets them when they grow too many.  Null and empty texts have no tokens; rows without an id and rows that repeat are
    counted each by itself; very long texts are counted whole.  Other columns don't matter; an empty input gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_bytes", F.octet_length("_text").cast("long"))
    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType), T.StructField("_bytes", T.LongType()), T.StructField("_n", T.LongType()), T.StructField("_changes", T.BinaryType())])
    counted = materialize(rows.mapInArrow(_counted(model), schema), "token-prefixes", compression="zstd")
    return counted.select(F.col("_id").alias(id_col), F.col("_bytes").alias("n_bytes"), F.col("_n").alias("n_tokens"), F.col("_changes").alias("prefix_changes"))


@F.pandas_udf(T.LongType())
def tokens_of(changes, k):
    """Token count of the first k code points (all, where there are fewer; none for k below 1; null for null)."""
    import pandas as pd

    return pd.Series([None if c is None or pd.isna(n) else int(np.frombuffer(c, np.int8, count=min(len(c), max(0, int(n)))).sum(dtype=np.int64)) for c, n in zip(changes, k, strict=True)], dtype="Int64")


@F.pandas_udf(T.LongType())
def longest_within(changes, budget):
    """Most code points whose token count is within the budget (0 where none is; null for null).  Counts may fall as a prefix grows, so
    this isn't where the budget is first passed."""
    import pandas as pd

    def longest(c, most):
        within = np.flatnonzero(np.frombuffer(c, np.int8).cumsum(dtype=np.int64) <= most)
        return int(within[-1]) + 1 if len(within) and most >= 0 else 0

    return pd.Series([None if c is None or pd.isna(b) else longest(c, int(b)) for c, b in zip(changes, budget, strict=True)], dtype="Int64")
