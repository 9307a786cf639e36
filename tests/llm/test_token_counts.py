"""Token counts of every prefix against the library itself."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.llm.queries import op13_token_counts
from tally.llm.token_counts import PieceCounts, longest_within, token_prefixes, tokens_of

from .corpus import SCHEMA, corpus, frame

P, S = pytest.importorskip("public_tokenizers"), pytest.importorskip("sentencepiece")
MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return S.SentencePieceProcessor(model_file=MODEL)


def texts(library) -> list[str]:
    rng = random.Random(3)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    out = ["", " ", "\n", "\x00", "▁", "😀", "é", "ﬁ", "<s>a</s><unk><0x0A>", " " * 70 + "x" + " " * 40, "=" * 90, "a" * 300, "漢字" * 40]
    for _ in range(150):
        out.append("".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12))))
        out.append("".join(rng.choice("ab ▁\n\t\r  é漢😀\x00.,") for _ in range(rng.randrange(1, 40))))
        out.append("".join(rng.choice("thethaninonder ") for _ in range(60)))
    return out


def test_every_prefix(library):
    """Also with a memory so small that stretches are forgotten in between."""
    some = texts(library)
    for most in (2_000_000, 500):
        counts = PieceCounts(MODEL, most)
        for i in range(0, len(some), 20):
            for text, made in zip(some[i : i + 20], counts.changes(some[i : i + 20]), strict=True):
                want = [len(x) for x in library.encode([text[:k] for k in range(1, len(text) + 1)])] if text else []
                assert np.frombuffer(made, np.int8).cumsum(dtype=np.int64).tolist() == want, text


def test_query(spark, tmp_path, library):
    """Null, empty and very long texts, rows that repeat, columns that clash."""
    rows = [*corpus(), (7000, None, None, None, None), (7001, "word " * 5000, "en", "s", 0), (7002, "x" * 200_000, "en", "s", 0), (7003, "x y" * 60_000, "en", "s", 0)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(((r[0] is not None, r[0] or 0), len((r[1] or "").encode()), n := len(library.encode(r[1] or "")), n > 4096) for r in rows)
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.n_bytes, r.n_tokens, r.over_limit) for r in op13_token_counts(spark, str(tmp_path)).collect())
    assert got == want and any(r[3] for r in got)


def test_questions(spark, library):
    """Truncation and budgets, from the table alone."""
    some = [t for t in texts(library) if "\x00" not in t][:120]
    rows = [(i, t, None, None, None) for i, t in enumerate(some)]
    table = token_prefixes(spark.createDataFrame(rows, SCHEMA), MODEL)
    asked = table.select("doc_id", *[tokens_of("prefix_changes", F.lit(k)).alias(f"k{k}") for k in (-1, 0, 3, 17, 10**6)], *[longest_within("prefix_changes", F.lit(b)).alias(f"b{b}") for b in (-1, 0, 4, 11)])
    for r in asked.collect():
        t = some[r.doc_id]
        counts = [0, *[len(x) for x in library.encode([t[:k] for k in range(1, len(t) + 1)])]] if t else [0]
        for k in (-1, 0, 3, 17, 10**6):
            assert r[f"k{k}"] == counts[min(max(k, 0), len(t))]
        for b in (-1, 0, 4, 11):
            assert r[f"b{b}"] == max((k for k, n in enumerate(counts) if n <= b), default=0)
    nulls = spark.createDataFrame([(None, None)], "c binary, k long").select(tokens_of("c", "k").alias("a"), longest_within("c", "k").alias("b")).first()
    assert tuple(nulls) == (None, None)


def test_empty(spark):
    assert token_prefixes(spark.createDataFrame([], SCHEMA), MODEL).collect() == []


def test_other_vocabularies_raise(monkeypatch):
    """One that changes texts before it counts has no counts of prefixes."""
    real = S.SentencePieceProcessor.normalize
    monkeypatch.setattr(S.SentencePieceProcessor, "normalize", lambda self, t: real(self, t).replace("ﬁ", "fi"))
    with pytest.raises(ValueError, match="leaves texts as they are"):
        PieceCounts(MODEL)
