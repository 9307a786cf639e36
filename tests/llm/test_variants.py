"""Spelling variants against all pairs."""

import collections
import random
import re
import string
import zlib

import pytest
from pyspark.sql import functions as F

from tally.llm import variants
from tally.llm.queries import op12_spelling_variants

from .corpus import corpus, frame

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def reference(counts: dict[str, int], ratio: int = 10) -> set[tuple]:
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] is not None else None))
    return out


def of_texts(rows) -> dict[str, int]:
    n = collections.Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 31 == 0 else w] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def grouped(df) -> set[tuple]:
    return {tuple(r) for r in variants.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def words_of(rng, n: int) -> dict[str, int]:
    """Stems with their edits, of one to twelve letters, some accented or beyond the basic plane."""
    letters, out = "abcé😀", {}
    for _ in range(n):
        w = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 5, 6, 7, 8, 12])))
        out[w] = rng.choice([2, 3, 30, 400, 5000])
        i = rng.randrange(len(w) + 1)
        out.setdefault(w[:i] + rng.choice(letters) + w[i:], rng.choice([2, 3, 40]))
        out.setdefault(w[:i] + rng.choice(letters) + w[i + 1 :], rng.choice([2, 3, 40]))
        out.setdefault(w[:i] + w[i + 1 :], rng.choice([2, 3, 40]))
    return out


@pytest.mark.parametrize("tile", [512, 4])
def test_all_pairs(spark, monkeypatch, tile):
    """Also where groups are split into many tiles."""
    monkeypatch.setattr(variants, "TILE", tile)
    counts = words_of(random.Random(tile), 120)
    df = spark.createDataFrame([*counts.items(), (None, 5)], "word string, n long").withColumns({"key": F.lit(1), "b": F.lit(2), "near": F.lit("x")})
    assert grouped(df) == reference(counts)


def test_texts(spark, tmp_path):
    """Nulls, an id twice, no id, words of any length, upper case outside A-Z kept."""
    rng = random.Random(5)
    stems = ["Spelling", "variante", "ÉCLAIRCIR", "éclaircir", "straßenbahn", "mississippi"]
    rows = [(i, " ".join(rng.choice(stems) for _ in range(40)) + " mississipi; missisippi", "en", "s", 0) for i in range(60)]
    rows += [*corpus(), (None, "spelling spellings " * 3, "en", "s", 0), (9000, "a" * 60_000 + " " + "a" * 60_001 + " ", "en", "s", 0), (9001, "a" * 60_000 + "\n" + "a" * 60_001, "en", "s", 0)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_spelling_variants(spark, str(tmp_path)).collect()
    want = reference(of_texts(rows))
    assert {tuple(r) for r in got} == want and len(got) == len(want) and any(r.form for r in got) and any(len(r.word) == 60_001 for r in got)


def test_ties_and_chains(spark):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaaac": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20_000, "aabbbbb": 200_000, "zzzzzzz": 9}
    got = {r[0]: r for r in grouped(spark.createDataFrame(list(counts.items()), "word string, n long"))}
    assert got["aaaaaaa"][1:3] == ("aaaaaab", "aabbbbb") and got["zzzzzzz"] == ("zzzzzzz", None, "zzzzzzz", 9, 0, None)
    assert set(got.values()) == reference(counts)


def test_empty(spark):
    assert variants.spelling_variants(spark.createDataFrame([], "word string, n long")).collect() == []
