"""The manifest against a plain tree."""

import collections
import hashlib
import string
import zlib

import pytest
from pyspark.sql import functions as F

from tally.llm import merkle
from tally.llm.queries import op11_merkle_manifest

from .corpus import SCHEMA, corpus, frame

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(level: list[str]) -> tuple[str, list[list]]:
    """The root, and for each leaf the siblings (left, right) of every level."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, a in enumerate(at):
            run = a // 8 * 8
            paths[i].append((level[run:a], level[a + 1 : run + 8]))
            at[i] = a // 8
        level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
    return level[0], paths


def reference(rows) -> collections.Counter:
    if not rows:
        return collections.Counter()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append(((r[0] is not None, r[0] or 0), leaf_of(*r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[1] for x in sorted(groups[g], key=lambda x: x[:2])]) for g in order}
    root, tops = tree([trees[g][0] for g in order])
    out = collections.Counter()
    for g, top in zip(order, tops, strict=True):
        for (_, leaf, r), low in zip(sorted(groups[g], key=lambda x: x[:2]), trees[g][1], strict=True):
            node = leaf_of(r[0], r[1] and r[1].translate(LOWER), *r[2:]) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else leaf
            for left, right in low + top:
                node = sha("".join([*left, node, *right]))
            out[(r[0], leaf, trees[g][0], root, sha("".join("".join(a + b) for a, b in low + top)), node, node == root)] += 1
    return out


def write(spark, folder, rows):
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    return {tuple(r): n for r, n in collections.Counter(op11_merkle_manifest(spark, str(folder)).collect()).items()}


@pytest.mark.parametrize("n", [0, 1, 8, 9, 64, 65])
def test_small_groups(spark, tmp_path, n):
    rows = [(i, f"Text {i}", None if i % 9 == 0 else "en", "s", i) for i in range(n)]
    assert write(spark, tmp_path, rows) == reference(rows)


def test_awkward_rows(spark, tmp_path):
    """Nulls in every column, empty and very long texts, an id twice, a row twice, a hot group beyond one block, columns that clash."""
    rows = [*corpus(), (None, None, None, None, None), *[(1000 + i, f"Row {i % 5}", "hot" if i % 20 else f"l{i}", None, i) for i in range(1400)]]
    got = write(spark, tmp_path, rows)
    assert got == reference(rows) and len({r[6] for r in got}) == 2


def test_exactly_one_block_and_one_more(spark, tmp_path):
    rows = [(i, "t", "a", "s", i) for i in range(512)] + [(i, "t", "b", "s", i) for i in range(513)]
    assert write(spark, tmp_path, rows) == reference(rows)


def test_storage_does_not_matter(spark):
    rows = corpus(4, 90)
    one = merkle.manifest(spark.createDataFrame(rows, SCHEMA).coalesce(1), COLUMNS, "lang", "doc_id").select("root").distinct().collect()
    many = merkle.manifest(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7), COLUMNS, "lang", "doc_id").select("root").distinct().collect()
    assert one == many and len(one) == 1
    changed = [(r[0], (r[1] or "") + ("." if i == 3 else ""), *r[2:]) for i, r in enumerate(rows)]
    other = merkle.manifest(spark.createDataFrame(changed, SCHEMA), COLUMNS, "lang", "doc_id").select("root").distinct().collect()
    assert other != one


def test_null_and_empty_differ(spark):
    row = spark.createDataFrame([(None, "", "1:a")], "a string, b string, c string").select(merkle.digest(F.col("a")).alias("a"), merkle.digest(F.col("b")).alias("b"), merkle.digest(F.col("a"), F.col("b"), F.col("c")).alias("c")).first()
    assert (row.a, row.b, row.c) == (sha("-"), sha("0:"), sha("-0:3:1:a"))
