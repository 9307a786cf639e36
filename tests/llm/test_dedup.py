import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tally.llm.exact_dedup import exact_dedup
from tally.llm.jaccard import Bands, Segments, jaccard_join, sketches
from tally.llm.line_dedup import line_dedup
from tally.llm.substring import FingerprintIndex, substring_dedup

from .corpus import SCHEMA, components, corpus, frame, words


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_exact_dedup(spark, rows):
    got = exact_dedup(frame(spark, rows), carry={"sha": F.sha2("_norm", 256)}).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[norm(t)].append(i)
    want = Counter()
    for i, t, *_ in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        want[(i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.sha) for r in got) == want


def test_exact_dedup_parts_equal_prefixes(spark):
    """Same length and prefix, other content: only the full hash tells."""
    made = [(i, "x" * 300 + str(i % 3), None, None, None) for i in range(9)]
    got = exact_dedup(spark.createDataFrame(made, SCHEMA)).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(i, i % 3, 3) for i in range(9)}


def test_line_dedup(spark, rows):
    got = line_dedup(frame(spark, rows)).collect()
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
    held = defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10 and i is not None:
                held[key(x)].add(i)
    want = Counter()
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(held.get(key(x), ())) < 2 or min(held[key(x)]) == i]
        want[(i, "\n".join(keep), len(lines), len(lines) - len(keep))] += 1
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got) == want


def test_line_dedup_threshold(spark):
    made = [(i, "a line in three documents\nown line number %d here" % i, None, None, None) for i in range(3)]
    df = spark.createDataFrame(made, SCHEMA)
    assert {(r.doc_id, r.n_dropped) for r in line_dedup(df, least_docs=3).collect()} == {(0, 0), (1, 1), (2, 1)}
    assert {r.n_dropped for r in line_dedup(df, least_docs=4).collect()} == {0}


def substring_reference(rows, window):
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for j in range(len(w) - window + 1 if i is not None else 0):
            k = tuple(w[j : j + window])
            first[k] = min(first.get(k, i), i)
    want = Counter()
    for i, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[j : j + window])] < i:
                gone[j : j + window] = [True] * window
        want[(i, b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode(), len(w), sum(gone))] += 1
    return want


@pytest.mark.parametrize(("window", "gram", "batches"), [(50, 10, 3), (12, 4, 1), (20, 20, 5)])
def test_substring_dedup(spark, rows, window, gram, batches):
    got = substring_dedup(frame(spark, rows), window=window, gram=gram, batches=batches).collect()
    assert Counter((r.doc_id, r.text, r.n_words, r.n_removed) for r in got) == substring_reference(rows, window)


def test_substring_index_stays(spark, rows, tmp_path):
    """Calls in sequence on one index remove what one call removes; merge joins with history don't shuffle it."""
    path = str(tmp_path / "index")
    known = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    cuts = [known[: len(known) // 2], known[len(known) // 2 : -8], known[-8:]]
    while cuts[0][-1][0] == cuts[1][0][0] or cuts[1][-1][0] == cuts[2][0][0]:  # rows of one id stay together
        cuts[0].append(cuts[1].pop(0)) if cuts[0][-1][0] == cuts[1][0][0] else cuts[1].append(cuts[2].pop(0))
    got, before = Counter(), []
    for part in cuts:
        out = substring_dedup(frame(spark, part), window=12, gram=4, batches=1, index_path=path, history=frame(spark, before) if before else None).collect()
        got += Counter((r.doc_id, r.text, r.n_words, r.n_removed) for r in out)
        before += part
    assert got == substring_reference(known, 12)
    index = FingerprintIndex(spark, path)
    assert [r[0] for r in index.runs] == [1, 0] and index.runs[-1][2] == 2
    old, new = (index._table(r, "entries") for r in index.runs)
    plan = index._ordered(lambda: new.join(old.withColumnRenamed("owner", "o").hint("merge"), ["fp", "whole"], "left")._jdf.queryExecution().executedPlan().toString())
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    with pytest.raises(ValueError, match="history"):
        substring_dedup(frame(spark, rows), index_path=path)


def shingle_set(text):
    w = words(text, True)
    return frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard_reference(rows):
    known = [(i, shingle_set(t)) for i, t, *_ in rows if i is not None]
    links = [(a, b) for x, (a, s) in enumerate(known) for b, t in known[x + 1 :] if a == b or (s and t and 100 * len(s & t) >= 75 * len(s | t))]
    comp = components([a for a, _ in known], links)
    return Counter((i, len(shingle_set(t)), comp.get(i)) for i, t, *_ in rows)


@pytest.mark.parametrize(("seed", "rounds"), [(1, 2), (2, 0), (3, 1)])
def test_jaccard_join(spark, seed, rounds):
    rows = corpus(seed)
    got = jaccard_join(frame(spark, rows), rounds=rounds).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == jaccard_reference(rows)


def test_jaccard_edits(spark):
    """Documents from far below to far above the threshold, of many sizes."""
    import random

    rng = random.Random(5)
    rows = []
    for size in (5, 6, 9, 14, 30, 64, 65, 130, 290, 310, 700):
        base = [f"x{rng.randrange(10**6)}" for _ in range(size)]
        for edits in range(0, max(2, size // 18 + 2)):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(size)] = f"y{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w[: size - edits % 2]), None, None, None))
    got = jaccard_join(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == jaccard_reference(rows)


def small_pairs(n):
    """Texts of 8 words (4 shingles) and their first 7 (3 shingles): Jaccard 3/4 exactly."""
    texts = [[f"p{i}w{j}" for j in range(8)] for i in range(n)]
    return [(2 * i + k, " ".join(t[: 8 - k]), None, None, None) for i, t in enumerate(texts) for k in (0, 1)]


def test_jaccard_of_sizes_three_and_four(spark):
    """Some of the larger sets fall into one segment and ask with their neighbourhoods."""
    got = jaccard_join(spark.createDataFrame(small_pairs(2000), SCHEMA)).collect()
    assert [r.doc_id for r in got if r.component_id != r.doc_id // 2 * 2] == []
    assert Counter(r.n_shingles for r in got) == {3: 2000, 4: 2000}


def test_hard_sets_are_compared_with_all(spark, monkeypatch):
    """With far too few segments every set is hard; the blocks find the same links."""
    monkeypatch.setattr(Bands, "segments", lambda self, band: 1)
    monkeypatch.setattr(Bands, "flex", lambda self, band: 0)
    rows = corpus(4, 30)
    got = jaccard_join(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == jaccard_reference(rows)


def test_pigeonhole_holds():
    """Linked sets share an asked signature whatever the hashes: checked on random sets."""
    import numpy as np

    rng, bands = np.random.default_rng(0), Bands()
    for _ in range(300):
        n = int(rng.integers(1, 400))
        u = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        drop = int(rng.integers(0, len(u) // 4 + 1))
        v = np.delete(u, rng.choice(len(u), drop, replace=False))
        if 4 * len(v) < 3 * len(u):
            continue
        target = {int(band[0]): int(most[0]) for _, band, most in bands.targets(np.array([len(u)]))}
        band = next(int(b[0]) for _, b, _ in bands.targets(np.array([len(v)])))
        assert band in target
        mine, own = (Segments(x, np.array([len(x)]), np.array([band]), bands) for x in (u, v))
        if mine.reach()[0] > target[band]:
            asked, offered = ({*base.tolist(), *near.tolist()} for base, near, _ in (mine.signatures(), own.signatures()))
            assert asked & offered
        a, b = sketches(np.concatenate([u, v]), np.array([len(u), len(v)]))
        assert sum(int(x).bit_count() for x in (a ^ b).view(np.uint64)) <= len(u) - len(v)


def test_word_hashes(monkeypatch):
    """Words in pieces of any length, beside empty and null texts, are those that split() finds."""
    import random

    import pyarrow as pa

    from tally.llm import tokens

    rng, seen = random.Random(1), {}
    parts = ["a", "B", "é", " ", "\n", "\t", "\x0b", "  ", "word", "W" * 50, "x" * 200, "\x1c", "\x85"]
    monkeypatch.setattr(tokens, "_PIECE", 64)
    for _ in range(200):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) if rng.random() > 0.1 else None for _ in range(rng.randrange(1, 8))]
        hashes, n = tokens.word_hashes(pa.array(texts, pa.string()).slice(1), True)
        want = [words(t, True) for t in texts[1:]]
        assert n.tolist() == list(map(len, want))
        for w, h in zip([w for t in want for w in t], hashes.tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("f", [exact_dedup, line_dedup, substring_dedup, jaccard_join])
def test_empty_tables(spark, f):
    assert f(spark.createDataFrame([], SCHEMA)).collect() == []
