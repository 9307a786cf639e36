import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.llm import kneser_ney
from tally.llm.mixing import integer_shares, mix_sources, pfair_period, schedule
from tally.llm.neardup import near_duplicates
from tally.llm import packing
from tally.llm.packing import Shard, Tokens, pack
from tally.llm import quality
from tally.llm.quality import classify_quality
from tally.llm.sharding import shard_by_bytes

from .corpus import SCHEMA, components, corpus, frame, words


def reference_scores(train, texts):
    """Interpolated modified Kneser-Ney bigrams in plain Python."""
    toks = lambda t: [*words(t, True), b" end"]
    seq = [toks(t) for t in train]
    c = collections.Counter(w for s in seq for w in s)
    big = collections.Counter(p for s in seq for p in zip([b" start", *s], s, strict=False))
    cont = collections.Counter(w for _, w in big)

    def discount(values):
        k = collections.Counter(values)
        return kneser_ney.discounts([k[i] for i in (1, 2, 3, 4)])

    d, e, total = discount(big.values()), discount(cont.values()), collections.Counter()
    kinds = collections.defaultdict(lambda: [0, 0, 0, 0])
    for (v, _), n in big.items():
        total[v] += n
        kinds[v][min(n, 3)] += 1
    size, n_all, n_big = len(c), sum(c.values()), len(big)
    freed = sum(e[min(n, 3)] for n in cont.values()) / max(1, n_big)

    def low(w):
        return (max(cont[w] - e[min(cont[w], 3)], 0) / n_big + freed / (size + 1)) if n_big else 1 / (size + 1)

    def p(v, w):
        if not total[v]:
            return low(w)
        n = big[(v, w)]
        return max(n - d[min(n, 3)], 0) / total[v] + sum(d[i] * kinds[v][i] for i in (1, 2, 3)) / total[v] * low(w)

    out = []
    for t in texts:
        s = toks(t)
        out.append((len(s), sum(c[w] > 0 for w in s), sum(math.log10((c[w] + 1) / (n_all + size + 1)) for w in s), sum(math.log10(p(v, w)) for v, w in zip([b" start", *s], s, strict=False))))
    return out, n_all


@pytest.mark.parametrize("per_shard", [2_000_000, 50])
def test_kneser_ney(spark, per_shard):
    rows = [r for r in corpus() if r[0] is not None]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    df = frame(spark, rows).select("doc_id", "text")
    model = kneser_ney.train(df.where(F.crc32(F.col("doc_id").cast("string")) % 7 != 2), tokens_per_shard=per_shard, flush=300)
    got = collections.Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in kneser_ney.score(df, model).collect())
    want, n = reference_scores([t for i, t, *_ in rows if not held(i)], [r[1] for r in rows])
    assert model.tokens == n
    assert got == collections.Counter((r[0], *w[:2], round(w[2], 6), round(w[3], 6)) for r, w in zip(rows, want, strict=True))


def test_kneser_ney_without_training_text(spark):
    df = spark.createDataFrame([(1, "a b", None, None, None), (2, None, None, None, None)], SCHEMA)
    model = kneser_ney.train(df.where("false"))
    got = {r.doc_id: (r.n_tokens, r.n_known, r.base_score, r.score) for r in kneser_ney.score(df.select("doc_id", "text"), model).collect()}
    assert got == {1: (3, 0, 0.0, 0.0), 2: (1, 0, 0.0, 0.0)}
    assert kneser_ney.score(df.select("doc_id", "text").where("false"), model).collect() == []


def test_quality_separates_held_out_labels(spark):
    rng = random.Random(3)
    vocabulary = [f"word{i}" for i in range(120)]
    clean = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(30, 90))), "en", "s", 0) for i in range(600)]
    junk = [(1000 + i, " ".join(f"{w}{rng.choice('#$%&')}{rng.randrange(999)}" for w in rng.choices(vocabulary, k=60)), "en", "s", 0) for i in range(60)]
    stutter = [(2000 + i, " ".join(w for w in rng.choices(vocabulary, k=6) for _ in range(12)), "en", "s", 0) for i in range(20)]
    odd = [(3000, None, None, None, None), (3001, "", "xx", None, 0), (3002, "word1 word2", None, "s", 0)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)] + [(1000, 0, 0), (None, 1, 0), (1, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r.accepted for r in classify_quality(spark.createDataFrame(clean + junk + stutter + odd, SCHEMA), labels).collect()}
    assert len(got) == 683 and not any(v is None for v in got.values())
    assert sum(got[i] for i in range(400, 600)) >= 197
    assert sum(got[1000 + i] for i in range(60)) == 0
    assert sum(got[2000 + i] for i in range(20)) == 0


@pytest.mark.parametrize("stutter", [False, True])
def test_count_joins_score_as_the_mapped_model(spark, tmp_path, stutter):
    """The joined counts and the memory-mapped arrays are the same model."""
    rows = corpus(7, 40)
    df = frame(spark, rows, False).select("doc_id", F.col("text").alias("_text"))
    train_rows = df.where("doc_id % 3 <> 0")
    df.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    got = quality.score(docs, kneser_ney.train(train_rows, "_text"), stutter).collect()
    want = kneser_ney.score(df, kneser_ney.train(train_rows, "_text"), "_text", stutter=stutter).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.n_tokens, round(r.score, 6))
    assert sorted(map(key, got), key=str) == sorted(map(key, want), key=str)
    # Rows that don't come straight from files are written first.
    again = quality.score(docs.groupBy("doc_id", "_text").count().drop("count"), kneser_ney.train(train_rows, "_text"), stutter).collect()
    assert {key(r) for r in again} == {key(r) for r in got}


def test_blocks_survive_other_splits(spark, tmp_path, monkeypatch):
    """Between the two scans files are split anew, and blocks are a few rows: scores are equal; a file that changes raises."""
    monkeypatch.setattr(quality, "BLOCK_ROWS", 7)
    rows = [r for r in corpus(6, 80) if r[0] is not None]
    path = str(tmp_path / "docs")
    frame(spark, rows, False).coalesce(1).write.option("parquet.block.size", 4096).parquet(path)
    docs = lambda: spark.read.parquet(path).select("doc_id", F.col("text").alias("_text"))
    model = kneser_ney.train(docs().where("doc_id % 2 = 0"), "_text")
    want = collections.Counter((r.doc_id, r.n_tokens, round(r.score, 9)) for r in quality.score(docs(), model).collect())
    name, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for first, then in (("3k", "1g"), ("1g", "3k"), ("5k", "3k")):
            spark.conf.set(name, first)
            scored = quality.score(docs(), model)
            spark.conf.set(name, then)
            assert collections.Counter((r.doc_id, r.n_tokens, round(r.score, 9)) for r in scored.collect()) == want
    finally:
        spark.conf.set(name, old)
    scored = quality.score(docs(), model)
    frame(spark, rows[:40], False).coalesce(1).write.mode("overwrite").parquet(path)
    with pytest.raises(Exception):  # noqa: B017
        scored.collect()


def test_a_missing_shard_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        kneser_ney._map(str(tmp_path), "words-0", "<u8")
    (tmp_path / "cut").write_bytes(b"12345")
    with pytest.raises(OSError, match="whole items"):
        kneser_ney._map(str(tmp_path), "cut", "<u8")


def test_quality_without_trusted_text(spark):
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert all(r.accepted for r in classify_quality(frame(spark, corpus()[:20], False), labels).collect())


def test_pfair_stays_within_one_block():
    for weights in ({"a": 1.0}, {"a": 5, "b": 3, "c": 1}, {"a": 1, "b": 1}, {"a": 97, "b": 2, "c": 1, "d": 40}):
        shares = integer_shares(weights, 200)
        assert sum(shares.values()) == 200
        slots = pfair_period(shares)
        assert sorted(x for v in slots.values() for x in v) == list(range(200))
        for s, own in slots.items():
            for i, t in enumerate(own):
                assert i * 200 // shares[s] <= t < -(-(i + 1) * 200 // shares[s])
            for t in range(201):
                assert abs(sum(x < t for x in own) - t * shares[s] / 200) < 1


def test_schedule_gives_every_block_once():
    blocks = {"a": 400, "b": 7, "c": 33}
    seen, phases = [], schedule(blocks, {"a": 1, "b": 1, "c": 2}, 50)
    for s, first, given, slot0, period, slots in phases:
        seen += [(slot0 + i // len(slots) * period + slots[i % len(slots)], s, first + i) for i in range(given)]
    assert sorted(x[0] for x in seen) == list(range(440))
    assert {(s, b) for _, s, b in seen} == {(s, b) for s, n in blocks.items() for b in range(n)}


def test_schedule_stays_within_one_block_of_the_target_weights():
    """A hot source and forty others over many periods, one of them far below 1/1000."""
    size = {"hot": 20_000, **{f"s{i:02}": 200 + 7 * i for i in range(39)}, "tiny": 3}
    weights = {s: n**0.5 for s, n in size.items()} | {"tiny": 0.05}
    slot0, left, phase = 0, dict(size), {}
    for s, _, given, start, length, slots in schedule(size, weights, 1000):
        phase.setdefault(start, []).append((s, given, length, slots))
    for start, rows in sorted(phase.items()):
        assert start == slot0
        total, length = sum(weights[s] for s, n in left.items() if n), rows[0][2]
        for s, given, _, slots in rows:
            own = [i // len(slots) * length + slots[i % len(slots)] for i in range(given)]
            for i, t in enumerate(own):
                w = weights[s] / total
                assert -1 < i - t * w and i + 1 - (t + 1) * w < 1
            left[s] -= given
        slot0 += sum(given for _, given, _, _ in rows)
    assert slot0 == sum(size.values()) and not any(left.values())


def test_mixing(spark):
    rows = corpus()
    df = frame(spark, rows, False).withColumn("size", F.length("text") + 1)
    out = mix_sources(df, "size", block_bytes=700, period=60).collect()
    assert collections.Counter((r.doc_id, r.text) for r in out) == collections.Counter((r[0], r[1]) for r in rows)
    assert all(r.release <= r.slot < r.deadline for r in out)
    where = collections.defaultdict(set)
    for r in out:
        where[r.slot].add((r.source, r.block))
    assert all(len(v) == 1 for v in where.values())
    by_source = collections.defaultdict(list)
    for r in out:
        by_source[r.source].append((r.doc_id if r.doc_id is not None else -1, r.slot))
    assert all(x == sorted(x, key=lambda y: y[0]) and [s for _, s in x] == sorted(s for _, s in x) for x in (sorted(v) for v in by_source.values()))
    assert mix_sources(df.where("false"), "size").collect() == []


def test_sharding(spark):
    rows = corpus(2, 200) + [(7, "copy " * 30, None, None, None)] * 150  # one key with many rows
    df = frame(spark, rows).withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)) + 1)
    out = shard_by_bytes(df, "bytes", 4, tolerance=0.02, ranges=3).collect()
    assert collections.Counter((r.doc_id, r.text) for r in out) == collections.Counter((r[0], r[1]) for r in rows)
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in out:
        size[r.shard] += r.bytes
        slots[r.shard].append(r.slot)
    mean, widest = sum(size.values()) / 4, max(r.bytes for r in out)
    assert set(size) == {0, 1, 2, 3} and all(abs(x - mean) <= 0.04 * mean + widest for x in size.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    order = [r.doc_id if r.doc_id is not None else -1 << 62 for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    assert shard_by_bytes(df.where("false"), "bytes", 4).collect() == []
    assert [r.slot for r in shard_by_bytes(df.limit(1), "bytes", 4).collect()] == [0]


@pytest.fixture(scope="module")
def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    return P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def test_ids_are_the_tokenizers(tokenizer):
    P, T = pytest.importorskip("public_tokenizers"), pytest.importorskip("tokenizers")
    reference = T.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng, own = random.Random(1), Tokens(*tokenizer)
    pieces = ["the", " ", "  ", "\n", "\t", "é", "don't", "'s", "123", "…", "日本", ".\n", " ", " ", "X", " a", "\r\n", "!!", "_", "🙂", "'re '"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(0, 30))) for _ in range(3000)] + [r[1] for r in corpus() if r[1]]
    for t, e in zip(texts, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(own.of(t), "<u2").tolist() == e.ids, repr(t)


def test_ids_of_added_tokens_and_long_white_space(tokenizer):
    P, T = pytest.importorskip("public_tokenizers"), pytest.importorskip("tokenizers")
    reference, own = T.Tokenizer.from_file(P.path("byte_bpe_50k.json")), Tokens(*tokenizer)
    texts = ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|><|endoftext|> x", "<|endoftext |>", "<|ENDOFTEXT|>"]
    texts += ["a" + " " * 1_000_000 + "x", "a" + "\n" * 1_200_000, " \u00a0" * 600_000 + "x", "a " * 100_000]
    for t in texts:
        assert np.frombuffer(own.of(t), "<u2").tolist() == reference.encode(t, add_special_tokens=False).ids, repr(t[:20])


def test_ids_need_no_look_ahead(spark, tokenizer):
    """The tokenizer's pattern is searched without a look-ahead, and texts are cut where that matters: with each kind of blank, the ids stay."""
    T = pytest.importorskip("tokenizers")
    own, again = packing._tokens(*tokenizer), packing._tokens(*tokenizer)
    assert own is again and own.cuts and "(?!" not in packing.PLAIN
    reference, rng = T.Tokenizer.from_file(own.reference_path), random.Random(4)
    blanks = [chr(c) for c in (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
    others = [chr(c) for c in (*range(28, 32), 0x180E, 0x200B, 0x2060, 0xFEFF)]
    texts = [a + w + b + x + b + a for w in ("", "word", "'s", "7") for x in ("A" * 40, "!") for a in blanks + others for b in (a, " ", "\n", "\u3000")]
    texts += ["".join(rng.choices([*blanks, *others, "word", "7", "'s", "é", "long words of prose " * 4], k=12)) for _ in range(2000)] + ["", "  ", " a", "a  ", None]
    out = pack(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), *tokenizer, window=1 << 14).collect()
    expected = [[*e.ids, 0] for e in reference.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for r in out:
        part = np.array(expected[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.doc_tokens == len(expected[r.doc_id]) and r.ids_crc32 == zlib.crc32(part.tobytes()), repr(texts[r.doc_id])
    assert sum(r.length for r in out) == sum(map(len, expected))


def test_distinct_is_unique():
    rng = np.random.default_rng(5)
    for a in [rng.integers(0, top, n).astype("<u2") for n in (0, 1, 2, 15, 16, 17, 300, 5000) for top in (1, 2, 50, 1 << 16)]:
        for x, y in zip(packing._distinct(a), np.unique(a, return_counts=True), strict=True):
            assert x.tolist() == y.tolist() and x.dtype == y.dtype


def test_packing_round_trip(spark, tokenizer):
    rows = [r for r in corpus() if r[0] is not None]
    rows = [r for r in rows if [x[0] for x in rows].count(r[0]) == 1]
    out = pack(frame(spark, rows), *tokenizer, window=64, shard_docs=20).collect()
    own = Tokens(*tokenizer)
    ids = {r[0]: np.append(np.frombuffer(own.of(r[1] or ""), "<u2"), 0).astype("<u4") for r in rows}
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in out:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts, total in [(sorted(pieces[i]), len(ids[i])) for i in ids]:
        assert [s for s, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) == total
    for parts in (sorted(v) for v in sequences.values()):
        assert [s for s, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        total = sum(n for _, n in parts)
        assert total <= 64 and total & (total - 1) == 0
    assert pack(frame(spark, rows).where("false"), *tokenizer).collect() == []


def test_packing_takes_lexical_neighbours(spark, tokenizer):
    """Documents of two vocabularies, interleaved: windows hold one vocabulary each."""
    rng = random.Random(2)
    text = lambda k: " ".join(rng.choices([f"{'cat' if k else 'star'}{i}" for i in range(9)], k=12))
    rows = [(i, text(i % 2), None, None, None) for i in range(80)]
    out = pack(spark.createDataFrame(rows, SCHEMA).coalesce(1), *tokenizer, window=256).collect()
    kinds = collections.defaultdict(collections.Counter)
    for r in out:
        kinds[r.sequence_id][r.doc_id % 2] += r.length
    pure = sum(max(c.values()) for c in kinds.values()) / sum(sum(c.values()) for c in kinds.values())
    assert pure > 0.85


def test_packing_finds_neighbours_in_other_partitions(spark, tokenizer):
    """Eight vocabularies dealt over four partitions and several shards: windows hold one each."""
    rng, kinds = random.Random(3), ["cat", "star", "river", "music", "bread", "engine", "garden", "winter"]
    rows = [(i, " ".join(rng.choices([f"{kinds[i % 8]}{j}" for j in range(9)], k=12)), None, None, None) for i in range(480)]
    out = pack(spark.createDataFrame(rows, SCHEMA).repartition(4, "doc_id"), *tokenizer, window=256, shard_docs=60).collect()
    held = collections.defaultdict(collections.Counter)
    for r in out:
        held[r.sequence_id][r.doc_id % 8] += r.length
    assert sum(max(c.values()) for c in held.values()) / sum(sum(c.values()) for c in held.values()) > 0.85


def test_packing_asks_with_all_terms():
    """The match shares only the seed's lightest terms, beyond the twelve heaviest."""
    idf = np.linspace(1, 2, 1 << 16).astype(np.float32)
    seed = np.arange(100, 130, dtype="<u2")
    index = Shard([seed, np.array([50_000, 50_001], "<u2"), np.array([100, 101, 102], "<u2")], idf, 20.0)
    assert index.first() == 0
    assert next(index.neighbours(0)) == 2
    ids = [np.random.default_rng(i).integers(0, 300, 40).astype("<u2") for i in range(50)]
    index = Shard(ids, idf, 40.0)
    for i, a in enumerate(ids[:5]):
        plain = [sum(idf[t] * c * 2.2 / (c + 1.2) for t in np.unique(a) if (c := int((b == t).sum()))) for b in ids]
        assert np.allclose(index.scores(i), plain, rtol=1e-4)


def vectors(seed=0, n=240, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[40:120] = x[40] + 0.08 * rng.normal(size=(80, dim))  # a hot group of near copies
    x[121], x[122] = x[120] * 3, x[120] + 0.2 * rng.normal(size=dim)
    for i in range(130, 190):  # a chain around the threshold
        x[i] = x[i - 1] + 0.42 * rng.normal(size=dim)
    return x.astype(np.float32)


@pytest.mark.parametrize("rows_each", [1500, 25])
def test_near_duplicates(spark, rows_each):
    x = vectors()
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [1.0, None] + [1.0] * 14), (904, [1.0]), (905, []), (906, [float("inf")] + [0.0] * 15)]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(i, v, 1) for i, v in odd] + [(5, x[40].tolist(), 2), (None, x[41].tolist(), 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = near_duplicates(df, rows_each=rows_each).collect()
    assert len(got) == len(rows) and got[0].recall >= 0.9
    y = np.array([r[1] for r in rows if r[1] is not None and len(r[1]) == 16 and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])], float)
    ids = [r[0] for r in rows if r[1] is not None and len(r[1]) == 16 and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.9
    want = collections.Counter((i, int(n)) for i, n in zip(ids, near.sum(1) - 1, strict=True))
    have = collections.Counter((r.vec_id, r.n_links) for r in got if r.vec_id is None or r.vec_id < 900)
    assert sum((want - have).values()) <= 0.05 * len(ids)
    comp = components(range(len(ids)), [(a, b) for a in range(len(ids)) for b in range(a) if near[a, b]])
    small = collections.defaultdict(list)
    for k, c in comp.items():
        if ids[k] is not None:
            small[c].append(ids[k])
    expected = collections.Counter((ids[k], min(small[c])) for k, c in comp.items())
    found = collections.Counter((r.vec_id, r.component_id) for r in got if r.vec_id is None or r.vec_id < 900)
    assert sum((expected - found).values()) <= 0.05 * len(ids)
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None and r.vec_id >= 900} == {(i, 0, i, True) for i, _ in odd}


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert near_duplicates(df).collect() == []
    one = spark.createDataFrame([(1, [0.0, 1.0], 0)], "vec_id bigint, embedding array<float>, label int")
    assert [(r.vec_id, r.n_links, r.kept) for r in near_duplicates(one).collect()] == [(1, 0, True)]


def test_packing_keeps_the_order_of_lots(spark, tokenizer):
    """Sequences ascend with the lots, and none holds documents of two; another order of lots gives other sequences."""
    rows = [(i, f"alpha beta gamma {i} " * 30) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def run(lot):
        at = collections.defaultdict(set)
        for r in pack(docs, *tokenizer, window=256, lot=lot).collect():
            at[r.sequence_id].add(r.doc_id)
        return [at[s] for s in sorted(at)]

    up = run((F.col("doc_id") / 20).cast("int"))
    assert [min(s) // 20 for s in up] == [max(s) // 20 for s in up] == sorted(min(s) // 20 for s in up)
    down = run(2 - (F.col("doc_id") / 20).cast("int"))
    assert [min(s) // 20 for s in down] == sorted((min(s) // 20 for s in down), reverse=True) and set().union(*up) == set().union(*down) == set(range(60))


def test_pipeline_packs_in_the_mixtures_order(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame([(i, f"word {i % 3} " * 50) for i in range(40)], "doc_id long, text string")
    first = F.when(F.col("doc_id") % 2 == 0, 0).otherwise(1)  # slots: even ids, then odd ones
    docs.repartitionById(2, first).write.parquet(str(tmp_path / "mixed"))
    seen = {}
    for r in corpus_pipeline.packed(spark, spark.read.parquet(str(tmp_path / "mixed")), "").collect():
        seen.setdefault(r.doc_id % 2, []).append(r.sequence_id)
    assert max(seen[0]) < min(seen[1])
