"""The registered queries and the stages of the pipeline, on small tables."""

import collections
import glob
import hashlib
import os
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tally.llm import mixing, queries
from tally.llm.common import shared_path
from tally.llm.mixing import mix_sources
from tally.llm.sharding import shard_by_bytes

from .corpus import SCHEMA, corpus, frame, words
from .test_dedup import jaccard_reference, substring_reference


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with unique ids, their labels, and embeddings."""
    d = tmp_path_factory.mktemp("sf")
    rows = [r for r in corpus(3, 80) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    frame(spark, rows, False).write.parquet(str(d / "documents.parquet"))
    spark.createDataFrame([(r[0], int(r[0] % 9 != 0), 0) for r in rows], "doc_id bigint, quality int, toxic int").write.parquet(str(d / "labels.parquet"))
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8))
    x[1:20] = x[0] + 0.05 * rng.normal(size=(19, 8))
    spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>, label int").write.parquet(str(d / "embeddings.parquet"))
    return str(d), rows, x


def test_columns_of_the_contracts(spark, tables):
    want = {
        "op2_lm_scoring": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"}, "op3_jaccard_join": {"doc_id", "n_shingles", "component_id"}, "op4_near_duplicates": {"vec_id", "n_links", "component_id", "kept"},
        "op6_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}, "op7_substring_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256"}, "op8_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
        "op9_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}, "op10_line_dedup": {"doc_id", "n_lines", "n_dropped", "kept_sha256"},
    }
    for name, columns in want.items():
        assert columns <= set(queries.QUERIES[name](spark, tables[0]).columns), name


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, tables, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet({glob.glob(os.path.join(tables[0], 'documents.parquet', '*.parquet'))!r})")
    df = queries.QUERIES[name](spark, tables[0])
    got = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in got.description]
    assert collections.Counter(tuple(map(str, r)) for r in df.select(*names).collect()) == collections.Counter(tuple(map(str, r)) for r in got.fetchall())


def test_op2_base_scores(spark, tables):
    rows = {r[0]: [*words(r[1], True), b" end"] for r in tables[1]}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in rows}
    c = collections.Counter(w for i, t in rows.items() if not held[i] for w in t)
    n, v = sum(c.values()), len(c)
    for r in queries.op2_lm_scoring(spark, tables[0]).collect():
        t = rows[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(w in c for w in t), n)
        assert r.base_score == pytest.approx(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in t)) and r.score < 0


def test_op3_and_op7_against_brute_force(spark, tables):
    got = queries.op3_jaccard_join(spark, tables[0]).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == jaccard_reference(tables[1])
    got = queries.op7_substring_dedup(spark, tables[0]).collect()
    want = collections.Counter((i, n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, gone in substring_reference(tables[1], 50))
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want


def test_op4_against_all_pairs(spark, tables):
    y = tables[2].astype(np.float32).astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.9
    got = {r.vec_id: (r.n_links, r.recall) for r in queries.op4_near_duplicates(spark, tables[0]).collect()}
    assert sum(n for n, _ in got.values()) >= 0.9 * (near.sum() - len(y)) > 0 and got[0][1] >= 0.9


def test_op5_is_earliest_deadline_first(spark, tables, monkeypatch):
    """Slots of small blocks against a plain scheduler that looks at every source at every slot."""
    out = mix_sources(spark.read.parquet(f"{tables[0]}/documents.parquet").withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)) + 1), "size", block_bytes=400).collect()
    by = collections.defaultdict(dict)
    for r in out:
        by[r.source][r.block] = (r.release, r.deadline, r.slot)
    jobs = [(s, b, *x) for s, blocks in by.items() for b, x in blocks.items()]
    for s, b, release, deadline, slot in jobs:
        assert release <= slot < deadline
        # Whatever was released and still waiting at that slot is due no earlier.
        assert all(d >= deadline or r > slot or t < slot for q, c, r, d, t in jobs if q != s)
    assert len({x[4] for x in jobs}) == len(jobs)


def test_op6_round_trip(spark, tables):
    P, T = pytest.importorskip("public_tokenizers"), pytest.importorskip("tokenizers")
    reference = T.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {r[0]: [*reference.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in tables[1]}
    seen, used = collections.defaultdict(list), collections.defaultdict(list)
    for r in queries.op6_packing(spark, tables[0]).collect():
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(own.tobytes()), len(ids[r.doc_id]))
        seen[r.doc_id].append((r.start, r.length))
        used[r.sequence_id].append((r.offset, r.length))
    for i, t in ids.items():
        assert sum(n for _, n in seen[i]) == len(t) and [a for a, _ in sorted(seen[i])] == np.cumsum([0, *[n for _, n in sorted(seen[i])]])[:-1].tolist()
    for parts in used.values():
        assert sum(n for _, n in parts) <= 1024 and [a for a, _ in sorted(parts)] == np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1].tolist()


def test_op9_shards(spark, tables):
    out = queries.op9_sharding(spark, tables[0]).collect()
    text = {r[0]: r[1] or "" for r in tables[1]}
    assert sorted(r.doc_id for r in out) == sorted(text) and {r.law for r in out} == {"bytes"}
    slots = collections.defaultdict(list)
    for r in out:
        assert (r.size, r.text_crc32) == (len(text[r.doc_id].encode()) + 1, zlib.crc32(text[r.doc_id].encode()))
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_clashing_columns(spark):
    """A column named like a result gives way; names used inside are fine."""
    names = ["block", "slot", "Release", "deadline", "shard", "_source", "_size", "_before", "_range", "_key", "_seq", "_n", "_r", "_s", "_b", "_in0", "score", "n_tokens"]
    df = frame(spark, corpus()[:30], False).withColumn("size", F.coalesce(F.length("text"), F.lit(0)) + 1).withColumns({c: F.lit("mine") for c in names})
    out = mix_sources(df, "size", block_bytes=300)
    assert out.where("_source = 'mine' AND shard = 'mine' AND slot >= 0 AND block >= 0").count() == df.count() and out.columns.count("slot") == 1
    out = shard_by_bytes(df, "size", 3)
    assert out.where("_key = 'mine' AND block = 'mine' AND shard BETWEEN 0 AND 2").count() == df.count()
    from tally.llm import kneser_ney

    scored = kneser_ney.score(df, kneser_ney.train(df))
    assert scored.where("score < 0 AND n_tokens > 0 AND _key = 'mine'").count() == df.count()


def test_stages(spark, tables):
    """Each stage keeps the columns and does its own work; extra columns pass through."""
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet").withColumns({"_id": F.lit(1), "_slot": F.lit(2), "n": F.lit(3)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables[0])
        assert out.columns == docs.columns, name
        kept = out.select("doc_id").distinct().count()
        assert 0 < kept <= docs.count() and out.where("_id = 1 AND _slot = 2 AND n = 3").count() == out.count()
        assert stage(spark, docs.where("false"), tables[0]).count() == 0
        docs = spark.createDataFrame(out.collect(), out.schema)
    ids = [r.doc_id for r in docs.collect()]
    assert len(ids) == len(set(ids))
    exact = corpus_pipeline.without_copies(spark, spark.read.parquet(f"{tables[0]}/documents.parquet"), tables[0])
    norm = lambda t: b" ".join(words("x" + (t or "") + "x"))
    firsts = {}
    for r in sorted(tables[1], key=lambda r: r[0]):
        firsts.setdefault(norm(r[1]), r[0])
    assert {r.doc_id for r in exact.collect()} == set(firsts.values())
    near = corpus_pipeline.without_near_copies(spark, spark.read.parquet(f"{tables[0]}/documents.parquet"), tables[0])
    assert {r.doc_id for r in near.collect()} == {c for _, _, c in jaccard_reference(tables[1])}
    mixed = corpus_pipeline.mixed(spark, spark.read.parquet(f"{tables[0]}/documents.parquet"), tables[0])
    assert collections.Counter((r.doc_id, r.text) for r in mixed.collect()) == collections.Counter((r[0], r[1]) for r in tables[1])


def test_a_cluster_without_a_shared_folder_raises():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = type("Conf", (), {"get": lambda self, k, d=None: d})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_path(Session(), "x")


def test_empty_and_null_schema(spark):
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA), "n_chars").count() == 0
