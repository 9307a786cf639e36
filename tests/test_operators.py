"""Operators on small literal tables, and the streaming versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tally.operators import claims as C
from tally.operators import relational as R
from tally.sources.tables import VersionedStore, gold_csv, monthly_rows, payload_log
from tally.streaming import projection as S


def test_nearest_baseline_is_thirty_days_back(spark):
    d = dt.date
    h = spark.createDataFrame([("x", d(2026, 6, 1), 40.0), ("x", d(2026, 6, 25), 45.0), ("x", d(2026, 7, 1), 46.0), ("y", d(2026, 7, 1), 5.0)], "k string, day date, v double")
    got = {r.k: (r.base_value, r.days) for r in R.nearest_baseline(h, "k", "day", "v", 20, 45, 30).collect()}
    assert got == {"x": (40.0, 30), "y": (None, None)}


def test_replay_is_idempotent_and_coalesces(spark):
    log = spark.createDataFrame([("a", 1, 100, None, 1), ("a", 2, None, 7, 1), ("a", 3, 300, None, 2), ("b", 4, None, None, 1)], "k string, id int, visits int, rank int, version int")
    want = {("a", 300, 7, 2), ("b", None, None, 1)}
    for df in (log, log.unionByName(log)):
        assert {(r.k, r.visits, r.rank, r.version) for r in R.coalescing_upsert(df, ["k"], "id", ["visits", "rank"], ["version"]).collect()} == want


@pytest.mark.parametrize(
    ("events", "want"),
    [
        ([(1, [("US", 3334), ("GB", 1000)], 10000)], (1, 2, 10000)),
        ([(1, [("US", 3334)], 10000), (2, [("CA", 2500)], 12000)], (2, 1, 12000)),
        ([(1, [("CA", 2500)], 12000), (2, [], 16000)], (1, 1, 16000)),
        ([(1, [("CA", 2500)], 12000), (2, None, None)], (1, 1, 12000)),
        ([(1, [("CA", 2500)], None), (2, [], 9)], (1, 1, 9)),
    ],
)
def test_set_reconciliation(spark, events, want):
    df = spark.createDataFrame([("d", *e) for e in events], "k string, id int, items array<struct<code:string,bps:int>>, visits int")
    r = R.latest_set(df, ["k"], "id", "items", "visits").first()
    assert (r.set_source, len(r["items"]), r.visits) == want


def test_facet_rollup_keeps_unknown_apart_from_zero(spark):
    rows = [("t0", "c", "US", 0), ("t1", "c", "US", None), ("t0", "c", "CA", 0), ("t1", "c", "GB", None)]
    out = R.facet_rollup(spark.createDataFrame(rows, "item string, cat string, country string, v int"), "item", "cat", "country", "v")
    got = {(r.cat, r.country): (r["items"], r.visits, r.unknown_visits) for r in out.where("grain IN (0, 2)").collect()}
    assert got[("c", "US")] == (2, 0, 1) and got[("c", "CA")] == (1, 0, 0) and got[("c", "GB")] == (1, None, 1) and got[(None, "US")] == (2, 0, 1)
    assert R.facet_rollup(spark.createDataFrame([], "item string, cat string, country string, v int"), "item", "cat", "country", "v").collect() == []


def test_continuity(spark):
    log = spark.createDataFrame([("s", i, v) for i, v in enumerate(["a", "a", None, None, "a", "b"])], "k string, id int, v string")
    assert [(r.island, r.seen) for r in R.continuity(log, ["k"], "id", "v").orderBy("id").collect()] == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 1)]


def test_manual_wins(spark):
    old = spark.createDataFrame([(1, "m", "manual"), (2, "x", "auto"), (3, "y", "auto")], "id int, v string, source string")
    new = spark.createDataFrame([(1, "n", "auto"), (2, "n", "auto"), (4, "n", "auto")], "id int, v string, source string")
    assert {(r.id, r.v) for r in R.manual_wins(old, new, ["id"], ["v"]).collect()} == {(1, "m"), (2, "n"), (3, "y"), (4, "n")}


def test_unpivot_keeps_the_first_place(spark):
    df = spark.createDataFrame([("d", "US", 0.5, "US", 0.1, None, 0.2, "GB", 0.3)], "k string, c0 string, s0 double, c1 string, s1 double, c2 string, s2 double, c3 string, s3 double")
    got = R.unpivot_positions(df, ["k"], [(f"c{i}", f"s{i}") for i in range(4)], "code", "share").collect()
    assert {(r.code, r.position, r.share) for r in got} == {("US", 1, 0.5), ("GB", 4, 0.3)}


def test_legal_states(spark):
    legal = C.legal_states(spark)
    n = legal.count()
    assert 0 < n < 1920
    assert legal.where("publication_status = 'published' AND lifecycle_status NOT IN ('active', 'aging')").count() == 0


def test_identity(spark):
    scored = spark.createDataFrame([("a", 1, 0.9), ("a", 2, 0.7), ("b", 1, 0.8), ("b", 2, 0.75), ("c", 1, 0.5)], "candidate string, subject int, score double")
    assert {r.candidate: (r.subject, r.status) for r in C.resolve_identity(scored).collect()} == {"a": (1, "matched"), "b": (None, "conflict"), "c": (None, "new")}


def test_per_class(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", None)], "g string, p string")
    got = {r.label: (r.support, r.precision, r.recall, r.f1) for r in C.per_class(rows, "g", "p").collect()}
    assert got == {"a": (2, 1.0, 0.5, 0.6667), "b": (2, 0.5, 0.5, 0.5)}


def test_payloads(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"id":1,"domain":"x.com","payload":"{\\"EstimatedMonthlyVisits\\":{\\"2026-05-01\\":100,\\"2026-06-01\\":200},\\"GlobalRank\\":{\\"Rank\\":0},\\"Engagments\\":{\\"BounceRate\\":\\"0.4\\"}}"}\n{"id":2,"domain":"y.com","payload":"oops"}\n')
    rows = monthly_rows(payload_log(spark, str(tmp_path / "log.json"))).orderBy("month").collect()
    assert [(str(r.month), r.visits, r.global_rank, r.bounce_rate) for r in rows] == [("2026-05-01", 100, None, None), ("2026-06-01", 200, None, 0.4)]


def test_gold_csv(spark, tmp_path):
    (tmp_path / "gold.csv").write_text("tool_id,primary_leaf_slug,primary_acceptable_alternates\n1,a,b|c;b\nx,a,\n2,,\n3,d,\n")
    assert [(r.tool_id, r.primary_acceptable_alternates) for r in gold_csv(spark, str(tmp_path / "gold.csv")).orderBy("tool_id").collect()] == [(1, ["b", "c"]), (3, [])]


def test_versioned_store_swaps_only_what_it_saw(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path / "store"))
    assert store.active() is None and store.read() is None
    a, b = store.write(spark.range(1)), store.write(spark.range(2))
    assert store.activate(a, None) and not store.activate(b, None) and store.read().count() == 1
    assert store.activate(b, a) and store.active() == b and store.read().count() == 2
    (tmp_path / "store/.next-dead").write_text("left by a writer that died before its rename")
    assert store.activate(a, b) and VersionedStore(spark, str(tmp_path / "store")).active() == a


def test_streaming_projection_equals_replay(spark, tmp_path):
    schema = "k string, id bigint, visits bigint, rank bigint"
    rows = [("a", 1, 100, None), ("a", 2, None, 7), ("b", 3, 5, 5), ("a", 4, 400, None), ("b", 5, None, 6)]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = S.read_files(spark, str(tmp_path / "in/*"), schema, 2)
    S.project(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), ["k"], "id", ["visits", "rank"]).awaitTermination()
    got = {(r.k, r.visits, r["rank"]) for r in S.projected(spark, str(tmp_path / "out"), ["k"], "id", ["visits", "rank"]).collect()}
    assert got == {("a", 400, 7), ("b", 5, 6)}


def test_streaming_projection_of_late_rows(spark, tmp_path):
    """A late value wins over an older one, not over a newer one; untouched buckets aren't written."""
    schema, args = "k string, id bigint, visits bigint, rank bigint", (["k"], "id", ["visits", "rank"])
    for i, rows in enumerate(([("a", 1, 10, None), ("a", 5, None, 7), ("z", 1, 1, 1)], [("a", 3, 20, 6)], [("a", 2, 15, None)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = S.read_files(spark, str(tmp_path / "in/*"), schema, 1)
    S.project(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), *args).awaitTermination()
    got = {(r.k, r.id, r.visits, r["rank"]) for r in S.projected(spark, str(tmp_path / "out"), *args).collect()}
    assert got == {("a", 5, 20, 7), ("z", 1, 1, 1)}
    assert sum(1 for _ in (tmp_path / "out").glob("bucket=*/version=*")) == 4


def test_leases_wait_and_beat(spark, tmp_path):
    t = lambda s: dt.datetime(2026, 1, 1, 0, s // 60, s % 60)
    rows = [("k", "claim", 0, t(0)), ("k", "beat", 1, t(50)), ("k", "claim", 0, t(70)), ("k", "failed", 1, t(80)), ("k", "claim", 0, t(85)), ("k", "claim", 0, t(90))]
    spark.createDataFrame(rows, "key string, event string, token bigint, at timestamp").repartition(4).write.parquet(str(tmp_path / "q"))
    out = []
    stream = S.read_files(spark, str(tmp_path / "q"), "key string, event string, token bigint, at timestamp")
    S.run_to_end(S.leases(stream, backoff=10), lambda df, i: out.extend(df.collect()), str(tmp_path / "c"))
    assert [r.event for r in out] == ["granted", "prolonged", "ignored", "queued", "ignored", "granted"]


def test_leases(spark, tmp_path):
    t = lambda s: dt.datetime(2026, 1, 1, 0, 0, s) if s < 60 else dt.datetime(2026, 1, 1, 0, s // 60, s % 60)
    rows = [("k", "claim", 0, t(0)), ("k", "claim", 0, t(5)), ("k", "failed", 9, t(6)), ("k", "claim", 0, t(70)), ("k", "done", 1, t(75)), ("k", "done", 2, t(80)), ("k", "claim", 0, t(90))]
    spark.createDataFrame(rows, "key string, event string, token bigint, at timestamp").coalesce(1).write.parquet(str(tmp_path / "q"))
    out = []
    stream = S.read_files(spark, str(tmp_path / "q"), "key string, event string, token bigint, at timestamp")
    S.run_to_end(S.leases(stream), lambda df, i: out.extend(df.collect()), str(tmp_path / "c"))
    assert [r.event for r in out] == ["granted", "ignored", "ignored", "granted", "ignored", "done", "ignored"]
    assert out[-1].status == "done" and out[-1].token == 2


def test_windowed_counts(spark, tmp_path):
    rows = [(dt.datetime(2026, 1, 1, h, 5), "a") for h in (0, 0, 1, 5)]
    spark.createDataFrame(rows, "ts timestamp, k string").coalesce(1).write.parquet(str(tmp_path / "e"))
    out = []
    stream = S.read_files(spark, str(tmp_path / "e"), "ts timestamp, k string")
    S.run_to_end(S.windowed_counts(stream, "ts", "k"), lambda df, i: out.extend(df.collect()), str(tmp_path / "c"), "update")
    assert sorted(r.n for r in out) == [1, 1, 2]


def test_due(spark):
    rows = [("queued", None, None, 0), ("failed", dt.datetime(2026, 1, 3), None, 0), ("running", None, dt.datetime(2026, 1, 1), 1), ("running", None, dt.datetime(2026, 1, 9), 1), ("queued", None, None, 3)]
    df = spark.createDataFrame(rows, "status string, retry timestamp, lease timestamp, attempts int").withColumns({"most": F.lit(3), "dead": F.lit(None).cast("timestamp")})
    ready = R.due("status", "retry", "lease", F.lit("2026-01-02").cast("timestamp"), "attempts", "most", "dead")
    assert [r.x for r in df.select(F.coalesce(ready, F.lit(False)).alias("x")).collect()] == [True, False, True, False, False]


def test_write_plan_of_a_hot_item(spark):
    """Ids are made distinct before the shuffle: no list of all rows of an item is built."""
    from tally.operators.state import write_plan

    tree = spark.createDataFrame([("a", 2, 1), ("b", 3, 1), ("top", 1, None)], "slug string, id int, parent_id int")
    rows = spark.range(3000).selectExpr("if(id < 2990, 'hot', concat('i', id % 2)) AS item", "CASE WHEN id < 2990 THEN elt(1 + id % 2, 'a', 'b') WHEN id % 2 = 0 THEN 'top' ELSE 'none' END AS leaf")
    plan = write_plan(rows, tree, "item", "leaf")
    assert {r.item: (r.ids, r.invalid) for r in plan.collect()} == {"hot": ([1, 2, 3], False), "i0": ([1], False), "i1": ([], True)}
    assert "collect_list" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_most_similar_leaves_no_pair_out(spark, monkeypatch):
    """Every candidate meets all known subjects (F6): equal sets, shared words, none at all, no words; frequent words are dealt out."""
    monkeypatch.setattr(R, "SHARE", 2)
    rng = random.Random(6)
    words = lambda: rng.choice([None, [], ["z"], rng.sample("abcdefg", rng.randint(1, 5)), ["a", "a", *rng.sample("bcdefg", 3)]])
    mine, theirs = [(i, words()) for i in range(80)], [(i, words()) for i in range(100, 140)]
    make = lambda rows, name: spark.createDataFrame(rows, f"{name} long, words array<string>")
    like = lambda p, q: len(p & q) / len(p | q) if p and q else 0.0
    want = {i: max((like(set(p or []), set(q or [])), -j) for j, q in theirs) for i, p in mine}
    got = R.most_similar(make(mine, "candidate"), make(theirs, "subject")).collect()
    assert len(got) == len(mine) and {r.candidate: (r.similarity, -r.subject) for r in got} == want
    assert len({r.similarity for r in got}) > 4


def test_identity_jaccard_crosses_brand_type_and_size(spark, tmp_path):
    """The most similar part may be of another brand, type and size, and a part without a name has a row too."""
    from tally.plans.catalog import QUERIES

    rows = [(1, "red ring", "A", "X", 1), (2, "red ring", "B", "Y", 2), (3, "hot rod", "B", "Y", 2), (4, "cold rod", "C", "X", 3), (6, None, "D", "Z", 4), (8, "blue gear", "D", "Z", 4)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = {r.candidate: (r.subject, r.similarity) for r in QUERIES["identity_jaccard"](spark, str(tmp_path)).collect()}
    assert got == {2: (1, 1.0), 4: (3, 0.333333), 6: (1, 0.0), 8: (1, 0.0)}


IDENTITY = "block string, {}, name string, names array<string>, audience string, billing string, position int, card array<string>, anchor array<string>, price array<string>"


def _identities(spark, monkeypatch):
    """Rows of few kinds, so that classes hold many members, and rows of ids, nulls and empty texts; the pairs by brute force."""
    import random

    monkeypatch.setattr(C, "CLASS_ROW", 4)
    monkeypatch.setattr(C, "DEAL", 8)
    rng = random.Random(5)
    some = lambda *x: rng.choice([None, [], *[list(v) for v in x]])
    make = lambda i: {"block": rng.choice(["x", "x", "y", None]), "i": i, "name": rng.choice(["a", "b", "", None]), "audience": rng.choice(["t", "", None]), "billing": "m", "position": rng.choice([1, 2, None]), "card": some("ab", "bc"), "anchor": some("pq"), "price": rng.choice([["9", None], None])}
    mine = [make(i) | {"sid": rng.choice([None, "", "k1", "k2"])} for i in range(60)]
    theirs = [make(i) | {"sids": rng.choice([None, [], ["k1", None], ["k2", ""]])} for i in range(100, 150)]
    cells = lambda r: (r["name"], [r["name"]], r["audience"], r["billing"], r["position"], r["card"], r["anchor"], r["price"])
    a = spark.createDataFrame([(r["block"], r["i"], r["sid"], *cells(r)) for r in mine], IDENTITY.format("candidate long, structured_id string")).drop("names")
    b = spark.createDataFrame([(r["block"], r["i"], r["sids"], *cells(r)) for r in theirs], IDENTITY.format("subject long, structured_ids array<string>")).drop("name")
    want = {}
    for x in mine:
        for y in theirs:
            if x["block"] is None or x["block"] != y["block"]:
                continue
            same = bool(x["sid"]) and x["sid"] in (y["sids"] or [])
            name = bool(x["name"]) and x["name"] == y["name"]
            score, met = 0.38 * name + 0.10 * (bool(x["audience"]) and x["audience"] == y["audience"]) + 0.12, name
            if x["position"] is not None and y["position"] is not None:
                score += 0.04 if x["position"] == y["position"] else 0.02
            for n, w in (("card", 0.24), ("anchor", 0.12), ("price", 0.16)):
                p, q = x[n] or [], y[n] or []
                both = len((set(p) & set(q)) - {None})
                met, score = met or both > 0, score + (w * both / (len(p) + len(q) - both) if both else 0)
            if same or met:
                want[x["i"], y["i"]] = 1.0 if same else min(1.0, score)
    return a, b, want


def test_identity_pairs_by_classes(spark, monkeypatch):
    a, b, want = _identities(spark, monkeypatch)
    scored = C.identity_scores(a, b, ["block"])
    got = {(r.candidate, r.subject): r.score for r in scored.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-9 for k, v in want.items())
    plan = scored._jdf.queryExecution().executedPlan().toString().split("Join")[0]
    assert "Exchange" not in plan and "Aggregate" not in plan  # no pair is shuffled


def test_identity_shortlist_decides_alike(spark, monkeypatch):
    a, b, want = _identities(spark, monkeypatch)
    few = C.identity_shortlist(a, b, ["block"])
    assert max(r["count"] for r in few.groupBy("candidate").count().collect()) <= 4
    rows = lambda df: {r.candidate: (r.subject, round(r.best, 9), r.status) for r in C.resolve_identity(df, 0.5, 0.05, a).collect()}
    every = spark.createDataFrame([(i, j, s) for (i, j), s in want.items()], "candidate long, subject long, score double")
    assert rows(few) == rows(every)
