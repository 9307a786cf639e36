"""Near-duplicate embeddings by range search on a robust-pruned flat graph."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, materialize, shared_path
from .kneser_ney import _folder


#: A large cluster is split by the sides of so many directions.
CELL_BITS = 12
#: Slices of the graph's arrays start at multiples of so many nodes, hence at pages of their own.
PAGE_NODES = 4096


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors, as doubles, of a list column whose rows have one length and aren't zero."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def _angle(cosine):
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def centroids(vectors: DataFrame, rows_each: int, most: int, sample: int, seed: int = 7) -> np.ndarray:
    """Spherical k-means on a sample of at most `sample` vectors: only where shards lie depends on it."""
    n = vectors.count()
    k = max(1, min(most, n // rows_each, sample // 8))
    share = min(1.0, 1.2 * sample / max(1, n))
    picked = vectors.where(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))).select("k", "v").limit(sample).toArrow()
    if not picked.num_rows:
        return np.zeros((0, 1))
    x = _matrix(picked.column("v").combine_chunks())
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(6):
        near = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.sqrt((total * total).sum(1, keepdims=True))
        c = np.where(norm > 0, total / np.maximum(norm, 1e-300), c)
    return c


def _nearest(shared, overlap: int):
    """The clusters of each vector: the nearest `overlap` centroids, one row for each; and its cell in
    the cluster: on which side of CELL_BITS fixed directions through the centroid it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        directions = np.random.default_rng(11).standard_normal((c.shape[1], CELL_BITS))
        for batch in batches:
            if not batch.num_rows:
                continue
            take = min(overlap, len(c))
            x = _matrix(batch.column("v"))
            near = np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :take].ravel().astype(np.int64)
            at = np.repeat(np.arange(batch.num_rows), take)
            side = (x @ directions)[at] > (c @ directions)[near]
            cell = side @ (1 << np.arange(CELL_BITS)[::-1])
            yield pa.RecordBatch.from_arrays([*(y.take(pa.array(at)) for y in batch.columns), pa.array(near), pa.array(cell.astype(np.int64))], names=[*batch.schema.names, "cluster", "cell"])

    return run


def _sharded(vectors: DataFrame, shared, overlap: int, rows_each: int, name: str) -> DataFrame:
    """Adds `shard` of about rows_each rows: a cluster; of a large one a range of cells, so that neighbours
    mostly stay together; and of what is still too large, such as many equal vectors, a salted part."""
    schema = T.StructType([*vectors.schema.fields, T.StructField("cluster", T.LongType()), T.StructField("cell", T.LongType())])
    placed = materialize(vectors.mapInArrow(_nearest(shared, overlap), schema), name)
    # One row for each cluster; their number is bounded.
    parts = placed.groupBy("cluster").agg(F.least(F.lit(1 << CELL_BITS), F.ceil(F.count("*") / rows_each)).cast("long").alias("_parts")).select(F.col("cluster").alias("_c"), "_parts")
    split = placed.join(F.broadcast(parts), F.col("cluster") == F.col("_c")).withColumn("shard", F.col("cluster") * (1 << CELL_BITS) + F.shiftright(F.col("cell") * F.col("_parts"), CELL_BITS))
    split = split.drop("_c", "_parts", "cluster", "cell")
    salts = materialize(split.groupBy("shard").agg(F.ceil(F.count("*") / (2 * rows_each)).cast("long").alias("_salts")).where("_salts > 1").select(F.col("shard").alias("_s"), "_salts"), f"{name}-salts")
    salted = split.join(salts, F.col("shard") == F.col("_s"), "left")
    return salted.withColumn("shard", F.col("shard") * 1_000_000 + F.pmod(F.xxhash64("k"), F.coalesce("_salts", F.lit(1)))).drop("_s", "_salts")


def _balls(radius: float):
    """Within a shard: centres, the densest first, and the vectors within `radius` of one."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        k = table.column("k").to_numpy()
        x = _matrix(table.column("v").combine_chunks())
        near = np.concatenate([x[i : i + 1024] @ x.T >= math.cos(radius) for i in range(0, len(x), 1024)])
        np.fill_diagonal(near, True)
        ball, free = np.full(len(k), -1), np.ones(len(k), bool)
        for i in np.lexsort((k, -near.sum(1))):
            if free[i]:
                members = near[i] & free
                ball[members], free[members] = i, False
        far = _angle((x * x[ball]).sum(1))
        far[ball == np.arange(len(k))] = 0.0
        return pa.table({"k": k, "ball": k[ball], "far": far})

    return run


def robust_prune(x: np.ndarray, degree: int, alpha: float, pool: int) -> list[np.ndarray]:
    """Out-neighbours of each vector: the nearest, then those nearer to it than, by alpha, to any kept."""
    n = len(x)
    pool = min(pool, n - 1)
    out: list[np.ndarray] = []
    for at in range(0, n, 512):
        s = x[at : at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -2
        if pool < 1:
            out += [np.zeros(0, np.int64)] * len(s)
            continue
        top = np.argpartition(-s, pool - 1, axis=1)[:, :pool]
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1), 1)
        for row, c in zip(s, top, strict=True):
            between = _angle(x[c] @ x[c].T) * alpha
            own = _angle(row[c])
            kept: list[int] = []
            alive = np.ones(len(c), bool)
            while alive.any() and len(kept) < degree:
                i = int(alive.argmax())
                kept.append(i)
                alive &= between[i] > own
                alive[i] = False
            out.append(c[kept])
    return out


def _graph(degree: int, alpha: float, pool: int):
    """Edges of a shard's graph, both ways, and its medoid (an edge to itself)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        k = table.column("k").to_numpy()
        x = _matrix(table.column("v").combine_chunks())
        lists = robust_prune(x, degree, alpha, pool)
        a = np.repeat(np.arange(len(k)), [len(v) for v in lists])
        b = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        medoid = int((x @ x.sum(0)).argmax())
        src, dst = np.concatenate([a, b, [medoid]]).astype(np.int64), np.concatenate([b, a, [medoid]]).astype(np.int64)
        return pa.table({"a": k[src], "b": k[dst]})

    return run


@dataclass
class Graph:
    """Arrays in the shared folder, sorted by node key: keys, vectors, radii, neighbours (place + 1; 0: none), medoids.

    Between the slices of different tasks keys repeat the last one, so the array stays sorted.
    """

    folder: str
    nodes: int
    dim: int
    width: int
    widest: float  # radius of the widest ball

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_") and k != "medoids"}

    def arrays(self):
        if not hasattr(self, "_arrays"):
            m = lambda name, dtype, shape: np.memmap(f"{self.folder}/{name}", dtype, "r", shape=shape)
            self._arrays = m("keys", "<i8", (self.nodes,)), m("vectors", "<f4", (self.nodes, self.dim)), m("radii", "<f4", (self.nodes,)), m("near", "<i8", (self.nodes, self.width))
            self.medoids = np.searchsorted(self._arrays[0], np.fromfile(f"{self.folder}/medoids", "<i8"))
            x = np.asarray(self._arrays[1][self.medoids])
            # Medoids in groups around every so-manieth of them: a query looks into the nearest groups only.
            self._heads = x[:: max(1, math.isqrt(len(x)))]
            group = np.concatenate([(x[i : i + 4096] @ self._heads.T).argmax(1) for i in range(0, len(x), 4096)])
            order = np.argsort(group, kind="stable")
            self.medoids, self._starts = self.medoids[order], x[order]
            self._groups = np.searchsorted(group[order], np.arange(len(self._heads) + 1))
        return self._arrays

    def entries(self, q: np.ndarray, starts: int, groups: int = 4) -> np.ndarray:
        """Places of the medoids from which each query starts."""
        if len(self.medoids) <= 1024:
            return self.medoids[np.argsort(-(q @ self._starts.T), axis=1, kind="stable")[:, :starts]]
        near = np.argpartition(-(q @ self._heads.T), groups - 1, axis=1)[:, :groups]
        out = np.empty((len(q), starts), np.int64)
        for i, g in enumerate(near):
            at = np.concatenate([np.arange(self._groups[j], self._groups[j + 1]) for j in g])
            best = at[np.argsort(-(self._starts[at] @ q[i]), kind="stable")[:starts]]
            out[i] = self.medoids[np.resize(best, starts)]
        return out

    def search(self, at: np.ndarray, limit: np.ndarray, width: int = 24, starts: int = 4, most_steps: int = 400) -> list[np.ndarray]:
        """Nodes within the angle `limit` of the nodes `at`.

        Best-first search of many queries in step, from the nearest medoids and the query's own
        node; while more than half of a query's beam is in range, the beam is widened and searched again.
        """
        _, vectors, _, near = self.arrays()
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(at)
        todo, floor = np.arange(len(at)), np.cos(np.minimum(limit, math.pi)).astype(np.float32)
        while len(todo):
            q = np.asarray(vectors[at[todo]])
            ids = np.concatenate([at[todo][:, None], self.entries(q, starts)], axis=1)
            cap = min(width, self.nodes + starts + 1)
            beam = np.full((len(todo), max(cap, ids.shape[1])), -1, np.int64)
            beam[:, : ids.shape[1]] = ids
            score = np.full(beam.shape, -2, np.float32)
            score[:, : ids.shape[1]] = np.einsum("qd,qnd->qn", q, vectors[ids])
            done = beam < 0
            beam, score, done = _best(beam, score, done, beam.shape[1])
            for _ in range(most_steps * max(1, width // 24)):
                open_ = ~done & (beam >= 0)
                rows = np.flatnonzero(open_.any(1))
                if not len(rows):
                    break
                pick = open_[rows].argmax(1)  # the best not yet expanded
                done[rows, pick] = True
                fresh = near[beam[rows, pick]] - 1
                s = np.einsum("qd,qnd->qn", q[rows], vectors[np.maximum(fresh, 0)])
                s[fresh < 0] = -2
                beam[rows], score[rows], done[rows] = _best(np.concatenate([beam[rows], fresh], 1), np.concatenate([score[rows], s], 1), np.concatenate([done[rows], fresh < 0], 1), beam.shape[1])
            found = (score >= floor[todo][:, None]) & (beam >= 0)
            wide = (found.sum(1) * 2 > beam.shape[1]) & (beam.shape[1] < self.nodes)
            for i in np.flatnonzero(~wide):
                out[todo[i]] = beam[i][found[i]]
            todo, width = todo[wide], width * 4
        return out


def _best(ids: np.ndarray, score: np.ndarray, done: np.ndarray, size: int):
    """The best `size` different nodes of each row, the best first; a node is done if it was."""
    order = np.lexsort((~done, ids), axis=1)  # copies stand together, the expanded one first
    ids, score, done = (np.take_along_axis(x, order, 1) for x in (ids, score, done))
    again = np.zeros(ids.shape, bool)
    again[:, 1:] = ids[:, 1:] == ids[:, :-1]
    score = np.where(again | (ids < 0), np.float32(-2), score)
    ids = np.where(again, -1, ids)
    order = np.argsort(-score, axis=1, kind="stable")[:, :size]
    return tuple(np.take_along_axis(x, order, 1) for x in (ids, score, done))


def _put(folder: str, name: str, row: int, values: np.ndarray) -> None:
    """Writes rows of an array in place; a retried task writes the same bytes again."""
    with open(f"{folder}/{name}", "r+b") as f:
        f.seek(row * values.dtype.itemsize * (values[0].size if len(values) else 1))
        f.write(np.ascontiguousarray(values).tobytes())


def _write_slices(folder: str, base: dict[int, int], room: dict[int, int]):
    """Writes a range's slice of the arrays; slices start at pages of their own."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        part = int(key[0].as_py())
        order = np.argsort(table.column("k").to_numpy(), kind="stable")
        k = table.column("k").to_numpy()[order]
        _put(folder, "keys", base[part], np.concatenate([k, np.full(room[part] - len(k), k[-1])]).astype("<i8"))
        _put(folder, "vectors", base[part], _matrix(table.column("v").combine_chunks())[order].astype("<f4"))
        _put(folder, "radii", base[part], table.column("far").to_numpy()[order].astype("<f4"))
        return pa.table({"part": pa.array([part], pa.int32())})

    return run


def _write_near(folder: str, base: dict[int, int], room: dict[int, int], width: int, nodes: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        part = int(key[0].as_py())
        keys = np.memmap(f"{folder}/keys", "<i8", "r", shape=(nodes,))
        out = np.zeros((room[part], width), "<i8")
        for a, near in zip(table.column("a").to_pylist(), table.column("near").to_pylist(), strict=True):
            out[np.searchsorted(keys, a) - base[part], : min(width, len(near))] = np.searchsorted(keys, np.array(sorted(near)[:width], np.int64)) + 1
        _put(folder, "near", base[part], out)
        return pa.table({"part": pa.array([part], pa.int32())})

    return run


def build_graph(centres: DataFrame, shared, rows_each: int, degree: int, alpha: float, overlap: int) -> Graph:
    """The union of the graphs of overlapping shards, as arrays that workers map."""
    spark = centres.sparkSession
    shards = _sharded(centres.select("k", "v"), shared, overlap, rows_each, "graph-shards")
    edges = materialize(shards.groupBy("shard").applyInArrow(_graph(degree, alpha, 4 * degree), "a long, b long").distinct(), "graph-edges")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(centres.select("k", "v", "far").repartitionByRange(n, "k").withColumn("_part", F.spark_partition_id()), "graph-nodes")
    parts = ranged.groupBy("_part").agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("far").alias("far"), F.max(F.size("v")).alias("dim")).orderBy("low").collect()
    nodes, base, room = 0, {}, {}
    for r in parts:
        base[r["_part"]], room[r["_part"]] = nodes, -(-r["n"] // PAGE_NODES) * PAGE_NODES if r is not parts[-1] else r["n"]
        nodes += room[r["_part"]]
    dim, width = parts[0]["dim"], degree * (overlap + 1)
    folder = _folder(shared_path(spark, "graph"))
    os.makedirs(folder)
    for name, size in (("keys", 8), ("vectors", 4 * dim), ("radii", 4), ("near", 8 * width)):
        with open(f"{folder}/{name}", "wb") as f:
            f.truncate(nodes * size)
    ranged.groupBy("_part").applyInArrow(_write_slices(folder, base, room), "part int").collect()
    # A node that many others point at keeps the links that a hash picks, so no list outgrows `width`.
    lows = spark.createDataFrame([(r["_part"], r["low"]) for r in parts], "_p int, _low long")
    spans = lows.withColumn("_next", F.lead("_low").over(Window.orderBy("_low")))
    links = edges.where("a <> b").withColumn("_h", F.xxhash64("a", "b"))
    lists = links.groupBy("a").agg(F.slice(F.array_sort(F.collect_list(F.struct("_h", "b"))), 1, width).alias("_l")).select("a", F.col("_l.b").alias("near"))
    placed = lists.join(F.broadcast(spans), (F.col("a") >= F.col("_low")) & (F.col("_next").isNull() | (F.col("a") < F.col("_next"))))
    placed.select("_p", "a", "near").groupBy("_p").applyInArrow(_write_near(folder, base, room, width, nodes), "part int").collect()
    # One key for each shard: 8 bytes for about rows_each / overlap vectors.
    medoids = edges.where("a = b").select("a").distinct().toArrow().column("a").to_numpy()
    np.sort(medoids).astype("<i8").tofile(f"{folder}/medoids")
    return Graph(folder, nodes, dim, width, max(r["far"] for r in parts))


def _find(shared, theta: float, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        keys, _, radii, _ = graph.arrays()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                k = batch.column("k").slice(i, 256).to_numpy()
                at = np.searchsorted(keys, k)
                found = graph.search(at, theta + radii[at] + graph.widest + 1e-3, width)
                a = np.repeat(k, [len(f) for f in found])
                b = keys[np.concatenate(found)] if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[a != b]), pa.array(np.maximum(a, b)[a != b])], names=["a", "b"])

    return run


def _pack_block(key: tuple, table: pa.Table) -> pa.Table:
    x = _matrix(table.column("v").combine_chunks())
    return pa.table({"ball": pa.array([key[0].as_py()]), "ids": pa.array([table.column("k").to_numpy().astype("<i8").tobytes()], pa.binary()), "vectors": pa.array([x.tobytes()], pa.binary())})


def _count_blocks(cosine: float):
    """Per vector of two blocks, how many of the other block it links with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ka, kb = (np.frombuffer(row[c], "<i8") for c in ("ids_a", "ids_b"))
                x, y = (np.frombuffer(row[c]).reshape(len(k), -1) for c, k in (("vec_a", ka), ("vec_b", kb)))
                s = x @ y.T >= cosine
                n = np.concatenate([s.sum(1), s.sum(0)])
                k = np.concatenate([ka, kb])
                met = n > 0
                m = int(met.sum())
                yield pa.RecordBatch.from_arrays([pa.array(k[met]), pa.array(n[met].astype(np.int64)), pa.array([row["a"]] * m, pa.int64()), pa.array([row["b"]] * m, pa.int64())], names=["k", "n", "a", "b"])

    return run


def _brute(shared, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, x = shared.value
        n = np.zeros(len(k), np.int64)
        for batch in batches:
            if batch.num_rows:
                n += (x @ _matrix(batch.column("v")).T >= cosine).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], names=["k", "n"])

    return run


def near_duplicates(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, radius: float = 0.15, rows_each: int = 1500, degree: int = 16, alpha: float = 1.2, overlap: int = 3, audit: int = 256, least_recall: float = 0.95) -> DataFrame:
    """Links vectors with a cosine of at least `cosine`, in double precision.

    1. Clusters come from k-means on a bounded sample; a cluster with too many rows is split by
       direction, and what is still too large, such as many equal vectors, by a hash.
    2. In each shard, vectors within `radius` of a dense centre form a ball.  Twice the radius is less
       than the angle of `cosine`, so a ball's vectors all link with each other without being
       compared, and a hot group is a few balls.
    3. Centres get a flat graph: on overlapping shards each is linked to robust-pruned neighbours, the
       lists of all shards are united.  Workers map the arrays from the shared folder.
    4. From the medoids and its own node, each centre searches the graph; the beam widens as long as its range
       isn't exhausted.
    5. Pairs of balls whose angle and radii settle it are counted whole; the others are verified
       in blocks of vectors.  Only counts leave a block.
    6. Audit: `audit` vectors picked by hash, and as many of those with links found so far, are compared with
       all vectors; below `least_recall` the search is repeated with a wider beam, then on a graph with
       more neighbours and overlap.  If recall stays below 0.9, an error is raised: no such result is returned.

    Returns id, n_links, component_id, kept, recall for each input row; recall is null, not 1, when no audited
    vector has a link.  Vectors that are
    null, zero, of another length than most, or hold null or non-finite components link with nothing.
    Rows that repeat an id are vectors of their own; a null id is never a component's smallest unless
    there is no other.  An empty input gives no rows.
    """
    theta = math.acos(cosine)
    if 2 * radius >= theta:
        raise ValueError("twice the radius must be less than the angle of the cosine")
    spark = embeddings.sparkSession
    v = F.col(vector_col).cast("array<double>")
    rows = materialize(embeddings.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).withColumn("k", F.monotonically_increasing_id()), "vectors")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    sizes = rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    good = rows.where(F.col("v").isNotNull() & (F.size("v") == (sizes["d"] if sizes else 0)) & finite)
    good = materialize(good, "valid")
    c = centroids(good, rows_each, 4096, 40_000)
    none = rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"), F.lit(None).cast("double").alias("recall"))
    if not len(c):
        return none
    shared = spark.sparkContext.broadcast(c)  # at most 4096 centroids

    shards = _sharded(good.select("k", "v"), shared, 1, 2 * rows_each, "ball-shards")
    balls = materialize(shards.groupBy("shard").applyInArrow(_balls(radius), "k long, ball long, far double"), "balls")
    members = materialize(good.join(balls, "k").select("k", "id", "v", "ball", "far"), "members")
    size = materialize(members.groupBy("ball").agg(F.count("*").alias("size"), F.max("far").alias("far")), "ball-sizes")
    centres = materialize(members.where("k = ball").select("k", "v").join(size.select(F.col("ball").alias("_b"), "far"), F.col("k") == F.col("_b")).drop("_b"), "centres")
    graph_b = spark.sparkContext.broadcast(build_graph(centres, shared, rows_each, degree, alpha, overlap))  # paths only

    parts = F.ceil(F.col("size") / 128).cast("long")
    blocked = members.join(size.select(F.col("ball").alias("_b"), "size"), F.col("ball") == F.col("_b")).withColumn("block", F.pmod(F.xxhash64("k"), parts))
    blocks = materialize(blocked.select("ball", "block", "k", "v").groupBy("ball", "block").applyInArrow(_pack_block, "ball long, ids binary, vectors binary"), "blocks")

    def truth_of(picked: DataFrame) -> dict[int, int]:
        """The true number of links of at most `audit` stated vectors, by comparison with all rows."""
        chosen = picked.select("k", "v").toArrow()
        asked = spark.sparkContext.broadcast((chosen.column("k").to_numpy(), _matrix(chosen.column("v").combine_chunks()))) if chosen.num_rows else None
        if asked is None:
            return {}
        return {r["k"]: r["n"] for r in good.select("v").mapInArrow(_brute(asked, cosine), "k long, n long").groupBy("k").agg((F.sum("n") - 1).alias("n")).collect()}

    truth = truth_of(good.withColumn("_h", F.xxhash64("k")).orderBy("_h").limit(audit))
    linked = False
    attempts = [(24, 1), (96, 1), (384, 1), (384, 2), (1536, 3)]
    for attempt, (width, more_edges) in enumerate(attempts):
        if attempt and more_edges > attempts[attempt - 1][1]:
            graph_b = spark.sparkContext.broadcast(build_graph(centres, shared, rows_each, degree * more_edges, alpha, overlap + more_edges))
        pairs = centres.select("k").mapInArrow(_find(graph_b, theta, width), "a long, b long").distinct()
        info = centres.select(F.col("k").alias("_k"), F.col("far"), F.col("v"))
        left = pairs.join(info.select(F.col("_k").alias("_ka"), F.col("far").alias("ra"), F.col("v").alias("va")), F.col("a") == F.col("_ka"))
        both = left.join(info.select(F.col("_k").alias("_kb"), F.col("far").alias("rb"), F.col("v").alias("vb")), F.col("b") == F.col("_kb"))
        dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, t: s + t)
        angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot("va", "vb") / F.sqrt(dot("va", "va")) / F.sqrt(dot("vb", "vb")))))
        measured = materialize(both.select("a", "b", (angle + F.col("ra") + F.col("rb")).alias("most"), (angle - F.col("ra") - F.col("rb")).alias("least")), "ball-pairs")
        whole = measured.where(F.col("most") <= theta - 1e-6).select("a", "b")
        open_ = measured.where((F.col("most") > theta - 1e-6) & (F.col("least") <= theta + 1e-6)).select("a", "b")
        one = open_.join(blocks.select(F.col("ball").alias("_ba"), F.col("ids").alias("ids_a"), F.col("vectors").alias("vec_a")), F.col("a") == F.col("_ba"))
        two = one.join(blocks.select(F.col("ball").alias("_bb"), F.col("ids").alias("ids_b"), F.col("vectors").alias("vec_b")), F.col("b") == F.col("_bb"))
        checked = materialize(two.select("a", "b", "ids_a", "vec_a", "ids_b", "vec_b").mapInArrow(_count_blocks(cosine), "k long, n long, a long, b long"), "checked")
        single = checked.groupBy("k").agg(F.sum("n").alias("n_single"))
        ends = whole.select("a", F.col("b").alias("o")).union(whole.select("b", F.col("a").alias("o")))
        more = ends.join(size.select(F.col("ball").alias("_o"), "size"), F.col("o") == F.col("_o")).groupBy(F.col("a").alias("_more")).agg(F.sum("size").alias("n_whole"))
        links = materialize(whole.union(checked.select("a", "b").distinct()), "ball-links")
        per_ball = size.join(more, F.col("ball") == F.col("_more"), "left").select(F.col("ball").alias("_b"), (F.col("size") - 1 + F.coalesce("n_whole", F.lit(0))).alias("n_ball"))
        per_ball = materialize(per_ball, "ball-counts")
        counted = members.select("k", "id", "ball").join(per_ball, F.col("ball") == F.col("_b")).select("k", "id", "ball", "n_ball")
        single = materialize(single.select(F.col("k").alias("_s"), "n_single"), "single-counts")
        counted = materialize(counted.join(single, F.col("k") == F.col("_s"), "left").select("k", "id", "ball", (F.col("n_ball") + F.coalesce("n_single", F.lit(0))).alias("n_links")), "counts")
        if not linked:  # random vectors may have no link at all: audit some that are known to have
            some = counted.where("n_links > 0").select(F.col("k").alias("_lk")).withColumn("_h", F.xxhash64("_lk", F.lit(1))).orderBy("_h").limit(audit)
            truth |= truth_of(good.join(F.broadcast(some), F.col("k") == F.col("_lk")))
            linked = True
        found = {r["k"]: r["n_links"] for r in counted.where(F.col("k").isin(list(map(int, truth)))).select("k", "n_links").collect()}  # at most 2 * audit rows
        shares = [min(found[x], n) / n for x, n in truth.items() if n]
        recall = sum(shares) / len(shares) if shares else None
        if recall is None or recall >= least_recall:
            break
    if recall is not None and recall < 0.9:
        raise RuntimeError(f"recall of near duplicates stays at {recall:.3f}; raise degree, overlap or the beam")

    label = components(links)
    named = size.select("ball").join(label, F.col("ball") == F.col("node"), "left").select("ball", F.coalesce("component", "ball").alias("group"))
    named = materialize(named.select(F.col("ball").alias("_nb"), "group"), "ball-groups")
    grouped = materialize(counted.join(named, F.col("ball") == F.col("_nb")).select("k", "id", "n_links", "group"), "grouped")
    smallest = materialize(grouped.groupBy("group").agg(F.min("id").alias("component_id")).select(F.col("group").alias("_g"), "component_id"), "smallest")
    out = grouped.join(smallest, F.col("group") == F.col("_g")).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"), F.lit(recall).cast("double").alias("recall"))
    rest = rows.join(good.select(F.col("k").alias("_gk")), F.col("k") == F.col("_gk"), "left_anti")
    return out.unionByName(rest.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"), F.lit(recall).cast("double").alias("recall")))
