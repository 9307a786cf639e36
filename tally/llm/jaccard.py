"""Exact Jaccard join of word shingles by a partition of the shingle universe."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import among, bit_array, bit_arrays, bits_for, components, materialize, near_labels, test_bits
from .tokens import mix, shingle_sets, slices

#: Filters in Python tasks hold at most 2**27 bits (16 MB); a filter that is full only costs time.
MOST_BITS = 27
#: At 3/4, linked sets of a and b elements differ in at most (a + b) / 7 elements.
SEVENTH = 7
#: 64-bit words of a set's parity sketch.
SKETCH = 16
STEP = np.uint64(0xD6E8FEB86659FD93)


class Bands:
    """Size bands [low, high) and how many segments the universe has in each.

    Segments are finer for small sets, where they are cheap; `flex` segments of a band also
    have their one-deletion neighbourhoods indexed.
    """

    def __init__(self, ratio: float = 1.5, most: int = 1 << 40):
        self.low = [1]
        while self.low[-1] < most:
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * ratio)))

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.low, n, "right")) - 1

    def segments(self, band: int) -> int:
        top = self.low[band + 1]
        return max(1, int(np.ceil(top * (1.5 if top <= 64 else 0.7 if top <= 300 else 0.38))))

    def flex(self, band: int) -> int:
        m = self.segments(band)
        return m if self.low[band + 1] <= 64 else min(m, 6)

    def targets(self, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Where sets of n elements look for sets not larger: which of them, in which band, and how
        many elements may differ there; first in their own bands, then in those below."""
        low = np.array(self.low)
        which = np.flatnonzero(n > 0)
        band = np.searchsorted(low, n[which], "right") - 1
        most = 2 * n[which] // SEVENTH
        while len(which):
            yield which, band, most
            more = (band > 0) & (4 * (low[band] - 1) >= 3 * n[which])
            which, band = which[more], band[more]
            most = (n[which] + low[band] - 1) // SEVENTH
            band = band - 1


class Segments:
    """The non-empty segments of some sets in given bands, one set after another.

    A segment's hash is a sum over its elements, so that of a one-deletion neighbour is a
    difference.  `of` names the set of each segment, `flexible` the segments with a neighbourhood.
    """

    def __init__(self, u: np.ndarray, n: np.ndarray, band: np.ndarray, bands: Bands):
        m = np.array([bands.segments(b) for b in range(int(band.max(initial=0)) + 1)], np.uint64)[band]
        flex = np.array([bands.flex(b) for b in range(int(band.max(initial=0)) + 1)])[band]
        at = np.repeat(np.arange(len(n)), n)
        segment = ((u >> np.uint64(32)) * m[at]) >> np.uint64(32)  # ascends with u
        new = np.ones(len(u), bool)
        new[1:] = (segment[1:] != segment[:-1]) | (at[1:] != at[:-1])
        self.first = np.flatnonzero(new)
        self.of, self.u, self.sets = at[self.first], u, len(n)
        self.ids, self.band = segment[self.first], band[self.of].astype(np.uint64)
        self.size = np.diff(np.append(self.first, len(u)))
        self.flexible = np.flatnonzero((self.ids < flex[self.of].astype(np.uint64)) & (self.size > 1))
        self.count = np.bincount(self.of, minlength=self.sets)

    def reach(self) -> np.ndarray:
        """How many differing elements each set's segments and neighbourhoods stand for."""
        return self.count + np.bincount(self.of[self.flexible], minlength=self.sets)

    def signatures(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the segments, those of the neighbourhoods, and the sets of the latter."""
        parts = mix(self.u)
        sums = np.add.reduceat(parts, self.first) if len(self.first) else parts
        tag = mix(self.ids + self.band * STEP)
        size = self.size[self.flexible]
        of = np.repeat(self.flexible, size)
        at = self.first[of] + np.arange(len(of)) - np.repeat(size.cumsum() - size, size)
        return mix(sums ^ tag), mix((sums[of] - parts[at]) ^ tag[of]), self.of[of]


def _chosen(u: np.ndarray, n: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets named by `which` (ascending), one after another, and their sizes."""
    if len(which) == len(n):
        return u, n
    take = np.zeros(len(n), bool)
    take[which] = True
    return u[np.repeat(take, n)], n[which]


def set_keys(u: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set of hashes; of an empty one, zeros."""
    out = np.zeros((2, len(n)), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        begin = (n.cumsum() - n)[some]
        out[0, some], out[1, some] = np.add.reduceat(mix(u), begin), np.add.reduceat(mix(u ^ STEP), begin)
    return out[0].view(np.int64), out[1].view(np.int64)


def sketches(u: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Parities of the number of elements in each of 64 * SKETCH classes, a row for each set.

    Two sets' sketches differ in at most as many bits as the sets differ in elements.
    """
    bits = 64 * SKETCH
    at = np.repeat(np.arange(len(n)), n) * bits + (u % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(at, minlength=len(n) * bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).reshape(-1, SKETCH)


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in slices(batches, "_text"):
        yield batch, *shingle_sets(batch.column("_text"), k)


def _describe(k: int, bands: Bands):
    """Size, key and sketch of each text's set, and whether its segments fall short of the pigeonhole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, u, n in _sets(batches, k):
            hard = np.zeros(len(n), bool)
            for which, band, most in bands.targets(n):
                hard[which] |= Segments(*_chosen(u, n, which), band, bands).reach() <= most
            lo, hi = (pa.array(x, mask=n == 0) for x in set_keys(u, n))
            sketch = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * SKETCH, pa.int32()), pa.array(sketches(u, n).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(n.astype(np.int64)), lo, hi, pa.array(hard), sketch], names=["_id", "n", "lo", "hi", "hard", "sketch"])

    return run


def _rep_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lo, ids = (np.ascontiguousarray(b.column(c).to_numpy().astype(np.int64)).view(np.uint64) for c in ("lo", "rep"))
        yield pa.RecordBatch.from_arrays([pa.array(mix(lo ^ mix(ids)).view(np.int64))], names=["h"])


def _representatives(batches, k: int, table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, elements, sizes) of the sets of texts that may stand for all texts with their set."""
    for batch, u, n in _sets(batches, k):
        ids = batch.column("_id").to_numpy().astype(np.int64)
        key = mix(set_keys(u, n)[0].view(np.uint64) ^ mix(ids.view(np.uint64)))
        which = np.flatnonzero((n > 0) & test_bits(table, key))
        if len(which):
            yield ids[which], *_chosen(u, n, which)


def _emit_signatures(k: int, bands: Bands, reps):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, u, n in _representatives(batches, k, reps.value):
            held = []
            for j, (which, band, most) in enumerate(bands.targets(n)):
                part = Segments(*_chosen(u, n, which), band, bands)
                base, near, owner = part.signatures()
                # Whatever _emit_entries may offer or ask with is counted.
                held += [base, near if not j else near[(part.count <= most)[owner]]]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held).view(np.int64))], names=["sig"])

    return run


def _emit_entries(k: int, bands: Bands, reps, levels):
    """(signature, id, whether the id asks with it) for signatures that two sets or more may share.

    Cost-based allocation: of its non-empty segments a set needs one more than may differ; it
    leaves out those that the most sets share (levels: filters of ever more frequent signatures).
    Where its segments don't suffice, flex segments ask with their neighbourhoods as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [x.value for x in levels]
        for ids, u, n in _representatives(batches, k, reps.value):
            sig, of, asks = [], [], []
            for j, (which, band, most) in enumerate(bands.targets(n)):
                part = Segments(*_chosen(u, n, which), band, bands)
                base, near, owner = part.signatures()
                cost, left = np.zeros(len(base), np.uint64), np.arange(len(base))
                for t in tables:
                    left = left[test_bits(t, base[left])]
                    cost[left] += np.uint64(1)
                spare = np.maximum(0, part.count - (most + 1))
                dear = (cost << np.uint64(56)) | (base >> np.uint64(8))
                ask = np.ones(len(base), bool)
                begin = part.count.cumsum() - part.count
                for i in np.flatnonzero(spare):
                    a, b = begin[i], begin[i] + part.count[i]
                    ask[a + np.argpartition(dear[a:b], part.count[i] - spare[i])[part.count[i] - spare[i] :]] = False
                shared = cost > 0
                short = part.count <= most
                if j:  # smaller sets are only asked for, never offered
                    shared &= ask
                    mine = short[owner]
                    near, owner = near[mine], owner[mine]
                seen = test_bits(tables[0], near)
                sig += [base[shared], near[seen]]
                asks += [ask[shared], short[owner[seen]]]
                of += [which[part.of[shared]], which[owner[seen]]]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sig).view(np.int64)), pa.array(ids[np.concatenate(of)]), pa.array(np.concatenate(asks))], names=["sig", "id", "ask"])

    return run


def _levels(counts: DataFrame, most: int) -> list:
    """Filters of ever more frequent signatures of a written table (sig, c)."""
    n = counts.count()
    return bit_arrays(counts, "sig", [(F.col("c") >= least, bits_for(max(1, n // least * 2), most)) for least in (2, 4, 8, 16, 32, 128, 512)])


def _linked(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both)


def _verify(k: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(slices([batch], "ta"), "tb"):
                (u, n), (v, m) = (shingle_sets(part.column(c), k) for c in ("ta", "tb"))
                i, j = np.append(0, n.cumsum()).tolist(), np.append(0, m.cumsum()).tolist()
                ok = [_linked(u[i[r] : i[r + 1]], v[j[r] : j[r + 1]], threshold) for r in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    return run


def _against(k: int, threshold: int, block):
    """Links between a stated block of sets and all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = block.value
        for batch, u, n in _sets(batches, k):
            ids, ends = batch.column("_id").to_pylist(), n.cumsum().tolist()
            found = [(i, j) for i, e, size in zip(ids, ends, n.tolist(), strict=True) for j, v in asked if i != j and _linked(u[e - size : e], v, threshold)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

    return run


def _may_link(x: str, y: str) -> Column:
    """Whether two sets can link, by their sizes and sketches: columns {x}n, {x}sketch, {y}n, {y}sketch.

    Sets of a and b elements that link differ in at most (a + b) / 7, and so do their sketches.
    """
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    apart = reduce(add, [F.bit_count(F.col(f"{x}sketch")[i].bitwiseXOR(F.col(f"{y}sketch")[i])) for i in range(SKETCH)])
    return (4 * n >= 3 * m) & (4 * m >= 3 * n) & (SEVENTH * apart <= n + m)


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, rounds: int = 1) -> DataFrame:
    """Links texts whose k-word shingle sets have a Jaccard similarity of at least 0.75, exactly.

    1. Texts with equal sets are one class; only its smallest id goes on.
    2. In its size band a set's elements are hashed into segments.  Linked sets of a and b elements
       differ in at most (a + b) / 7, so by the pigeonhole a set with more non-empty segments
       than that has one in common with every partner; where segments fall short, one-deletion
       neighbourhoods of the flex segments make up for it.  Sets ask in their own band and, if
       partners may be smaller, in the bands below.  The few sets for which even that falls
       short (the hard ones) are compared with all rows, in blocks.
    3. Signatures are counted; those of one set alone are dropped.  Each set then leaves out its most
       frequent segments as far as the pigeonhole allows (cost-based allocation).
    4. Sets that share a signature are not paired with each other but with the smallest id that
       shares it (the pivot).  Links join components; only sets that share a signature with
       another component go on (between rounds, components are told from links at most four steps long).
       After `rounds` rounds the sets still open are compared within their signatures, across components only.  Every pair is first compared by size and by a
       parity sketch of 1,024 bits, which never loses a link, inside the join; what passes is verified on whole
       texts.  So groups of many copies cost one verification a member, and no link
       between components is lost.

    Returns id, n_shingles, component_id for each input row.  Texts are lower-cased (A-Z) and split at ASCII
    white space; fewer than k words are one shingle; null, empty and blank texts have an empty set, link with nothing and
    are their own component.  Rows that repeat an id are one document, linked if any of their
    texts is.  Rows without an id get their size and no component.
    """
    spark = docs.sparkSession
    bands, threshold = Bands(), 75
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    known = rows.where("_id IS NOT NULL")
    described = materialize(rows.mapInArrow(_describe(k, bands), "_id long, n long, lo long, hi long, hard boolean, sketch array<long>"), "sets")
    classes = described.where("n > 0 AND _id IS NOT NULL").groupBy("lo", "hi")
    classes = materialize(classes.agg(F.min("_id").alias("rep"), F.max("hard").alias("hard"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    log2_bits = bits_for(classes.count(), MOST_BITS)
    reps = bit_array(classes.mapInArrow(_rep_keys, "h long"), "h", log2_bits)

    counts = known.mapInArrow(_emit_signatures(k, bands, reps), "sig long").groupBy("sig").agg(F.count("*").alias("c")).where("c > 1")
    counts = materialize(counts, "signatures")
    levels = _levels(counts, MOST_BITS - 1)
    entries = materialize(known.mapInArrow(_emit_entries(k, bands, reps, levels), "sig long, id long, ask boolean"), "entries")
    groups = entries.groupBy("sig").agg(F.min("id").alias("pivot"), F.max("id").alias("last"), F.max("ask").alias("ask"))
    groups = materialize(groups.where("ask AND pivot < last").select(F.col("sig").alias("gsig"), "pivot"), "groups")
    members = materialize(entries.join(groups, F.col("sig") == F.col("gsig")).groupBy("sig", "id", "pivot").agg(F.max("ask").alias("ask")), "members")

    def side(prefix: str) -> DataFrame:
        return classes.select(*[F.col(c).alias(f"{prefix}{c}") for c in ("rep", "n", "sketch")])

    def likely(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sizes and sketches allow a link."""
        half = pairs.join(side("x_"), F.col("a") == F.col("x_rep")).select("a", "b", "x_n", "x_sketch")
        return half.join(side("y_"), (F.col("b") == F.col("y_rep")) & _may_link("x_", "y_")).select("a", "b")  # no distinct: Spark could not split a hot pivot

    def verified(pairs: DataFrame) -> DataFrame:
        """pairs (a, b) -> (a, b, ok), by the whole texts of both."""
        involved = materialize(pairs.select(F.col("a").alias("v")).union(pairs.select("b")).distinct(), "involved")
        texts = materialize(among(known, "_id", involved), "texts")
        both = pairs.join(texts.select(F.col("_id").alias("_a"), F.col("_text").alias("ta")), F.col("a") == F.col("_a"))
        both = both.select("a", "b", "ta").join(texts.select(F.col("_id").alias("_b"), F.col("_text").alias("tb")), F.col("b") == F.col("_b"))
        return materialize(both.select("a", "b", "ta", "tb").mapInArrow(_verify(k, threshold), "a long, b long, ok boolean"), "verified")

    def across(members: DataFrame) -> DataFrame:
        """Pairs of sets in different components that share an asked signature and may link."""
        full = materialize(members.join(side(""), F.col("id") == F.col("rep")).select("sig", "id", "ask", "c", "n", "sketch"), "sketched")
        x, y = (full.select(*[F.col(c).alias(p + c) for c in full.columns]) for p in ("x_", "y_"))
        pairs = x.join(y, (F.col("x_sig") == F.col("y_sig")) & F.expr("x_id > y_id AND x_c <> y_c AND (x_ask OR y_ask)") & _may_link("x_", "y_"))
        return pairs.select(F.col("x_id").alias("a"), F.col("y_id").alias("b")).distinct()

    edges = _repeated(described, classes)
    hard = classes.where("hard")
    if hard.count():
        edges = edges.unionByName(_hard_links(known, hard, k, threshold))
    for turn in range(rounds + 1):
        if turn == 0 and rounds:  # each set and the smallest of its pivots
            pairs = likely(members.where("id > pivot").groupBy(F.col("id").alias("a")).agg(F.min("pivot").alias("b")))
        else:
            label = near_labels(edges)
            named = members.select("sig", "id", "pivot", "ask").join(label, F.col("id") == F.col("node"), "left")
            named = materialize(named.select("sig", "id", "pivot", "ask", F.coalesce("component", "id").alias("c")), "named")
            mixed = named.groupBy("sig").agg(F.min("c").alias("_lo"), F.max("c").alias("_hi")).where("_lo < _hi").select(F.col("sig").alias("msig"))
            members = named.join(mixed, F.col("sig") == F.col("msig"), "left_semi")
            if turn < rounds:
                members = materialize(members, "open")
            if turn < rounds:
                home = members.where("id = pivot").select(F.col("sig").alias("hsig"), F.col("c").alias("hc"))
                pairs = members.where("id > pivot").join(home, F.col("sig") == F.col("hsig")).where("c <> hc")
                pairs = likely(pairs.select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct())
            else:
                pairs = across(members)
        done = verified(materialize(pairs, "pairs"))
        edges = materialize(edges.unionByName(done.where("ok").select("a", "b")).distinct(), "links")

    label = materialize(components(edges), "labels")
    row = described.select(F.col("_id"), "n", F.coalesce("lo", F.xxhash64("_id")).alias("lo"), "hi")
    named = row.join(classes.select(F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "rep"), (F.col("lo") == F.col("_lo")) & (F.col("hi") == F.col("_hi")), "left")
    named = materialize(named.select("_id", "n", F.coalesce("rep", "_id").alias("rep")), "representatives")
    out = named.join(label, F.col("rep") == F.col("node"), "left")
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("_id").isNotNull(), F.least(F.coalesce("component", "rep"), "_id")).alias("component_id"))


def _repeated(described: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of a document whose rows have different texts."""
    several = described.where("_id IS NOT NULL AND n > 0").groupBy("_id").agg(F.count("*").alias("_c")).where("_c > 1").select("_id")
    rows = described.join(several, "_id", "left_semi").select("_id", "lo", "hi").distinct().join(classes.select("lo", "hi", "rep"), ["lo", "hi"])
    return rows.where("_id <> rep").select(F.col("_id").alias("a"), F.col("rep").alias("b"))


def _hard_links(known: DataFrame, hard: DataFrame, k: int, threshold: int, block: int = 500) -> DataFrame:
    """Links of the hard sets, found against all rows; a block of at most `block` sets is broadcast at
    a time, and hard sets are small or next to impossible."""
    spark = known.sparkSession
    texts = known.join(hard.select(F.col("rep").alias("_rep")), F.col("_id") == F.col("_rep"), "left_semi")
    out, held = None, []

    def links() -> DataFrame:
        shared = spark.sparkContext.broadcast(list(held))
        return materialize(known.mapInArrow(_against(k, threshold, shared), "a long, b long"), "hard-links")

    for r in texts.toLocalIterator():
        held.append((r["_id"], shingle_sets(pa.array([r["_text"]], pa.string()), k)[0]))
        if len(held) == block:
            out, held = (links() if out is None else out.unionByName(links())), []
    if held:
        out = links() if out is None else out.unionByName(links())
    return out if out is not None else spark.createDataFrame([], "a long, b long")
