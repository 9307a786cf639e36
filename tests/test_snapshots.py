"""Artifacts, bundles, capture plans, and the sink that stores objects by their content."""

import glob
import hashlib
import json
import os
import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tally.operators import snapshots as S
from tally.plans.batches import written
from tally.sources import objects as OB


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_parts(spark):
    rows = [(1, "<p>r</p>", True, "<p>o</p>"), (2, "<p>r</p>", True, None), (3, "<p>o</p>", False, "<p>x</p>"), (4, None, None, None)]
    df = spark.createDataFrame(rows, "id int, html string, rendered boolean, original string")
    parts = df.select("id", F.explode(S.parts_of(F.col("html"), F.col("rendered"), F.col("original"), F.lit("t"), F.lit("[]"), F.lit("{}"))).alias("p")).select("id", "p.*")
    made = S.artifacts(parts)
    kinds = {r.id: [x.artifact_type for x in made.where(f"id = {r.id}").collect()] for r in df.collect()}
    rest = ["text", "structured_data", "dom_map"]
    assert kinds == {1: ["html", "rendered_html", *rest], 2: ["rendered_html", *rest], 3: ["html", *rest], 4: ["html", *rest]}
    one = made.where("id = 3 AND artifact_type = 'html'").first()
    assert (one.content_hash, one.object_key, one.byte_size, one.content_type, one.retention_class, one.state_key) == (sha("<p>o</p>"), f"pricing/artifacts/html/{sha('<p>o</p>')}", 8, "text/html; charset=utf-8", "changed_snapshot", "default")
    assert made.where("id = 4 AND artifact_type = 'html'").first().content_hash == sha("")
    same = S.bundles(made, ["id"]).orderBy("id").collect()
    assert [r.parts for r in same] == [5, 4, 4, 4] and len({r.bundle_hash for r in same}) == 4
    shuffled = S.bundles(made.repartition(7, "content_hash"), ["id"]).orderBy("id").collect()
    assert [r.bundle_hash for r in shuffled] == [r.bundle_hash for r in same]


def test_unknown_kinds_fail(spark):
    with pytest.raises(ValueError):
        S.artifacts(spark.range(1), retention="for ever")
    for kind in ("pdf", None):
        rows = spark.createDataFrame([(kind, "x")], "artifact_type string, body string")
        with pytest.raises(Exception, match="unknown artifact type"):
            S.artifacts(rows).collect()


def test_currencies(spark):
    texts = [("usd 5, EUR 6 or US$7, $8 and €9 USD",), ("nothing",), (None,)]
    got = [json.loads(r[0]) for r in spark.createDataFrame(texts, "t string").select(S.currency_context(F.col("t"))).collect()]
    assert got[0] == {"currency_codes": ["EUR", "USD"], "currency_symbols": ["$", "US$", "€"], "diagnostic_only": True}
    assert got[1] == got[2] == {"currency_codes": [], "currency_symbols": [], "diagnostic_only": True}


def test_capture(spark):
    """Unknown, empty, equal and other hashes; a hot source over many ranges; what is stored isn't uploaded, screenshots only on demand."""
    rows = spark.createDataFrame([(None, "a", False, False), ("", "a", None, None), ("a", "a", False, False), ("a", "b", False, False), ("a", "a", True, False), ("a", "a", False, True), ("a", None, False, False)], "p string, c string, v boolean, f boolean")
    flags = S.capture_flags(F.col("p"), F.col("c"), F.col("v"), F.col("f"))
    got = [tuple(r) for r in rows.select(*[c.alias(n) for n, c in flags.items()]).collect()]
    assert got == [(True, True, True), (True, True, True), (False, False, False), (True, True, True), (False, True, False), (False, False, True), (True, True, True)]
    log = spark.createDataFrame([("hot", i, None if i % 7 == 0 else f"h{i // 3}") for i in range(200)] + [(None, 1, "x"), (None, 2, "y")], "k string, seq int, h string").repartition(5)
    before = {(r.k, r.seq): r.p for r in S.previous_in_key(log, ["k"], "seq", "h", "p", written).collect()}
    assert before == {("hot", i): None if i == 0 or (i - 1) % 7 == 0 else f"h{(i - 1) // 3}" for i in range(200)} | {(None, 1): None, (None, 2): "x"}
    made = spark.createDataFrame([(1, "html", "h/1", 1, False), (2, "html", "h/1", 1, False), (2, "html", "h/2", 1, False), (3, "screenshot", "s/1", 1, False), (4, "screenshot", "s/1", 1, True)], "seq int, artifact_type string, object_key string, byte_size int, capture_screenshot boolean")
    first = {r.object_key: (r.seq, r.holders) for r in S.uploads(made, spark.createDataFrame([("h/2",)], "object_key string"), "seq").collect()}
    assert first == {"h/1": (1, 2), "s/1": (4, 1)}


def objects(spark, bodies):
    df = spark.createDataFrame([(b,) for b in bodies], "body binary")
    return df.select(F.concat(F.lit("k/"), F.sha2(F.coalesce("body", F.lit(b"")), 256)).alias("object_key"), "body", F.lit("x/y").alias("content_type"))


def files(path):
    return sorted(os.path.relpath(f, path) for f in glob.glob(f"{path}/**", recursive=True) if os.path.isfile(f) and not f.endswith(".crc"))


def test_objects_once(spark, tmp_path):
    """Copies in one job, over jobs, an empty and a null body, a large one."""
    path = str(tmp_path / "o")
    big = os.urandom(3_000_000)
    OB.put(objects(spark, [b"a", b"b", b"a", b"", None, bytearray(big)]).repartition(3), path)
    OB.put(objects(spark, [b"b", b"c"]), path)
    OB.put(objects(spark, []), path)
    held = {r.object_key: bytes(r.body) for r in OB.stored(spark, path).collect()}
    want = {f"k/{sha(b)}": b for b in (b"a", b"b", b"c", b"", big)}
    assert held == want and {r.object_key: r.byte_size for r in OB.index(spark, path).collect()} == {k: len(v) for k, v in want.items()}
    assert not glob.glob(f"{path}/_staging/*")


def test_wrong_keys_fail(spark, tmp_path):
    path = str(tmp_path / "o")
    for key in (f"k/{sha(b'other')}", f"../k/{sha(b'a')}", None):
        bad = spark.createDataFrame([(key, b"a", "x")], "object_key string, body binary, content_type string")
        with pytest.raises(Exception, match="not the key of this body"):
            OB.put(bad, path)
    assert OB.index(spark, path).count() == 0 and not glob.glob(f"{path}/objects/**/*", recursive=True) and not glob.glob(f"{path}/_staging/*")


def test_an_attempt_that_dies_leaves_one_object(tmp_path):
    """The same rows by two attempts of a task, the first of which dies after some objects; the index holds the second only."""
    path = str(tmp_path / "o")
    bodies = [b"one", b"two", b"three"]
    batch = pa.RecordBatch.from_pydict({"object_key": [f"k/{sha(b)}" for b in bodies], "body": bodies, "content_type": ["x"] * 3})
    writer = OB.ObjectWriter(path)

    def dies():
        yield batch.slice(0, 2)
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(dies())
    again = writer.write(iter([batch]))
    writer.commit([again, None])
    assert [f for f in files(path) if f.startswith("objects/")] == sorted(f"objects/k/{sha(b)}" for b in bodies)
    assert [f for f in files(path) if not f.startswith("objects/")] == [f for f in files(path) if f.startswith("index/")] and len(files(path)) == 4
    other = OB.ObjectWriter(path)
    other.abort([other.write(iter([batch]))])
    assert len(files(path)) == 4


RETRIED = """
import os, sys
from pyspark.sql import SparkSession, functions as F
from tally.sources import objects as OB
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
mark = sys.argv[1] + "/died"
df = spark.range(40).select(F.encode(F.concat(F.lit("body "), (F.col("id") % 20).cast("string")), "UTF-8").alias("body"))
df = df.select(F.concat(F.lit("k/"), F.sha2("body", 256)).alias("object_key"), "body", F.lit("x").alias("content_type"))
def die(it):
    for i, b in enumerate(it):
        yield b
    if not os.path.exists(mark):
        open(mark, "w").close()
        os._exit(3)
OB.put(df.mapInArrow(die, df.schema), sys.argv[1] + "/o")
print(OB.index(spark, sys.argv[1] + "/o").count())
"""


def test_a_retried_task(tmp_path):
    """A worker dies in the first attempt; Spark runs the task again."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", RETRIED, str(tmp_path)], cwd=root, capture_output=True, timeout=200)
    assert done.returncode == 0 and done.stdout.split()[-1] == b"20", done.stderr[-2000:]
    assert os.path.exists(tmp_path / "died") and len([f for f in files(tmp_path / "o") if f.startswith("objects/")]) == 20


def test_writer_refuses(spark):
    sink = OB.ObjectSink({"path": "/tmp/none"})
    with pytest.raises(ValueError):
        sink.writer(spark.range(1).schema, False)
    with pytest.raises(ValueError):
        sink.writer(objects(spark, [b"a"]).schema, True)


def test_capture_plan_makes_pages_once(spark, monkeypatch):
    """Pages are made once, and what is kept between steps has keys without their folders."""
    from tally.plans import captures as C

    made, kept, pages, written = [], [], C._pages, C.written
    monkeypatch.setattr(C, "_pages", lambda *a: made.append(1) or pages(*a))
    monkeypatch.setattr(C, "written", lambda df: kept.append(written(df)) or kept[-1])
    C.capture_plan(spark, "/root/testdata/sf0.001")
    longest = max(df.agg(F.max(F.length("object_key"))).first()[0] for df in kept if "object_key" in df.columns)
    assert len(made) == 1 and longest < 64
