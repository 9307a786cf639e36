"""Writes and reports that leave files behind."""

from pyspark.sql import functions as F

from tally.operators import evaluation as E
from tally.operators import writes as W


def test_fan_out_is_idempotent(spark, tmp_path):
    """A batch that runs again replaces its own files in every table and no others."""
    root = str(tmp_path / "out")
    for batch, n in ((0, 3), (1, 5), (1, 5)):
        rows = spark.range(n).withColumn("b", F.lit(batch))
        W.fan_out(rows, {"snapshots": rows, "monthly": rows.where("id % 2 = 0")}, root, batch)
    assert spark.read.parquet(f"{root}/snapshots/*").count() == 8 and spark.read.parquet(f"{root}/monthly/*").count() == 5


def test_written_counts_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert W.written(spark.range(7), path) == 7 and W.written(spark.range(0), path) == 0 and W.written(spark.range(2), path) == 2
    assert spark.read.parquet(path).count() == 9


def test_recovery_takes_the_oldest(spark):
    rows = spark.createDataFrame([(i, "dead" if i % 2 else "done", 10 - i) for i in range(8)], "id int, status string, at int")
    got = {r.id: r.status for r in W.recover(rows, F.col("status") == "dead", ["at", "id"], 2).collect()}
    assert [i for i, s in got.items() if s == "queued"] == [5, 7] or {i for i, s in got.items() if s == "queued"} == {5, 7}
    assert sum(s == "dead" for s in got.values()) == 2


def test_replacement_keeps_manual_rows(spark):
    old = spark.createDataFrame([(1, 10, "auto"), (1, 11, "manual"), (2, 20, "auto"), (3, 30, "auto")], "k int, v int, source string")
    new = spark.createDataFrame([(1, 11), (1, 12), (2, 20), (2, 20)], "k int, v int")
    table, events = W.replace_automatic(old, new, ["k"], ["v"])
    assert sorted(map(tuple, table.collect())) == [(1, 11, "manual"), (1, 12, "auto"), (2, 20, "auto"), (3, 30, "auto")]
    assert sorted(map(tuple, events.collect())) == [(1, 10, "removed"), (1, 12, "added")]


def test_report_of_nothing(spark):
    gold = spark.createDataFrame([], "tool_id int, gold string, alternates array<string>, must_not array<string>, capabilities_ok array<string>, is_draft boolean")
    pred = spark.createDataFrame([], "tool_id int, pred string, confidence double, decision_status string, capabilities array<string>")
    old = spark.createDataFrame([], "tool_id int, primary_slug string, leaf string")
    rows = E.judged(gold, pred, old)
    row = E.metrics(rows).first()
    assert row.gold_n == 0 and row.accuracy is None and row.macro_f1 == 0.0
    assert "_None_" in E.markdown(E.metrics(rows), E.class_table(rows))
    one = E.judged(spark.createDataFrame([(1, "a", ["b"], [], ["x"], False)], gold.schema), spark.createDataFrame([(1, "b", 0.9, "provisional", ["x", "y"])], pred.schema), old)
    assert "| a | 1 | 1.0 | 1.0 | 1.0 |" in E.markdown(E.metrics(one), E.class_table(one)) and E.metrics(one).first().capability_precision == 0.5
