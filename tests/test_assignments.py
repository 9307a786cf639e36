"""What people decided wins over a run's writes."""

from tally.operators import assignments as A

ROW = "item int, term_id int, run_id int, is_primary boolean, confidence double, decision_status string, source string, evidence string, assigned_at int, updated_at int, reviewed_at int"


def test_locks(spark):
    base = (7, True, 0.9, "verified", "manual", "e", 1)
    rows = [(1, 10, *base, 5, 3), (1, 11, *base, 4, 4), (1, 12, *base, 9, None), (2, 10, *base, 1, None), (2, 11, *base, 2, None), (3, 99, *base, 1, 1), (4, 10, 7, False, 0.9, "verified", "manual", "e", 1, 1, 1)]
    rows += [(5, 10, 7, True, 0.9, "verified", "auto", "e", 1, 1, 1), (6, 10, 7, True, 0.9, "provisional", "manual", "e", 1, 1, 1), (7, 0, *base, 1, 1), (8, 10, 7, None, 0.9, None, None, "e", 1, 1, 1)]
    terms = spark.createDataFrame([(10, "primary_category"), (11, "primary_category"), (12, "primary_category"), (0, "primary_category"), (99, "capability")], "id int, dimension string")
    assert {r.item: r.locked_term for r in A.primary_locks(spark.createDataFrame(rows, ROW), terms).collect()} == {1: 11, 2: 11}


def test_writes(spark):
    old = spark.createDataFrame([(1, 10, 1, True, 0.9, "verified", "manual", "person", 1, 1, 1), (1, 20, 1, False, 0.1, "unresolved", "auto", "old", 1, 1, None), (2, 10, 1, True, 0.2, "unresolved", None, "old", 1, 1, None), (3, 30, 1, True, 0.5, "provisional", "auto", "stays", 1, 1, None)], ROW)
    new = spark.createDataFrame([(1, 10, 2, True, 0.95, "n", 9), (1, 20, 2, False, 0.85, "n", 9), (1, 11, 2, True, 0.99, "n", 9), (2, 10, 2, True, 0.6, "n", 9), (4, 10, 2, True, None, "n", 9)], "item int, term_id int, run_id int, primary boolean, confidence double, evidence string, at int")
    terms = spark.createDataFrame([(10, "primary_category"), (11, "primary_category")], "id int, dimension string")
    got = {(r.item, r.term_id): (r.run_id, r.is_primary, r.decision_status, r.source, r.evidence, r.assigned_at, r.updated_at) for r in A.written_assignments(old, new, terms).collect()}
    assert got == {
        (1, 10): (1, True, "verified", "manual", "person", 1, 9), (1, 20): (2, False, "auto_accepted", "auto", "n", 9, 9), (1, 11): (2, False, "superseded", "auto", "n", 9, 9),
        (2, 10): (2, True, "provisional", "auto", "n", 9, 9), (3, 30): (1, True, "provisional", "auto", "stays", 1, 1), (4, 10): (2, True, "unresolved", "auto", "n", 9, 9),
    }


def test_runs(spark):
    runs = spark.createDataFrame([(1, "running", None, "m"), (2, "running", "old", "m"), (3, "done", None, "m")], "run_id int, run_status string, error string, model string")
    results = spark.createDataFrame([(1, 1, "failed", "x"), (1, 2, "done", " "), (2, 5, "failed", "late"), (9, 1, "done", None)], "run_id int, at int, status string, error string")
    assert sorted(tuple(r) for r in A.runs_after(runs, results).collect()) == [(1, "done", None, "m"), (2, "failed", "late", "m"), (3, "done", None, "m")]
