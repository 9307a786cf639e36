"""Writes of a classification run in which what people decided wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.operators.state import confidence_band

VALUES = ["run_id", "is_primary", "confidence", "decision_status", "source", "evidence", "assigned_at"]


def primary_locks(assignments: DataFrame, terms: DataFrame) -> DataFrame:
    """(item, locked_term): the primary category that a person has verified; of several the last reviewed, then the last updated.

    assignments: item, term_id, is_primary, source, decision_status, reviewed_at, updated_at; terms: id, dimension.  A term without a
    positive id locks nothing.
    """
    categories = terms.where("dimension = 'primary_category'").select(F.col("id").alias("_id"))
    sure = assignments.where("is_primary AND source = 'manual' AND decision_status = 'verified'").join(categories, F.col("term_id") == F.col("_id"), "left_semi")
    # Nulls come first in the order of structs: a row that was reviewed wins over one that wasn't.
    last = F.max_by("term_id", F.struct("reviewed_at", "updated_at", "term_id"))
    return sure.groupBy("item").agg(last.alias("locked_term")).where("locked_term > 0")


def primary_state(confidence: Column, locked: Column, accept: float = 0.8) -> Column:
    """Struct (is_primary, decision_status) of a proposed primary: it may be observed beside a lock, but doesn't compete with it."""
    return F.when(locked.isNotNull(), F.struct(F.lit(False).alias("is_primary"), F.lit("superseded").alias("decision_status"))).otherwise(F.struct(F.lit(True).alias("is_primary"), confidence_band(confidence, accept).alias("decision_status")))


def upsert_assignments(old: DataFrame, new: DataFrame) -> DataFrame:
    """Assignments after a run: new ones are added, automatic ones replaced, manual ones keep all but the time of their update.

    Both have item, term_id, VALUES and updated_at; one row for each item and term.
    """
    side = lambda df, name: df.select("item", "term_id", F.struct(*VALUES, "updated_at").alias(name))
    both = side(old, "_o").join(side(new, "_n"), ["item", "term_id"], "full")
    keeps = F.coalesce(F.col("_o.source") == "manual", F.lit(False)) | F.col("_n").isNull()
    picked = F.when(keeps, F.col("_o")).otherwise(F.col("_n"))
    return both.select("item", "term_id", *[picked[v].alias(v) for v in VALUES], F.coalesce(F.col("_n.updated_at"), F.col("_o.updated_at")).alias("updated_at"))


def written_assignments(old: DataFrame, proposed: DataFrame, terms: DataFrame, accept: float = 0.8) -> DataFrame:
    """The table after a run's proposals (item, term_id, run_id, primary, confidence, evidence, at): primaries take their state from
    the item's lock, other terms theirs from their confidence; then `upsert_assignments`."""
    locks = primary_locks(old, terms)
    found = proposed.join(locks, "item", "left")
    state = F.when(F.col("primary"), primary_state(F.col("confidence"), F.col("locked_term"), accept)).otherwise(F.struct(F.lit(False).alias("is_primary"), confidence_band(F.col("confidence"), accept).alias("decision_status")))
    new = found.withColumn("_s", state).select("item", "term_id", "run_id", "_s.is_primary", "confidence", "_s.decision_status", F.lit("auto").alias("source"), "evidence", F.col("at").alias("assigned_at"), F.col("at").alias("updated_at"))
    return upsert_assignments(old.select("item", "term_id", *VALUES, "updated_at"), new)


def runs_after(runs: DataFrame, results: DataFrame) -> DataFrame:
    """Runs with the status and error of their last result (run_id, at, status, error); a blank error is none, runs without a result stay."""
    last = results.groupBy(F.col("run_id").alias("_r")).agg(F.max_by(F.struct("status", F.nullif(F.trim(F.coalesce("error", F.lit(""))), F.lit("")).alias("error")), "at").alias("_l"))
    both = runs.join(last, F.col("run_id") == F.col("_r"), "left")
    done = F.col("_l").isNotNull()
    return both.select(*[F.when(done, F.col(f"_l.{c}")).otherwise(F.col(x)).alias(x) if (c := {"run_status": "status", "error": "error"}.get(x)) else F.col(x) for x in runs.columns])
