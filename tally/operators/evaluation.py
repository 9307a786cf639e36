"""Evaluation of taxonomy predictions against gold labels.

Gold, predictions and legacy views are tables by item; every figure is an aggregation, and only the
report's tables of fixed length are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.functions.numbers import f1, safe_div
from tally.functions.text import slug

# Fixed value: from this confidence on a provisional prediction counts as accepted.
ACCEPT = 0.85
RUN = "leaf_accepted struct<slug:string,confidence:string>, capabilities_accepted array<string>"


def accepted(threshold: float = ACCEPT) -> Column:
    """Whether a prediction (pred, decision_status, confidence) is accepted without a person."""
    sure = F.col("decision_status").isin("provisional", "") & (F.col("confidence") >= threshold)
    return F.coalesce((F.col("pred") != "") & ((F.col("decision_status") == "auto_accepted") | sure), F.lit(False))


def matches(predicted: str | Column) -> Column:
    """Whether a slug is the gold one or one of its alternates."""
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    return F.coalesce((p != "") & ((p == F.col("gold")) | F.array_contains("alternates", p)), F.lit(False))


def predictions_of_runs(runs: DataFrame, raw: str = "raw_output") -> DataFrame:
    """A prediction from each item's newest run (F62, W4): runs have tool_id, run_id and the model's JSON text.

    Text that isn't a JSON object gives an unresolved prediction.  Of a capability named twice the first counts.
    """
    newest = runs.groupBy("tool_id").agg(F.max_by(F.struct("run_id", raw), "run_id").alias("_r")).select("tool_id", "_r.run_id", F.from_json(f"_r.{raw}", RUN).alias("_j"))
    cap = lambda x: slug(F.get_json_object(x, "$.slug"))
    caps = F.array_distinct(F.filter(F.transform(F.coalesce("_j.capabilities_accepted", F.array().cast("array<string>")), cap), lambda x: x != ""))
    pred = slug("_j.leaf_accepted.slug")
    return newest.select("tool_id", "run_id", pred.alias("pred"), F.col("_j.leaf_accepted.confidence").try_cast("double").alias("confidence"), F.when(pred != "", "provisional").otherwise("unresolved").alias("decision_status"), caps.alias("capabilities"))


def assembled(runs: DataFrame, assignments: DataFrame, capabilities: DataFrame) -> DataFrame:
    """One prediction for each item (F66): its newest run's, else its newest assignment's with the capabilities
    of the table, else those alone.

    runs: as predictions_of_runs returns; assignments: tool_id, assignment_id, updated_at, pred, confidence,
    decision_status; capabilities: tool_id, capability.
    """
    caps = capabilities.where("capability <> ''").groupBy("tool_id").agg(F.array_sort(F.collect_set("capability")).alias("_caps"))
    last = assignments.groupBy("tool_id").agg(F.max_by(F.struct("pred", "confidence", "decision_status"), F.struct("updated_at", "assignment_id")).alias("_a"))
    j = runs.select("tool_id", F.struct("pred", "confidence", "decision_status", "capabilities").alias("_r")).join(last, "tool_id", "full").join(caps, "tool_id", "full")
    none = F.array().cast("array<string>")
    own = F.col("_r").isNotNull()
    pick = lambda c: F.when(own, F.col(f"_r.{c}")).otherwise(F.col(f"_a.{c}"))
    source = F.when(own, "run").when(F.col("_a").isNotNull(), "assignment").otherwise("capabilities")
    return j.select("tool_id", F.coalesce(pick("pred"), F.lit("")).alias("pred"), pick("confidence").alias("confidence"), F.coalesce(pick("decision_status"), F.lit("unresolved")).alias("decision_status"), F.when(own, F.coalesce("_r.capabilities", none)).otherwise(F.coalesce("_caps", none)).alias("capabilities"), source.alias("source"))


def legacy_leaf(categories: DataFrame) -> DataFrame:
    """The leaf that an item's old categories stand for (F67): the first that has a parent and isn't the primary,
    else the first that isn't, else the primary.

    categories: tool_id, primary_slug, category_id, category_slug, parent_slug; a row a category, or one without.
    """
    other = (F.col("category_slug") != "") & (F.col("category_slug") != F.coalesce("primary_slug", F.lit("")))
    child = other & (F.coalesce("parent_slug", F.lit("")) != "")
    first = lambda ok: F.min_by(F.when(ok, F.col("category_slug")), F.when(ok, F.col("category_id")))
    return categories.groupBy("tool_id").agg(F.max(F.coalesce("primary_slug", F.lit(""))).alias("primary_slug"), first(child).alias("_c"), first(other).alias("_o")).select("tool_id", "primary_slug", F.coalesce("_c", "_o", "primary_slug").alias("leaf"))


def judged(gold: DataFrame, predictions: DataFrame, legacy: DataFrame, threshold: float = ACCEPT) -> DataFrame:
    """Gold rows with their prediction and legacy view, and what follows from them; one row each.

    gold: tool_id, gold, alternates, must_not, capabilities_ok, is_draft; predictions: tool_id, pred, confidence,
    decision_status, capabilities; legacy: tool_id, primary_slug, leaf.
    """
    p = predictions.select("tool_id", "pred", "confidence", "decision_status", "capabilities", F.lit(True).alias("_has"))
    j = gold.join(p, "tool_id", "left").join(legacy.select("tool_id", "primary_slug", "leaf"), "tool_id", "left")
    old = F.coalesce(F.nullif("leaf", F.lit("")), F.nullif("primary_slug", F.lit("")))
    none = F.array().cast("array<string>")
    caps, ok = F.coalesce("capabilities", none), F.coalesce("capabilities_ok", none)
    has = F.coalesce(F.col("pred") != "", F.lit(False))
    rated = F.size(ok) > 0
    return j.withColumns({
        "present": has, "match": has & matches("pred"), "auto_accepted": has & accepted(threshold), "must_not_hit": F.coalesce(has & F.array_contains("must_not", F.col("pred")), F.lit(False)),
        "unresolved": has & (F.col("decision_status") == "unresolved"), "provisional": has & (F.col("decision_status") == "provisional"), "legacy_match": matches(F.coalesce(old, F.lit(""))),
        "versus": F.when(has & old.isNotNull(), F.when((F.col("pred") == F.col("leaf")) | (F.col("pred") == F.col("primary_slug")), "same").otherwise("different")),
        "cap_tp": F.when(rated, F.size(F.array_intersect(caps, ok))).otherwise(0), "cap_fp": F.when(rated, F.size(F.array_except(caps, ok))).otherwise(0), "cap_fn": F.when(rated, F.size(F.array_except(ok, caps))).otherwise(0),
    }).drop("_has")


def per_label(rows: DataFrame) -> DataFrame:
    """Support, counts, precision, recall and F1 of each gold label of judged rows (A16, A19).  A wrong prediction
    counts against the label that was predicted and the one that was missed; alternates count as right."""
    labels = rows.groupBy(F.col("gold").alias("label")).agg(F.count("*").alias("support"), F.count_if("match").alias("tp"), F.count_if(F.col("present") & ~F.col("match")).alias("fn"))
    wrong = rows.where("present AND NOT match").groupBy(F.col("pred").alias("label")).agg(F.count("*").alias("fp"))
    out = labels.join(wrong, "label", "left").withColumn("fp", F.coalesce("fp", F.lit(0)))
    return out.withColumns({"p": safe_div("tp", F.col("tp") + F.col("fp")), "r": safe_div("tp", F.col("tp") + F.col("fn"))})


def class_table(rows: DataFrame) -> DataFrame:
    """per_label as a report's table: support descending, then label."""
    return per_label(rows).select("label", "support", "tp", "fp", "fn", F.round("p", 4).alias("precision"), F.round("r", 4).alias("recall"), F.round(f1("p", "r"), 4).alias("f1")).orderBy(F.desc("support"), "label")


def metrics(rows: DataFrame) -> DataFrame:
    """One row of figures (A17): rates to four places, null where nothing was counted; macro figures over gold labels."""
    n, part = F.count("*"), lambda c: F.count_if(c)
    one = rows.agg(
        n.alias("gold_n"), part("is_draft").alias("gold_draft_n"), part("present").alias("present"), part("match").alias("hits"), part("auto_accepted").alias("auto_accepted_n"), part(F.col("auto_accepted") & F.col("match")).alias("auto_hits"),
        part("unresolved").alias("unresolved"), part("provisional").alias("provisional"), part("must_not_hit").alias("must_not"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("cap_tp", "cap_fp", "cap_fn")],
        part("legacy_match").alias("legacy_match_gold"), part(F.col("versus") == "same").alias("same"), part(F.col("versus") == "different").alias("different"), part(F.col("match") & ~F.col("legacy_match")).alias("better"), part(F.col("legacy_match") & ~F.col("match") & F.col("present")).alias("worse"),
    )
    macro = per_label(rows).agg(F.coalesce(F.avg("p"), F.lit(0.0)).alias("mp"), F.coalesce(F.avg("r"), F.lit(0.0)).alias("mr"))
    rate = lambda a, b: F.round(F.when(F.expr(b) > 0, F.expr(a) / F.expr(b)), 4)
    cp, cr = safe_div("cap_tp", F.expr("cap_tp + cap_fp")), safe_div("cap_tp", F.expr("cap_tp + cap_fn"))
    return one.crossJoin(macro).select(  # two single rows
        "gold_n", "gold_draft_n", "present", (F.col("gold_n") - F.col("present")).alias("missing"), rate("hits", "present").alias("accuracy"), rate("hits", "gold_n").alias("accuracy_incl_missing"),
        F.round("mp", 4).alias("macro_precision"), F.round("mr", 4).alias("macro_recall"), F.round(f1("mp", "mr"), 4).alias("macro_f1"), "auto_accepted_n", rate("auto_hits", "auto_accepted_n").alias("auto_accepted_precision"),
        rate("unresolved", "gold_n").alias("unresolved_rate"), rate("provisional", "gold_n").alias("provisional_rate"), rate("gold_n - present", "gold_n").alias("missing_rate"), rate("must_not", "present").alias("must_not_rate"),
        rate("(gold_n - present) + unresolved + (present - auto_accepted_n)", "gold_n").alias("manual_review_rate"), rate("cap_tp", "cap_tp + cap_fp").alias("capability_precision"), rate("cap_tp", "cap_tp + cap_fn").alias("capability_recall"),
        F.round(F.when(F.expr("cap_tp + cap_fp + cap_fn") > 0, f1(cp, cr)), 4).alias("capability_f1"), "legacy_match_gold", "same", "different", "better", "worse",
    )


def mismatches(rows: DataFrame, most: int = 50) -> DataFrame:
    """The most frequent confusions (A18): a report of fixed length; ties by gold, then prediction."""
    wrong = rows.where("present AND NOT match AND gold <> pred").groupBy("gold", "pred").agg(F.count("*").alias("n"))
    return wrong.orderBy(F.desc("n"), "gold", "pred").limit(most)


def markdown(metrics_row: DataFrame, classes: DataFrame) -> str:
    """A report as Markdown (S23): the figures and the table of classes, both of bounded size."""
    row = metrics_row.first().asDict()
    lines = ["# Evaluation", "", "| figure | value |", "| --- | --- |", *[f"| {k} | {'' if v is None else v} |" for k, v in row.items()], "", "## Per class", ""]
    table = classes.collect()
    if not table:
        return "\n".join([*lines, "_None_", ""])
    lines += ["| class | support | P | R | F1 |", "| --- | --- | --- | --- | --- |", *[f"| {r['label']} | {r['support']} | {r['precision']} | {r['recall']} | {r['f1']} |" for r in table]]
    return "\n".join([*lines, ""])


def numbered(rows: DataFrame, keys: list[str], order: list[Column], most: int, name: str = "place") -> DataFrame:
    """The first `most` rows of each key with their places (O7, O10); Spark limits groups before the shuffle."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= most)
