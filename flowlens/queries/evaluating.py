"""Confusion counts, binary and multiclass metrics, per-class detection, model comparison."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlens.functions.predicates import flag_anomaly
from flowlens.operators.evaluation import (
    binary_confusion,
    compare_models,
    confusion_cells,
    macro_metrics,
    multiclass_metrics,
    per_class_metrics,
    report_at,
    score_by_class,
    unseen_detection,
    with_binary_metrics,
)
from flowlens.operators.features import attach_class_name
from flowlens.operators.ranking import rank_truth
from flowlens.queries.calibrating import METRICS, RATES, auc_sql, rounded
from flowlens.queries.registry import calibration_part, held_out_part, labelled, multi, query, scored, table
from flowlens.workspace import materialize

CUT = 60.0


def flagged(rows):
    return rows.withColumn("flag", flag_anomaly(F.col("score"), CUT))


CELLS_SQL = f"""SELECT count(*) FILTER (score > {CUT} AND truth = 1) AS tp, count(*) FILTER (score > {CUT} AND truth = 0) AS fp,
    count(*) FILTER (score <= {CUT} AND truth = 1) AS fn, count(*) FILTER (score <= {CUT} AND truth = 0) AS tn FROM @scored"""
FULL_SQL = f"""SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
    FROM (SELECT *, {METRICS} FROM ({{cells}}) c) m"""


@query("binary_confusion", CELLS_SQL)
def binary_confusion_query(spark, sf):
    return binary_confusion(flagged(scored(spark, sf)), "flag", "truth")


@query("binary_metrics", f"SELECT tp, fp, fn, tn{rounded(RATES)} FROM ({FULL_SQL.format(cells=CELLS_SQL)}) x")
def binary_metrics(spark, sf):
    cells = with_binary_metrics(binary_confusion(flagged(scored(spark, sf)), "flag", "truth"))
    return cells.select("tp", "fp", "fn", "tn", *[F.round(c, 9).alias(c) for c in RATES])


PAIR_SQL = """SELECT count(*) FILTER (quality = 0 AND toxic = 1) AS tp, count(*) FILTER (quality = 0 AND toxic = 0) AS fp,
    count(*) FILTER (quality = 1 AND toxic = 1) AS fn, count(*) FILTER (quality = 1 AND toxic = 0) AS tn FROM labels"""


@query("binary_metrics_labels", f"SELECT tp, fp, fn, tn{rounded(RATES)} FROM ({FULL_SQL.format(cells=PAIR_SQL)}) x")
def binary_metrics_labels(spark, sf):
    """The same report on a rare positive class."""
    pair = table(spark, sf, "labels").select((1 - F.col("quality")).alias("flag"), F.col("toxic").alias("truth"))
    cells = with_binary_metrics(binary_confusion(pair, "flag", "truth"))
    return cells.select("tp", "fp", "fn", "tn", *[F.round(c, 9).alias(c) for c in RATES])


# predictions of a class set that is only partly the true one: purchase is never predicted, other never true
GUESS_SQL = """(SELECT event_type AS truth, CASE WHEN value > 100 THEN 'error' WHEN value > 40 THEN 'click'
    WHEN value > 20 THEN 'view' WHEN value > 5 THEN 'signup' ELSE 'other' END AS pred FROM events)"""


def guesses(spark, sf):
    v = F.col("value")
    pred = (
        F.when(v > 100, "error").when(v > 40, "click").when(v > 20, "view").when(v > 5, "signup").otherwise("other")
    )
    return table(spark, sf, "events").select(F.col("event_type").alias("truth"), pred.alias("pred"))


@query(
    "confusion_matrix",
    f"""WITH idx AS (SELECT class, CAST(row_number() OVER (ORDER BY count(*) DESC, class) - 1 AS DOUBLE) AS i
        FROM (SELECT truth AS class FROM {GUESS_SQL} g UNION ALL SELECT pred FROM {GUESS_SQL} h) u GROUP BY class)
    SELECT t.i AS truth_index, m.truth AS true_class, p.i AS pred_index, m.pred AS predicted_class, count(*) AS n
    FROM {GUESS_SQL} m LEFT JOIN idx t ON m.truth = t.class LEFT JOIN idx p ON m.pred = p.class GROUP BY ALL""",
)
def confusion_matrix(spark, sf):
    """Counts per pair of class indexes, then the names of the classes; some are only true, some only predicted."""
    rows = guesses(spark, sf)
    # one scan: every index and name comes from the table of cells
    cells = materialize(confusion_cells(rows, "truth", "pred"), "cells")
    either = F.explode(F.array("truth", "pred")).alias("class")
    counts = cells.select(either, "n").groupBy("class").agg(F.sum("n").alias("n"))
    names = counts.select(
        F.col("class").alias("label"),
        (F.row_number().over(Window.orderBy(F.desc("n"), "class")) - 1).cast("double").alias("label_index"),
    )  # one row per class
    names = materialize(names, "names")
    back = names.select(F.col("label").alias("truth"), F.col("label_index").alias("truth_index"))
    other = names.select(F.col("label").alias("pred"), F.col("label_index").alias("pred_index"))
    indexed = cells.join(back, "truth", "left").join(other, "pred", "left").select("truth_index", "pred_index", "n")
    named = attach_class_name(indexed, names, "truth_index", "true_class")
    return attach_class_name(named, names, "pred_index", "predicted_class")


PER_CLASS_SQL = """SELECT class, support, predicted, hits,
    CASE WHEN predicted > 0 THEN hits / CAST(predicted AS DOUBLE) ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN hits / CAST(support AS DOUBLE) ELSE 0 END AS recall
    FROM (SELECT class, CAST(sum(s) AS BIGINT) AS support, CAST(sum(p) AS BIGINT) AS predicted, CAST(sum(h) AS BIGINT) AS hits
        FROM (SELECT truth AS class, 1 AS s, 0 AS p, CASE WHEN truth = pred THEN 1 ELSE 0 END AS h FROM {source}
              UNION ALL SELECT pred, 0, 1, 0 FROM {source}) u GROUP BY class) c"""


def per_class_sql(source: str) -> str:
    return f"""SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
    FROM ({PER_CLASS_SQL.format(source=source)}) r"""


def class_metrics(rows):
    return per_class_metrics(confusion_cells(rows, "truth", "pred"), "truth", "pred")


SCORES = ["precision", "recall", "f1"]


@query(
    "per_class_metrics",
    f"SELECT class, support, predicted, hits{rounded(SCORES)} FROM ({per_class_sql(GUESS_SQL)}) x",
)
def per_class_metrics_query(spark, sf):
    return class_metrics(guesses(spark, sf)).withColumns({c: F.round(c, 9) for c in SCORES})


@query(
    "macro_metrics",
    f"""SELECT round(avg(precision), 9) AS precision_macro, round(avg(recall), 9) AS recall_macro,
    round(avg(f1), 9) AS f1_macro FROM ({per_class_sql(GUESS_SQL)}) x WHERE support > 0""",
)
def macro_metrics_query(spark, sf):
    """Averages over the true classes: a class that is only predicted does not count."""
    averages = macro_metrics(class_metrics(guesses(spark, sf)))
    return averages.select(*[F.round(c, 9).alias(c) for c in averages.columns])


@query(
    "multiclass_metrics",
    f"""SELECT round(sum(hits) / sum(support), 9) AS accuracy,
    round(sum(precision * support) / sum(support), 9) AS precision_weighted,
    round(sum(recall * support) / sum(support), 9) AS recall_weighted,
    round(sum(f1 * support) / sum(support), 9) AS f1_weighted FROM ({per_class_sql("@multi")}) x""",
)
def multiclass_metrics_query(spark, sf):
    averages = multiclass_metrics(class_metrics(multi(spark, sf)))
    return averages.select(*[F.round(c, 9).alias(c) for c in averages.columns])


@query(
    "score_by_class",
    f"""SELECT event_type, round(avg(score), 8) AS mean_dist, round(stddev_samp(score), 8) AS std_dist,
    count(*) AS num_records, round(avg(CASE WHEN score > {CUT} THEN CAST(1 AS DOUBLE) ELSE 0 END), 8) AS detection_rate
    FROM @scored GROUP BY event_type""",
)
def score_by_class_query(spark, sf):
    table_ = score_by_class(flagged(scored(spark, sf)), "event_type", "score", "flag")
    return table_.withColumns({c: F.round(c, 8) for c in ("mean_dist", "std_dist", "detection_rate")})


@query(
    "unseen_detection",
    f"""SELECT label, count(*) AS num_records, count(*) FILTER (score > {CUT}) AS detected_as_attack,
    round(avg(score), 8) AS mean_dist, round(avg(CASE WHEN score > {CUT} THEN CAST(1 AS DOUBLE) ELSE 0 END), 9) AS detection_recall,
    CASE WHEN avg(CASE WHEN score > {CUT} THEN CAST(1 AS DOUBLE) ELSE 0 END) >= 0.5 THEN 'full' ELSE 'partial' END AS detection
    FROM @labelled WHERE day(ts) > 20 AND label IS NOT NULL
        AND label NOT IN (SELECT label FROM @labelled WHERE day(ts) <= 20 AND label IS NOT NULL) GROUP BY label""",
)
def unseen_detection_query(spark, sf):
    """Classes that appear only after the calibration days."""
    rows = flagged(labelled(spark, sf).where(F.col("label").isNotNull()))
    found = unseen_detection(calibration_part(rows), held_out_part(rows), "label", "flag", "score")
    return found.withColumns({"mean_dist": F.round("mean_dist", 8), "detection_recall": F.round("detection_recall", 9)})


COMPARED = ["auc_roc", "f1", "fpr", "accuracy"]


def compared_sql() -> str:
    def long(cut: float, name: str) -> str:
        cells = CELLS_SQL.replace(f"> {CUT}", f"> {cut}").replace(f"<= {CUT}", f"<= {cut}")
        report = f"SELECT * FROM ({FULL_SQL.format(cells=cells)}) x, ({auc_sql('@scored')}) a"
        return " UNION ALL ".join(f"SELECT '{m}' AS metric, {m} AS {name} FROM ({report}) r" for m in COMPARED)

    return f"""SELECT o.metric, round(b.base, 9) AS base, round(o.optimised, 9) AS optimised,
        round(o.optimised - b.base, 9) AS change FROM ({long(90.0, "optimised")}) o
        LEFT JOIN ({long(30.0, "base")}) b ON o.metric = b.metric"""


@query("compare_models", compared_sql())
def compare_models_query(spark, sf):
    """Reports at two thresholds side by side, from one ranking."""
    ranking = rank_truth(scored(spark, sf), "score", "truth")
    base, other = (report_at(ranking, cut) for cut in (30.0, 90.0))
    compared = compare_models(base, other, COMPARED)
    return compared.withColumns({c: F.round(c, 9) for c in ("base", "optimised", "change")})
