"""Class-weighted random forest: train, evaluate, optimise."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.operators.evaluation import (
    binary_from_cells,
    compare_reports,
    confusion_cells,
    detection_by_class,
    macro_metrics,
    match_classes,
    multiclass_metrics,
    per_class_metrics,
    run_figures,
    with_binary_metrics,
)
from flowlens.operators.features import attach_class_name
from flowlens.operators.forest import attack_probability, feature_importance, fit_forest, predict
from flowlens.operators.ranking import auc
from flowlens.operators.search import best_forest, refit_forest, search_forest
from flowlens.plans.layout import Layout
from flowlens.sources.documents import load_manifest, read_values, write_values
from flowlens.sources.tables import load_model, read_table, save_model, write_table
from flowlens.workspace import materialize


def label_names(spark: SparkSession, layout: Layout):
    labels = StringIndexerModel.load(layout("models", "indexer")).labels
    return spark.createDataFrame([(n, float(i)) for i, n in enumerate(labels)], "label string, label_index double")


def train_forest(spark: SparkSession, layout: Layout, name: str = "forest_v1", **params) -> dict:
    """Fit on the weighted training rows, save the model, its importances and its training time."""
    params = {**K.FOREST, **params}
    train = read_table(spark, layout("processed", "train"))
    start = time.time()
    model = fit_forest(train, **params)
    seconds = time.time() - start
    return store_training(spark, layout, name, model, params, seconds, train.count())


def store_training(spark, layout: Layout, name: str, model, params: Mapping, seconds: float, rows: int) -> dict:
    save_model(model, layout("models", name))
    ranked = feature_importance(spark, model, load_manifest(spark, layout("models", "features")))
    report = {
        "training_time_seconds": round(seconds, 4),
        **params,
        "num_training_records": rows,
        "feature_importances": [r.asDict() for r in ranked.collect()],  # one row per feature
    }
    write_values(spark, report, layout("reports", f"{name}_train"))
    return report


def evaluate_forest(
    spark: SparkSession, layout: Layout, name: str = "forest_v1", unseen: Sequence[str] = K.UNSEEN_PATTERNS
) -> dict:
    """Score the test rows, store them, and report on the stored scores.

    Everything but the AUC and the unseen classes comes from the confusion cells, which are counted once.
    """
    model = load_model(layout("models", name))
    test = read_table(spark, layout("processed", "test"))
    start = time.time()
    write_table(predict(model, test), layout("scores", name), K.FOREST_SCORE_COLUMNS)
    seconds = time.time() - start
    stored = read_table(spark, layout("scores", name))
    names = label_names(spark, layout)

    cells = materialize(confusion_cells(stored, K.LABEL_INDEX, K.PREDICTION), "cells")
    rows = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    per_class = per_class_metrics(cells, K.LABEL_INDEX, K.PREDICTION)
    named_cells = attach_class_name(
        attach_class_name(cells, names, K.LABEL_INDEX, "true_class"), names, K.PREDICTION, "predicted_class"
    )
    named_classes = attach_class_name(per_class.where("support > 0"), names, "class", "name")
    binary = with_binary_metrics(binary_from_cells(cells, K.LABEL_INDEX, K.PREDICTION)).first()
    unseen_rows = detection_by_class(match_classes(stored, K.LABEL, unseen), K.LABEL)
    report = {
        "multiclass": {**multiclass_metrics(per_class).first().asDict(), **macro_metrics(per_class).first().asDict()},
        "binary": {"auc_roc": auc(attack_probability(stored)).first()["auc_roc"], "fpr_global": binary["fpr"]},
        "confusion_matrix": [r.asDict() for r in named_cells.orderBy(K.LABEL_INDEX, K.PREDICTION).collect()],
        "metrics_per_class": [r.asDict() for r in named_classes.orderBy("class").collect()],
        "unseen_classes_analysis": [r.asDict() for r in unseen_rows.orderBy(K.LABEL).collect()],
        "system_metrics": run_figures(rows, seconds, test.rdd.getNumPartitions()),
    }
    write_values(spark, report, layout("reports", f"{name}_test"))
    return report


def optimise_forest(
    spark: SparkSession,
    layout: Layout,
    base: str = "forest_v1",
    name: str = "forest_optimised",
    grid: Mapping[str, Sequence] = K.FOREST_GRID,
    folds: int = K.FOREST_FOLDS,
    fraction: float = K.SEARCH_FRACTION,
    parallelism: int = 2,
) -> dict:
    """Cross-validate the grid on a sample, refit the best combination on all rows, compare with the base."""
    train = read_table(spark, layout("processed", "train"))
    start = time.time()
    results = search_forest(train, grid, folds, fraction, parallelism=parallelism)
    search_seconds = time.time() - start
    best = best_forest(results)
    chosen = best.first()
    params = {"trees": chosen["trees"], "depth": chosen["depth"], "subset": chosen["subset"]}
    start = time.time()
    model = refit_forest(train, best)
    store_training(spark, layout, name, model, params, time.time() - start, train.count())
    evaluate_forest(spark, layout, name)
    report = {
        "base_model": model_report(spark, layout, base),
        "optimized_model": {
            **model_report(spark, layout, name),
            "avg_cv_f1": chosen["avg_metric"],
            "crossvalidator_time_s": round(search_seconds, 4),
        },
        "comparison": compare_reports(spark, model_report(spark, layout, base), model_report(spark, layout, name)),
        "search_config": {**grid, "folds": folds, "sample_fraction": fraction, "combinations": results.count()},
    }
    write_values(spark, report, layout("reports", f"{name}_comparison"))
    return report


def model_report(spark: SparkSession, layout: Layout, name: str) -> dict:
    """The compared figures of one model; None where it was never trained or evaluated."""
    trained = read_values(spark, layout("reports", f"{name}_train"))
    tested = read_values(spark, layout("reports", f"{name}_test")).get("multiclass", {})
    return {
        "hyperparameters": {p: trained.get(p, K.FOREST[p]) for p in K.FOREST},
        "f1_weighted": tested.get("f1_weighted"),
        "accuracy": tested.get("accuracy"),
        "training_time_s": trained.get("training_time_seconds"),
    }
