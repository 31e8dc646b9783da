"""Clusters of benign rows as an anomaly detector: train, calibrate, evaluate, optimise."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.functions.predicates import binary_label, flag_anomaly
from flowlens.operators.calibration import (
    best_threshold,
    cross_fitted,
    fold_of,
    ranked_grid,
    threshold_candidates,
)
from flowlens.operators.clustering import (
    centroid_table,
    cluster_summary,
    distance_to_centroid,
    fit_kmeans,
    silhouette,
)
from flowlens.operators.evaluation import compare_reports, evaluate_at_threshold, run_figures, score_by_class, unseen_detection
from flowlens.operators.ranking import auc_expr, rank_truth, score_quantiles
from flowlens.operators.search import refit_kmeans, search_kmeans, select_model
from flowlens.plans.layout import Layout
from flowlens.sources.documents import read_values, write_values
from flowlens.sources.tables import load_model, read_table, save_model, write_table
from flowlens.workspace import discard, materialize

STORED = [*K.CLUSTER_SCORE_COLUMNS, K.LABEL]


def benign_label(layout: Layout) -> str:
    """The benign class unless one is named: the most frequent label of training."""
    return StringIndexerModel.load(layout("models", "indexer")).labels[0]


def score(model: PipelineModel, df: DataFrame, benign: str) -> DataFrame:
    """Cluster, distance to its centroid and the 0/1 truth of each row."""
    scored = distance_to_centroid(model.transform(df), centroid_table(df.sparkSession, model))
    return scored.withColumn(K.TRUTH, binary_label(F.col(K.LABEL), benign))


def benign_rows(spark: SparkSession, layout: Layout, benign: str) -> DataFrame:
    train = read_table(spark, layout("processed", "train"))
    return train.where(F.col(K.LABEL) == benign).select(K.SCALED_VECTOR)


def fit_report(model: PipelineModel, rows: DataFrame, seconds: float, params: Mapping) -> dict:
    assigned = model.transform(rows)
    summary = cluster_summary(distance_to_centroid(assigned, centroid_table(rows.sparkSession, model)))
    ends = summary.agg(F.min("min_dist").alias("lo"), F.max("max_dist").alias("hi")).first()
    trained = model.stages[-1].summary
    return {
        "training_time_seconds": round(seconds, 4),
        **params,
        "init_mode": "k-means||",
        "wssse": trained.trainingCost,
        "silhouette_score": silhouette(assigned),
        "cluster_sizes": list(trained.clusterSizes),
        "min_distance": ends["lo"],
        "max_distance": ends["hi"],
        "num_training_records": sum(trained.clusterSizes),
    }


def train_clusters(
    spark: SparkSession, layout: Layout, benign: str | None = None, name: str = "clusters_v1", **params
) -> dict:
    """Fit on the benign training rows, save the model and its clustering metrics."""
    params = {**K.CLUSTERS, **params}
    rows = materialize(benign_rows(spark, layout, benign or benign_label(layout)), "benign")
    start = time.time()
    model = fit_kmeans(rows, **params)
    seconds = time.time() - start
    report = fit_report(model, rows, seconds, params)
    discard(rows)
    save_model(model, layout("models", name))
    write_values(spark, report, layout("reports", f"{name}_train"))
    return report


def calibrate_clusters(
    spark: SparkSession,
    layout: Layout,
    benign: str | None = None,
    name: str = "clusters_v1",
    probabilities: Sequence[float] = K.QUANTILES,
    points: int = K.GRID_POINTS,
    rel_err: float = K.QUANTILE_ERROR,
    folds: int | None = None,
) -> dict:
    """Choose the threshold on the labelled training rows and store it.

    The scores are written once and ranked once; threshold grid and AUC are sums over the ranking.
    The model has seen the benign training rows, whose distances are thus a little short. With ``folds``, each
    row is scored by clusters fitted, with the stored model's parameters, on the benign rows of the other folds.
    Benign and other rows of each fold are written to folders of their own, so that a fit reads no more than its rows.
    """
    benign, parts = benign or benign_label(layout), None
    train = read_table(spark, layout("processed", "train"))
    if folds is None:
        scores = score(load_model(layout("models", name)), train, benign)
    else:
        trained = read_values(spark, layout("reports", f"{name}_train"))
        params = {p: trained.get(p, default) for p, default in K.CLUSTERS.items()}
        is_benign = F.coalesce(F.col(K.LABEL) == benign, F.lit(False)).cast("int").alias("benign")
        fold = fold_of([K.SCALED_VECTOR], folds).alias("fold")
        parts = materialize(train.select(K.LABEL, K.SCALED_VECTOR, is_benign, fold), "folds", by=["fold", "benign"])
        scores = cross_fitted(
            parts,
            lambda rows: fit_kmeans(rows.where(F.col("benign") == 1), **params),
            lambda model, rows: score(model, rows, benign),
            folds,
        )
    write_table(scores.select(K.SCORE, K.TRUTH), layout("scores", f"{name}_calibration"))
    if parts is not None:
        discard(parts)
    scored = read_table(spark, layout("scores", f"{name}_calibration"))
    quantiles = score_quantiles(scored.where(F.col(K.TRUTH) == 0), K.SCORE, probabilities, rel_err)
    found = {r["probability"]: r["quantile"] for r in quantiles.collect()}
    given = spark.createDataFrame(sorted(found.items()), "probability double, quantile double")
    ranking = rank_truth(scored)
    best = best_threshold(ranked_grid(ranking, threshold_candidates(given, points))).first()
    report = {
        "threshold_optimal": best["threshold"],
        "f1_at_threshold": best["f1"],
        **{c: best[c] for c in ("precision", "recall", "fpr")},
        "auc_roc": ranking.agg(auc_expr().alias("auc_roc")).first()["auc_roc"],
        **{f"percentile_{f'{p:g}'[2:].ljust(2, '0')}": q for p, q in sorted(found.items())},
        "calibration_records": sum(best[c] for c in ("tp", "fp", "fn", "tn")),
        "calibration_folds": folds,
    }
    write_values(spark, report, layout("reports", f"{name}_threshold"))
    return report


def evaluate_clusters(
    spark: SparkSession, layout: Layout, benign: str | None = None, name: str = "clusters_v1"
) -> dict:
    """Score the test rows, store them, and report on the stored scores."""
    model = load_model(layout("models", name))
    threshold = read_values(spark, layout("reports", f"{name}_threshold"))["threshold_optimal"]
    test = read_table(spark, layout("processed", "test"))
    flagged = score(model, test, benign or benign_label(layout)).withColumn(
        K.FLAG, flag_anomaly(F.col(K.SCORE), threshold)
    )
    start = time.time()
    write_table(flagged, layout("scores", name), STORED)
    seconds = time.time() - start
    stored = read_table(spark, layout("scores", name))
    binary = evaluate_at_threshold(stored, threshold).first().asDict()
    rows = stored.count()
    labels = StringIndexerModel.load(layout("models", "indexer")).labels  # those of training
    known = spark.createDataFrame([(label,) for label in labels], f"{K.LABEL} string")
    report = {
        "threshold_used": threshold,
        "binary": {k: v for k, v in binary.items() if k != "threshold"},
        "per_class_distribution": [
            r.asDict() for r in score_by_class(stored, K.LABEL).orderBy(K.LABEL).collect()
        ],
        "unseen_classes_analysis": [
            r.asDict() for r in unseen_detection(known, stored, K.LABEL, K.FLAG, K.SCORE).orderBy(K.LABEL).collect()
        ],
        "system_metrics": run_figures(rows, seconds, test.rdd.getNumPartitions()),
    }
    write_values(spark, report, layout("reports", f"{name}_test"))
    return report


def optimise_clusters(
    spark: SparkSession,
    layout: Layout,
    benign: str | None = None,
    base: str = "clusters_v1",
    name: str = "clusters_optimised",
    grid: Sequence[Mapping] = K.CLUSTER_GRID,
    fraction: float | None = None,
) -> dict:
    """Search (on all benign rows, or on a sample of a given fraction), refit the chosen configuration on all benign rows, calibrate and evaluate it,
    and set it against the base model."""
    benign = benign or benign_label(layout)
    rows = benign_rows(spark, layout, benign)
    results = search_kmeans(rows, grid, fraction)
    best = select_model(results)
    chosen = best.first()
    params = {"k": chosen["k"], "max_iter": chosen["max_iter"], "tol": chosen["tol"]}
    start = time.time()
    model = refit_kmeans(rows, best)
    trained = fit_report(model, rows, time.time() - start, params)
    save_model(model, layout("models", name))
    write_values(spark, trained, layout("reports", f"{name}_train"))
    calibrate_clusters(spark, layout, benign, name)
    evaluate_clusters(spark, layout, benign, name)
    report = {
        "base_model": model_report(spark, layout, base),
        "optimized_model": model_report(spark, layout, name),
        "comparison": compare_reports(spark, model_report(spark, layout, base), model_report(spark, layout, name)),
        "search_grid": [r.asDict() for r in results.orderBy("position").collect()],  # one row per configuration
        "sample_fraction": fraction,
    }
    write_values(spark, report, layout("reports", f"{name}_comparison"))
    return report


def model_report(spark: SparkSession, layout: Layout, name: str) -> dict:
    """The compared figures of one model; None where it was never trained or evaluated."""
    trained = read_values(spark, layout("reports", f"{name}_train"))
    tested = read_values(spark, layout("reports", f"{name}_test"))
    binary = tested.get("binary", {})
    return {
        "hyperparameters": {p: trained.get(p, K.CLUSTERS[p]) for p in K.CLUSTERS},
        "silhouette": trained.get("silhouette_score"),
        "wssse": trained.get("wssse"),
        "auc_roc": binary.get("auc_roc"),
        "binary_f1": binary.get("f1"),
        "fpr": binary.get("fpr"),
        "binary_accuracy": binary.get("accuracy"),
        "calibrated_threshold": tested.get("threshold_used"),
        "training_time_s": trained.get("training_time_seconds"),
    }
