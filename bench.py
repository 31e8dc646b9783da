"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores. Every query runs
twice into a sink that discards its rows: ``queries`` holds the faster run, ``first_run`` the first.
table, ``models_78_features`` those of clusters over the published number of features.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.ml import Pipeline
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.operators.clustering import centroid_table, distance_to_centroid, fit_kmeans
from flowlens.operators.forest import fit_forest, predict
from flowlens.queries import QUERIES
from flowlens.queries.modelling import ROWS_PER_FILE, prepared_flows
from flowlens.plans.prepare import preparation_stages
from flowlens.queries.registry import BENIGN_FLOW, FLOW_FEATURES, flows
from flowlens.workspace import materialize

HEADLINE = [
    "detect_numeric", "clean_single_pass", "clean_dedup", "clean_audit", "route_split_by_day", "label_index",
    "scale_features", "join_class_weight", "score_quantiles", "threshold_candidates", "calibrate_grid",
    "calibrate_best", "evaluate_at_threshold", "auc_exact", "roc_curve", "binary_metrics", "multiclass_metrics",
    "per_class_metrics", "score_by_class", "unseen_detection", "distance_to_centroid", "assign_centroid",
    "cluster_summary", "silhouette", "sample_hash", "sla_summary", "sla_percentiles", "stream_parse_csv",
    "stream_sink_scores", "stream_batch_summary",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    start = time.time()
    fn()
    return time.time() - start


def wide_figures(spark: SparkSession, sf: str, width: int = 78) -> dict:
    """Clusters over the published number of features: mixtures of the four of ``lineitem``."""
    mixed = [
        (F.col(a) * (1 + i % 7) - F.col(b) * (i % 5)).alias(f"f{i:02d}")
        for i in range(width)
        for a, b in [(FLOW_FEATURES[i % 4], FLOW_FEATURES[(i // 4) % 4])]
    ]
    rows = flows(spark, sf).select("label", *mixed)
    stages = preparation_stages([f"f{i:02d}" for i in range(width)])
    ready = materialize(Pipeline(stages=stages).fit(rows).transform(rows).select(K.LABEL, K.SCALED_VECTOR), "wide", rows_per_file=ROWS_PER_FILE)
    start = time.time()
    clusters = fit_kmeans(ready.where(F.col(K.LABEL) == BENIGN_FLOW))
    trained = time.time() - start
    scored = distance_to_centroid(clusters.transform(ready), centroid_table(spark, clusters))
    n, seconds = ready.count(), min(timed(lambda: drain(scored)) for _ in range(2))
    return {
        "features": width, "rows": n, "kmeans_training_s": round(trained, 2),
        "kmeans_rows_per_s": round(n / seconds), "kmeans_us_per_row": round(seconds / n * 1e6, 3),
    }


def model_figures(spark: SparkSession, sf: str) -> dict:
    """Models of full size on all flows: training time and scoring rate."""
    rows = prepared_flows(spark, sf)
    benign = rows.where(F.col(K.LABEL) == BENIGN_FLOW).select(K.SCALED_VECTOR).persist()
    n = rows.count()
    start = time.time()
    clusters = fit_kmeans(benign)
    kmeans_seconds = time.time() - start
    benign.unpersist()
    start = time.time()
    forest = fit_forest(rows)
    forest_seconds = time.time() - start
    centers = centroid_table(spark, clusters)
    figures = {"rows": n, "kmeans_training_s": round(kmeans_seconds, 2), "forest_training_s": round(forest_seconds, 2)}
    for name, scored in (
        ("kmeans", distance_to_centroid(clusters.transform(rows), centers)),
        ("forest", predict(forest, rows)),
    ):
        seconds = min(timed(lambda: drain(scored)) for _ in range(2))
        figures[f"{name}_rows_per_s"] = round(n / seconds)
        figures[f"{name}_us_per_row"] = round(seconds / n * 1e6, 3)
    return figures


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("flowlens-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    drain(spark.read.parquet(f"{sf}/lineitem.parquet"))
    first, best = {}, {}
    for name in names:
        runs = [timed(lambda: drain(QUERIES[name](spark, sf))) for _ in range(2)]
        first[name] = round(runs[0], 3)
        best[name] = round(min(runs), 3)
    result = {
        "metric": "sum of the headline query times",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "first_run": first,
        "sf": re.sub(r".*sf", "", sf.rstrip("/")),
        "cpus": cpus,
    }
    result["models"] = model_figures(spark, sf)
    result["models_78_features"] = wide_figures(spark, sf)
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
