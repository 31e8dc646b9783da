"""Distances, clusterings, forests, searches and saved models."""

from __future__ import annotations

import time

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.operators.clustering import (
    assign_centroid,
    centroid_table,
    cluster_summary,
    distance_to_centroid,
    fit_kmeans,
    mean_centroids,
    silhouette,
)
from flowlens.operators.evaluation import run_metrics
from flowlens.operators.features import weighted_training_set
from flowlens.operators.forest import MANY_ROWS, attack_probability, feature_importance, fit_forest, predict
from flowlens.operators.ranking import auc
from flowlens.operators.search import best_forest, search_forest, search_kmeans, select_model
from flowlens.plans.prepare import for_streams, preparation_stages
from flowlens.queries.registry import BENIGN_FLOW, FLOW_FEATURES, flows, query, table, vecs
from flowlens.sources.tables import load_model, save_model
from flowlens.streaming.scoring import Scorer
from flowlens.workspace import materialize, shared_dir

NEAREST_SQL = """SELECT vec_id, cluster_id, sqrt(d2) AS distance, true_cluster FROM (
    SELECT e.vec_id, e.cluster_id AS true_cluster, c.cluster_id, sum((e.x - c.c) * (e.x - c.c)) AS d2,
        row_number() OVER (PARTITION BY e.vec_id ORDER BY sum((e.x - c.c) * (e.x - c.c)), c.cluster_id) AS place
    FROM @elements e JOIN @centroids c ON e.pos = c.pos GROUP BY e.vec_id, e.cluster_id, c.cluster_id) r WHERE place = 1"""
OWN_SQL = """SELECT e.vec_id, e.cluster_id, sqrt(sum((e.x - c.c) * (e.x - c.c))) AS d FROM @elements e
    JOIN @centroids c ON e.pos = c.pos AND e.cluster_id = c.cluster_id GROUP BY e.vec_id, e.cluster_id"""


def class_means(rows):
    return mean_centroids(rows, "x", "cluster_id")


@query("distance_to_centroid", f"SELECT vec_id, cluster_id, round(d, 6) AS distance FROM ({OWN_SQL}) o")
def distance_to_centroid_query(spark, sf):
    rows = vecs(spark, sf)
    scored = distance_to_centroid(rows, class_means(rows), "x", out="distance")
    return scored.select("vec_id", "cluster_id", F.round("distance", 6).alias("distance"))


@query("assign_centroid", f"SELECT vec_id, CAST(cluster_id AS BIGINT) AS cluster_id, round(distance, 6) AS distance FROM ({NEAREST_SQL}) n")
def assign_centroid_query(spark, sf):
    rows = vecs(spark, sf)
    nearest = assign_centroid(rows.drop("cluster_id"), class_means(rows), "x", out="distance")
    return nearest.select("vec_id", "cluster_id", F.round("distance", 6).alias("distance"))


@query(
    "cluster_summary",
    f"""SELECT cluster_id, count(*) AS size, round(sum(d * d), 6) AS wssse, round(min(d), 6) AS min_dist,
    round(max(d), 6) AS max_dist FROM ({OWN_SQL}) o GROUP BY cluster_id""",
)
def cluster_summary_query(spark, sf):
    rows = vecs(spark, sf)
    summary = cluster_summary(distance_to_centroid(rows, class_means(rows), "x"))
    return summary.withColumns({c: F.round(c, 6) for c in ("wssse", "min_dist", "max_dist")})


@query(
    "silhouette",
    """WITH sizes AS (SELECT label AS cluster_id, CAST(count(*) AS DOUBLE) AS n FROM embeddings GROUP BY label),
    norms AS (SELECT vec_id, cluster_id, sum(x * x) AS q FROM @elements GROUP BY vec_id, cluster_id),
    spread AS (SELECT cluster_id, sum(q) AS psi FROM norms GROUP BY cluster_id),
    dots AS (SELECT e.vec_id, c.cluster_id AS other, sum(e.x * c.c) AS dot FROM @elements e
        JOIN @centroids c ON e.pos = c.pos GROUP BY e.vec_id, c.cluster_id),
    gaps AS (SELECT v.vec_id, v.cluster_id, d.other, z.n, v.q + s.psi / z.n - 2 * d.dot AS mean_gap
        FROM norms v JOIN dots d ON v.vec_id = d.vec_id JOIN sizes z ON d.other = z.cluster_id
        JOIN spread s ON s.cluster_id = d.other),
    ab AS (SELECT vec_id, max(CASE WHEN other = cluster_id THEN mean_gap * n / (n - 1) END) AS a,
        min(CASE WHEN other <> cluster_id THEN mean_gap END) AS b FROM gaps GROUP BY vec_id)
    SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM ab""",
)
def silhouette_query(spark, sf):
    """Silhouette of the given labels as clusters."""
    value = silhouette(vecs(spark, sf), "x", "cluster_id")
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


def vectors(spark, sf):
    return vecs(spark, sf).select("vec_id", array_to_vector("x").alias(K.SCALED_VECTOR), "cluster_id")


@query(
    "kmeans_fit",
    "SELECT count(*) AS row_count, TRUE AS at_most_k, TRUE AS consistent FROM embeddings",
)
def kmeans_fit(spark, sf):
    """Clusters fitted on all vectors: their sizes add up, costs lie between those of the extreme distances."""
    rows = materialize(vectors(spark, sf).drop("cluster_id"), "vectors")
    model = fit_kmeans(rows)
    found = cluster_summary(distance_to_centroid(model.transform(rows), centroid_table(spark, model)))
    low, high = (F.col("size") * F.col(c) * F.col(c) for c in ("min_dist", "max_dist"))
    return found.agg(
        F.sum("size").alias("row_count"),
        (F.count("*") <= K.CLUSTERS["k"]).alias("at_most_k"),
        F.bool_and((F.col("wssse") >= low - 1e-9) & (F.col("wssse") <= high + 1e-9)).alias("consistent"),
    )


@query(
    "kmeans_nearest",
    "SELECT count(*) AS row_count, count(*) AS nearest, count(*) AS same_distance FROM embeddings",
)
def kmeans_nearest(spark, sf):
    """The fitted model puts every row into the cluster whose centroid is nearest."""
    rows = materialize(vectors(spark, sf).drop("cluster_id"), "vectors")
    model = fit_kmeans(rows)
    centers = centroid_table(spark, model)
    by_model = distance_to_centroid(model.transform(rows), centers)
    both = assign_centroid(by_model.withColumnsRenamed({K.CLUSTER: "c1", K.SCORE: "d1"}), centers)
    return both.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("c1") == F.col(K.CLUSTER)).alias("nearest"),
        F.count_if(F.abs(F.col("d1") - F.col(K.SCORE)) < 1e-9).alias("same_distance"),
    )


@query(
    "model_roundtrip",
    "SELECT count(*) AS row_count, count(*) AS same_cluster, count(*) AS same_distance FROM embeddings",
)
def model_roundtrip(spark, sf):
    """A saved and reloaded model gives every row the cluster and distance the original gave."""
    rows = materialize(vectors(spark, sf).drop("cluster_id"), "vectors")
    model = fit_kmeans(rows)
    path = shared_dir(spark, "model")
    save_model(model, path)
    again = load_model(path)
    first = distance_to_centroid(model.transform(rows), centroid_table(spark, model))
    both = again.transform(first.withColumnsRenamed({K.CLUSTER: "c1", K.SCORE: "d1"}))
    both = distance_to_centroid(both, centroid_table(spark, again))
    return both.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("c1") == F.col(K.CLUSTER)).alias("same_cluster"),
        F.count_if(F.col("d1") == F.col(K.SCORE)).alias("same_distance"),
    )


GRID_SQL = ", ".join(
    f"({i}, {c['k']}, {c['max_iter']}, CAST({c['tol']} AS DOUBLE))" for i, c in enumerate(K.CLUSTER_GRID)
)


@query(
    "kmeans_search",
    f"""SELECT position, k, max_iter, tol, (SELECT count(*) FROM embeddings) AS row_count, TRUE AS measured,
    1 AS chosen_of_all, TRUE AS not_beaten FROM (VALUES {GRID_SQL}) g(position, k, max_iter, tol)""",
)
def kmeans_search(spark, sf):
    """The published grid on all vectors: each configuration is measured, one is chosen, none clearly beats it."""
    rows = materialize(vectors(spark, sf).drop("cluster_id"), "vectors")
    results = search_kmeans(rows)
    chosen = select_model(results).collect()
    measured = F.col("silhouette").between(-1, 1) & (F.col("wssse") > 0) & (F.col("mean_dist") > 0)
    limit = chosen[0]["silhouette"] + K.SILHOUETTE_TIE * len(K.CLUSTER_GRID)  # each tie may give away a little
    return results.select(
        "position", "k", "max_iter", "tol", F.lit(rows.count()).alias("row_count"), measured.alias("measured"),
        F.lit(len(chosen)).alias("chosen_of_all"), (F.col("silhouette") <= limit).alias("not_beaten"),
    )


CANDIDATES_SQL = """SELECT day(o_orderdate) AS position, avg(o_totalprice) / 1000000 AS silhouette,
    CAST(max(o_orderkey) AS DOUBLE) AS wssse FROM orders GROUP BY 1"""


@query(
    "select_model",
    f"""WITH RECURSIVE ranked AS (SELECT *, row_number() OVER (ORDER BY position) AS i FROM ({CANDIDATES_SQL}) c),
    fold AS (SELECT i, position, silhouette, wssse FROM ranked WHERE i = 1
        UNION ALL SELECT r.i,
            CASE WHEN r.silhouette - f.silhouette > CAST(0.01 AS DOUBLE) OR (abs(r.silhouette - f.silhouette) <= CAST(0.01 AS DOUBLE)
                AND r.wssse < f.wssse) THEN r.position ELSE f.position END,
            CASE WHEN r.silhouette - f.silhouette > CAST(0.01 AS DOUBLE) OR (abs(r.silhouette - f.silhouette) <= CAST(0.01 AS DOUBLE)
                AND r.wssse < f.wssse) THEN r.silhouette ELSE f.silhouette END,
            CASE WHEN r.silhouette - f.silhouette > CAST(0.01 AS DOUBLE) OR (abs(r.silhouette - f.silhouette) <= CAST(0.01 AS DOUBLE)
                AND r.wssse < f.wssse) THEN r.wssse ELSE f.wssse END
        FROM fold f JOIN ranked r ON r.i = f.i + 1)
    SELECT position, round(silhouette, 9) AS silhouette, wssse FROM fold ORDER BY i DESC LIMIT 1""",
)
def select_model_query(spark, sf):
    """The selection rule over one candidate per day of the month, taken in order."""
    results = table(spark, sf, "orders").groupBy(F.dayofmonth("o_orderdate").cast("long").alias("position")).agg(
        (F.avg("o_totalprice") / 1000000).alias("silhouette"),
        F.max("o_orderkey").cast("double").alias("wssse"),
    )
    return select_model(results).withColumn("silhouette", F.round("silhouette", 9))


# --- supervised ---

#: Models pass over their rows many times: these lie in files of so many.
ROWS_PER_FILE = 20_000


_PREPARATIONS: dict[tuple[str, str], PipelineModel] = {}


def fitted_preparation(spark, sf):
    """The stages the plans fit, label index, feature vector and scaling, on all flows; fitted once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PREPARATIONS:
        _PREPARATIONS[key] = Pipeline(stages=preparation_stages(FLOW_FEATURES)).fit(flows(spark, sf))
    return _PREPARATIONS[key]


def prepared_flows(spark, sf):
    ready = fitted_preparation(spark, sf).transform(flows(spark, sf)).select(K.LABEL, K.LABEL_INDEX, K.SCALED_VECTOR)
    return materialize(weighted_training_set(ready), "flows", rows_per_file=ROWS_PER_FILE)


_FORESTS: dict[tuple[str, str], tuple] = {}


def fitted_forest(spark, sf):
    """A forest of the published size on all flows, and these; fitted once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FORESTS:
        rows = prepared_flows(spark, sf)
        _FORESTS[key] = fit_forest(rows), rows
    return _FORESTS[key]


@query(
    "rf_fit_predict",
    "SELECT label, count(*) AS n, TRUE AS at_most_all, TRUE AS is_rate FROM @flows GROUP BY label",
)
def rf_fit_predict(spark, sf):
    """Forest trained and applied on all flows: every row gets a prediction, and right ones are some of them."""
    model, rows = fitted_forest(spark, sf)
    return predict(model, rows).groupBy(K.LABEL).agg(
        F.count(K.PREDICTION).alias("n"),
        (F.count_if(F.col(K.LABEL_INDEX) == F.col(K.PREDICTION)) <= F.count("*")).alias("at_most_all"),
        F.avg(K.FLAG).between(0, 1).alias("is_rate"),
    )


@query(
    "rf_consistent",
    """SELECT label, count(*) AS n, count(*) AS most_probable, count(*) AS proper, count(*) AS flagged_right
    FROM @flows GROUP BY label""",
)
def rf_consistent(spark, sf):
    """Every prediction is the most probable class, probabilities add up to 1, flags follow predictions."""
    model, rows = fitted_forest(spark, sf)
    p = vector_to_array(K.PROBABILITY)
    best = F.array_position(p, F.array_max(p)) - 1
    scored = predict(model, rows)
    return scored.groupBy(K.LABEL).agg(
        F.count("*").alias("n"),
        F.count_if(best == F.col(K.PREDICTION)).alias("most_probable"),
        F.count_if(F.abs(F.aggregate(p, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).alias("proper"),
        F.count_if(F.col(K.FLAG) == (F.col(K.PREDICTION) != 0).cast("int")).alias("flagged_right"),
    )


@query("rf_auc", "SELECT count(*) AS row_count, TRUE AS same FROM lineitem")
def rf_auc(spark, sf):
    """AUC of 1 minus the predicted benign probability equals that of Spark's evaluator without binning."""
    model, rows = fitted_forest(spark, sf)
    scored = materialize(
        attack_probability(predict(model, rows)).select(K.SCORE, F.col(K.TRUTH).cast("double").alias(K.TRUTH)), "scores"
    )
    other = BinaryClassificationEvaluator(rawPredictionCol=K.SCORE, labelCol=K.TRUTH, numBins=0).evaluate(scored)
    same = F.abs(F.col("auc_roc") - F.lit(other)) < 1e-9
    return auc(scored).select(F.lit(scored.count()).alias("row_count"), same.alias("same"))


@query(
    "feature_importance",
    """SELECT feature, TRUE AS adds_up, TRUE AS in_order FROM
    (VALUES ('l_discount'), ('l_extendedprice'), ('l_quantity'), ('l_tax')) f(feature) WHERE EXISTS (FROM lineitem)""",
)
def feature_importance_query(spark, sf):
    """Every feature has an importance, they add up to 1 and come highest first."""
    model, _ = fitted_forest(spark, sf)
    found = feature_importance(spark, model, FLOW_FEATURES, K.TOP_FEATURES).collect()  # one row per feature
    adds_up = abs(sum(r["importance"] for r in found) - 1) < 1e-9
    in_order = [r["importance"] for r in found] == sorted((r["importance"] for r in found), reverse=True)
    rows = [(r["feature"], adds_up, in_order) for r in found]
    return spark.createDataFrame(rows, "feature string, adds_up boolean, in_order boolean")


SEARCHED_SQL = ", ".join(
    f"({i}, {t}, {d}, '{s}')"
    for i, (t, d, s) in enumerate((t, d, s) for t in K.FOREST_GRID["trees"] for d in K.FOREST_GRID["depth"] for s in K.FOREST_GRID["subset"])
)


@query(
    "rf_search",
    f"""SELECT trees, depth, subset, TRUE AS is_score, TRUE AS follows FROM (VALUES {SEARCHED_SQL}) g(position, trees, depth, subset)
    WHERE EXISTS (FROM lineitem)""",
)
def rf_search(spark, sf):
    """Every published combination is cross-validated in three folds; the chosen one has the highest average."""
    results = materialize(search_forest(prepared_flows(spark, sf), parallelism=8), "search")
    best = best_forest(results).first()
    follows = (F.col("avg_metric") < best["avg_metric"]) | (
        (F.col("avg_metric") == best["avg_metric"]) & (F.col("position") >= best["position"])
    )
    return results.select("trees", "depth", "subset", F.col("avg_metric").between(0, 1).alias("is_score"), follows.alias("follows"))


_SCORERS: dict[tuple[str, str], Scorer] = {}


def fitted_scorer(spark, sf, threshold: float = 2.0) -> Scorer:
    """Preparation, forest and clusters of the published sizes, fitted once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SCORERS:
        model, ready = fitted_forest(spark, sf)
        benign = ready.where(F.col(K.LABEL) == BENIGN_FLOW)
        prepared = for_streams(fitted_preparation(spark, sf), FLOW_FEATURES)
        _SCORERS[key] = Scorer(prepared, model, fit_kmeans(benign), threshold, by_cells=ready.count() >= MANY_ROWS)
    return _SCORERS[key]


@query("score_batch", "SELECT label, count(*) AS n, count(*) AS clustered, count(*) AS follows FROM @flows GROUP BY label")
def score_batch(spark, sf):
    """Both fitted models over all flows in one plan; the flag follows the distance."""
    scorer = fitted_scorer(spark, sf)
    follows = F.col("is_anomaly") == (F.col("distanceToCentroid") > scorer.threshold).cast("int")
    return scorer.score(flows(spark, sf)).groupBy(K.LABEL).agg(
        F.count(K.PREDICTION).alias("n"), F.count(K.CLUSTER).alias("clustered"), F.count_if(follows).alias("follows")
    )


@query("run_metrics", "SELECT count(*) AS num_records, TRUE AS consistent FROM embeddings")
def run_metrics_query(spark, sf):
    """Timed distance scoring of all vectors: throughput and cost per row agree with rows and time."""
    rows = vecs(spark, sf)
    centers = class_means(rows)
    seen = Observation("rows")
    scored = distance_to_centroid(rows, centers, "x").observe(seen, F.count("*").alias("n"))
    start = time.time()
    scored.write.format("noop").mode("overwrite").save()
    figures = run_metrics(spark, seen.get["n"], time.time() - start, scored.rdd.getNumPartitions())
    both = F.col("throughput_records_per_second") * F.col("average_latency_us") / 1e6
    return figures.select("num_records", (F.abs(both - 1) < 0.01).alias("consistent"))
