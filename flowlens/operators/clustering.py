"""KMeans on scaled vectors, distance to the assigned centroid, clustering summaries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from flowlens import conventions as K
from flowlens.functions.vectors import euclidean
from flowlens.operators.joins import sized

#: Doubles that a task holds at once per temporary while it looks for the nearest centroids.
BLOCK_DOUBLES = 1 << 20


def as_array(df: DataFrame, vec: str) -> Column:
    """The vector column as an array of doubles, whichever way it is stored."""
    if isinstance(df.schema[vec].dataType, ArrayType):
        return F.col(vec).cast("array<double>")
    return vector_to_array(vec)


def as_vector(df: DataFrame, vec: str) -> Column:
    if isinstance(df.schema[vec].dataType, ArrayType):
        return array_to_vector(F.col(vec).cast("array<double>"))
    return F.col(vec)


def fit_kmeans(
    df: DataFrame,
    k: int = K.CLUSTERS["k"],
    max_iter: int = K.CLUSTERS["max_iter"],
    tol: float = K.CLUSTERS["tol"],
    seed: int = K.SEED,
    vec: str = K.SCALED_VECTOR,
    cluster: str = K.CLUSTER,
) -> PipelineModel:
    """KMeans with parallel initialisation. Give it benign rows only; read them from a written table
    or persist them, since every iteration passes over them."""
    kmeans = KMeans(
        k=k, maxIter=max_iter, tol=tol, seed=seed, initMode="k-means||", distanceMeasure="euclidean",
        featuresCol=vec, predictionCol=cluster,
    )
    return Pipeline(stages=[kmeans]).fit(df)


def centroid_table(spark: SparkSession, model: PipelineModel | KMeansModel, cluster: str = K.CLUSTER) -> DataFrame:
    """One row per centroid of a fitted model."""
    kmeans = model.stages[-1] if isinstance(model, PipelineModel) else model
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(kmeans.clusterCenters())]
    return spark.createDataFrame(rows, f"{cluster} int, centroid array<double>")


def mean_centroids(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """The mean vector of each cluster, from one aggregate with partial means per task."""
    mean = vector_to_array(Summarizer.mean(as_vector(df, vec)))
    return df.groupBy(cluster).agg(mean.alias("centroid"))


def centroid_side(centroids: DataFrame, cluster: str = K.CLUSTER) -> DataFrame:
    """Centroids ready to be joined, of a size that the planner knows."""
    return sized(centroids.select(cluster, "centroid"))


def distance_to_side(df: DataFrame, side: DataFrame, vec: str, cluster: str, out: str) -> DataFrame:
    joined = df.withColumn("__x", as_array(df, vec)).join(side, cluster, "left")
    return joined.withColumn(out, euclidean("__x", "centroid")).drop("__x", "centroid")


def distance_to_centroid(
    df: DataFrame, centroids: DataFrame, vec: str = K.SCALED_VECTOR, cluster: str = K.CLUSTER, out: str = K.SCORE
) -> DataFrame:
    """Euclidean distance of each row to the centroid it is assigned to; NULL for an unknown cluster or where
    the lengths differ."""
    return distance_to_side(df, centroid_side(centroids, cluster), vec, cluster, out)


def nearest_centroids(x: np.ndarray, ids: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the id of the nearest centroid (the smallest of equals) and its squared distance.

    ``ids`` ascend. A matrix product of a block of rows and a block of centroids tells roughly; the centroids
    it can't tell from the nearest of its block are measured by the direct difference.
    """
    best, place = np.full(len(x), np.inf), np.zeros(len(x), dtype=np.int64)
    side = max(1, int(BLOCK_DOUBLES**0.5))
    norms = (centers**2).sum(axis=1)
    for low in range(0, len(x), side):
        rows = x[low : low + side]
        square = (rows**2).sum(axis=1)
        for at in range(0, len(centers), side):
            block = centers[at : at + side]
            rough = norms[at : at + side] - 2 * rows @ block.T
            slack = 1e-9 * (square + norms[at : at + side].max()) + 1e-300
            r, c = np.nonzero(rough <= (rough.min(axis=1) + slack)[:, None])
            for start in range(0, len(r), side):
                own, other = r[start : start + side], c[start : start + side]
                exact = ((rows[own] - block[other]) ** 2).sum(axis=1)
                order = np.lexsort((other, exact, own))
                first = order[np.append(True, np.diff(own[order]) != 0)]
                nearer = first[exact[first] < best[low + own[first]]]
                best[low + own[nearer]], place[low + own[nearer]] = exact[nearer], at + other[nearer]
    return ids[place], best


def assign_centroid(
    df: DataFrame, centroids: DataFrame, vec: str = K.SCALED_VECTOR, cluster: str = K.CLUSTER, out: str = K.SCORE
) -> DataFrame:
    """Nearest centroid of each row and the distance to it, for a table of centroids.

    A fitted KMeans model does this with ``transform``. For centroids that come as a table this is block-wise
    matrix products per Arrow batch; array functions need a boxed call per component and centroid, about seven
    times as slow when measured. Of equally near centroids the smallest id wins. A row without a vector, or
    with one of another length than the centroids', gets no cluster. The centroids are a model: all of them go
    to every task, like those of a fitted KMeans, but rows and centroids are compared in blocks.
    """
    rows = centroids.select(cluster, "centroid").where(F.col("centroid").isNotNull()).orderBy(cluster).collect()
    lengths = {len(r[1]) for r in rows}
    if len(lengths) != 1:
        raise ValueError("centroids of one length are needed")
    dim = lengths.pop()
    table = df.sparkSession.sparkContext.broadcast(
        (np.array([r[0] for r in rows], dtype="int64"), np.array([r[1] for r in rows], dtype="float64"))
    )

    @F.pandas_udf("cluster long, distance double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        found = pd.DataFrame({"cluster": pd.array([None] * len(vectors), dtype="Int64"), "distance": np.nan})
        known = vectors.map(lambda v: v is not None and len(v) == dim).to_numpy(dtype=bool)
        if known.any():
            own, squared = nearest_centroids(np.vstack(vectors[known].to_numpy()), *table.value)
            found.loc[known, "cluster"] = own
            found.loc[known, "distance"] = np.sqrt(squared)
        return found

    return (
        df.withColumn("__nearest", nearest(as_array(df, vec)))
        .withColumn(cluster, F.col("__nearest.cluster"))
        .withColumn(out, F.when(F.col("__nearest.cluster").isNotNull(), F.col("__nearest.distance")))
        .drop("__nearest")
    )


def cluster_summary(df: DataFrame, cluster: str = K.CLUSTER, distance: str = K.SCORE) -> DataFrame:
    """Size, within-cluster sum of squared distances and extreme distances per cluster."""
    d = F.col(distance)
    return df.groupBy(cluster).agg(
        F.count("*").alias("size"),
        F.sum(d * d).alias("wssse"),
        F.min(d).alias("min_dist"),
        F.max(d).alias("max_dist"),
    )


def silhouette(df: DataFrame, vec: str = K.SCALED_VECTOR, cluster: str = K.CLUSTER) -> float:
    """Mean silhouette with squared Euclidean distance: cluster totals first, then one pass."""
    rows = df.select(as_vector(df, vec).alias("v"), F.col(cluster).cast("double").alias("c"))
    evaluator = ClusteringEvaluator(
        featuresCol="v", predictionCol="c", metricName="silhouette", distanceMeasure="squaredEuclidean"
    )
    return evaluator.evaluate(rows)
