"""Hyper-parameter search for both models."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.operators.clustering import centroid_table, distance_to_centroid, fit_kmeans, silhouette
from flowlens.operators.evaluation import score_stats
from flowlens.operators import trees
from flowlens.operators.forest import MANY_ROWS, bin_values, features_per_split, fit_forest, forest_cells, running_predictions
from flowlens.operators.sampling import bernoulli_sample, stratified_sample
from flowlens.workspace import discard, materialize

#: From so many nodes in the largest forest on a search grows trees on cells, as Spark's driver handles each node of its learner.
MANY_NODES = 100_000

RESULT_SCHEMA = (
    "position int, k int, max_iter int, tol double, silhouette double, wssse double, "
    "mean_dist double, dist_std double, training_time_s double"
)


def select_model(results: DataFrame, order: str = "position", tol: float = K.SILHOUETTE_TIE) -> DataFrame:
    """The chosen row of a search: a clearly better silhouette wins, a near tie goes to the lower cost.

    The rule compares each row with the best so far, so the order of the rows matters. A result
    table has one row per configuration and is folded as one array.
    """
    row = F.struct(order, *[c for c in results.columns if c != order])
    gathered = results.agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def better(best, new):
        gain = new["silhouette"] - best["silhouette"]
        wins = (gain > F.lit(tol)) | ((F.abs(gain) <= F.lit(tol)) & (new["wssse"] < best["wssse"]))
        return F.when(wins, new).otherwise(best)

    folded = gathered.where(F.size("rows") > 0).select(
        F.aggregate(F.expr("slice(rows, 2, size(rows))"), F.col("rows")[0], better).alias("best")
    )
    return folded.select("best.*")


def search_kmeans(
    benign: DataFrame,
    grid: Sequence[Mapping] = K.CLUSTER_GRID,
    fraction: float | None = None,
    seed: int = K.SEED,
    vec: str = K.SCALED_VECTOR,
) -> DataFrame:
    """Fit every configuration on the same rows; one result row each.

    All rows unless a caller gives a ``fraction`` to sample. Read them from a written table.
    """
    spark = benign.sparkSession
    rows = benign if fraction is None else bernoulli_sample(benign, fraction, seed)
    results = []
    for position, params in enumerate(grid):
        start = time.time()
        model = fit_kmeans(rows, seed=seed, vec=vec, **params)
        seconds = time.time() - start
        assigned = model.transform(rows)
        scored = distance_to_centroid(assigned, centroid_table(spark, model), vec)
        stats = score_stats(scored).first()
        results.append(
            (
                position, params["k"], params["max_iter"], params["tol"], silhouette(assigned, vec),
                model.stages[-1].summary.trainingCost, stats["mean_dist"], stats["std_dist"], round(seconds, 4),
            )
        )
    return spark.createDataFrame(results, RESULT_SCHEMA)


def refit_kmeans(benign: DataFrame, best: DataFrame, seed: int = K.SEED, vec: str = K.SCALED_VECTOR):
    """Fit the chosen configuration on all rows."""
    row = best.first()
    return fit_kmeans(benign, k=row["k"], max_iter=row["max_iter"], tol=row["tol"], seed=seed, vec=vec)


def _scores_by_cells(
    sample: DataFrame, grid: Mapping[str, Sequence], number: int, weight: Column, weight_col: str | None, seed: int, score
) -> dict[tuple, float] | None:
    """The score of every combination on the held-out rows of fold ``number``; None if a task can't hold the cells of the sample.

    The cells are those of the bins of the fold's other rows. Every tree is grown whole by a task and votes on the held-out rows of each
    cell, so neither the driver nor a task holds a forest.
    """
    spark, own = sample.sparkSession, F.col("__fold") == number
    values = bin_values(sample.where(~own))
    per_split = {s: features_per_split(s, len(values)) for s in grid["subset"]}
    if not values or not all(isinstance(n, int) for n in per_split.values()):
        return None
    cells = forest_cells(sample, values, K.SCALED_VECTOR, K.LABEL_INDEX, weight_col, F.when(own, weight))
    cells = materialize(cells, "cells")
    if not trees.fits(cells.count(), len(values)):
        discard(cells)
        return None
    classes = int(cells.agg(F.max("label")).first()[0]) + 1
    jobs = sorted({(d, n) for d in grid["depth"] for n in per_split.values()})
    sizes = sorted(set(grid["trees"]))
    rows = trees.held_out_votes(spark, trees.packed(cells, values, classes), jobs, sizes, seed).collect()  # one per pair of classes
    discard(cells)
    found = {(j, t): score([r[2:] for r in rows if r["job"] == j and r["trees"] == t]) for j in range(len(jobs)) for t in sizes}
    return {(t, d, s): found[jobs.index((d, per_split[s])), t] for t in sizes for d in grid["depth"] for s in grid["subset"]}


def search_forest(
    train: DataFrame,
    grid: Mapping[str, Sequence] = K.FOREST_GRID,
    folds: int = K.FOREST_FOLDS,
    fraction: float = K.SEARCH_FRACTION,
    metric: str = "f1",
    parallelism: int = 2,
    seed: int = K.SEED,
    weight_col: str | None = K.CLASS_WEIGHT,
    weighted_metric: bool = False,
) -> DataFrame:
    """Cross-validate every combination on a stratified sample; one row per combination in grid order.

    The sample is written once with a fold for each row. For each fold, depth and subset one forest is fitted, with
    the most trees of the grid; smaller numbers of trees are its first ones, whose votes are kept while the
    others' are added. Subsets of the same number of features share a forest: with one seed theirs are the same.
    All sizes are scored in one pass, to confusion cells that ``metric`` is computed from;
    it may be any metric of Spark's evaluator that needs no probabilities.

    Forests of ``MANY_NODES`` or on many rows are grown tree by tree on the cells of the sample. There a tree depends on the seed and its
    number only, so that each score is that of a forest fitted for its combination alone.
    """
    spark, sizes = train.sparkSession, sorted(set(grid["trees"]))
    sample = stratified_sample(train, K.LABEL_INDEX, fraction, seed)
    fold = F.least(F.floor(F.rand(seed) * folds), F.lit(folds - 1)).cast("int")
    sample = materialize(sample.withColumn("__fold", fold), "search")
    weight = F.col(weight_col) if weighted_metric and weight_col else F.lit(1.0)
    evaluator = MulticlassClassificationEvaluator(
        labelCol=K.LABEL_INDEX, predictionCol=K.PREDICTION, metricName=metric, weightCol="n"
    )

    def score(counts: list) -> float:
        table = spark.createDataFrame(counts, f"{K.LABEL_INDEX} double, {K.PREDICTION} double, n double") if counts else None
        return evaluator.evaluate(table.coalesce(1)) if counts else float("nan")

    combos = [(t, d, s) for t in grid["trees"] for d in grid["depth"] for s in grid["subset"]]
    if sizes[-1] * 2 ** max(grid["depth"]) >= MANY_NODES or sample.count() >= MANY_ROWS:

        def by_cells(number: int) -> dict[tuple, float] | None:
            return _scores_by_cells(sample, grid, number, weight, weight_col, seed, score)

        with ThreadPool(parallelism) as pool:
            each = pool.map(inheritable_thread_target(spark)(by_cells), range(folds), chunksize=1)
        if None not in each:
            discard(sample)
            return _results(spark, combos, {c: [found[c] for found in each] for c in combos}, folds)

    first = sample.select(F.size(vector_to_array(K.SCALED_VECTOR))).first()
    alike: dict[int | str, list[str]] = {}
    for subset in dict.fromkeys(grid["subset"]):
        alike.setdefault(features_per_split(subset, first[0]) if first else subset, []).append(subset)

    def scores(job: tuple[int, int, list[str]]) -> dict[tuple, float]:
        number, depth, subsets = job
        others = sample.where(F.col("__fold") != number)
        fitted = fit_forest(others, trees=sizes[-1], depth=depth, subset=subsets[0], weight_col=weight_col, seed=seed)
        held, names = running_predictions(fitted.stages[-1], sample.where(F.col("__fold") == number), sizes)
        each = F.explode(F.array(*(F.struct(F.lit(n).alias("trees"), F.col(c).alias(K.PREDICTION)) for n, c in zip(sizes, names))))
        cells = held.select(K.LABEL_INDEX, weight.alias("__w"), each.alias("x")).groupBy("x.trees", K.LABEL_INDEX, f"x.{K.PREDICTION}")
        rows = cells.agg(F.sum("__w").alias("n")).collect()  # a row per size and pair of classes
        found = {}
        for size in sizes:
            own = score([r[1:] for r in rows if r["trees"] == size])
            found |= {(size, depth, subset): own for subset in subsets}
        return found

    jobs = [(n, depth, subsets) for depth in sorted(set(grid["depth"]), reverse=True) for subsets in alike.values() for n in range(folds)]
    totals: dict[tuple, list[float]] = {}
    with ThreadPool(parallelism) as pool:
        for found in pool.imap_unordered(inheritable_thread_target(spark)(scores), jobs):
            for combo, own in found.items():
                totals.setdefault(combo, []).append(own)
    discard(sample)
    return _results(spark, combos, totals, folds)


def _results(spark: SparkSession, combos: Sequence[tuple], totals: Mapping[tuple, Sequence[float]], folds: int) -> DataFrame:
    rows = [(i, int(t), int(d), str(s), sum(totals[t, d, s]) / folds) for i, (t, d, s) in enumerate(combos)]
    return spark.createDataFrame(rows, "position int, trees int, depth int, subset string, avg_metric double")


def best_forest(results: DataFrame) -> DataFrame:
    """The highest average metric, the earliest of equals."""
    return results.orderBy(F.desc("avg_metric"), F.asc("position")).limit(1)


def refit_forest(train: DataFrame, best: DataFrame, **params):
    """Fit the chosen combination on all rows."""
    row = best.first()
    return fit_forest(train, trees=row["trees"], depth=row["depth"], subset=row["subset"], **params)
