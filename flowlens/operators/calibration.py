"""Choosing the anomaly threshold on labelled data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.functions.predicates import levels_below
from flowlens.operators.evaluation import with_binary_metrics
from flowlens.operators.ranking import score_quantiles

#: Models that cross-fitting fits at the same time.
FITS_AT_ONCE = 3


def threshold_candidates(quantiles: DataFrame, points: int = K.GRID_POINTS) -> DataFrame:
    """The quantiles and evenly spaced points from the lowest to the highest, without repeats."""
    ends = quantiles.agg(
        F.min_by("quantile", "probability").alias("lo"),
        F.max_by("quantile", "probability").alias("hi"),
        F.collect_list("quantile").alias("given"),  # one entry per requested probability
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(float(points - 1))
    spaced = F.transform(
        F.sequence(F.lit(0), F.lit(points - 1)),
        lambda i: F.when(i == points - 1, F.col("hi")).otherwise(i * step + F.col("lo")),
    )
    return ends.select(
        F.explode(F.array_sort(F.array_distinct(F.concat("given", spaced)))).alias("threshold")
    ).where(F.col("threshold").isNotNull())


def calibrate_grid(
    df: DataFrame, thresholds: DataFrame | Sequence[float], score: str = K.SCORE, truth: str = K.TRUTH
) -> DataFrame:
    """Confusion counts and binary metrics of every candidate threshold, from one pass over the rows."""
    counts = {"pos": F.count_if(F.col(truth) == 1), "neg": F.count_if(F.col(truth) == 0)}
    return _grid(df, thresholds, score, counts)


def ranked_grid(ranking: DataFrame, thresholds: DataFrame | Sequence[float]) -> DataFrame:
    """The same from a ranking (``rank_truth``), which has one row per distinct score."""
    return _grid(ranking, thresholds, "score", {"pos": F.sum("pos"), "neg": F.sum("neg")})


def _grid(df: DataFrame, thresholds: DataFrame | Sequence[float], score: str, totals: Mapping[str, Column]) -> DataFrame:
    """
    Each row only needs the number of candidates its score exceeds. The table collapses map-side to
    one row per such number, and sums from the top of that short table give all candidates.
    """
    if isinstance(thresholds, DataFrame):
        thresholds = [r[0] for r in thresholds.collect()]
    cuts = sorted({float(t) for t in thresholds})
    level = levels_below(F.col(score), cuts)
    counts = (
        df.where(F.col(score).isNotNull())
        .groupBy(level.alias("level"))
        .agg(*[total.alias(name) for name, total in totals.items()])
    )
    steps = df.sparkSession.createDataFrame(
        [(i, cuts[i - 1] if i else None) for i in range(len(cuts) + 1)], "level int, threshold double"
    )
    # counts has at most one row per level, so broadcasting it is safe at any size of the data
    full = steps.join(F.broadcast(counts), "level", "left").na.fill(0, ["pos", "neg"])
    above = Window.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.orderBy(F.desc("level")).rowsBetween(1, Window.unboundedFollowing)
    cells = full.select(
        "threshold",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.coalesce(F.sum("pos").over(below), F.lit(0)).alias("fn"),
        F.coalesce(F.sum("neg").over(below), F.lit(0)).alias("tn"),
    )
    return with_binary_metrics(cells.where(F.col("threshold").isNotNull()))


def best_threshold(grid: DataFrame) -> DataFrame:
    """Highest F1, then lowest false-positive rate, then lowest threshold."""
    return grid.orderBy(F.desc("f1"), F.asc("fpr"), F.asc("threshold")).limit(1)


def calibrate(
    df: DataFrame,
    score: str = K.SCORE,
    truth: str = K.TRUTH,
    probabilities: Sequence[float] = K.QUANTILES,
    points: int = K.GRID_POINTS,
    rel_err: float = K.QUANTILE_ERROR,
) -> DataFrame:
    """The best threshold over candidates taken from the benign scores: one row."""
    benign = df.where(F.col(truth) == 0)
    candidates = threshold_candidates(score_quantiles(benign, score, probabilities, rel_err), points)
    return best_threshold(calibrate_grid(df, candidates, score, truth))


def fold_of(cols: Sequence[Column | str], folds: int) -> Column:
    """The fold of a row, from its own values: copies of a row share a fold, whatever the partitions or the run."""
    return F.pmod(F.xxhash64(*cols), F.lit(folds)).cast("int")


def cross_fitted(
    df: DataFrame,
    fit: Callable[[DataFrame], Any],
    apply: Callable[[Any, DataFrame], DataFrame],
    folds: int,
    fold: str = "fold",
) -> DataFrame:
    """All rows, each scored by a model that never saw it: one fitted without the row's fold.

    ``fit`` gets the rows of the other folds and ``apply`` the model and the rows of its fold. A grid over the
    result has each candidate's confusion counts added over the folds. Rows whose fold is missing or not in
    0 .. folds - 1 have no such model and are an error. Give a written table: it is read twice per fold. Up to
    ``FITS_AT_ONCE`` models are fitted at the same time.
    """
    if folds < 2:
        raise ValueError("cross-fitting needs two folds or more")
    f = F.col(fold)
    stray = df.where(f.isNull() | (f < 0) | (f >= folds)).limit(1).count()
    if stray:
        raise ValueError(f"rows whose {fold} is not in 0 .. {folds - 1}")

    def part(i: int) -> DataFrame:
        return apply(fit(df.where(f != i)), df.where(f == i))

    with ThreadPool(min(folds, FITS_AT_ONCE)) as pool:
        parts = pool.map(inheritable_thread_target(df.sparkSession)(part), range(folds), chunksize=1)
    return reduce(DataFrame.unionByName, parts)
