"""Running counts over a score, and what follows from them: exact quantiles, ROC curve, AUC.

A score column of a large table has a total order that no single task should see. Equal scores are
collapsed first (a score shared by a third of all rows becomes one row map-side) and written once, the distinct
scores are cut into ranges of similar size, sums run inside each range, and the totals of the
ranges before it are added from a table with one row per range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.workspace import materialize

SCORES_PER_RANGE = 1 << 20


def _range_edges(cells: DataFrame, ranges: int | None) -> list[float]:
    """The borders of ranges that each hold about ``SCORES_PER_RANGE`` distinct scores, or of ``ranges`` ranges.

    ``cells`` has one row per distinct score and is a written table, so that counting it reads no data and its
    quantiles are those of the distinct scores, however many rows share one.
    """
    ranges = ranges or -(-cells.count() // SCORES_PER_RANGE)
    steps = [i / ranges for i in range(1, ranges)]
    cuts = cells.approxQuantile("score", steps, 0.5 / ranges) if steps else []
    inner = sorted({c for c in cuts if abs(c) != float("inf")}) or [0.0]
    return [-float("inf"), *inner, float("inf")]


def running_counts(
    df: DataFrame,
    score: str,
    counts: Mapping[str, Column],
    descending: bool = True,
    ranges: int | None = None,
) -> DataFrame:
    """One row per distinct score with, for each count, its sum at that score (``name``), up to and
    including that score (``cum_name``) and over the whole table (``all_name``).

    NULL scores are left out. NaN is the greatest score.
    """
    scored = df.where(F.col(score).isNotNull()).select(
        F.col(score).cast("double").alias("score"), *[c.cast("long").alias(n) for n, c in counts.items()]
    )
    cells = materialize(scored.groupBy("score").agg(*[F.sum(n).alias(n) for n in counts]), "scores")
    edges = _range_edges(cells, ranges)
    ranged = Bucketizer(splits=edges, inputCol="score", outputCol="range", handleInvalid="keep").transform(cells)

    def order(col: str) -> Column:
        return F.col(col).desc() if descending else F.col(col).asc()

    totals = ranged.groupBy("range").agg(*[F.sum(n).alias(f"sum_{n}") for n in counts])
    before = Window.orderBy(order("range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "range",
        *[F.coalesce(F.sum(f"sum_{n}").over(before), F.lit(0)).alias(f"off_{n}") for n in counts],
        *[F.sum(f"sum_{n}").over(Window.partitionBy()).alias(f"all_{n}") for n in counts],
    )
    inside = Window.partitionBy("range").orderBy(order("score")).rowsBetween(Window.unboundedPreceding, 0)
    # offsets has at most one row per edge, so broadcasting it is safe at any size of the data
    joined = ranged.join(F.broadcast(offsets), "range")
    return joined.select(
        "score",
        *counts,
        *[(F.sum(n).over(inside) + F.col(f"off_{n}")).alias(f"cum_{n}") for n in counts],
        *[f"all_{n}" for n in counts],
    )


def scores_at(df: DataFrame, score: str, ranks: Mapping[str, Column], ranges: int | None = None) -> DataFrame:
    """One row with the scores at the given 1-based ascending ranks, exactly.

    A rank is an expression of ``all_n``, the number of scored rows.
    """
    running = running_counts(df, score, {"n": F.lit(1)}, descending=False, ranges=ranges)
    return running.agg(
        *[F.min(F.when(F.col("cum_n") >= rank, F.col("score"))).alias(name) for name, rank in ranks.items()]
    )


def score_quantiles(
    df: DataFrame,
    score: str = K.SCORE,
    probabilities: Sequence[float] = K.QUANTILES,
    rel_err: float = K.QUANTILE_ERROR,
    ranges: int | None = None,
) -> DataFrame:
    """(probability, quantile) rows; NaN and NULL scores do not count.

    ``rel_err=0`` is exact. Otherwise the quantiles come from summaries merged in a tree, which is
    one pass and a small result at any size of the data.
    """
    spark = df.sparkSession
    scores = df.where(~F.isnan(score)).select(F.col(score).cast("double").alias("score"))
    if rel_err:
        found = scores.approxQuantile("score", [float(p) for p in probabilities], rel_err)
        rows = [(float(p), q) for p, q in zip(probabilities, found or [None] * len(probabilities))]
        return spark.createDataFrame(rows, "probability double, quantile double")
    ranks = {
        f"q{i}": F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * F.col("all_n")))
        for i, p in enumerate(probabilities)
    }
    entries = [
        F.struct(F.lit(float(p)).alias("probability"), F.col(f"q{i}").alias("quantile"))
        for i, p in enumerate(probabilities)
    ]
    return scores_at(scores, "score", ranks, ranges).select(F.inline(F.array(*entries)))


def nearest_rank(
    df: DataFrame, col: str, percents: Sequence[int] = K.SLA_PERCENTILES, ranges: int | None = None
) -> DataFrame:
    """One row of percentiles ``p<n>``: the value at position ``floor(n * p / 100)``, counted from 0
    and limited to the last one."""
    ranks = {
        f"p{p}": F.least(F.col("all_n"), F.floor(F.col("all_n") * p / 100) + 1) for p in percents
    }
    return scores_at(df, col, ranks, ranges)


def truth_counts(truth: str) -> dict[str, Column]:
    """Positives and negatives of a 0/1 truth column; NULL truth counts as neither."""
    return {
        "pos": F.when(F.col(truth) == 1, 1).otherwise(0),
        "neg": F.when(F.col(truth) == 0, 1).otherwise(0),
    }


def roc_curve(df: DataFrame, score: str = K.SCORE, truth: str = K.TRUTH, ranges: int | None = None) -> DataFrame:
    """One point per distinct score: counts and rates of rows at or above it."""
    running = running_counts(df, score, truth_counts(truth), ranges=ranges)
    return running.select(
        "score",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        F.when(F.col("all_pos") > 0, F.col("cum_pos") / F.col("all_pos")).otherwise(0.0).alias("tpr"),
        F.when(F.col("all_neg") > 0, F.col("cum_neg") / F.col("all_neg")).otherwise(0.0).alias("fpr"),
    )


def rank_truth(df: DataFrame, score: str = K.SCORE, truth: str = K.TRUTH, ranges: int | None = None) -> DataFrame:
    """The ranking of a score table, written once: calibration, reports and AUC are sums over it."""
    return materialize(running_counts(df, score, truth_counts(truth), ranges=ranges), "ranking")


def ranked_quantiles(ranking: DataFrame, probabilities: Sequence[float] = K.QUANTILES) -> DataFrame:
    """(probability, quantile) rows of the benign scores, exactly, from a ranking. NaN scores do not count."""
    known = ranking.where(~F.isnan("score") & (F.col("neg") > 0))
    # the ranking runs from the top: what is not above a score is at or below it
    upto = F.col("all_neg") - F.col("cum_neg") + F.col("neg")
    strange = ranking.where(F.isnan("score")).agg(F.coalesce(F.sum("neg"), F.lit(0)).alias("strange"))
    of_all = (F.col("all_neg") - F.lit(strange.first()["strange"])).cast("double")
    entries = [
        F.struct(
            F.lit(float(p)).alias("probability"),
            F.min(F.when(upto >= F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * of_all)), F.col("score"))).alias("quantile"),
        )
        for p in probabilities
    ]
    return known.agg(F.array(*entries).alias("q")).select(F.inline("q"))


def auc_expr() -> Column:
    """Area under the ROC curve as an aggregate over ``running_counts(truth_counts)``.

    Each negative is beaten by the positives above it and by half of those with the same score.
    NULL when one of the two classes is empty.
    """
    beaten = F.col("neg") * (F.col("cum_pos") - F.col("pos") + F.col("pos") / 2)
    pairs = F.max("all_pos").cast("double") * F.max("all_neg")
    return F.when(pairs > 0, F.sum(beaten) / pairs)


def auc(df: DataFrame, score: str = K.SCORE, truth: str = K.TRUTH, ranges: int | None = None) -> DataFrame:
    """One row ``auc_roc``, exact and tie-aware."""
    return running_counts(df, score, truth_counts(truth), ranges=ranges).agg(auc_expr().alias("auc_roc"))
