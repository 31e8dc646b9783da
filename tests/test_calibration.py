import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.operators import ranking as ranking_ops
from flowlens.operators.calibration import (
    best_threshold,
    calibrate,
    calibrate_grid,
    cross_fitted,
    fold_of,
    ranked_grid,
    threshold_candidates,
)
from flowlens.operators.evaluation import evaluate_at_threshold, report_at
from flowlens.operators.ranking import score_quantiles
from flowlens.queries.registry import dirty
from flowlens.workspace import materialize

PROBS = [0.90, 0.95, 0.97, 0.99, 0.999]


def rows(n=3000, seed=5):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        t = int(rng.random() < 0.1)
        out.append((rng.expovariate(0.5) + 4 * t * rng.random() if rng.random() > 0.3 else 1.0, t))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "score double, truth int")


def brute(data, t):
    tp = sum(s > t and y == 1 for s, y in data)
    fp = sum(s > t and y == 0 for s, y in data)
    fn = sum(s <= t and y == 1 for s, y in data)
    tn = sum(s <= t and y == 0 for s, y in data)
    return tp, fp, fn, tn


def test_candidates_follow_linspace(spark):
    data = rows()
    q = score_quantiles(frame(spark, [d for d in data if d[1] == 0]), "score", PROBS, rel_err=0)
    given = [r.quantile for r in q.orderBy("probability").collect()]
    want = sorted(set(given) | set(np.linspace(given[0], given[-1], 20).tolist()))
    assert [r.threshold for r in threshold_candidates(q).collect()] == want


def test_candidates_of_equal_quantiles(spark):
    q = spark.createDataFrame([(p, 2.0) for p in PROBS], "probability double, quantile double")
    assert [r.threshold for r in threshold_candidates(q).collect()] == [2.0]


def test_grid_matches_one_count_per_candidate(spark):
    data = rows()
    cuts = [0.0, 1.0, 1.5, 2.0, 2.0, 3.7, 5.0, 100.0]
    grid = {r.threshold: (r.tp, r.fp, r.fn, r.tn) for r in calibrate_grid(frame(spark, data), cuts, "score", "truth").collect()}
    assert grid == {t: brute(data, t) for t in set(cuts)}


def test_grid_without_rows(spark):
    grid = calibrate_grid(frame(spark, []), [1.0, 2.0], "score", "truth").collect()
    assert [(r.tp, r.fp, r.fn, r.tn, r.f1) for r in grid] == [(0, 0, 0, 0, 0.0)] * 2


def test_many_candidates(spark):
    data = rows(400)
    cuts = [i / 50 for i in range(500)]
    grid = {r.threshold: (r.tp, r.fp, r.fn, r.tn) for r in calibrate_grid(frame(spark, data), cuts, "score", "truth").collect()}
    assert grid == {t: brute(data, t) for t in cuts}


def test_best_is_at_least_every_candidate(spark):
    data = rows()
    df = frame(spark, data)
    best = calibrate(df, "score", "truth", rel_err=0).first()
    q = score_quantiles(df.where("truth = 0"), "score", PROBS, rel_err=0)
    grid = calibrate_grid(df, threshold_candidates(q), "score", "truth").collect()
    assert best.f1 == max(r.f1 for r in grid)
    first = min((-r.f1, r.fpr, r.threshold) for r in grid)
    assert (-best.f1, best.fpr, best.threshold) == first


def test_ties_prefer_low_fpr_then_low_threshold(spark):
    grid = spark.createDataFrame(
        [(3.0, 0.5, 0.2), (2.0, 0.5, 0.1), (1.0, 0.5, 0.1), (0.5, 0.4, 0.0)], ["threshold", "f1", "fpr"]
    )
    assert best_threshold(grid).first().threshold == 1.0


def test_nan_is_an_anomaly_and_null_is_not_counted(spark):
    df = frame(spark, [(float("nan"), 1), (None, 1), (1.0, 0)])
    row = calibrate_grid(df, [2.0], "score", "truth").first()
    assert (row.tp, row.fp, row.fn, row.tn) == (1, 0, 0, 1)
    assert row.f1 == pytest.approx(1.0)


@pytest.mark.parametrize("ranges", [None, 3])
def test_a_ranking_gives_what_the_rows_give(spark, ranges):
    rnd = random.Random(4)
    values = [(rnd.choice([None, float("nan"), float(rnd.randint(0, 40)) / 4]), rnd.choice([0, 0, 0, 1, None])) for _ in range(400)]
    df = spark.createDataFrame(values, "score double, truth int")
    ranking = ranking_ops.rank_truth(df, "score", "truth", ranges)
    exact = ranking_ops.score_quantiles(df.where("truth = 0"), "score", [0.0, 0.5, 0.9, 1.0], rel_err=0)
    assert ranking_ops.ranked_quantiles(ranking, [0.0, 0.5, 0.9, 1.0]).collect() == exact.collect()
    cuts = [0.0, 2.5, 2.6, 9.0]
    assert ranked_grid(ranking, cuts).collect() == calibrate_grid(df.where("truth is not null"), cuts, "score", "truth").collect()
    for cut in cuts:
        assert report_at(ranking, cut).collect() == evaluate_at_threshold(df, cut, "score", "truth").collect()


def test_cross_fitted_models_never_see_their_rows(spark):
    df = spark.createDataFrame([(i, i % 3, float(i * i)) for i in range(30)], "id int, fold int, x double")

    def fit(rows):
        return sorted(r.id for r in rows.collect())

    def apply(seen, rows):
        return rows.withColumn("seen", F.col("id").isin(seen)).withColumn("n", F.lit(len(seen)))

    got = cross_fitted(df, fit, apply, 3).collect()
    assert sorted(r.id for r in got) == list(range(30)) and not any(r.seen for r in got) and {r.n for r in got} == {20}
    for bad in (None, -1, 3):
        stray = df.union(spark.createDataFrame([(99, bad, 1.0)], df.schema))
        with pytest.raises(ValueError, match="fold"):
            cross_fitted(stray, fit, apply, 3)
    with pytest.raises(ValueError, match="two"):
        cross_fitted(df, fit, apply, 1)


def test_copies_share_a_fold(spark):
    df = spark.createDataFrame([(i % 50, None if i % 5 else 1.0) for i in range(200)], "a int, b double")
    folds = df.select("a", fold_of(["a", "b"], 4).alias("fold")).distinct()
    assert folds.count() == 50 and {r.fold for r in folds.collect()} == {0, 1, 2, 3}


def test_folds_are_fitted_at_the_same_time(spark):
    """No model waits for another: each fit goes on only once the others have begun."""
    begun = threading.Barrier(3, timeout=30)
    rows = spark.range(9).select("id", (F.col("id") % 3).cast("int").alias("fold"))

    def fit(others):
        begun.wait()
        return others.count()

    scored = cross_fitted(rows, fit, lambda n, own: own.withColumn("others", F.lit(n)), 3)
    assert sorted((r.id, r.others) for r in scored.collect()) == [(i, 6) for i in range(9)]


def test_a_filter_on_folder_columns_opens_their_folders_only(spark):
    rows = spark.range(12).select("id", (F.col("id") % 3).cast("int").alias("fold"), (F.col("id") % 2).cast("int").alias("benign"))
    written = materialize(rows, "folds", by=["fold", "benign"])
    assert sorted(written.select("id", "fold", "benign").collect()) == rows.collect() and written.schema["fold"].dataType == rows.schema["fold"].dataType
    some = written.where((F.col("fold") != 1) & (F.col("benign") == 1)).select("id", F.input_file_name().alias("file")).collect()
    assert sorted(r.id for r in some) == [3, 5, 9, 11]
    assert {tuple(r.file.split("/")[-3:-1]) for r in some} == {("fold=0", "benign=1"), ("fold=2", "benign=1")}


def test_dirty_rows_are_read_once(spark, sf):
    rows = dirty(spark, sf)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    base = spark.read.parquet(f"{sf}/lineitem.parquet")
    assert rows.count() == base.count() + base.where("l_partkey % 20 = 0").count()
