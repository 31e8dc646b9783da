import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.operators import clustering
from flowlens.operators import forest as forest_module
from flowlens.operators import search as search_module
from flowlens.operators.clustering import (
    assign_centroid,
    centroid_table,
    cluster_summary,
    distance_to_centroid,
    fit_kmeans,
    mean_centroids,
    silhouette,
)
from flowlens.operators.forest import (
    attack_probability, bin_values, feature_importance, fit_forest, fit_on_cells, forest, forest_cells, part_of, predict,
    running_predictions, with_draws,
)
from flowlens.operators.sampling import stratified_sample
from flowlens.operators.search import best_forest, refit_kmeans, search_forest, search_kmeans, select_model
from flowlens.sources.tables import load_model, save_model
from flowlens.workspace import materialize


@pytest.fixture(scope="module")
def vecs(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    return df.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias(K.SCALED_VECTOR), "label").persist()


@pytest.fixture(scope="module")
def model(vecs):
    return fit_kmeans(vecs, k=6, max_iter=5)


def test_table_assignment_equals_model(spark, vecs, model):
    centers = centroid_table(spark, model)
    by_model = distance_to_centroid(model.transform(vecs), centers)
    by_table = assign_centroid(vecs, centers)
    both = by_model.select("vec_id", F.col(K.CLUSTER).alias("c1"), F.col(K.SCORE).alias("d1")).join(
        by_table.select("vec_id", F.col(K.CLUSTER).alias("c2"), F.col(K.SCORE).alias("d2")), "vec_id"
    )
    got = both.agg(F.count("*"), F.count_if(F.col("c1") == F.col("c2")), F.max(F.abs(F.col("d1") - F.col("d2")))).first()
    assert got[0] == got[1] == 500
    assert got[2] < 1e-9


def test_summary_equals_training_summary(spark, vecs, model):
    scored = distance_to_centroid(model.transform(vecs), centroid_table(spark, model))
    rows = {r[K.CLUSTER]: r for r in cluster_summary(scored).collect()}
    trained = model.stages[-1].summary
    assert [rows[i]["size"] for i in range(6)] == trained.clusterSizes
    points = vecs.collect()
    centers = np.array(model.stages[-1].clusterCenters())
    gaps = [((r[K.SCALED_VECTOR].toArray() - centers) ** 2).sum(1).min() for r in points]
    assert sum(r.wssse for r in rows.values()) == pytest.approx(sum(gaps), rel=1e-9)


def test_silhouette_matches_definition(spark):
    rng = np.random.default_rng(4)
    points = np.vstack([rng.normal(c, 1.0, (12, 3)) for c in (0, 3, 7)])
    labels = np.repeat([0, 1, 2], 12)
    df = spark.createDataFrame([(p.tolist(), int(c)) for p, c in zip(points, labels)], "x array<double>, c int")
    total = 0.0
    for i, p in enumerate(points):
        gaps = ((points - p) ** 2).sum(1)
        a = gaps[labels == labels[i]].sum() / 11
        b = min(gaps[labels == c].mean() for c in set(labels) - {labels[i]})
        total += (b - a) / max(a, b)
    assert silhouette(df, "x", "c") == pytest.approx(total / len(points), abs=1e-9)


def test_unknown_cluster_and_missing_vector(spark):
    centers = spark.createDataFrame([(0, [0.0, 0.0]), (1, [3.0, 4.0])], "cluster_id int, centroid array<double>")
    df = spark.createDataFrame(
        [(1, [3.0, 4.0], 0), (2, [3.0, 4.0], 1), (3, [1.0, 1.0], 9), (4, None, 0)],
        "i int, x array<double>, cluster_id int",
    )
    got = {r.i: r[K.SCORE] for r in distance_to_centroid(df, centers, "x").collect()}
    assert got == {1: 5.0, 2: 0.0, 3: None, 4: None}
    near = {r.i: (r.cluster_id, r[K.SCORE]) for r in assign_centroid(df.drop("cluster_id"), centers, "x").collect()}
    assert near[1] == near[2] == (1, 0.0)
    assert near[4] == (None, None)
    with pytest.raises(ValueError):
        assign_centroid(df, centers.limit(0), "x")


def test_wide_vectors_use_array_functions(spark):
    df = spark.createDataFrame([([1.0] * 300, 0)], "x array<double>, cluster_id int")
    centers = spark.createDataFrame([(0, [0.0] * 300)], "cluster_id int, centroid array<double>")
    assert distance_to_centroid(df, centers, "x").first()[K.SCORE] == pytest.approx(300**0.5)


def test_mean_centroids(spark):
    df = spark.createDataFrame([([1.0, 2.0], "a"), ([3.0, 6.0], "a"), ([5.0, 5.0], "b")], "x array<double>, c string")
    assert {r.c: r.centroid for r in mean_centroids(df, "x", "c").collect()} == {"a": [2.0, 4.0], "b": [5.0, 5.0]}


RESULTS = "position int, k int, silhouette double, wssse double"


@pytest.mark.parametrize(
    "rows,chosen",
    [
        ([(0, 5, 0.40, 10.0), (1, 6, 0.405, 12.0), (2, 7, 0.42, 9.0)], 2),
        ([(0, 5, 0.42, 9.0), (1, 6, 0.405, 8.0), (2, 7, 0.40, 12.0)], 0),
        ([(0, 5, 0.40, 10.0), (1, 6, 0.405, 9.0), (2, 7, 0.414, 8.0), (3, 8, 0.405, 7.0)], 3),
        ([(0, 5, 0.40, 10.0)], 0),
    ],
)
def test_select_model_is_a_fold_in_order(spark, rows, chosen):
    best = rows[0]
    for r in rows[1:]:
        gain = r[2] - best[2]
        if gain > 0.01 or (abs(gain) <= 0.01 and r[3] < best[3]):
            best = r
    df = spark.createDataFrame(rows, RESULTS).repartition(3)
    got = select_model(df).first()
    assert (got.position, got.k) == (best[0], best[1])
    assert got.position == chosen


def test_select_model_of_nothing(spark):
    assert select_model(spark.createDataFrame([], RESULTS)).count() == 0


def test_search_and_refit_kmeans(spark, vecs):
    grid = [{"k": 2, "max_iter": 3, "tol": 1e-4}, {"k": 4, "max_iter": 3, "tol": 1e-4}]
    results = search_kmeans(vecs, grid, fraction=0.5)
    assert [r.k for r in results.orderBy("position").collect()] == [2, 4]
    best = select_model(results)
    assert len(refit_kmeans(vecs, best).stages[-1].clusterCenters()) == best.first().k


@pytest.fixture(scope="module")
def flows(spark):
    rows = [(float(i % 10), float(i % 7), float(i % 10 > 6) + float(i % 10 > 8)) for i in range(600)]
    df = spark.createDataFrame(rows, ["a", "b", K.LABEL_INDEX])
    return df.withColumn(K.SCALED_VECTOR, array_to_vector(F.array("a", "b"))).withColumn(K.CLASS_WEIGHT, F.lit(1.0)).persist()


def test_forest(spark, flows):
    model = fit_forest(flows, trees=5, depth=4)
    scored = predict(model, flows)
    assert scored.where(F.col("prediction") == F.col(K.LABEL_INDEX)).count() == 600
    assert scored.where(F.col(K.FLAG) != F.col(K.TRUTH)).count() == 0
    p = attack_probability(scored).agg(F.min(K.SCORE), F.max(K.SCORE)).first()
    assert 0 <= p[0] < 0.5 < p[1] <= 1
    ranked = feature_importance(spark, model, ["b", "a"]).collect()
    assert [r.feature for r in ranked] == ["a", "b"]
    assert sum(r.importance for r in ranked) == pytest.approx(1)
    assert feature_importance(spark, model, ["a", "b"], k=1).count() == 1
    again = predict(fit_forest(flows, trees=5, depth=4), flows)
    assert again.select("prediction").exceptAll(scored.select("prediction")).count() == 0


def test_forest_on_cells_counts_every_row(spark, flows, tmp_path):
    wide = flows.withColumn("c", F.col("a") * 100 + F.col("b") * F.col("b") * F.col("b")).withColumn(
        K.SCALED_VECTOR, array_to_vector(F.array("a", "b", "c"))
    )
    values = bin_values(wide)
    assert values[:2] == [[float(i) for i in range(n)] for n in (10, 7)] and 10 < len(values[2]) <= 32
    assert (values[2][0], values[2][-1]) == (0.0, 1116.0)
    rows = [(r.label, r.x, r.n) for r in forest_cells(wide, values, K.SCALED_VECTOR, K.LABEL_INDEX, K.CLASS_WEIGHT).collect()]
    assert len(rows) == len({x[:1] + tuple(x[1]) for x in rows}) == 70 and sum(x[2] for x in rows) == 600
    nearest = lambda v: min(values[2], key=lambda r: (abs(r - v), r))
    assert {tuple(x[1]) for x in rows} == {(r.a, r.b, nearest(r.c)) for r in wide.collect()}

    model = fit_forest(wide, by_cells=True, trees=5, depth=4)
    scored = predict(model, wide)
    assert scored.where(F.col("prediction") == F.col(K.LABEL_INDEX)).count() == 600
    again = predict(fit_forest(wide, by_cells=True, trees=5, depth=4), wide)
    assert again.select("probability").exceptAll(scored.select("probability")).count() == 0
    save_model(model, str(tmp_path / "model"))
    assert len(load_model(str(tmp_path / "model")).stages[0].trees) == 5
    assert fit_on_cells(wide, most=69, trees=2) is None


def test_many_rows_are_fitted_on_their_cells(flows, monkeypatch):
    monkeypatch.setattr(forest_module, "MANY_ROWS", 500)
    chosen = []
    monkeypatch.setattr(forest_module, "fit_on_cells", lambda *a, **k: chosen.append(a[1]))
    assert fit_forest(flows, trees=2, depth=2).stages[0].getNumTrees == 2 and chosen == [150]


def test_draws_of_a_cell_are_those_of_its_rows(spark):
    cells = spark.createDataFrame([(0.0, 2.0, [float(i)], 50) for i in range(40)], "label double, weight double, x array<double>, n long")
    drawn = np.array([[r[f"w{t}"] / 2 for t in range(25)] for r in with_draws(cells, 25, 1).orderBy("x").collect()])
    assert abs(drawn.mean() - 50) < 1 and 40 < drawn.var() < 60  # Poisson(50), not 50 times one draw
    again = with_draws(cells.repartition(3), 25, 1).orderBy("x").collect()
    assert [[r[f"w{t}"] / 2 for t in range(25)] for r in again] == drawn.tolist()


def test_search_forest(flows):
    results = search_forest(flows, {"trees": [2], "depth": [1, 4], "subset": ["sqrt"]}, folds=2, fraction=0.6)
    assert [(r.position, r.depth) for r in results.orderBy("position").collect()] == [(0, 1), (1, 4)]
    assert best_forest(results).first().depth == 4
    weighted = search_forest(
        flows, {"trees": [2], "depth": [2], "subset": ["sqrt"]}, folds=2, fraction=0.6, weighted_metric=True
    )
    assert weighted.first().avg_metric > 0


def test_first_trees_of_a_forest_predict_like_a_forest_of_them(flows):
    model = forest(trees=7, depth=4).fit(flows)
    rows, names = running_predictions(model, flows, [2, 5, 7])
    assert [c for c in rows.columns if c not in flows.columns] == names
    for size, name in zip((2, 5, 7), names):
        part = part_of(flows.sparkSession, model, 0, size).transform(rows)
        assert part.count() == part.where(F.col("prediction") == F.col(name)).count() > 0
    whole = model.transform(rows)
    assert whole.where(F.col("prediction") != F.col(names[-1])).count() == 0


def test_search_scores_equal_separate_fits(flows):
    """The largest forest of each fold is the one that a separate fit gives; smaller ones come close."""
    grid = {"trees": [3, 40], "depth": [2, 3], "subset": ["sqrt"]}
    found = {(r.trees, r.depth): r.avg_metric for r in search_forest(flows, grid, folds=2, fraction=1.0).collect()}
    assert list(found) == [(3, 2), (3, 3), (40, 2), (40, 3)]
    split = stratified_sample(flows, "label_index", 1.0, K.SEED).withColumn("f", F.least(F.floor(F.rand(K.SEED) * 2), F.lit(1)))
    split = materialize(split, "split")
    judge = MulticlassClassificationEvaluator(labelCol="label_index", metricName="f1")
    for trees, depth in found:
        scores = [
            judge.evaluate(forest(trees, depth, "sqrt").fit(split.where(F.col("f") != n)).transform(split.where(F.col("f") == n)))
            for n in (0, 1)
        ]
        assert found[trees, depth] == pytest.approx(sum(scores) / 2, abs=1e-9 if trees == 40 else 0.1)


def test_subsets_of_as_many_features_share_a_forest(flows, monkeypatch):
    """Of 5 features, sqrt and log2 both draw three: each fold is fitted once for them and scored as by separate fits."""
    assert [search_module.features_per_split(s, 4) for s in ("sqrt", "log2", "all", "onethird", "0.5")] == [2, 2, 4, 2, "0.5"]
    assert search_module.features_per_split("sqrt", 78) == 9 and search_module.features_per_split("log2", 78) == 7
    five = F.concat(vector_to_array(K.SCALED_VECTOR), F.array(F.rand(1), F.rand(2), F.rand(3)))
    one_file = materialize(flows.withColumn(K.SCALED_VECTOR, array_to_vector(five)).coalesce(1), "wide")
    fits = []
    monkeypatch.setattr(search_module, "fit_forest", lambda *a, **k: fits.append(k["subset"]) or fit_forest(*a, **k))
    grid = {"trees": [2, 4], "depth": [3], "subset": ["sqrt", "log2", "all"]}
    found = {(r.trees, r.subset): r.avg_metric for r in search_forest(one_file, grid, folds=2, fraction=1.0).collect()}
    assert sorted(fits) == ["all", "all", "sqrt", "sqrt"] and len(found) == 6
    alone = search_forest(one_file, grid | {"subset": ["log2"]}, folds=2, fraction=1.0).collect()
    assert {r.trees: r.avg_metric for r in alone} == {t: found[t, s] for t, s in found if s == "log2"} == {t: found[t, "sqrt"] for t in (2, 4)}


def test_a_tree_on_few_cells_takes_one_task(flows, monkeypatch):
    parts, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(forest_module, "CELLS_PER_FILE", 10)
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: parts.append(df.rdd.getNumPartitions()) or fit(self, df))
    assert len(fit_on_cells(flows, trees=2, depth=2).trees) == 2 and parts == [1, 1]


def test_kept_nodes_give_the_same_forest(flows):
    kept = fit_forest(flows, trees=6, depth=6).stages[0]
    plain = forest(6, 6).fit(flows)
    assert kept.toDebugString.split("\n", 1)[1] == plain.toDebugString.split("\n", 1)[1]


def test_first_of_equal_combinations_wins(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (2, 0.4)], "position int, avg_metric double")
    assert best_forest(df).first().position == 0


@pytest.mark.parametrize("dim", [2, 127, 128, 129, 500])
def test_vectors_of_another_length_have_no_distance(spark, dim):
    whole = [float(i) for i in range(dim)]
    rows = [(0, whole, 0), (1, whole + [1.0], 0), (2, whole[:-1], 0), (3, None, 0), (4, whole, 9)]
    df = spark.createDataFrame(rows, "id int, x array<double>, cluster_id int")
    centers = spark.createDataFrame([(0, [0.0] * dim)], "cluster_id int, centroid array<double>")
    got = {r.id: r.d for r in distance_to_centroid(df, centers, "x", out="d").collect()}
    want = sum(v * v for v in whole) ** 0.5
    assert abs(got[0] - want) < 1e-9 and [got[i] for i in (1, 2, 3, 4)] == [None] * 4
    near = {r.id: (r.cluster_id, r.d) for r in assign_centroid(df.drop("cluster_id"), centers, "x", out="d").collect()}
    assert near[0][0] == 0 and abs(near[0][1] - want) < 1e-9 and near[1] == near[2] == near[3] == (None, None)


def test_nearest_of_many_centroids_in_blocks(monkeypatch):
    rnd = np.random.default_rng(3)
    centers = rnd.normal(size=(300, 5)) + 1e6  # far from zero, where rounding hides small gaps
    centers[200] = centers[10]  # a tie: the smaller id wins
    x = np.vstack([centers[[10, 200, 299]], centers[:50] + 1e-4])
    ids = np.arange(300) * 2
    gaps = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
    for doubles in (1 << 20, 400, 1):
        monkeypatch.setattr(clustering, "BLOCK_DOUBLES", doubles)
        found, squared = clustering.nearest_centroids(x, ids, centers)
        assert found.tolist() == ids[gaps.argmin(axis=1)].tolist()
        assert np.allclose(squared, gaps.min(axis=1), rtol=0, atol=1e-12)
    assert found[0] == found[1] == 20
