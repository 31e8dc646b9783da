"""Trees grown by tasks, against Spark ML's."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.operators import forest as forest_module
from flowlens.operators import search as search_module
from flowlens.operators import trees as grower
from flowlens.operators.forest import cell_table, classes_of, fit_forest, fit_on_cells, forest, part_of, predict
from flowlens.operators.clustering import fit_kmeans
from flowlens.operators.sampling import stratified_sample
from flowlens.operators.search import search_forest
from flowlens.plans.prepare import for_streams, preparation_stages
from flowlens.queries import QUERIES
from flowlens.sources.tables import load_model, save_model
from flowlens.streaming.scoring import Scorer
from flowlens.workspace import materialize
from harness import plan_text


def noisy(spark, n=4000):
    """Rows of three classes that depend on two of four features."""
    rng = np.random.default_rng(3)
    x = np.round(rng.random((n, 4)) * [10, 30, 12, 5])
    y = (x[:, 0] + rng.integers(0, 6, n) > 8).astype(int) + (x[:, 1] + rng.integers(0, 20, n) > 35)
    rows = [(float(c), 1.7 if c == 0 else 0.3, [float(v) for v in r]) for c, r in zip(y, x)]
    df = spark.createDataFrame(rows, f"{K.LABEL_INDEX} double, {K.CLASS_WEIGHT} double, x array<double>")
    return df.withColumn(K.SCALED_VECTOR, array_to_vector("x")).drop("x").persist()


@pytest.fixture(scope="module")
def rows(spark):
    return noisy(spark)


def shape(tree, values):
    """Nodes from the root, left before right: split or leaf, with the class sums."""
    found, todo = [], [0]
    while todo:
        i = todo.pop()
        f = int(tree.feature[i])
        found.append((f, (values[f][tree.cut[i]] + values[f][tree.cut[i] + 1]) / 2 if f >= 0 else None, *np.round(tree.stats[i], 6)))
        todo += [int(tree.left[i]) + 1, int(tree.left[i])] if f >= 0 else []
    return found


def shape_of_model(nodes):
    found, todo, by_id = [], [0], {r.id: r for r in nodes}
    while todo:
        r = by_id[todo.pop()]
        inner = r.leftChild >= 0
        found.append((r.split.featureIndex, r.split.leftCategoriesOrThreshold[0] if inner else None, *np.round(r.impurityStats, 6)))
        todo += [r.rightChild, r.leftChild] if inner else []
    return found


@pytest.mark.parametrize("depth", [0, 1, 4, 11])
def test_a_tree_of_the_same_draws_is_sparks(spark, rows, tmp_path, depth):
    values = forest_module.bin_values(rows)
    cells = forest_module.forest_cells(rows, values, K.SCALED_VECTOR, K.LABEL_INDEX, K.CLASS_WEIGHT)
    own = grower.packed(cells, values, 3)
    assert own.n.sum() == 4000
    _, draws = own.drawn(1, 0)
    tree = grower.grow(own, draws, depth, 4, None)
    drawn = [(float(c), float(w), [float(own.values[f][own.bins[f, i]]) for f in range(4)]) for i, (c, w) in enumerate(zip(own.labels, draws * own.weights)) if w]
    df = spark.createDataFrame(drawn, "label double, w double, x array<double>").withColumn("v", array_to_vector("x"))
    forest(1, depth, "all", "w", 3, "v", "label").setBootstrap(False).fit(df).write().save(str(tmp_path / "m"))
    nodes = spark.read.parquet(str(tmp_path / "m" / "data")).select("nodeData.*").collect()
    assert shape(tree, own.values) == shape_of_model(nodes) and len(nodes) == len(tree.feature)
    leaves = np.flatnonzero(tree.feature < 0)
    assert set(tree.leaf_of) <= set(leaves) and tree.count[0] == tree.count[leaves].sum() == draws.sum()


def test_slices_of_nodes_give_the_same_tree(spark, rows, monkeypatch):
    values = forest_module.bin_values(rows)
    own = grower.packed(forest_module.forest_cells(rows, values, K.SCALED_VECTOR, K.LABEL_INDEX, None), values, 3)
    whole = grower.grow(own, own.n, 8, 2, np.random.default_rng(1))
    monkeypatch.setattr(grower, "SUMS", 300)
    assert shape(grower.grow(own, own.n, 8, 2, np.random.default_rng(1)), own.values) == shape(whole, own.values)


def test_forest_of_many_cells_is_grown_by_tasks(spark, rows, monkeypatch, tmp_path):
    """No job of Spark's learner sees the rows; the first trees are the forest of so many; Spark reads, saves and applies it."""
    fitted, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(forest_module, "MANY_CELLS", 1_000)
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df: fitted.append(df.count()) or fit(self, df))
    model = fit_on_cells(rows, trees=12, depth=7)
    assert sum(fitted) == 1 and len(model.trees) == model.getNumTrees == 12 and max(t.depth for t in model.trees) <= 7
    assert model.numClasses == classes_of({"num_vals": 3}) == 3 and model.featureImportances.toArray().sum() == pytest.approx(1)
    few = fit_on_cells(rows, trees=5, depth=7)
    parts = [m.transform(rows).select(K.SCALED_VECTOR, "probability") for m in (few, part_of(spark, model, 0, 5))]
    assert parts[0].exceptAll(parts[1]).count() == 0
    save_model(model, str(tmp_path / "model"))
    again = load_model(str(tmp_path / "model"), type(model))
    right = [m.transform(rows).where(F.col("prediction") == F.col(K.LABEL_INDEX)).count() for m in (model, again)]
    plain = forest(12, 7).fit(rows).transform(rows).where(F.col("prediction") == F.col(K.LABEL_INDEX)).count()
    assert right[0] == right[1] and abs(right[0] - plain) < 200


@pytest.mark.parametrize("many", [False, True])
def test_rows_are_applied_through_cells(spark, rows, monkeypatch, many):
    """The table gives every row what the forest gives it, at thresholds, beyond all values and for NaN, too."""
    monkeypatch.setattr(forest_module, "MANY_CELLS", 1 if many else 10**9)
    model = fit_forest(rows, by_cells=many, trees=6, depth=6)
    cuts, table, _ = cell_table(spark, model.stages[0])
    assert table.count() == np.prod([len(c) + 1 for c in cuts]) and all(c == sorted(set(c)) for c in cuts)
    odd = [[a, b, 3.0, 1.0] for a in [*cuts[0], -1e9, 1e9, float("nan"), float("inf"), -0.0] for b in [*cuts[1], float("-inf")]]
    odd = spark.createDataFrame([(0.0, x) for x in odd], f"{K.LABEL_INDEX} double, x array<double>").withColumn(K.SCALED_VECTOR, array_to_vector("x"))
    for df in (rows, odd):
        plain, own = predict(model, df, by_cells=False), predict(model, df, by_cells=True)
        assert own.dtypes == plain.dtypes
        assert own.exceptAll(plain).count() == plain.exceptAll(own).count() == 0


def test_many_rows_go_through_cells(spark, rows, monkeypatch):
    model = fit_forest(rows, trees=2, depth=2)
    assert "__cell" not in plan_text(predict(model, rows))
    monkeypatch.setattr(forest_module, "MANY_ROWS", 4_000)
    assert "__cell" in plan_text(predict(model, rows))
    monkeypatch.setattr(forest_module, "TABLE_CELLS", 3)
    other = fit_forest(rows, trees=2, depth=3, by_cells=False)
    assert cell_table(spark, other.stages[0]) is None and "__cell" not in plan_text(predict(other, rows))


def test_every_searched_combination_is_a_forest_of_its_own(spark, rows, monkeypatch):
    """Grown by tasks, each score of the search is that of a forest fitted for the combination alone, on the fold's other rows."""
    monkeypatch.setattr(search_module, "MANY_NODES", 1)
    monkeypatch.setattr(forest_module, "MANY_CELLS", 1)
    monkeypatch.setattr(grower, "TREES_PER_TASK", 3)
    monkeypatch.setattr(grower, "CELLS_PER_PART", 50)
    table = materialize(rows, "rows")
    grid = {"trees": [2, 5, 8], "depth": [3, 7], "subset": ["sqrt", "all"]}
    for weighted in (False, True):
        found = search_forest(table, grid, folds=2, fraction=1.0, weighted_metric=weighted)
        found = {(r.trees, r.depth, r.subset): r.avg_metric for r in found.collect()}
        assert list(found) == [(t, d, s) for t in grid["trees"] for d in grid["depth"] for s in grid["subset"]]
        split = stratified_sample(table, K.LABEL_INDEX, 1.0, K.SEED).withColumn("f", F.least(F.floor(F.rand(K.SEED) * 2), F.lit(1)))
        split = materialize(split, "split")
        judge = MulticlassClassificationEvaluator(labelCol=K.LABEL_INDEX, metricName="f1")
        if weighted:
            judge = judge.setWeightCol(K.CLASS_WEIGHT)
        for t, d, s in [(2, 7, "all"), (5, 3, "sqrt"), (5, 7, "sqrt"), (8, 7, "sqrt")]:
            models = [fit_forest(split.where(F.col("f") != n), by_cells=True, trees=t, depth=d, subset=s) for n in (0, 1)]
            scores = [judge.evaluate(m.transform(split.where(F.col("f") == n))) for n, m in enumerate(models)]
            assert found[t, d, s] == pytest.approx(sum(scores) / 2, abs=1e-9)


def test_search_without_room_for_the_cells_is_the_plain_one(rows, monkeypatch):
    rows, grid = materialize(rows.coalesce(1), "rows"), {"trees": [2], "depth": [3], "subset": ["sqrt"]}
    plain = search_forest(rows, grid, folds=2, fraction=1.0).first().avg_metric
    monkeypatch.setattr(search_module, "MANY_NODES", 1)
    monkeypatch.setattr(grower, "PACKED_BYTES", 1_000)
    assert search_forest(rows, grid, folds=2, fraction=1.0).first().avg_metric == pytest.approx(plain)


def test_whole_published_grid_is_registered():
    from flowlens.queries import ORACLES

    assert [(t, d) for t in (50, 100, 200) for d in (5, 10, 15) if f"{t}, {d}, 'sqrt'), " not in ORACLES["rf_search"]] == []


def test_scoring_through_cells_is_scoring(spark):
    """Both models on the same rows, one without a feature: the table of cells changes no column."""
    data = [(float(i % 9), float(i % 13), "x" if i % 9 > 5 else "y") for i in range(400)] + [(None, 1.0, "x"), (2.0, float("inf"), "z")]
    df = materialize(spark.createDataFrame(data, "a double, b double, label string").coalesce(1), "rows")
    good = df.where("a is not null and b < 100")
    prepared = Pipeline(stages=preparation_stages(["a", "b"])).fit(good)
    ready = prepared.transform(good)
    fitted = fit_forest(ready, by_cells=True, trees=3, depth=4, weight_col=None), fit_kmeans(ready, k=3, max_iter=5)
    plain, own = (Scorer(for_streams(prepared, ["a", "b"]), *fitted, 1.0, by_cells=c).score(df) for c in (False, True))
    assert "__cell" in plan_text(own) and "__cell" not in plan_text(plain) and own.dtypes == plain.dtypes
    assert own.count() == 402 and own.exceptAll(plain).count() == plain.exceptAll(own).count() == 0


def test_stream_score_counts_rows_without_a_label(spark, tmp_path):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(300)
    flag = F.when(F.col("l_linenumber") > 1, F.col("l_returnflag"))
    lines.withColumn("l_returnflag", flag).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = {r.label: (r.n, r.same) for r in QUERIES["stream_score"](spark, str(tmp_path)).collect()}
    assert None in found and sum(n for n, _ in found.values()) == 300 and all(n == same for n, same in found.values())


def test_quantiles_are_taken_of_features_with_more_values_than_bins(spark, monkeypatch):
    """Bins as before, with an exact list of up to 32 values; a wrong estimate of their number changes nothing."""
    x = F.array(*((F.col("id") % n).cast("double") for n in (31, 32, 33, 64, 1000)))
    df = spark.range(4_000).select(array_to_vector(x).alias(K.SCALED_VECTOR))
    asked, real = [], F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda *a, **k: asked.append(a[0]) or real(*a, **k))
    values = forest_module.bin_values(df)
    assert values[:2] == [[float(i) for i in range(n)] for n in (31, 32)] and len(asked) == 5
    assert [(v[0], v[-1], len(v) <= 32) for v in values[2:]] == [(0.0, n - 1.0, True) for n in (33, 64, 1000)]
    monkeypatch.setattr(F, "approx_count_distinct", lambda c: F.lit(20))
    del asked[:]
    assert [(v[0], v[-1], len(v) <= 32) for v in forest_module.bin_values(df)] == [(v[0], v[-1], True) for v in values] and len(asked) == 3
