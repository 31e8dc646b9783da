import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from flowlens.functions.predicates import flag_anomaly
from flowlens.operators.evaluation import (
    binary_confusion,
    class_share,
    compare_models,
    confusion_cells,
    detection_by_class,
    dominant_label,
    macro_metrics,
    multiclass_metrics,
    per_class_metrics,
    run_metrics,
    score_by_class,
    top_classes,
    unseen_detection,
    with_binary_metrics,
)


def pairs(spark, truth, pred):
    return spark.createDataFrame([(float(t), float(p)) for t, p in zip(truth, pred)], ["truth", "pred"])


def test_macro_counts_never_predicted_classes(spark):
    df = pairs(spark, [0, 1, 1, 2], [0, 0, 1, 0])
    per = per_class_metrics(confusion_cells(df, "truth", "pred"), "truth", "pred")
    two = per.where("class = 2").first()
    assert (two.precision, two.recall, two.f1) == (0.0, 0.0, 0.0)
    got = macro_metrics(per).first()
    assert got.precision_macro == pytest.approx((1 / 3 + 1 + 0) / 3)
    assert got.recall_macro == pytest.approx((1 + 0.5 + 0) / 3)


def test_macro_ignores_classes_that_are_only_predicted(spark):
    per = per_class_metrics(confusion_cells(pairs(spark, [0, 0], [0, 9]), "truth", "pred"), "truth", "pred")
    assert {r["class"] for r in per.collect()} == {0.0, 9.0}
    assert macro_metrics(per).first().recall_macro == 0.5


def test_weighted_metrics_match_evaluator(spark):
    truth = [i * i % 7 % 4 for i in range(400)]
    pred = [(i * 31) % 11 % 4 if i % 3 else truth[i] for i in range(400)]
    df = pairs(spark, truth, pred)
    cells = confusion_cells(df, "truth", "pred")
    assert cells.agg(F.sum("n")).first()[0] == 400
    got = multiclass_metrics(per_class_metrics(cells, "truth", "pred")).first()
    ev = MulticlassClassificationEvaluator(labelCol="truth", predictionCol="pred")
    for name, metric in [
        ("accuracy", "accuracy"), ("precision_weighted", "weightedPrecision"),
        ("recall_weighted", "weightedRecall"), ("f1_weighted", "f1"),
    ]:
        assert got[name] == pytest.approx(ev.setMetricName(metric).evaluate(df), abs=1e-9)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "flag int, truth int")
    assert tuple(binary_confusion(empty, "flag", "truth").first()) == (0, 0, 0, 0)
    row = with_binary_metrics(binary_confusion(empty, "flag", "truth")).first()
    assert (row.precision, row.recall, row.f1, row.fpr, row.accuracy) == (0.0,) * 5
    none = macro_metrics(per_class_metrics(confusion_cells(empty, "truth", "flag"), "truth", "flag")).first()
    assert none.f1_macro is None


def test_null_scores_are_in_no_cell(spark):
    df = spark.createDataFrame([(None, 1), (float("nan"), 1), (1.0, 0), (3.0, 0)], "s double, truth int")
    flagged = df.withColumn("flag", flag_anomaly(F.col("s"), 2))
    assert tuple(binary_confusion(flagged, "flag", "truth").first()) == (1, 1, 0, 1)


def test_unseen_detection(spark):
    train = spark.createDataFrame([("a",), ("b",)], "label string")
    test = spark.createDataFrame(
        [("a", 1, 5.0), ("x", 1, 2.0), ("x", 0, 4.0), ("y", 0, 1.0)], "label string, flag int, s double"
    )
    got = {r.label: (r.num_records, r.detected_as_attack, r.detection_recall, r.detection, r.mean_dist)
           for r in unseen_detection(train, test, "label", "flag", "s").collect()}
    assert got == {"x": (2, 1, 0.5, "full", 3.0), "y": (1, 0, 0.0, "partial", 1.0)}
    assert detection_by_class(test, "label", "flag").count() == 3


def test_score_by_class(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("a", 3.0, 1), ("b", 2.0, 0)], "c string, s double, f int")
    got = {r.c: tuple(r)[1:] for r in score_by_class(df, "c", "s", "f").collect()}
    assert got["a"] == (2.0, pytest.approx(2**0.5), 2, 0.5)
    assert got["b"] == (2.0, None, 1, 0.0)


def test_shares_top_and_dominant(spark):
    df = spark.createDataFrame([(0, "a"), (0, "a"), (0, "b"), (1, "d"), (1, "c"), (2, None)], "p int, l string")
    assert sum(r.share for r in class_share(df, "p").collect()) == pytest.approx(100)
    assert [(r.p, r.n) for r in top_classes(df, "p", 0, 1).collect()] == [(1, 2)]
    got = {r.p: (r.n, r.dominant_label) for r in dominant_label(df, "p", "l").collect()}
    assert got == {0: (3, "a"), 1: (2, "c"), 2: (1, None)}


def test_compare_models(spark):
    new = spark.createDataFrame([(0.5, 0.25)], ["f1", "fpr"])
    old = spark.createDataFrame([(0.4, 0.5)], ["f1", "fpr"])
    both = {r.metric: (r.base, r.optimised, r.change) for r in compare_models(old, new, ["f1", "fpr"]).collect()}
    assert both["fpr"] == (0.5, 0.25, -0.25)
    alone = {r.metric: (r.base, r.change) for r in compare_models(None, new, ["f1"]).collect()}
    assert alone == {"f1": (None, None)}


def test_run_metrics(spark):
    row = run_metrics(spark, 1000, 0.5, 4).first()
    assert (row.throughput_records_per_second, row.average_latency_us, row.num_partitions) == (2000.0, 500.0, 4)
    assert run_metrics(spark, 0, 0.0, 1).first().throughput_records_per_second == 0.0
