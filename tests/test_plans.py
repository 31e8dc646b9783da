"""The whole way on small data: raw CSV -> tables -> models -> reports -> live scores."""

import json

import pytest
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.plans.clusters import calibrate_clusters, evaluate_clusters, optimise_clusters, train_clusters
from flowlens.plans.forests import evaluate_forest, optimise_forest, train_forest
from flowlens.plans.layout import Layout
from flowlens.plans.live import load_scorer, score_lines
from flowlens.plans.prepare import files_by_split, prepare, prepare_stream_table
from flowlens.sources.csv import list_csv
from flowlens.sources.documents import load_manifest, read_doc, read_values
from flowlens.sources.tables import read_table
from flowlens.streaming.scoring import batch_summary
from flowlens.sources.wire import parse_wire, replay_stream, to_wire, wire_schema

HEADERS = [" Flow Bytes/s", "Flow Duration", "Fwd Packets/s", "Note", " Label"]


@pytest.fixture(scope="module")
def project(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("project")
    items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    q = F.col("l_quantity")
    attack = F.when(q > 45, "Flood").when((q > 43) & (F.dayofweek("l_shipdate") == 5), "Web Attack").otherwise("BENIGN")
    text = items.select(
        F.when(F.col("l_partkey") % 40 == 0, "Infinity").otherwise(F.col("l_extendedprice").cast("string")).alias("a"),
        (q + F.when(q > 43, 30).otherwise(0)).cast("string").alias("b"),
        F.when(F.col("l_partkey") % 50 == 0, None).otherwise(F.col("l_tax").cast("string")).alias("c"),
        F.lit("free text").alias("d"),
        attack.alias("label"),
        F.dayofweek("l_shipdate").alias("day"),
    )
    train = text.where("day in (2, 4, 6)").drop("day").toDF(*HEADERS)
    test = text.where("day in (3, 5)").drop("day").toDF(*HEADERS)
    train.unionAll(train.limit(50)).write.option("header", True).csv(str(root / "raw" / "train"))
    test.write.option("header", True).csv(str(root / "raw" / "test"))
    layout = Layout(str(root / "out"))
    features = prepare(spark, str(root / "raw" / "train"), str(root / "raw" / "test"), layout)
    return root, layout, features


def test_prepare(spark, project):
    _, layout, features = project
    assert features == ["flow_bytess", "flow_duration", "fwd_packetss"] == load_manifest(spark, layout("models", "features"))
    train, test = (read_table(spark, layout("processed", s)) for s in ("train", "test"))
    assert train.columns == K.TRAIN_COLUMNS and test.columns == K.TEST_COLUMNS
    first = train.where("label_index = 0").first()
    assert first.label == "BENIGN" and first[K.SPLIT] == "train" and "/raw/train/" in first[K.SOURCE_FILE]
    weights = train.groupBy("label").agg(F.first("class_weight").alias("w")).agg(F.sum("w")).first()[0]
    assert weights == pytest.approx(train.select("label").distinct().count())
    unseen = test.where("label = 'Web Attack'").select("label_index").distinct().collect()
    assert [r.label_index for r in unseen] == [2.0]
    audit = {r.step: r for r in read_doc(spark, layout("reports", "cleaning_train"), "step string, rows_before long, rows_after long, removed long").collect()}
    assert set(audit) == {"nulls", "infinite", "duplicates"}
    assert all(r.removed > 0 for r in audit.values() if r.step != "duplicates")
    assert audit["duplicates"].rows_after == train.count()


def test_files_by_split(spark, tmp_path):
    for name in ("Monday-a.csv", "friday.CSV", "Thursday-b.csv", "Sunday.csv"):
        (tmp_path / name).write_text("x\n1\n")
    found = files_by_split(spark, str(tmp_path))
    assert {k: [p.rsplit("/", 1)[1] for p in v] for k, v in found.items()} == {
        "train": ["Monday-a.csv", "friday.CSV"], "test": ["Thursday-b.csv"],
    }
    (tmp_path / "only").mkdir()
    (tmp_path / "only" / "Monday.csv").write_text("x\n1\n")
    with pytest.raises(FileNotFoundError, match="test"):
        files_by_split(spark, str(tmp_path / "only"))


def test_clusters(spark, project):
    _, layout, _ = project
    trained = train_clusters(spark, layout, k=4, max_iter=10)
    benign = read_table(spark, layout("processed", "train")).where("label = 'BENIGN'").count()
    assert sum(trained["cluster_sizes"]) == trained["num_training_records"] == benign
    assert trained["min_distance"] <= trained["max_distance"] and -1 <= trained["silhouette_score"] <= 1
    calibrated = calibrate_clusters(spark, layout, rel_err=0)
    assert {"percentile_90", "percentile_95", "percentile_97", "percentile_99", "percentile_999"} <= set(calibrated)
    assert calibrated["percentile_90"] <= calibrated["threshold_optimal"] <= calibrated["percentile_999"]
    assert calibrated["calibration_records"] == read_table(spark, layout("processed", "train")).count()
    crossed = calibrate_clusters(spark, layout, rel_err=0, folds=3)
    assert crossed["calibration_records"] == calibrated["calibration_records"] and crossed["calibration_folds"] == 3
    assert crossed["threshold_optimal"] != calibrated["threshold_optimal"] and crossed["auc_roc"] > 0.6
    calibrate_clusters(spark, layout, rel_err=0)
    report = evaluate_clusters(spark, layout)
    test = read_table(spark, layout("processed", "test"))
    assert report["binary"]["total_records"] == test.count()
    assert [r["label"] for r in report["unseen_classes_analysis"]] == ["Web Attack"]
    assert sum(r["num_records"] for r in report["per_class_distribution"]) == test.count()
    assert read_table(spark, layout("scores", "clusters_v1")).columns == [*K.CLUSTER_SCORE_COLUMNS, "label"]
    assert report["binary"]["auc_roc"] > 0.6
    json.dumps(report)


def test_forest(spark, project):
    _, layout, _ = project
    trained = train_forest(spark, layout, trees=8, depth=5)
    assert [r["feature"] for r in trained["feature_importances"]][0] == "flow_duration"
    report = evaluate_forest(spark, layout)
    rows = read_table(spark, layout("processed", "test")).count()
    assert sum(c["n"] for c in report["confusion_matrix"]) == rows
    assert report["multiclass"]["accuracy"] > 0.8
    assert "__unseen__" in {c["true_class"] for c in report["confusion_matrix"]}
    assert [u["label"] for u in report["unseen_classes_analysis"]] == ["Web Attack"]
    assert read_table(spark, layout("scores", "forest_v1")).columns == K.FOREST_SCORE_COLUMNS
    assert read_values(spark, layout("reports", "forest_v1_test"))["binary"]["auc_roc"] == report["binary"]["auc_roc"]


def test_optimise(spark, project):
    _, layout, _ = project
    clusters = optimise_clusters(spark, layout, grid=[{"k": 2, "max_iter": 5, "tol": 1e-4}, {"k": 3, "max_iter": 5, "tol": 1e-4}])
    assert [r["k"] for r in clusters["search_grid"]] == [2, 3]
    assert clusters["base_model"]["hyperparameters"]["k"] == 4
    assert clusters["optimized_model"]["hyperparameters"]["k"] in (2, 3)
    compared = {r["metric"]: r for r in clusters["comparison"]}
    assert "hyperparameters" not in compared
    assert compared["wssse"]["change"] == compared["wssse"]["optimised"] - compared["wssse"]["base"]
    assert compared["wssse"]["base"] == clusters["base_model"]["wssse"]
    missing = optimise_forest(spark, layout, base="never_trained", grid={"trees": [3], "depth": [2, 4], "subset": ["sqrt"]}, folds=2)
    assert missing["base_model"]["f1_weighted"] is None and missing["base_model"]["hyperparameters"] == K.FOREST
    assert missing["search_config"]["combinations"] == 2
    assert all(r["base"] is None for r in missing["comparison"] if r["metric"] in ("f1_weighted", "accuracy"))
    assert missing["optimized_model"]["avg_cv_f1"] > 0


def test_other_dataset_is_aligned(spark, project):
    root, layout, features = project
    other = spark.createDataFrame(
        [("1.5", "2.0", "BENIGN", "10.0.0.1"), ("1.5", "2.0", "BENIGN", "10.0.0.1"), ("NaN", "1.0", "Flood", "x")],
        ["Fwd Packets/s", "Flow Duration", "Label", "Src IP"],
    )
    other.write.option("header", True).csv(str(root / "raw" / "other"))
    files = [r.path for r in list_csv(spark, str(root / "raw" / "other")).collect()]
    out = prepare_stream_table(spark, files, layout)
    assert out.columns == [*features, "label", K.SOURCE_FILE, K.SPLIT]
    row = out.drop(K.SOURCE_FILE).distinct().collect()
    assert [tuple(r) for r in row] == [(0.0, 2.0, 1.5, "BENIGN", "streaming_demo")]
    diff = {(r["column"], r.status) for r in read_doc(spark, layout("reports", "alignment"), "column string, status string").collect()}
    assert diff == {("flow_bytess", "imputed"), (K.SOURCE_FILE, "extra")} - {(K.SOURCE_FILE, "extra")}


def test_live_scores(spark, project):
    root, layout, _ = project
    rows = read_table(spark, layout("clean", "test"))
    broken = spark.createDataFrame([("1.0,2.0",), ("a,b,c,d",)], "value string")
    to_wire(rows).repartition(3).write.text(str(root / "wire"))
    broken.coalesce(1).write.mode("append").text(str(root / "wire"))
    query = score_lines(
        spark, layout, replay_stream(spark, str(root / "wire"), 1), trigger=None, extra=["flow_duration"], listener=False
    )
    query.awaitTermination()
    n = rows.count()
    forest, clusters = (read_table(spark, layout("live", s)) for s in ("forest", "clusters"))
    assert forest.count() == clusters.count() == n
    assert "flow_duration" in forest.columns
    summary = read_table(spark, layout("live", "summary")).agg(F.sum("n"), F.sum("km_anom"), F.count("*")).first()
    assert summary[0] == n and summary[2] == 3
    bad = read_table(spark, layout("live", "malformed"))
    assert sorted(r.value for r in bad.collect()) == ["1.0,2.0", "a,b,c,d"]
    assert summary[1] == clusters.agg(F.sum("is_anomaly")).first()[0]
    stored = read_table(spark, layout("scores", "clusters_v1"))
    assert stored.agg(F.sum(K.FLAG)).first()[0] == summary[1]


def test_scoring_is_a_plain_streaming_projection(spark, project):
    root, layout, features = project
    rows = read_table(spark, layout("clean", "test"))
    to_wire(rows).write.text(str(root / "wire2"))
    scorer = load_scorer(spark, layout)
    parsed = parse_wire(replay_stream(spark, str(root / "wire2")), wire_schema(features))
    cols = ["label", K.PREDICTION, K.CLUSTER, "distanceToCentroid", "is_anomaly"]
    query = (
        scorer.score(parsed).select(*cols).writeStream.format("parquet")
        .option("path", str(root / "projected")).option("checkpointLocation", str(root / "projected_checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = scorer.score(rows).select(*cols)
    assert read_table(spark, str(root / "projected")).exceptAll(batch).count() == 0
    assert batch.count() == rows.count()


def test_missing_features_are_anomalies(spark, project):
    _, layout, features = project
    broken = [(None, 1.0, 2.0, "a"), (1.0, float("nan"), 2.0, "b"), (1.0, 2.0, float("inf"), "c")]
    rows = spark.createDataFrame([*broken, (1.0, 1.0, 0.01, "never seen")], wire_schema(features))
    scored = load_scorer(spark, layout).score(rows)
    got = scored.orderBy("label").collect()
    for row in got[:3]:
        assert row.is_anomaly == 1 and row[K.CLUSTER] is None and row.prediction is not None
        assert row.distanceToCentroid != row.distanceToCentroid
    assert got[3].label_index == 2.0 and got[3].distanceToCentroid > 0
    summary = batch_summary(scored).first()
    assert summary.n == 4 and summary.km_anom >= 3 and summary.km_dist_max == round(got[3].distanceToCentroid, 2)
