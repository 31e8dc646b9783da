import math

import pytest
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowlens.operators import joins
from flowlens.operators.features import (
    apply_label_dictionary,
    apply_label_index,
    assemble,
    attach_class_name,
    class_weights,
    fit_label_dictionary,
    fit_label_index,
    fit_scaler,
    label_collisions,
    scale,
    weighted_training_set,
)


def labels(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, label string")


def test_label_index_matches_indexer(spark):
    train = labels(spark, ["b", "b", "a", "a", "c", None])
    test = labels(spark, ["c", "a", "b", "z", None])
    model = StringIndexer(inputCol="label", outputCol="label_index", handleInvalid="keep").fit(train)
    want = [r.label_index for r in model.transform(test).orderBy("i").collect()]
    got = [r.label_index for r in apply_label_index(test, fit_label_index(train)).orderBy("i").collect()]
    assert got == want == [2.0, 0.0, 1.0, 3.0, 3.0]


def test_scaler_matches_scaler(spark):
    df = spark.createDataFrame([(float(i), 7.0, i * i / 3) for i in range(1, 6)], ["a", "k", "z"])
    stats = fit_scaler(df, ["z", "a", "k"])
    got = [(r.a, r.k, r.z) for r in scale(df, stats).orderBy("a").collect()]
    vec = VectorAssembler(inputCols=["a", "k", "z"], outputCol="v").transform(df)
    model = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vec)
    want = [r.s for r in model.transform(vec).orderBy("a").select(vector_to_array("s").alias("s")).collect()]
    for g, w in zip(got, want):
        assert g == pytest.approx(w, abs=1e-9)
    assert [round(g[0], 4) for g in got] == [-1.2649, -0.6325, 0.0, 0.6325, 1.2649]
    assert {g[1] for g in got} == {0.0}


def test_scaled_training_data_is_standard(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_quantity", "l_tax")
    out = scale(df, fit_scaler(df, df.columns)).agg(
        *[f(c) for c in df.columns for f in (F.avg, F.stddev_samp)]
    ).first()
    assert list(out) == pytest.approx([0, 1, 0, 1], abs=1e-9)


def test_assemble(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (float("nan"), 4.0)], "b double, a double")
    assert [r.features for r in assemble(df, ["b", "a"]).collect()] == [[2.0, 1.0]]
    kept = [r.features for r in assemble(df, ["b", "a"], invalid="keep").orderBy("a").collect()]
    assert kept[0] == [2.0, 1.0]
    assert all(math.isnan(v[1]) for v in kept[1:])


def test_class_weights(spark):
    df = labels(spark, ["a"] * 90 + ["b"] * 9 + ["c"])
    got = {r.label: r.class_weight for r in class_weights(df, "label").collect()}
    assert sum(got.values()) == pytest.approx(3)
    assert got["b"] / got["a"] == pytest.approx(10)
    assert got["c"] / got["a"] == pytest.approx(90)
    weighted = weighted_training_set(df, "label")
    assert weighted.count() == 100
    assert weighted.where("class_weight is null").count() == 0


def test_lookup_join_both_ways(spark):
    big = labels(spark, ["a"] * 50 + ["b", "c", None])
    table = spark.createDataFrame([("a", 1), ("b", 2)], "label string, v int")
    small = joins.lookup_join(big, table, "label")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 1)
    try:
        large = joins.lookup_join(big, table, "label")
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_class_name_marker(spark):
    names = spark.createDataFrame([("x", 0.0), ("y", 1.0)], "label string, label_index double")
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "idx double")
    assert {r.idx: r.c for r in attach_class_name(df, names, "idx", "c").collect()} == {0.0: "x", 1.0: "y", 2.0: "__unseen__"}
    marked = attach_class_name(df, names, "idx", "c", F.concat(F.lit("idx_"), F.col("idx").cast("int").cast("string")))
    assert {r.c for r in marked.collect()} == {"x", "y", "idx_2"}


def test_label_dictionary_joins_spellings(spark):
    rows = [("DoS Hulk",), ("dos hulk ",), ("DoS Hulk",), (" DOS   HULK",), ("Benign",), ("BENIGN",), ("Bot",), (None,), ("  ",)]
    train = spark.createDataFrame(rows, "label string")
    known = {r.key: (r.label, r.label_index, r.n) for r in fit_label_dictionary(train).collect()}
    # of two spellings with one row each the first alphabetically is shown
    assert known == {"dos hulk": ("DoS Hulk", 0.0, 4), "benign": ("BENIGN", 1.0, 2), "bot": ("Bot", 2.0, 1)}
    found = {(r.key, r.spelling, r.n, r.spellings) for r in label_collisions(train).collect()}
    assert found == {
        ("dos hulk", "DoS Hulk", 2, 3), ("dos hulk", "dos hulk ", 1, 3), ("dos hulk", " DOS   HULK", 1, 3),
        ("benign", "Benign", 1, 2), ("benign", "BENIGN", 1, 2),
    }
    test = spark.createDataFrame([("dos\tHulk",), ("BOT",), ("new",), (None,), ("",)], "label string")
    got = {r.label: (r.label_index, r.name) for r in apply_label_dictionary(test, fit_label_dictionary(train), shown="name").collect()}
    assert got == {"dos\tHulk": (0.0, "DoS Hulk"), "BOT": (2.0, "Bot"), "new": (3.0, "new"), None: (3.0, None), "": (3.0, "")}


def test_label_dictionary_of_nothing(spark):
    none = spark.createDataFrame([(None,)], "label string")
    assert fit_label_dictionary(none).count() == 0 and label_collisions(none).count() == 0
    assert apply_label_dictionary(none, fit_label_dictionary(none)).first().label_index == 0
