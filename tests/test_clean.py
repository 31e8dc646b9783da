from pyspark.sql import functions as F

from flowlens.operators.clean import clean_audit, clean_rows, dedup, dedup_by_hash, drop_invalid, drop_nan, drop_nulls, inf_to_nan

INF, NAN = float("inf"), float("nan")
ROWS = [
    (1.0, 1.0, "a"), (1.0, 1.0, "a"), (2.0, None, "a"), (3.0, NAN, "a"), (INF, 1.0, "a"), (-INF, 1.0, "a"),
    (4.0, 1.0, None), (5.0, 1.0, "b"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "x double, y double, label string")


def test_single_pass_equals_three_steps(spark):
    df = frame(spark)
    one = drop_invalid(df, ["x", "y"])
    three = drop_nan(inf_to_nan(drop_nulls(df, ["x", "y", "label"]), ["x", "y"]), ["x", "y"])
    assert sorted(one.collect()) == sorted(three.collect()) == [(1.0, 1.0, "a"), (1.0, 1.0, "a"), (5.0, 1.0, "b")]


def test_dedup_is_idempotent(spark):
    once = clean_rows(frame(spark), ["x", "y"])
    assert sorted(once.collect()) == [(1.0, 1.0, "a"), (5.0, 1.0, "b")]
    assert sorted(dedup(once).collect()) == sorted(once.collect())


def test_dedup_by_content_keeps_one_source(spark):
    df = spark.createDataFrame([(1.0, "f2"), (1.0, "f1"), (2.0, "f3"), (None, "f9"), (None, "f8")], "x double, src string")
    assert dedup(df).count() == 5
    got = {(r.x, r.src) for r in dedup(df, ignore=["src"]).collect()}
    assert got == {(1.0, "f1"), (2.0, "f3"), (None, "f8")}
    assert dedup(df, ignore=["src"]).columns == ["x", "src"]


def test_dedup_by_hash_equals_dedup(spark):
    rows = [
        (0.0, "a", [1.0], "f2"), (-0.0, "a", [1.0], "f1"), (NAN, None, None, "f3"), (-NAN, None, None, "f4"),
        (None, "a", [0.0], "f5"), (None, "a", [-0.0], "f6"), (None, "a", [], "f7"), (1.0, None, [NAN], "f8"),
    ] * 2 + [(1.0, "b", [None], "f9"), (None, None, None, None)]  # nulls are skipped by hashes: many share one
    df = spark.createDataFrame(rows, "x double, name string, v array<double>, src string")
    for ignore in ([], ["src"], ["src", "x"]):
        whole = sorted(map(str, dedup(df, ignore).collect()))
        for most in (0, 100):
            assert sorted(map(str, dedup_by_hash(df, ignore, most).collect())) == whole
    assert dedup_by_hash(df.limit(0)).count() == 0


def test_single_rows_are_not_shuffled(spark):
    df = spark.range(100).union(spark.range(5)).select("id", F.repeat(F.lit("x"), 50).alias("wide"))
    once = dedup_by_hash(df)
    assert once.count() == 100
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("hashpartitioning") == 1  # that of the copies


def test_audit_both_ways(spark):
    df = frame(spark)
    full = [tuple(r) for r in clean_audit(df, ["x", "y"]).orderBy("step_no").collect()]
    cheap = [tuple(r) for r in clean_audit(df, ["x", "y"], cleaned=clean_rows(df, ["x", "y"])).orderBy("step_no").collect()]
    assert full == cheap == [
        (1, "nulls", 8, 5, 3, True), (2, "infinite", 5, 3, 2, True), (3, "duplicates", 3, 2, 1, True),
    ]


def test_audit_of_nothing(spark):
    rows = clean_audit(frame(spark, []), ["x", "y"]).collect()
    assert [(r.rows_before, r.rows_after, r.excessive) for r in rows] == [(0, 0, False)] * 3


def test_audit_counts_one_hot_row(spark):
    hot = spark.range(0, 30_000).select(F.lit(1.0).alias("x"), F.lit(1.0).alias("y"), F.lit("a").alias("label"))
    other = spark.range(0, 500).select(F.col("id").cast("double").alias("x"), F.lit(2.0).alias("y"), F.lit("b").alias("label"))
    last = clean_audit(hot.unionAll(other), ["x", "y"]).where("step_no = 3").first()
    assert (last.rows_before, last.rows_after, last.excessive) == (30_500, 501, True)
