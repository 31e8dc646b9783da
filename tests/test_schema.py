import pytest
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.functions.names import normalize_name, normalized
from flowlens.operators.schema import (
    align_schema,
    cast_features,
    cast_failures,
    castable_profile,
    detect_numeric,
    normalize_columns,
    rename_guarded,
    require_columns,
    route_split,
    schema_diff,
    union_by_name,
)
from flowlens.functions.predicates import weekday_token
from flowlens.sources.wire import wire_schema

NAMES = {
    " Flow Bytes/s ": "flow_bytess",
    "A  B\tC": "a_b_c",
    "Down/Up Ratio": "downup_ratio",
    "Fwd Header Length.1": "fwd_header_length1",
    "": "",
}


def test_normalize_name_and_column_agree(spark):
    assert {n: normalize_name(n) for n in NAMES} == NAMES
    df = spark.createDataFrame([(n,) for n in NAMES], "raw string").withColumn("name", normalized(F.col("raw")))
    assert {r.raw: r.name for r in df.collect()} == NAMES


def test_colliding_names_fail(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "A/ B"])
    assert normalize_columns(df.select("a b")).columns == ["a_b"]
    with pytest.raises(ValueError, match="a_b"):
        normalize_columns(df)


def test_rename_guarded(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    assert rename_guarded(df, {"a": "x"}).columns == ["x", "b", "c"]
    assert rename_guarded(df, {"a": "b"}).columns == ["a", "b", "c"]
    assert rename_guarded(df, {"q": "x"}).columns == ["a", "b", "c"]
    assert rename_guarded(df, {"a": "x", "b": "x"}).columns == ["x", "b", "c"]
    assert rename_guarded(df, {"a": "x", "x": "y"}).columns == ["y", "b", "c"]


def test_fixed_lists():
    assert len(K.WIRE_FEATURES) == 78 == len(set(K.WIRE_FEATURES))
    assert sorted(K.WIRE_FEATURES) == K.WIRE_FEATURES
    assert len(K.HOMOLOGATION) == 45
    off = sorted(set(K.HOMOLOGATION.values()) - set(K.WIRE_FEATURES))
    assert len(off) == 8  # these names never match a normalised feature; schema_diff reports them


def test_cast_rules(spark):
    raw = ["abc", "1.5", "Infinity", "-inf", "NaN", " 2 ", "", None]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(raw)], "i int, v string, label string")
    got = [r.v for r in cast_features(df.orderBy("i"), ["v"], keep=["label"]).collect()]
    assert got[:4] == [None, 1.5, float("inf"), float("-inf")]
    assert got[4] != got[4]
    assert got[5:] == [2.0, None, None]


def test_detect_numeric(spark):
    rows = [("1", "a", None, "x", "1"), ("2.5", "1", None, "x", None)]
    df = spark.createDataFrame(rows, "n string, t string, e string, label string, h string")
    profile = {r["column"]: (r.non_null, r.castable, r.is_numeric) for r in castable_profile(df).collect()}
    assert profile == {"n": (2, 2, True), "t": (2, 1, False), "e": (0, 0, False), "h": (1, 1, True)}
    assert detect_numeric(df) == ["n", "h"]
    assert castable_profile(df.select("label")).count() == 0


def test_align_and_diff(spark):
    df = spark.createDataFrame([(1.0, 2.0, "x", "f")], ["b", "extra", "label", "_source_file"])
    out = align_schema(df, ["a", "b", "c"])
    assert out.columns == ["a", "b", "c", "label", "_source_file"]
    assert tuple(out.first()) == (0.0, 1.0, 0.0, "x", "f")
    diff = {(r["column"], r.status, r.non_null) for r in schema_diff(df, ["a", "b", "c"]).collect()}
    assert diff == {("extra", "extra", 1), ("a", "imputed", 0), ("c", "imputed", 0)}
    assert schema_diff(out, ["a", "b", "c"]).count() == 0


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], ["a"])
    assert require_columns(df, ["a"]) is df
    with pytest.raises(KeyError, match="label"):
        require_columns(df, ["label"])


def test_route_split(spark):
    files = [
        "Monday-WorkingHours.csv", "Tuesday-x.csv", "wednesday.csv", "THURSDAY.csv", "Friday-Afternoon.csv",
        "Saturday.csv", "friday-after-monday.csv", None,
    ]
    df = spark.createDataFrame([(f,) for f in files], "file string")
    got = {r.file: r[K.SPLIT] for r in route_split(df, weekday_token(F.col("file"))).collect()}
    assert got == {
        "Monday-WorkingHours.csv": "train", "Tuesday-x.csv": "test", "wednesday.csv": "train",
        "THURSDAY.csv": "test", "Friday-Afternoon.csv": "train", "friday-after-monday.csv": "train",
    }


def test_weekday_is_tried_in_day_order_not_by_position(spark):
    df = spark.createDataFrame([("thursday-then-tuesday",)], "file string")
    assert df.select(weekday_token(F.col("file")).alias("d")).first().d == "tuesday"


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2.0)], "s string, d double")
    out = union_by_name([a, b, a])
    assert out.columns == ["i", "s", "d"]
    assert sorted((r.s, r.i, r.d) for r in out.collect()) == [("x", 1, None), ("x", 1, None), ("y", None, 2.0)]


def test_wire_schema():
    assert wire_schema(["a", "b"]) == "`a` double, `b` double, `label` string"


def test_cast_failures_of_thousands_of_columns(spark):
    n = 2000
    names = [f"c{i}" for i in range(n)]
    rows = [("a", *["1.5"] * n), ("a", *[None if i % 2 else "x" for i in range(n)]), ("b", *["NaN"] * n)]
    df = spark.createDataFrame(rows, ", ".join(["split string", *(f"{c} string" for c in names)]))
    found = {(r.split, r.column): tuple(r[2:]) for r in cast_failures(df, "split").collect()}
    assert len(found) == 2 * n
    assert found["a", "c0"] == (2, 0, 1, 1) and found["a", "c1"] == (2, 1, 1, 0) and found["b", "c7"] == (1, 0, 1, 0)


def test_cast_failures_of_no_columns(spark):
    assert cast_failures(spark.createDataFrame([("a",)], "split string"), "split").count() == 0
