import tempfile

import pytest
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.sources.csv import (
    first_lines,
    group_by_header,
    list_csv,
    read_raw_csv,
    read_raw_csv_by_name,
    read_with_fallback,
    undecodable_rows,
)
from flowlens.sources.documents import (
    append_metrics,
    load_manifest,
    read_doc,
    read_metrics,
    read_values,
    save_manifest,
    write_doc,
    write_values,
)
from flowlens.sources.tables import read_table, write_batch, write_table
from flowlens.sources.wire import parse_wire, split_malformed, to_wire, wire_columns, wire_schema
from flowlens.workspace import materialize, shared_dir


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def test_listing_and_suffix(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n1,2\n")
    put(tmp_path / "sub" / "b.CSV", "x,y\n3,4\n")
    put(tmp_path / "c.txt", "x,y\n9,9\n")
    put(tmp_path / "processed" / "d.csv", "x,y\n8,8\n")
    names = sorted(r.path.rsplit("/", 1)[1] for r in list_csv(spark, str(tmp_path)).collect())
    assert names == ["a.csv", "b.CSV"]
    paths = [r.path for r in list_csv(spark, str(tmp_path)).collect()]
    df = read_raw_csv(spark, paths)
    assert df.dtypes == [("x", "string"), ("y", "string"), (K.SOURCE_FILE, "string")]
    assert sorted((r.x, r[K.SOURCE_FILE].rsplit("/", 1)[1]) for r in df.collect()) == [("1", "a.csv"), ("3", "b.CSV")]


def test_headers_in_another_order(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n1,2\n")
    put(tmp_path / "b.csv", "y,x\n4,3\n")
    put(tmp_path / "c.csv", "x,y,z\n5,6,7\n")
    files = [str(tmp_path / f"{n}.csv") for n in "abc"]
    df = read_raw_csv_by_name(spark, files)
    assert sorted((r.x, r.y, r.z) for r in df.select("x", "y", F.coalesce("z", F.lit("-")).alias("z")).collect()) == [
        ("1", "2", "-"), ("3", "4", "-"), ("5", "6", "7"),
    ]
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, files[:2]).collect()
    with pytest.raises(FileNotFoundError):
        read_raw_csv_by_name(spark, [])


def test_repeated_header_names(spark, tmp_path):
    put(tmp_path / "a.csv", "Len,Fwd Len,Len\n1,2,3\n")
    put(tmp_path / "b.csv", "Len,Fwd Len,Len\n4,5,6\n")
    df = read_raw_csv(spark, str(tmp_path))
    assert df.columns == ["len0", "fwd_len", "len2", K.SOURCE_FILE]
    assert sorted(tuple(r)[:3] for r in df.collect()) == [("1", "2", "3"), ("4", "5", "6")]
    put(tmp_path / "c.csv", "Fwd Len,Len,Len\n5,4,6\n")
    with pytest.raises(ValueError, match="headers"):
        read_raw_csv(spark, str(tmp_path))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        read_raw_csv(spark, str(tmp_path / "empty"))


def test_many_files_with_several_headers(spark, tmp_path):
    for i in range(999):
        head = ("x,y", "y,x", "\n\nX, y ")[i % 3]
        put(tmp_path / f"part {i % 7}" / f"a+b %41 {i}.csv", f"{head}\n{i},{-i}\nx,y\n")
    put(tmp_path / "processed" / "d.csv", "other\n8\n")
    put(tmp_path / "empty.csv", "")
    put(tmp_path / "blank.csv", "\n  \n")
    groups = {bytes(r.header): r.files for r in group_by_header(spark, str(tmp_path)).collect()}
    assert groups == {b"x,y": 333, b"y,x": 333, b"X, y ": 333}
    df = read_raw_csv_by_name(spark, str(tmp_path))
    assert sorted(df.columns) == sorted(["x", "y", K.SOURCE_FILE])
    wanted = [(str(i), str(-i)) if i % 3 != 1 else (str(-i), str(i)) for i in range(999)]
    wanted += [("y", "x") if i % 3 == 1 else ("x", "y") for i in range(999)]  # a later line like the header is a row
    assert sorted((r.x, r.y) for r in df.collect()) == sorted(wanted)


def test_one_header_needs_no_list_of_files(spark, tmp_path):
    for i in range(50):
        put(tmp_path / f"{i}.csv", f"x,y\n{i},z\n")
    put(tmp_path / "processed" / "d.csv", "other\n8\n")
    df = read_raw_csv_by_name(spark, str(tmp_path))
    assert df.count() == 50 and df.columns == ["x", "y", K.SOURCE_FILE]
    assert read_raw_csv(spark, str(tmp_path)).count() == 50
    put(tmp_path / "only" / "empty.csv", "")
    with pytest.raises(FileNotFoundError):
        read_raw_csv_by_name(spark, str(tmp_path / "only"))


def test_first_line_of_a_file_in_several_splits(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n" + "1,2\n" * 50_000)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        rows = first_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [bytes(r.header) for r in rows] == [b"x,y"]


def test_encoding_fallback(spark, tmp_path):
    put(tmp_path / "u.csv", "x,label\n1,señal\n")
    put(tmp_path / "l.csv", "x,label\n2,señal\n", "latin-1")
    files = [str(tmp_path / "u.csv"), str(tmp_path / "l.csv")]
    audit = {r[K.SOURCE_FILE].rsplit("/", 1)[1]: r.undecodable for r in undecodable_rows(read_raw_csv_by_name(spark, files)).collect()}
    assert audit == {"u.csv": 0, "l.csv": 1}
    assert {(r.x, r.label) for r in read_with_fallback(spark, files).collect()} == {("1", "señal"), ("2", "señal")}


def test_documents(spark, tmp_path):
    path = str(tmp_path / "doc")
    assert read_values(spark, path) == {}
    assert read_values(spark, path, {"a": 1}) == {"a": 1}
    doc = {"k": 3, "nested": {"f": 0.1, "list": [1, None, "x"]}, "text": "ü\n"}
    write_values(spark, doc, path)
    write_values(spark, doc, path)
    assert read_values(spark, path) == doc
    table = str(tmp_path / "table")
    assert read_doc(spark, table, "a int").count() == 0
    write_doc(spark.createDataFrame([(1, (2.0,))], "a int, s struct<v: double>"), table)
    assert read_doc(spark, table, "a int, s struct<v: double>, missing string").first().asDict(True) == {
        "a": 1, "s": {"v": 2.0}, "missing": None,
    }


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "features")
    assert load_manifest(spark, path) == []
    save_manifest(spark, ["b", "a"], path)
    assert load_manifest(spark, path) == ["a", "b"]


def test_metric_log_skips_broken_lines(spark, tmp_path):
    path = str(tmp_path / "log")
    append_metrics(spark.createDataFrame([(1, "OK")], "batchId long, status string"), path)
    append_metrics(spark.createDataFrame([(2, "OK")], "batchId long, status string"), path)
    (tmp_path / "log" / "torn.json").write_text('{"batchId": 3, "sta\nnot json\n')
    assert sorted(r.batchId for r in read_metrics(spark, path).collect()) == [1, 2]


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"]), path, ["c", "a"])
    assert read_table(spark, path).columns == ["c", "a"]
    batches = str(tmp_path / "b")
    for n in (2, 3):
        write_batch(spark.range(n), batches, 7)
    write_batch(spark.range(1), batches, 8)
    assert {(r.batch_id, r["count"]) for r in read_table(spark, batches).groupBy("batch_id").count().collect()} == {(7, 3), (8, 1)}


def test_wire_roundtrip(spark):
    rows = [(1.5, "a,b", 2.0, "f"), (None, 'q"x', float("nan"), "g"), (float("inf"), None, -float("inf"), "h")]
    df = spark.createDataFrame(rows, "z double, label string, a double, _source_file string")
    assert wire_columns(df) == ["a", "z", "label", K.SOURCE_FILE]
    back = parse_wire(to_wire(df), wire_schema(["a", "z"]))
    assert str(sorted(back.collect(), key=str)) == str(sorted(df.select("a", "z", "label").collect(), key=str))


def test_malformed_lines(spark):
    lines = spark.createDataFrame([("1.0,2.0,x",), ("1.0",), ("a,2.0,x",), ("1.0,2.0,x,y,z",)], "value string")
    parsed = parse_wire(lines, wire_schema(["a", "b"]))
    assert [tuple(r) for r in parsed.collect()] == [
        (1.0, 2.0, "x"), (1.0, None, None), (None, 2.0, "x"), (1.0, 2.0, "x"),
    ]
    good, bad = split_malformed(lines, wire_schema(["a", "b"]))
    assert [tuple(r) for r in good.collect()] == [(1.0, 2.0, "x")]
    assert sorted(r.value for r in bad.collect()) == ["1.0", "1.0,2.0,x,y,z", "a,2.0,x"]


def test_workspace(spark):
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    again = materialize(df, "cut")
    assert again.schema["v"].dataType == df.schema["v"].dataType
    assert again.exceptAll(df).count() == 0
    assert "Range" not in again._jdf.queryExecution().logical().toString()


def test_workspace_reads_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark, "x").startswith(base.rstrip("/") if base else tempfile.gettempdir())
