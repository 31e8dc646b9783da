import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from flowlens.functions.predicates import rate_band, ratio_band, sla_status, value_band
from flowlens.queries import streaming
from flowlens.sources.documents import read_metrics
from flowlens.sources.tables import read_table
from flowlens.sources.wire import LINEAGE_SCHEMA, parse_wire, parse_wire_checked, replay_stream
from flowlens.streaming.scoring import batch_summary, batch_writer, start_scoring
from flowlens.streaming.sla import SlaListener, batch_trend, recent_batches, sla_records, sla_rollup, PROGRESS_SCHEMA

SCHEMA = "v double, label string"


def score(df):
    return df.withColumns(
        {
            "prediction": F.when(F.col("v") > 5, 1.0).otherwise(0.0),
            "distanceToCentroid": F.col("v"),
            "is_anomaly": (F.col("v") > 7).cast("int"),
        }
    )


def put(folder, name, values):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(f"{v},c{v % 2}\n" for v in values))


def start(spark, tmp_path, writer, name=None):
    stream = parse_wire(replay_stream(spark, str(tmp_path / "in"), 1), SCHEMA)
    return start_scoring(stream, writer, str(tmp_path / "checkpoint"), trigger=None, name=name)


def test_stream_equals_batch_and_restarts_without_copies(spark, tmp_path):
    out, summary = str(tmp_path / "out"), str(tmp_path / "summary")
    writer = batch_writer(score, {out: ["v", "prediction", "label"]}, summary)
    put(tmp_path / "in", "a.txt", range(0, 10))
    put(tmp_path / "in", "b.txt", range(10, 15))
    start(spark, tmp_path, writer).awaitTermination()
    assert read_table(spark, summary).count() == 2
    put(tmp_path / "in", "c.txt", range(15, 18))
    start(spark, tmp_path, writer).awaitTermination()
    rows = read_table(spark, out)
    assert sorted(r.v for r in rows.collect()) == [float(i) for i in range(18)]
    assert {r.batch_id: r.n for r in rows.groupBy("batch_id").agg(F.count("*").alias("n")).collect()}[2] == 3
    lines = spark.read.text(str(tmp_path / "in"))
    batch = score(parse_wire(lines, SCHEMA)).select("v", "prediction", "label")
    assert rows.drop("batch_id").exceptAll(batch).count() == 0


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    out, summary = str(tmp_path / "out"), str(tmp_path / "summary")
    writer = batch_writer(score, {out: ["v"]}, summary)
    df = spark.createDataFrame([(1.0, "a"), (9.0, "b")], SCHEMA)
    for _ in range(2):
        writer(df, 4)
    assert read_table(spark, out).count() == 2
    assert read_table(spark, summary).count() == 1


def test_empty_batch_writes_nothing(spark, tmp_path):
    writer = batch_writer(score, {str(tmp_path / "out"): ["v"]}, str(tmp_path / "summary"))
    writer(spark.createDataFrame([], SCHEMA), 0)
    assert not (tmp_path / "out").exists() and not (tmp_path / "summary").exists()


def test_failing_score_surfaces(spark, tmp_path):
    put(tmp_path / "in", "a.txt", [1])
    query = start(spark, tmp_path, batch_writer(lambda df: df.select("nope"), {}))
    with pytest.raises(Exception, match="nope"):
        query.awaitTermination()


def test_batch_summary(spark):
    df = score(spark.createDataFrame([(1.0, "a"), (6.0, "b"), (8.0, "b"), (9.0, "c"), (None, None)], SCHEMA))
    row = batch_summary(df).first()
    assert (row.n, row.rf_benign, row.rf_anomaly, row.km_anom, row.km_normal) == (5, 2, 3, 2, 3)
    assert row.rf_dist == {0: 2, 1: 3}
    assert row.label_map == {0: "a", 1: "b"} or row.label_map[1] == "b"
    assert (row.km_dist_mean, row.km_dist_max) == (6.0, 9.0)
    none = batch_summary(df.limit(0)).first()
    assert (none.n, none.rf_benign, none.km_anom, none.km_dist_mean, none.rf_dist) == (0, 0, 0, 0.0, {})


def test_unlabelled_class_gets_a_name(spark):
    df = score(spark.createDataFrame([(1.0, None)], SCHEMA))
    assert batch_summary(df).first().label_map == {0: "class_0"}


@pytest.mark.parametrize("latency", [0, 22000, 22001, 35001, 60001])
@pytest.mark.parametrize("ratio", [0.99, 1.0, 1.1, 1.2])
def test_sla_states(spark, latency, ratio):
    if latency > 60000 or ratio < 1.0:
        want = "VIOLATION"
    elif latency > 35000 or ratio < 1.1:
        want = "CRITICAL"
    elif latency > 22000 or ratio < 1.2:
        want = "WARNING"
    else:
        want = "OK"
    got = spark.range(1).select(sla_status(F.lit(latency), F.lit(ratio)).alias("s")).first().s
    assert got == want


def progress(spark, rows):
    return spark.createDataFrame([(i, f"t{i}", *r, 10, 1, 2, 3) for i, r in enumerate(rows)], PROGRESS_SCHEMA)


def test_first_batch_without_input_rate(spark):
    df = progress(spark, [(100, 0.0, 50.0), (100, 10.0, 20.0)])
    assert [r.status for r in sla_records(df).orderBy("batchId").collect()] == ["VIOLATION", "OK"]
    assert [r.status for r in sla_records(df, ignore_idle=True).orderBy("batchId").collect()] == ["OK", "OK"]


def test_rollup_of_recent_batches(spark):
    log = sla_records(progress(spark, [(1000 * i, 10.0, 10.0 + i) for i in range(40)]))
    summary, percentiles = sla_rollup(log, last_n=30)
    s = summary.first()
    assert (s.batches, s.total_rows, s.max_latency_ms, s.last_status) == (30, 300, 39000, "CRITICAL")
    assert percentiles.first().p50 == 25000.0
    assert [r.batchId for r in recent_batches(log, 3).collect()] == [39, 38, 37]
    empty, _ = sla_rollup(log.limit(0))
    assert (empty.first().batches, empty.first().total_rows) == (0, 0)


def test_trend(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0), (4, 1.0)], "batch_id int, rf_rate double")
    assert [(r.previous_rate, r.trend) for r in batch_trend(df).orderBy("batch_id").collect()] == [
        (0.0, "up"), (5.0, "up"), (7.0, "flat"), (7.0, "down"),
    ]


def test_bands(spark):
    df = spark.createDataFrame([(v,) for v in (9.9, 10.0, 29.9, 30.0)], "v double")
    assert [r[0] for r in df.select(rate_band(F.col("v"))).collect()] == ["ok", "warn", "warn", "high"]
    assert [r[0] for r in df.select(value_band(F.col("v"), 10, 30)).collect()] == ["ok", "ok", "warn", "bad"]
    ratios = spark.createDataFrame([(v,) for v in (0.9, 1.0, 1.2)], "v double")
    assert [r[0] for r in ratios.select(ratio_band(F.col("v"))).collect()] == ["bad", "warn", "ok"]


def test_listener_writes_the_batches_of_its_own_query_once(spark, tmp_path):
    logs = {}
    for name, sizes in (("one", (5, 3)), ("two", (7,))):
        folder = tmp_path / name
        for i, n in enumerate(sizes):
            put(folder / "in", f"{i}.txt", range(n))
        logs[name] = SlaListener(spark, str(folder / "sla"), f"listener-test-{name}")
        spark.streams.addListener(logs[name])
        writer = batch_writer(score, {str(folder / "out"): ["v"]})
        start(spark, folder, writer, name=logs[name].name).awaitTermination()
    for name, sizes in (("one", [3, 5]), ("two", [7])):
        assert logs[name].finished.wait(60)
        rows = read_metrics(spark, logs[name].path).collect()
        assert sorted(r.numRows for r in rows) == sizes
        assert {r.query_id for r in rows} == {logs[name].query_id}
        assert {r.status for r in rows} <= {"OK", "WARNING", "CRITICAL", "VIOLATION"}
        assert all(r.L_E2E_ms > 0 for r in rows)


def test_records_that_wait_are_written_together(spark, tmp_path):
    """A hundred batches that end at once are one write, and the log is whole when the listener has finished."""
    log = SlaListener(spark, str(tmp_path), "short-batches")
    jobs, write = [], log._write
    log._write = lambda rows: (jobs.append(len(rows)), write(rows))
    log.onQueryStarted(SimpleNamespace(name="short-batches", id="q"))
    for i in [*range(100), 7]:  # batch 7 once more
        progress = SimpleNamespace(
            id="q", numInputRows=i + 1, batchId=i, timestamp="t", durationMs={"triggerExecution": 5}, inputRowsPerSecond=1.0,
            processedRowsPerSecond=2.0,
        )
        log.onQueryProgress(SimpleNamespace(progress=progress))
        if i == 99:
            while sum(jobs) < 100:
                time.sleep(0.05)
    log.onQueryTerminated(SimpleNamespace(id="q"))
    assert log.finished.wait(60) and not log.errors
    assert sum(jobs) == 101 and len(jobs) < 20
    rows = read_metrics(spark, str(tmp_path)).collect()
    assert sorted(r.numRows for r in rows) == list(range(1, 101)) and {r.query_id for r in rows} == {"q"}
    assert len(list(tmp_path.glob("query_id=q/batch_id=*"))) == 100


def test_replayed_batches_give_every_core_its_share(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streaming, "LINES_PER_FILE", 10)
    cores, share = spark.sparkContext.defaultParallelism, streaming.FILES_PER_CORE
    rows = spark.range(0, 30 * cores * share, 1, 1).selectExpr("CAST(id AS STRING) AS value")
    batches = []
    replayed = streaming.replayed(spark, rows).writeStream.foreachBatch(lambda df, i: batches.append(df.count()))
    replayed.option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start().awaitTermination()
    assert batches == [10 * cores * share] * 3


def test_a_log_that_is_not_there_has_no_rows(spark, tmp_path):
    assert read_metrics(spark, str(tmp_path / "nothing")).count() == 0


def test_lines_may_end_with_their_origin(spark):
    texts = ["1,a", "1,a,f.csv,train", "1,a,f.csv", "x,a,f.csv,train", ",a,f.csv,train", ",a"]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = parse_wire_checked(lines, "v double, label string", LINEAGE_SCHEMA).collect()
    assert [r[2] for r in rows] == [None, None, "1,a,f.csv", "x,a,f.csv,train", None, None]
    assert [(r.v, r.label) for r in rows[:2]] == [(1.0, "a")] * 2


def test_malformed_lines_have_their_own_table(spark, tmp_path):
    lines = spark.createDataFrame([("1.5,a",), ("x,a",), ("2.5",), ("1,2,3",)], "value string")
    rows = parse_wire_checked(lines, "v double, label string")
    paths = {name: str(tmp_path / name) for name in ("good", "bad", "summary")}

    def scored(df):
        return df.selectExpr("*", "0D AS prediction", "v AS distanceToCentroid", "0 AS is_anomaly")

    batch_writer(scored, {paths["good"]: ["v", "label"]}, paths["summary"], bad_path=paths["bad"])(rows, 3)
    assert [r.v for r in spark.read.parquet(paths["good"]).collect()] == [1.5]
    assert sorted(r.value for r in spark.read.parquet(paths["bad"]).collect()) == ["1,2,3", "2.5", "x,a"]
    summary = spark.read.parquet(paths["summary"]).first()
    assert summary.n == 1 and summary.proc_ms >= 0 and summary.ts
