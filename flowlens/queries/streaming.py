"""Streams over replayed wire lines. Every query runs its stream to the end and reads its sink."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.functions.predicates import flag_anomaly
from flowlens.operators.features import apply_label_dictionary, fit_label_dictionary, label_collisions
from flowlens.queries.modelling import fitted_scorer
from flowlens.queries.registry import FLOW_FEATURES, flows, query, table
from flowlens.sources.documents import read_metrics
from flowlens.sources.tables import read_table, write_batch
from flowlens.sources.wire import parse_wire, replay_stream, split_malformed, to_wire, wire_schema
from flowlens.streaming.commits import compact, drop_compacted, publish, read_committed, write_run
from flowlens.streaming.scoring import batch_writer, start_scoring
from flowlens.streaming.sla import SlaListener
from flowlens.workspace import shared_dir

EVENT_SCHEMA = "event_id double, value double, event_type string"
CUT = 60.0
LINES_PER_FILE, FILES_PER_CORE = 20_000, 2


def replayed(spark, lines):
    """Write lines to files of a fixed length and replay so many per micro-batch that every core has its share.

    A micro-batch costs a second or more however few its rows, so batches of two files on many cores take their time for that.
    """
    path = shared_dir(spark, "wire")
    lines.write.option("maxRecordsPerFile", LINES_PER_FILE).text(path)
    return replay_stream(spark, path, FILES_PER_CORE * spark.sparkContext.defaultParallelism)


def event_lines(spark, sf):
    """Events as wire lines, some of them broken: cut short, not a number, or too long."""
    rows = table(spark, sf, "events")
    good = F.to_csv(F.struct("event_id", "value", "event_type"))
    line = (
        F.when(F.col("value") < 1, F.col("event_id").cast("string"))
        .when(F.col("value") < 2, F.concat_ws(",", "event_id", F.lit("n/a"), "event_type"))
        .when(F.col("value") < 3, F.concat(good, F.lit(",a.csv,test")))
        .otherwise(good)
    )
    return rows.select(line.alias("value"))


def run(query_):
    query_.awaitTermination()
    return query_


def run_to_table(spark, stream, purpose: str):
    """Append a stream to a Parquet folder through the checkpointed file sink and read it."""
    out = shared_dir(spark, purpose)
    run(
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", shared_dir(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    return spark.read.schema(stream.schema).parquet(out)


LINES_SQL = """SELECT CAST(event_id AS DOUBLE) AS event_id,
    CASE WHEN value < 1 OR (value >= 1 AND value < 2) THEN NULL ELSE value END AS value,
    CASE WHEN value < 1 THEN NULL ELSE event_type END AS event_type FROM events"""


@query("stream_parse_csv", LINES_SQL)
def stream_parse_csv(spark, sf):
    """Lenient parse: short rows fill with NULL, bad numbers are NULL, extra fields drop."""
    stream = replayed(spark, event_lines(spark, sf))
    return run_to_table(spark, parse_wire(stream, EVENT_SCHEMA), "parsed")


@query(
    "stream_bad_rows",
    """SELECT CASE WHEN value < 1 THEN 'short' WHEN value < 2 THEN 'number' ELSE 'long' END AS kind, count(*) AS n
    FROM events WHERE value < 3 GROUP BY 1""",
)
def stream_bad_rows(spark, sf):
    """The malformed lines, counted by what is wrong with them."""
    _, bad = split_malformed(replayed(spark, event_lines(spark, sf)), EVENT_SCHEMA)
    lines = run_to_table(spark, bad, "bad")
    fields = F.size(F.split("value", ","))
    kind = F.when(fields < 3, "short").when(fields == 3, "number").otherwise("long")
    return lines.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def linear_score(rows):
    """Stand-in models that are functions of a row, so that SQL can check the stream."""
    return rows.withColumns(
        {
            "prediction": F.when(F.col("value") > 2 * CUT, 2.0).when(F.col("value") > CUT, 1.0).otherwise(0.0),
            "distanceToCentroid": F.col("value"),
            "is_anomaly": flag_anomaly(F.col("value"), CUT),
            "label": F.col("event_type"),
        }
    )


def scored_stream(spark, sf, paths):
    lines = to_wire(table(spark, sf, "events").select("event_id", "value", "event_type"), tail=["event_type"])
    stream = parse_wire(replayed(spark, lines), EVENT_SCHEMA)
    writer = batch_writer(
        linear_score,
        {paths["forest"]: ["event_id", "prediction", "label"], paths["clusters"]: ["event_id", "distanceToCentroid", "is_anomaly"]},
        paths["summary"],
    )
    return run(start_scoring(stream, writer, shared_dir(spark, "checkpoint"), trigger=None))


def sink_paths(spark):
    return {name: shared_dir(spark, name) for name in ("forest", "clusters", "summary")}


@query(
    "stream_sink_scores",
    f"""SELECT CAST(event_id AS DOUBLE) AS event_id, event_type AS label,
    CASE WHEN value > {2 * CUT} THEN CAST(2 AS DOUBLE) WHEN value > {CUT} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction,
    value AS "distanceToCentroid", CASE WHEN value > {CUT} THEN 1 ELSE 0 END AS is_anomaly FROM events""",
)
def stream_sink_scores(spark, sf):
    """Both per-batch sinks together hold every row once."""
    paths = sink_paths(spark)
    scored_stream(spark, sf, paths)
    forest, clusters = read_table(spark, paths["forest"]), read_table(spark, paths["clusters"])
    return forest.drop("batch_id").join(clusters.drop("batch_id"), "event_id")


class Stopped(Exception):
    """What a writer raises that stops half-way."""


def five_batches(spark, sf):
    """Events as a stream of five micro-batches, whatever their number."""
    rows = table(spark, sf, "events").select("event_id", "value", "event_type")
    path = shared_dir(spark, "wire")
    size = -(-rows.count() // 10) or 1
    to_wire(rows, tail=["event_type"]).coalesce(1).write.option("maxRecordsPerFile", size).text(path)
    return parse_wire(replay_stream(spark, path, 2), EVENT_SCHEMA)


def committing_writer(paths):
    return batch_writer(
        linear_score,
        {paths["forest"]: ["event_id", "prediction", "label"], paths["clusters"]: ["event_id", "distanceToCentroid", "is_anomaly"]},
        paths["summary"],
        commit_path=paths["commits"],
    )


@query(
    "label_dictionary_stream",
    """SELECT event_type AS label, CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS label_index, count(*) AS n,
    CAST(3 AS BIGINT) AS spellings FROM events GROUP BY event_type""",
)
def label_dictionary_stream(spark, sf):
    """A dictionary fitted on one way of writing labels gives a stream that writes them otherwise the same index."""
    dictionary = fit_label_dictionary(table(spark, sf, "events").select(F.col("event_type").alias("label")))
    spelled = F.when(F.col("event_id") % 3 == 0, F.upper("event_type")).when(F.col("event_id") % 3 == 1, F.initcap("event_type"))
    rows = table(spark, sf, "events").withColumn("event_type", F.coalesce(spelled, F.col("event_type")))
    stream = parse_wire(replayed(spark, to_wire(rows.select("event_id", "value", "event_type"), tail=["event_type"])), EVENT_SCHEMA)
    indexed = apply_label_dictionary(stream.withColumnRenamed("event_type", "written"), dictionary.withColumnRenamed("label", "written"), "written", shown="label")
    found = run_to_table(spark, indexed.select("written", "label", K.LABEL_INDEX), "indexed")
    several = label_collisions(found, "written").select("key", "spellings").distinct()
    counts = found.groupBy("label", K.LABEL_INDEX).agg(F.count("*").alias("n"))
    return counts.join(several.withColumnRenamed("key", "label"), "label")


@query(
    "stream_commit_restart",
    f"""SELECT CAST(event_id AS DOUBLE) AS event_id, event_type AS label,
    CASE WHEN value > {2 * CUT} THEN CAST(2 AS DOUBLE) WHEN value > {CUT} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction,
    value AS "distanceToCentroid", CASE WHEN value > {CUT} THEN 1 ELSE 0 END AS is_anomaly,
    TRUE AS torn_in_folders, TRUE AS whole_to_readers FROM events""",
)
def stream_commit_restart(spark, sf):
    """A writer stops after the first sink of its third batch; restarted, the stream ends with every row once.

    In between the folders are torn, but readers of committed batches see two whole ones.
    """
    paths = sink_paths(spark) | {"commits": shared_dir(spark, "commits")}
    stream, checkpoint = five_batches(spark, sf), shared_dir(spark, "checkpoint")
    whole = committing_writer(paths)

    def half(batch, batch_id):
        if batch_id < 2:
            return whole(batch, batch_id)
        write_batch(linear_score(batch), paths["forest"], batch_id, ["event_id", "prediction", "label"])
        raise Stopped

    try:
        run(start_scoring(stream, half, checkpoint, trigger=None))
    except StreamingQueryException:
        pass
    folders = [read_table(spark, paths[s]).select("batch_id").distinct().count() for s in ("forest", "clusters")]
    seen = [read_committed(spark, paths[s], paths["commits"]) for s in ("forest", "clusters")]
    kept = seen[0].select("event_id").exceptAll(seen[1].select("event_id")).count() == 0
    batches = [x.select("batch_id").distinct().count() for x in seen]
    run(start_scoring(stream, whole, checkpoint, trigger=None))
    forest, clusters = (read_committed(spark, paths[s], paths["commits"]).drop("batch_id") for s in ("forest", "clusters"))
    facts = {"torn_in_folders": F.lit(folders == [3, 2]), "whole_to_readers": F.lit(kept and batches == [2, 2])}
    return forest.join(clusters, "event_id").withColumns(facts)


@query(
    "stream_compaction",
    """SELECT state, count(*) AS n, count(DISTINCT event_id) AS events, round(sum(value), 3) AS total, TRUE AS in_folders
    FROM events, (VALUES ('before'), ('written'), ('published'), ('dropped'), ('again')) s(state) GROUP BY state""",
)
def stream_compaction(spark, sf):
    """What a reader sees before, during and after the compaction of three batches, and of the rest: every row once."""
    paths = sink_paths(spark) | {"commits": shared_dir(spark, "commits")}
    run(start_scoring(five_batches(spark, sf), committing_writer(paths), shared_dir(spark, "checkpoint"), trigger=None))
    sink, found = paths["clusters"], []

    def look(state: str, folders: int) -> None:
        rows = read_committed(spark, sink, paths["commits"])
        figures = rows.agg(F.count("*"), F.countDistinct("event_id"), F.round(F.sum("distanceToCentroid"), 3)).first()
        there = read_table(spark, sink).select("batch_id").distinct().count()
        found.append((state, *figures, there == folders))

    look("before", 5)
    name = write_run(spark, sink, paths["commits"], before=3)
    look("written", 5)
    publish(spark, sink, name)
    look("published", 5)
    drop_compacted(spark, sink, "0 seconds")
    look("dropped", 2)
    compact(spark, sink, paths["commits"])
    look("again", 2)
    return spark.createDataFrame(found, "state string, n long, events long, total double, in_folders boolean")


@query(
    "stream_batch_summary",
    f"""SELECT count(*) AS n, count(*) FILTER (value <= {CUT}) AS rf_benign, count(*) FILTER (value > {CUT}) AS rf_anomaly,
    count(*) FILTER (value > {CUT}) AS km_anom, count(*) FILTER (value <= {CUT}) AS km_normal,
    count(*) FILTER (value > {CUT} AND value <= {2 * CUT}) AS class_1, count(*) FILTER (value > {2 * CUT}) AS class_2,
    max(value) AS km_dist_max FROM events""",
)
def stream_batch_summary(spark, sf):
    """Per-batch summary rows, rolled up: how the lines fell into batches does not matter."""
    paths = sink_paths(spark)
    scored_stream(spark, sf, paths)
    counts = ("n", "rf_benign", "rf_anomaly", "km_anom", "km_normal")
    return read_table(spark, paths["summary"]).agg(
        *[F.sum(c).alias(c) for c in counts],
        *[F.coalesce(F.sum(F.try_element_at("rf_dist", F.lit(i))), F.lit(0)).alias(f"class_{i}") for i in (1, 2)],
        F.max("km_dist_max").alias("km_dist_max"),
    )


@query(
    "stream_score",
    "SELECT l_returnflag AS label, count(*) AS n, count(*) AS same FROM lineitem GROUP BY l_returnflag",
)
def stream_score(spark, sf):
    """Fitted models score a stream exactly as they score the same rows in a batch."""
    scorer = fitted_scorer(spark, sf)
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    rows = flows(spark, sf).select(*keys, *FLOW_FEATURES, "label")
    schema = wire_schema(sorted([*keys, *FLOW_FEATURES]))
    stream = parse_wire(replayed(spark, to_wire(rows)), schema)
    sink = shared_dir(spark, "scores")
    out = [*keys, K.LABEL, K.PREDICTION, K.CLUSTER, "distanceToCentroid", "is_anomaly"]
    run(start_scoring(stream, batch_writer(scorer.score, {sink: out}), shared_dir(spark, "checkpoint"), trigger=None))
    streamed = read_table(spark, sink).select(*out)
    batch = scorer.score(rows.select(*[F.col(c).cast("double").alias(c) for c in [*keys, *FLOW_FEATURES]], "label"))
    # equal rows may repeat: both sides are counted per distinct row, in one shuffle, and missing values equal each other
    both = streamed.withColumn("by_batch", F.lit(False)).unionByName(batch.select(*out, F.lit(True).alias("by_batch")))
    counted = both.groupBy(*out).agg(F.count_if(~F.col("by_batch")).alias("s"), F.count_if("by_batch").alias("b"))
    return counted.groupBy("label").agg(F.sum("b").alias("n"), F.sum(F.least("s", "b")).alias("same"))


@query(
    "sla_records",
    f"""SELECT 'all' AS stream, CAST(count(*) AS BIGINT) AS total_rows, TRUE AS one_query, TRUE AS rated FROM events
    UNION ALL SELECT 'high', CAST(count(*) AS BIGINT), TRUE, TRUE FROM events WHERE value > {CUT}""",
)
def sla_records_query(spark, sf):
    """Two streams at the same time, each with a listener: every log has the batches of its own stream."""
    rows = table(spark, sf, "events").select("event_id", "value", "event_type")
    started = []
    for name, part in (("all", rows), ("high", rows.where(F.col("value") > CUT))):
        stream = parse_wire(replayed(spark, to_wire(part, tail=["event_type"])), EVENT_SCHEMA)
        log = shared_dir(spark, "sla")
        listener = SlaListener(spark, log, f"{name}-{uuid.uuid4().hex}")
        spark.streams.addListener(listener)
        writer = stream.writeStream.format("noop").option("checkpointLocation", shared_dir(spark, "checkpoint"))
        started.append((name, log, listener, writer.queryName(listener.name).trigger(availableNow=True).start()))
    logs = []
    for name, log, listener, stream in started:
        run(stream)
        if not listener.finished.wait(60):
            raise TimeoutError(f"no end of stream {name} was reported")
        if listener.errors:
            raise listener.errors[0]
        logs.append(read_metrics(spark, log).withColumn("stream", F.lit(name)))
    return logs[0].unionByName(logs[1]).groupBy("stream").agg(
        F.sum("numRows").alias("total_rows"),
        (F.count_distinct("query_id") == 1).alias("one_query"),
        F.bool_and(F.col("status").isNotNull()).alias("rated"),
    )
