"""Scoring a stream micro-batch by micro-batch with both models."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens import conventions as K
from flowlens.functions.predicates import all_finite, flag_anomaly
from flowlens.operators.clustering import centroid_side, centroid_table, distance_to_side
from flowlens.operators.forest import transform_by_cells
from flowlens.sources.tables import write_batch
from flowlens.sources.wire import CORRUPT
from flowlens.streaming.commits import commit, is_committed

DISTANCE = "distanceToCentroid"
FOREST_SINK = [K.PREDICTION, K.LABEL, K.LABEL_INDEX]
CLUSTER_SINK = [K.CLUSTER, DISTANCE, "is_anomaly", K.LABEL]


@dataclass
class Scorer:
    """The fitted stages a stream is scored with: preparation, forest, clusters, threshold.

    For many rows to come ``by_cells`` applies the forest through a table of its cells, with the same result.
    """

    preparation: PipelineModel
    forest: PipelineModel
    clusters: PipelineModel
    threshold: float = K.STREAM_THRESHOLD
    side: DataFrame | None = None
    by_cells: bool = False

    def score(self, rows: DataFrame) -> DataFrame:
        """Both models on the same prepared rows, in one plan.

        Works on batch and on streaming frames: every step is a projection or a join to centroids.
        A row with a missing or infinite feature has no nearest centroid (the cluster model would
        fail on it): it gets no cluster and a NaN distance, and so counts as an anomaly.
        """
        features = next(s for s in self.preparation.stages if isinstance(s, VectorAssembler)).getInputCols()
        usable = F.coalesce(all_finite(features), F.lit(False))
        zeros = array_to_vector(F.array_repeat(F.lit(0.0), len(features)))
        prepared = self.preparation.transform(rows)
        classified = transform_by_cells(self.forest.stages[-1], prepared) if self.by_cells else self.forest.transform(prepared)
        guarded = classified.withColumns({"__usable": usable, "__scaled": F.col(K.SCALED_VECTOR)}).withColumn(
            K.SCALED_VECTOR, F.when(F.col("__usable"), F.col(K.SCALED_VECTOR)).otherwise(zeros)
        )
        clustered = self.clusters.transform(guarded)
        if self.side is None:  # the same for every micro-batch
            self.side = centroid_side(centroid_table(rows.sparkSession, self.clusters))
        scored = distance_to_side(clustered, self.side, K.SCALED_VECTOR, K.CLUSTER, DISTANCE).withColumns(
            {
                K.SCALED_VECTOR: F.col("__scaled"),
                K.CLUSTER: F.when(F.col("__usable"), F.col(K.CLUSTER)),
                DISTANCE: F.when(F.col("__usable"), F.col(DISTANCE)).otherwise(F.lit(float("nan"))),
            }
        )
        flag = flag_anomaly(F.col(DISTANCE), self.threshold)
        return scored.withColumn("is_anomaly", flag).drop("__usable", "__scaled")


def batch_summary(
    scored: DataFrame,
    prediction: str = K.PREDICTION,
    label: str = K.LABEL,
    distance: str = DISTANCE,
    flag: str = "is_anomaly",
    benign: int = 0,
) -> DataFrame:
    """One row about a batch: sizes, predicted-class counts with their usual label, distances.

    Rows are counted per predicted class and label first; only those counts are gathered into maps.
    NaN distances count as anomalies but not in the mean and maximum. Expressions are given as SQL
    text, which costs a running stream less planning time per batch.
    """
    known_distance = f"nanvl(`{distance}`, CAST(NULL AS DOUBLE))"
    cells = scored.groupBy(
        F.expr(f"CAST(`{prediction}` AS INT) AS class"), F.col(label).alias("true_label")
    ).agg(
        F.expr("count(*) AS n"),
        F.expr(f"sum(`{flag}`) AS flags"),
        F.expr(f"sum({known_distance}) AS dist_sum"),
        F.expr(f"count({known_distance}) AS dist_n"),
        F.expr(f"max({known_distance}) AS dist_max"),
    )
    usual = "min_by(true_label, struct(-n, true_label))"
    classes = cells.groupBy("class").agg(
        F.expr(f"coalesce({usual}, 'class_' || class) AS usual_label"),
        F.expr("sum(n) AS n"),
        F.expr("sum(flags) AS flags"),
        F.expr("sum(dist_sum) AS dist_sum"),
        F.expr("sum(dist_n) AS dist_n"),
        F.expr("max(dist_max) AS dist_max"),
    )
    known = "FILTER (WHERE class IS NOT NULL)"
    sums = classes.agg(
        F.expr("coalesce(sum(n), 0) AS n"),
        F.expr(f"coalesce(sum(n) FILTER (WHERE class = {int(benign)}), 0) AS rf_benign"),
        F.expr(f"map_from_entries(sort_array(collect_list(struct(class, n)) {known})) AS rf_dist"),
        F.expr(f"map_from_entries(sort_array(collect_list(struct(class, usual_label)) {known})) AS label_map"),
        F.expr("coalesce(sum(flags), 0) AS km_anom"),
        F.expr("round(coalesce(try_divide(sum(dist_sum), sum(dist_n)), 0D), 2) AS km_dist_mean"),
        F.expr("round(coalesce(max(dist_max), 0D), 2) AS km_dist_max"),
    )
    return sums.selectExpr(
        "n", "rf_benign", "n - rf_benign AS rf_anomaly", "rf_dist", "label_map",
        "km_anom", "n - km_anom AS km_normal", "km_dist_mean", "km_dist_max",
    )


def batch_writer(
    score: Callable[[DataFrame], DataFrame],
    sinks: dict[str, Sequence[str]],
    summary_path: str | None = None,
    summarise: Callable[[DataFrame], DataFrame] = batch_summary,
    bad_path: str | None = None,
    commit_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """The function a stream calls per micro-batch: score once, write each sink, write a summary row.

    ``sinks`` maps a path to its columns. Each batch owns one partition of every sink, so a batch
    that is run again after a failure replaces its own rows. The cache is filled first, with the columns of the sinks if there
    is no summary, so that no row is scored twice; then the sinks, which do not depend on each other, are written at the same
    time; any failure fails the batch. The summary follows with ``proc_ms``, the time all this took.

    With ``commit_path`` the batch gets a commit record after all else; ``read_committed`` shows it from then on, and a batch
    that has one isn't written again.
    With ``bad_path`` the batch comes from ``parse_wire_checked``: malformed lines go there and aren't scored.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        start = time.monotonic()
        spark = batch.sparkSession
        if commit_path and is_committed(spark, commit_path, batch_id):
            return
        tasks = []
        if bad_path:
            bad = batch.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
            tasks.append(partial(write_batch, bad, bad_path, batch_id))
            batch = batch.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        scored = score(batch)
        if sinks and not summary_path:
            scored = scored.select(*dict.fromkeys(c for cols in sinks.values() for c in cols))
        scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = scored.count()
            tasks += [partial(write_batch, scored, path, batch_id, cols) for path, cols in sinks.items() if rows]
            with ThreadPoolExecutor(max(1, len(tasks))) as pool:
                running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
            for done in running:
                done.result()
            if summary_path and rows:
                took = int((time.monotonic() - start) * 1000)
                extra = [F.expr("date_format(current_timestamp(), 'HH:mm:ss') AS ts"), F.lit(took).cast("long").alias("proc_ms")]
                write_batch(summarise(scored).select("*", *extra).coalesce(1), summary_path, batch_id)
            if commit_path:
                commit(spark, commit_path, batch_id, rows)
        finally:
            scored.unpersist()

    return write


def start_scoring(
    stream: DataFrame,
    writer: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = K.TRIGGER,
    name: str | None = None,
) -> StreamingQuery:
    """Start the stream. Without a trigger interval it handles what is there and stops."""
    timing = {"processingTime": trigger} if trigger else {"availableNow": True}
    started = stream.writeStream.queryName(name) if name else stream.writeStream
    return (
        started.foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .trigger(**timing)
        .start()
    )
