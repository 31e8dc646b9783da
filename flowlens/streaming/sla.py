"""Service-level records of streaming batches: listener, states, roll-ups, trends."""

from __future__ import annotations

import queue
import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from flowlens import conventions as K
from flowlens.functions.predicates import ratio_band, sla_status, throughput_ratio, value_band
from flowlens.operators.ranking import nearest_rank
from flowlens.sources.documents import write_metrics

PROGRESS_SCHEMA = (
    "batchId long, ts string, L_E2E_ms long, in_rate double, out_rate double, numRows long, "
    "t_read_ms long, t_add_batch_ms long, t_commit_ms long"
)


def progress_row(progress) -> tuple:
    """The measured fields of one streaming progress event."""
    took = progress.durationMs
    return (
        progress.batchId,
        progress.timestamp,
        took.get("triggerExecution", 0),
        float(progress.inputRowsPerSecond),
        float(progress.processedRowsPerSecond),
        progress.numInputRows,
        took.get("getBatch", 0),
        took.get("addBatch", 0),
        took.get("commitOffsets", 0),
    )


def sla_records(progress: DataFrame, ignore_idle: bool = False) -> DataFrame:
    """Progress rows as service-level records.

    Without an input rate the ratio is 0, which counts as a violation; ``ignore_idle`` rates such
    batches by latency alone.
    """
    ratio = throughput_ratio(F.col("in_rate"), F.col("out_rate"))
    judged = F.when(F.col("in_rate") > 0, ratio) if ignore_idle else ratio
    return progress.select(
        "batchId",
        "ts",
        "L_E2E_ms",
        F.round("in_rate", 1).alias("inputRps"),
        F.round("out_rate", 1).alias("procRps"),
        F.round(ratio, 3).alias("ratio"),
        "numRows",
        sla_status(F.col("L_E2E_ms"), F.coalesce(judged, F.lit(float("inf")))).alias("status"),
        "t_read_ms",
        "t_add_batch_ms",
        "t_commit_ms",
    )


class SlaListener(StreamingQueryListener):
    """Writes one service-level record per finished micro-batch of the query with the given name.

    Batches without input leave no record. Records that wait are written together by a thread of the listener, so that
    the log keeps up with batches shorter than a write. Once its query has ended and all records are written, the
    listener removes itself and sets ``finished``; ``errors`` has what kept records from being written.
    """

    def __init__(self, spark: SparkSession, path: str, name: str, ignore_idle: bool = False):
        self.spark = spark
        self.path = path
        self.name = name
        self.ignore_idle = ignore_idle
        self.query_id = None
        self.waiting: queue.SimpleQueue[tuple | None] = queue.SimpleQueue()
        self.errors: list[Exception] = []
        self.finished = threading.Event()

    def onQueryStarted(self, event):
        if event.name == self.name:
            self.query_id = str(event.id)
            threading.Thread(target=self._write_waiting, daemon=True).start()

    def onQueryProgress(self, event):
        progress = event.progress
        if str(progress.id) != self.query_id or not progress.numInputRows:
            return
        self.waiting.put(progress_row(progress))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if str(event.id) == self.query_id:
            self.spark.streams.removeListener(self)
            self.waiting.put(None)

    def _write_waiting(self) -> None:
        running = True
        while running:
            rows = [self.waiting.get()]
            while not self.waiting.empty():
                rows.append(self.waiting.get())
            running = None not in rows
            try:
                self._write([r for r in rows if r is not None])
            except Exception as err:  # the records of later batches are still wanted
                self.errors.append(err)
        self.finished.set()

    def _write(self, rows: list[tuple]) -> None:
        if rows:
            rows = list({r[0]: r for r in rows}.values())  # the last record of a batch
            progress = self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1)
            record = sla_records(progress, self.ignore_idle).select(F.lit(self.query_id).alias("query_id"), "*")
            write_metrics(record, self.path, self.query_id)


def recent_batches(log: DataFrame, n: int = K.SLA_HISTORY_KEPT, order: str = "batchId") -> DataFrame:
    """The last n batches, as a top-n rather than a sort of the whole log."""
    return log.orderBy(F.desc(order)).limit(n)


#: Share of the greatest allowed latency from which on it is near its limit (fixed value).
MAX_FAIR = 0.7


def sla_summary(log: DataFrame, order: str = "batchId", targets=K.SLA_TARGETS) -> DataFrame:
    """Batches, rows, compliance, worst latency and its band, and the state of the last batch, one row."""

    def last(col: str) -> Column:
        return F.max_by(col, order)

    rolled = log.agg(
        F.count("*").alias("batches"),
        F.coalesce(F.sum("numRows"), F.lit(0)).alias("total_rows"),
        F.count_if(F.col("status") == "OK").alias("compliant"),
        F.max("L_E2E_ms").alias("max_latency_ms"),
        last("inputRps").alias("last_input_rps"),
        last("procRps").alias("last_proc_rps"),
        last("ratio").alias("last_ratio"),
        last("status").alias("last_status"),
    )
    worst = value_band(F.col("max_latency_ms"), MAX_FAIR * targets["max"], targets["max"])
    return rolled.withColumns({"last_ratio_band": ratio_band(F.col("last_ratio")), "max_latency_band": worst})


def sla_percentiles(log: DataFrame, percents=K.SLA_PERCENTILES, targets=K.SLA_TARGETS) -> DataFrame:
    """Nearest-rank latency percentiles and the band each falls into."""
    found = nearest_rank(log, "L_E2E_ms", percents)
    bands = {  # band limits: 80 % of the target up to the target; P99 between the P95 and maximum targets
        "p50": (targets["p50"] * 0.8, targets["p50"]),
        "p95": (targets["p95"] * 0.8, targets["p95"]),
        "p99": (targets["p95"], targets["max"]),
    }
    return found.withColumns(
        {f"{p}_band": value_band(F.col(p), *limits) for p, limits in bands.items() if p in found.columns}
    )


def sla_rollup(log: DataFrame, last_n: int = K.SLA_HISTORY_KEPT, order: str = "batchId") -> tuple[DataFrame, DataFrame]:
    """Summary and percentiles of the last n batches."""
    recent = recent_batches(log, last_n, order)
    return sla_summary(recent, order), sla_percentiles(recent)


def batch_trend(summary: DataFrame, rate: str = "rf_rate", order: str = "batch_id") -> DataFrame:
    """Direction of a rate against the batch before (0 before the first).

    The window runs over one row per micro-batch, a history of batches rather than of data.
    """
    before = F.lag(rate, 1, 0.0).over(Window.orderBy(order))
    change = F.col(rate) - before
    return summary.withColumns(
        {
            "previous_rate": before,
            "trend": F.when(change > 0, "up").when(change < 0, "down").otherwise("flat"),
        }
    )
