"""Batches that become visible as a whole, and the compaction of their folders.

A stream writes each micro-batch to several sinks, a folder per batch and sink. A commit record, written after all
sinks, makes the batch visible: readers join it. So a batch whose writer stopped half-way isn't seen until it
has run again, and one that runs again after its record was written is left as it is.

Compaction rewrites committed batches into day partitions of one run. Its marker, which lists the batches, is written
last: before, readers take the batches from their own folders, afterwards from the run. A reader that has listed the
markers keeps to them, so it sees each batch once at any time. Old folders go in a step of their own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.sources.tables import read_table

COMMITS = "rows long, day date, written timestamp, batch_id int"
MARKERS = "batch_id int, written timestamp, run string"


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not exist yet."""
    files, where = _folder(spark, path)
    if not files.exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id``, ``rows``, ``day`` and ``written`` of all committed batches."""
    return _read(spark, path, COMMITS)


def commit(spark: SparkSession, path: str, batch_id: int, rows: int) -> None:
    """Make a batch visible. One file, which appears at once or not at all."""
    record = spark.range(1, numPartitions=1).select(
        F.lit(rows).cast("long").alias("rows"), F.current_date().alias("day"), F.current_timestamp().alias("written")
    )
    record.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    files, where = _folder(spark, f"{path}/batch_id={int(batch_id)}/_SUCCESS")
    return files.exists(where)


def markers(spark: SparkSession, sink: str) -> DataFrame:
    """``run`` and ``written`` of every batch of a sink that has been compacted."""
    return _read(spark, f"{sink}_markers", MARKERS)


def read_committed(spark: SparkSession, sink: str, commit_path: str) -> DataFrame:
    """The rows of all committed batches of a sink, each once, whatever is being written or compacted."""
    moved = markers(spark, sink)  # listed first; both halves below keep to this list
    files, where = _folder(spark, sink)
    halves = []
    if files.exists(where):
        known = commits(spark, commit_path).select("batch_id")
        halves.append(read_table(spark, sink).join(known, "batch_id", "left_semi").join(moved, "batch_id", "left_anti"))
    if moved.limit(1).count():
        runs = read_table(spark, f"{sink}_runs").join(moved.select("run").distinct(), "run", "left_semi")
        halves.append(runs.drop("run", "day"))
    if not halves:
        raise FileNotFoundError(f"no batches in {sink}")
    return halves[0] if len(halves) == 1 else halves[0].unionByName(halves[1])


def write_run(spark: SparkSession, sink: str, commit_path: str, before: int | None = None) -> str | None:
    """Rewrite the committed, not yet compacted batches (with ids under ``before``) by day; the run's name, or None.

    Nobody sees the run until ``publish``. Partitions are balanced by size, so that a day with most of the rows
    is several files and a day with few is one.
    """
    closed = commits(spark, commit_path).join(markers(spark, sink), "batch_id", "left_anti")
    if before is not None:
        closed = closed.where(F.col("batch_id") < before)
    if not closed.limit(1).count():
        return None
    run = f"r{uuid.uuid4().hex}"
    rows = read_table(spark, sink).join(closed.select("batch_id", "day"), "batch_id")
    rows.hint("rebalance", "day").write.partitionBy("day").parquet(f"{sink}_runs/run={run}")
    # batches without rows have nothing in the run, but are closed, too
    listed = closed.select("batch_id", F.current_timestamp().alias("written")).coalesce(1)
    listed.write.parquet(f"{sink}_pending/run={run}")
    return run


def publish(spark: SparkSession, sink: str, run: str) -> None:
    """Make a run visible in place of its batches' folders."""
    listed = read_table(spark, f"{sink}_pending/run={run}").select("batch_id", F.current_timestamp().alias("written"))
    listed.coalesce(1).write.parquet(f"{sink}_markers/run={run}")


def compact(spark: SparkSession, sink: str, commit_path: str, before: int | None = None) -> str | None:
    """Rewrite and publish what has been committed so far; the run's name, or None if there was nothing to do."""
    run = write_run(spark, sink, commit_path, before)
    if run:
        publish(spark, sink, run)
    return run


def drop_compacted(spark: SparkSession, sink: str, older_than: str = "1 day") -> int:
    """Remove the folders of batches that were compacted longer ago than any reader runs; their number."""
    old = markers(spark, sink).where(F.col("written") <= F.current_timestamp() - F.expr(f"interval {older_than}"))
    gone = 0
    for row in old.select("batch_id").toLocalIterator():  # a row per folder
        files, where = _folder(spark, f"{sink}/batch_id={row['batch_id']}")
        gone += bool(files.exists(where) and files.delete(where, True))
    return gone
