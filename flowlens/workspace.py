"""Shared folders for data a job has to write for itself (streams, checkpoints, cut lineage)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a session whose master is local may do without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="flowlens-")
    return f"{base.rstrip('/')}/flowlens/{purpose}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, purpose: str, replaces: DataFrame | None = None, rows_per_file: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and outlives lost executors.

    ``rows_per_file`` bounds the rows of a file, so that a table read in few pieces is read back in more of them
    ahead of heavy work per row. The files depend on the rows alone, not on the machine.
    ``by`` names columns of few values: each combination lies in a folder of its own, and a filter on them opens only its folders.
    ``replaces`` is an earlier result of this function that nothing needs any more; its files go.
    """
    path = shared_dir(df.sparkSession, purpose)
    writer = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
    (writer.partitionBy(*by) if by else writer).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.scratch_path = path
    if replaces is not None:
        discard(replaces)
    return written


def discard(df: DataFrame) -> None:
    """Remove the files of a table that ``materialize`` wrote. Tables from elsewhere are left alone."""
    path = getattr(df, "scratch_path", None)
    if path:
        discard_path(df.sparkSession, path)


def discard_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``shared_dir`` named."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
