"""Parquet tables and ML models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, cols: Sequence[str] | None = None) -> None:
    """Overwrite a Parquet table with the given columns in the given order."""
    (df.select(*cols) if cols else df).write.mode("overwrite").parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int, cols: Sequence[str] | None = None) -> None:
    """Write one micro-batch as its own ``batch_id`` partition of a table.

    A batch that runs again replaces its partition, so nothing is ever added twice. Naming the
    partition's folder keeps the rows from being sorted by a partition column.
    """
    (df.select(*cols) if cols else df).write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, kind=PipelineModel):
    return kind.load(path)
