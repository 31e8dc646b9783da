"""JSON documents, feature lists and JSON-lines logs."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

FEATURE_SCHEMA = StructType([StructField("feature_cols", ArrayType(StringType()))])
SLA_SCHEMA = (
    "query_id string, batchId long, ts string, L_E2E_ms long, inputRps double, procRps double, ratio double, "
    "numRows long, status string, t_read_ms long, t_add_batch_ms long, t_commit_ms long"
)


def write_doc(df: DataFrame, path: str) -> None:
    """Write a small result table (one row, or one row per class) as JSON."""
    df.write.mode("overwrite").json(path)


def write_values(spark: SparkSession, values: Mapping, path: str) -> None:
    """Write one nested document of plain values."""
    spark.createDataFrame([(json.dumps(values),)], "value string").write.mode("overwrite").text(path)


def read_doc(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a document table; a missing one reads as no rows."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_values(spark: SparkSession, path: str, default: Mapping | None = None) -> dict:
    """Read one nested document back as plain values; a missing one gives the default."""
    rows = read_text_doc(spark, path)
    return json.loads(rows[0][0]) if rows else dict(default or {})


def read_text_doc(spark: SparkSession, path: str) -> list:
    try:
        return spark.read.text(path, wholetext=True).where("value != ''").take(1)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def save_manifest(spark: SparkSession, features: Sequence[str], path: str) -> None:
    """Freeze the feature list, in its alphabetical order."""
    write_doc(spark.createDataFrame([(sorted(features),)], FEATURE_SCHEMA), path)


def load_manifest(spark: SparkSession, path: str) -> list[str]:
    """The frozen feature list; empty when there is none, so that the caller can infer one."""
    rows = read_doc(spark, path, FEATURE_SCHEMA).take(1)
    return list(rows[0].feature_cols) if rows else []


def append_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_metrics(df: DataFrame, path: str, query_id: str, batch: str = "batchId") -> None:
    """Write the records of some micro-batches in one job; a batch that runs again replaces its record."""
    records = df.withColumn("batch_id", df[batch]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    records.partitionBy("batch_id").json(f"{path}/query_id={query_id}")


def read_metrics(spark: SparkSession, path: str, schema=SLA_SCHEMA) -> DataFrame:
    """Read a JSON-lines log, skipping lines that do not parse; one that isn't there yet has no rows."""
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True)
    try:
        return reader.json(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
