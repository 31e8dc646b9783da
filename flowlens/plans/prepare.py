"""From raw CSV files to tables ready for training."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.functions.predicates import weekday_token
from flowlens.operators.clean import clean_audit, clean_rows
from flowlens.operators.features import feature_order, weighted_training_set
from flowlens.operators.schema import (
    align_schema,
    cast_features,
    detect_numeric,
    rename_guarded,
    require_columns,
    route_split,
    schema_diff,
    with_split,
)
from flowlens.plans.layout import Layout
from flowlens.sources.csv import list_csv, read_csv_files, read_raw_csv
from flowlens.sources.documents import load_manifest, save_manifest, write_doc
from flowlens.sources.tables import read_table, save_model, write_table


def preparation_stages(features: Sequence[str], invalid: str = "skip") -> list:
    """Label index (frequent first, unknown kept), feature vector in alphabetical order, scaling."""
    return [
        StringIndexer(
            inputCol=K.LABEL, outputCol=K.LABEL_INDEX, stringOrderType="frequencyDesc", handleInvalid="keep"
        ),
        VectorAssembler(inputCols=feature_order(features), outputCol=K.FEATURES_VECTOR, handleInvalid=invalid),
        StandardScaler(inputCol=K.FEATURES_VECTOR, outputCol=K.SCALED_VECTOR, withMean=True, withStd=True),
    ]


def for_streams(fitted: PipelineModel, features: Sequence[str]) -> PipelineModel:
    """The fitted preparation with an assembler that keeps rows with missing values (as NaN)."""
    indexer, _, scaler = fitted.stages
    return PipelineModel(stages=[indexer, preparation_stages(features, "keep")[1], scaler])


def clean_to_table(typed: DataFrame, split: str, features: Sequence[str], layout: Layout) -> DataFrame:
    """Write the typed rows, then the cleaned rows, then the audit of what cleaning removed.

    Both written tables cut the lineage, so later passes (indexing,
    scaling, weights) read a few columns of Parquet and a lost executor costs no earlier work.
    """
    spark = typed.sparkSession
    write_table(with_split(typed, split), layout("typed", split))
    rows = read_table(spark, layout("typed", split))
    write_table(clean_rows(rows, features), layout("clean", split))
    cleaned = read_table(spark, layout("clean", split))
    write_doc(clean_audit(rows, features, cleaned=cleaned), layout("reports", f"cleaning_{split}"))
    return cleaned


def files_by_split(spark: SparkSession, prefix: str) -> dict[str, list[str]]:
    """CSV files below a prefix by the split of the weekday in their names; both splits must occur."""
    name = F.regexp_extract("path", "[^/]*$", 0)
    found = {"train": [], "test": []}
    for row in route_split(list_csv(spark, prefix), weekday_token(name)).orderBy("path").collect():  # one row per file
        found[row[K.SPLIT]].append(row["path"])
    for split, files in found.items():
        if not files:
            raise FileNotFoundError(f"no CSV file of the {split} days in {prefix}")
    return found


def prepare(
    spark: SparkSession,
    train_paths: str | Sequence[str],
    test_paths: str | Sequence[str],
    layout: Layout,
    encoding: str = "UTF-8",
) -> list[str]:
    """Clean both splits, fit the preparation on train, write the processed tables; returns the features.

    The splits don't wait for each other: both are cleaned at the same time, and so are the processed tables written.
    """
    train_raw = require_columns(read_raw_csv(spark, train_paths, encoding), [K.LABEL])
    test_raw = require_columns(read_raw_csv(spark, test_paths, encoding), [K.LABEL])
    features = feature_order(detect_numeric(train_raw))
    if not features:
        raise ValueError("no numeric column found")
    require_columns(test_raw, features)

    def cleaned(split: str, raw: DataFrame) -> DataFrame:
        return clean_to_table(cast_features(raw, features), split, features, layout)

    def processed(split: str, rows: DataFrame, cols: Sequence[str]) -> None:
        ready = fitted.transform(rows)
        write_table(weighted_training_set(ready) if split == "train" else ready, layout("processed", split), cols)

    with ThreadPool(2) as pool:
        train, test = pool.starmap(inheritable_thread_target(spark)(cleaned), [("train", train_raw), ("test", test_raw)])
        fitted = Pipeline(stages=preparation_stages(features)).fit(train)
        tables = [("train", train, K.TRAIN_COLUMNS), ("test", test, K.TEST_COLUMNS)]
        pool.starmap(inheritable_thread_target(spark)(processed), tables)

    save_model(fitted.stages[0], layout("models", "indexer"))
    save_model(fitted.stages[2], layout("models", "scaler"))
    save_model(for_streams(fitted, features), layout("models", "preparation"))
    save_manifest(spark, features, layout("models", "features"))
    return features


def prepare_stream_table(
    spark: SparkSession,
    paths: Sequence[str],
    layout: Layout,
    split: str = "streaming_demo",
    encoding: str | Sequence[str] = ("UTF-8", "ISO-8859-1"),
) -> DataFrame:
    """Bring another dataset into the frozen feature layout, clean it and write it for replay.

    A file is read in the first of the encodings that decodes it.
    Without a frozen list the features are the numeric columns found in this dataset.
    """
    raw = rename_guarded(read_csv_files(spark, paths, encoding))
    require_columns(raw, [K.LABEL])
    features = load_manifest(spark, layout("models", "features")) or feature_order(detect_numeric(raw))
    write_doc(schema_diff(raw, features), layout("reports", "alignment"))
    aligned = align_schema(raw, features)
    clean_to_table(cast_features(aligned, features), split, features, layout)
    return read_table(spark, layout("clean", split))
