"""Label indexing, feature arrays, scaling and class weights as joins and projections.

Each has a counterpart among Spark's ML stages (used by ``plans.prepare``); these return plain
columns and tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.operators.joins import lookup_join, sized


def fit_label_index(train: DataFrame, label: str = K.LABEL, index: str = K.LABEL_INDEX) -> DataFrame:
    """One row per known label: the most frequent gets index 0, ties go alphabetically."""
    counts = train.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    by_frequency = Window.orderBy(F.desc("n"), F.asc(label))
    return counts.withColumn(index, (F.row_number().over(by_frequency) - 1).cast("double"))


def apply_label_index(
    df: DataFrame, labels: DataFrame, label: str = K.LABEL, index: str = K.LABEL_INDEX
) -> DataFrame:
    """Add the index. Unknown and missing labels share the first index after the known ones."""
    known = sized(labels.select(label, index))
    unknown = float(known.count())
    return df.join(known, label, "left").withColumn(index, F.coalesce(index, F.lit(unknown)))


def label_key(label: Column) -> Column:
    """What spellings of one label have in common: no case, no white space around it, single spaces inside."""
    return F.lower(F.trim(F.regexp_replace(label, r"\s+", " ")))


def fit_label_dictionary(train: DataFrame, label: str = K.LABEL, index: str = K.LABEL_INDEX) -> DataFrame:
    """``key``, ``label``, index and ``n`` of every label, however it is spelled.

    The label shown is the most frequent spelling, of equals the first alphabetically; index 0 goes to the most
    frequent label, ties go by key. Missing and blank labels are none. Rows are counted per spelling
    first, so that no more than one row per spelling and task travels.
    """
    spelled = label_spellings(train, label)
    shown = F.min_by("spelling", F.struct(-F.col("n"), F.col("spelling"))).alias(label)
    labels = spelled.groupBy("key").agg(shown, F.sum("n").alias("n"))
    by_frequency = Window.orderBy(F.desc("n"), F.asc("key"))
    return labels.withColumn(index, (F.row_number().over(by_frequency) - 1).cast("double"))


def label_spellings(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """``key``, ``spelling`` and its number of rows ``n``."""
    counts = df.select(F.col(label).alias("spelling")).groupBy("spelling").agg(F.count("*").alias("n"))
    return counts.withColumn("key", label_key(F.col("spelling"))).where("key <> ''").select("key", "spelling", "n")


def label_collisions(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """The spellings of labels that have several: a row for each, with the label's number of them."""
    spelled = label_spellings(df, label)
    several = spelled.groupBy("key").agg(F.count("*").alias("spellings")).where("spellings > 1")
    return spelled.join(several, "key")


def apply_label_dictionary(
    df: DataFrame, dictionary: DataFrame, label: str = K.LABEL, index: str = K.LABEL_INDEX, shown: str | None = None
) -> DataFrame:
    """Add the index of each row's label, by its key; works on tables and streams.

    Unknown, missing and blank labels share the first index after the known ones. ``shown`` names a column for
    the dictionary's spelling, the row's own where it is unknown.
    """
    known = sized(dictionary.select("key", F.col(label).alias("__label"), F.col(index).alias("__index")))
    unknown = float(known.count())
    found = df.withColumn("__key", label_key(F.col(label))).join(known.withColumnRenamed("key", "__key"), "__key", "left")
    added = {index: F.coalesce("__index", F.lit(unknown))} | ({shown: F.coalesce("__label", F.col(label))} if shown else {})
    return found.withColumns(added).drop("__key", "__label", "__index")


def feature_order(cols: Sequence[str]) -> list[str]:
    """The layout of every feature vector: alphabetical."""
    return sorted(cols)


def assemble(df: DataFrame, features: Sequence[str], out: str = K.FEATURES_VECTOR, invalid: str = "skip") -> DataFrame:
    """Features as one array. ``skip`` drops rows with NULL or NaN, ``keep`` turns NULL into NaN."""
    cols = feature_order(features)
    if invalid == "skip":
        for c in cols:
            df = df.where(F.col(c).isNotNull() & ~F.isnan(F.col(c)))
        return df.withColumn(out, F.array(*cols))
    return df.withColumn(out, F.array(*[F.coalesce(F.col(c), F.lit(float("nan"))) for c in cols]))


def fit_scaler(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation per feature, from one aggregate pass."""
    cols = feature_order(features)
    moments = train.agg(
        *[F.avg(c).alias(f"mean_{i}") for i, c in enumerate(cols)],
        *[F.stddev_samp(c).alias(f"std_{i}") for i, c in enumerate(cols)],
    )
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(f"mean_{i}").alias("mean"), F.col(f"std_{i}").alias("std"))
        for i, c in enumerate(cols)
    ]
    return moments.select(F.inline(F.array(*entries)))


def scale(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Replace each feature by its standard score. A constant feature becomes 0.

    The statistics are one row per feature column, so they are put into the projection as literals.
    """
    scaled = {}
    for row in stats.collect():
        if row["std"]:
            scaled[row["feature"]] = (F.col(row["feature"]) - F.lit(row["mean"])) * F.lit(1.0 / row["std"])
        else:
            scaled[row["feature"]] = F.col(row["feature"]) * F.lit(0.0)
    return df.withColumns(scaled)


def class_distribution(df: DataFrame, cls: str) -> DataFrame:
    return df.groupBy(cls).agg(F.count("*").alias("n"))


def class_weights(df: DataFrame, cls: str = K.LABEL_INDEX, weight: str = K.CLASS_WEIGHT) -> DataFrame:
    """Inverse-frequency weights, scaled so that they add up to the number of classes.

    The window runs over one row per class, not over the data.
    """
    everything = Window.partitionBy()
    counts = class_distribution(df, cls)
    inverse = F.sum("n").over(everything) / F.col("n")
    scaled = counts.withColumn("__inverse", inverse)
    total = F.sum("__inverse").over(everything)
    return scaled.select(cls, (F.col("__inverse") * (F.count("*").over(everything) / total)).alias(weight))


def attach_weights(df: DataFrame, weights: DataFrame, cls: str = K.LABEL_INDEX) -> DataFrame:
    return lookup_join(df, weights, cls)


def weighted_training_set(df: DataFrame, cls: str = K.LABEL_INDEX) -> DataFrame:
    return attach_weights(df, class_weights(df, cls), cls)


def attach_class_name(
    df: DataFrame, names: DataFrame, index: str, out: str, default="__unseen__", label: str = K.LABEL,
    label_index: str = K.LABEL_INDEX,
) -> DataFrame:
    """Add the class name of an index column; ``default`` is a marker or an expression."""
    table = names.select(F.col(label_index).alias(index), F.col(label).alias(out))
    fallback = F.lit(default) if isinstance(default, str) else default
    return lookup_join(df, table, index).withColumn(out, F.coalesce(out, fallback))
