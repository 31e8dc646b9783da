"""Column names, column types and alignment to a frozen feature list."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.functions.names import normalize_name
from flowlens.functions.predicates import mapped


def normalize_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Normalise all column names in one projection. Names that collide afterwards are an error."""
    names = [c if c in keep else normalize_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after normalising: {clashes}")
    return df.toDF(*names)


def rename_guarded(df: DataFrame, mapping: Mapping[str, str] = K.HOMOLOGATION) -> DataFrame:
    """Rename where the old name exists and the new one does not, pair by pair, as one projection."""
    names = list(df.columns)
    for old, new in mapping.items():
        if old in names and new not in names:
            names[names.index(old)] = new
    return df.toDF(*names)


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df


def union_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union of any number of tables by column name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def castable_profile(df: DataFrame, exclude: Iterable[str] = K.NON_FEATURES) -> DataFrame:
    """Per column: non-null values, values that cast to double, and whether the column is numeric.

    One aggregate pass over all columns and all rows.
    """
    cols = [c for c in df.columns if c not in set(exclude)]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "column string, non_null long, castable long, is_numeric boolean"
        )
    counts = df.agg(
        *[F.count(c).alias(f"non_null_{i}") for i, c in enumerate(cols)],
        *[F.count(F.col(c).try_cast("double")).alias(f"castable_{i}") for i, c in enumerate(cols)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"non_null_{i}").alias("non_null"),
            F.col(f"castable_{i}").alias("castable"),
        )
        for i, c in enumerate(cols)
    ]
    numeric = (F.col("non_null") > 0) & (F.col("non_null") == F.col("castable"))
    return counts.select(F.inline(F.array(*entries))).withColumn("is_numeric", numeric)


def cast_failures(df: DataFrame, by: str = K.SPLIT, exclude: Iterable[str] = K.NON_FEATURES) -> DataFrame:
    """Per value of ``by`` and column: rows, NULLs, values that cast to double, and values that fail to.

    Columns become rows and are counted in two steps, within tasks and then by split and column, so that a table
    of thousands of columns is no aggregate of thousands of counts.
    """
    cols = [c for c in df.columns if c != by and c not in set(exclude)]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], f"`{by}` string, column string, row_count long, nulls long, castable long, failed long"
        )
    texts = df.select(F.col(by), *[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    long = texts.unpivot([by], cols, "column", "value")
    return long.groupBy(by, "column").agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.count(F.col("value").try_cast("double")).alias("castable"),
        F.count_if(F.col("value").isNotNull() & F.col("value").try_cast("double").isNull()).alias("failed"),
    )


def detect_numeric(df: DataFrame, exclude: Iterable[str] = K.NON_FEATURES) -> list[str]:
    """Names of the numeric columns, in table order."""
    found = {r[0] for r in castable_profile(df, exclude).where("is_numeric").select("column").collect()}
    return [c for c in df.columns if c in found]


def cast_features(
    df: DataFrame, numeric: Sequence[str], keep: Sequence[str] = (K.LABEL, K.SOURCE_FILE)
) -> DataFrame:
    """Numeric columns as doubles (unparsable text is NULL) plus the kept columns the table has."""
    return df.select(
        *[F.col(c).try_cast("double").alias(c) for c in numeric],
        *[c for c in keep if c in df.columns],
    )


def align_schema(
    df: DataFrame, features: Sequence[str], keep: Sequence[str] = (K.LABEL, K.SOURCE_FILE), fill: float = 0.0
) -> DataFrame:
    """Exactly the listed features, in that order, plus the kept columns; absent features get ``fill``."""
    present = set(df.columns)
    filled = [F.col(f) if f in present else F.lit(float(fill)).alias(f) for f in features]
    return df.select(*filled, *[c for c in keep if c in present])


def schema_diff(
    df: DataFrame, features: Sequence[str], exclude: Iterable[str] = K.NON_FEATURES
) -> DataFrame:
    """Columns that differ from a feature list: ``imputed`` (absent here) or ``extra`` (not listed).

    The number of values shows how much an ignored extra column holds.
    """
    wanted, ignored = set(features), set(exclude)
    extra = [c for c in df.columns if c not in wanted and c not in ignored]
    imputed = [f for f in features if f not in set(df.columns)]
    counts = df.agg(
        F.count("*").alias("row_count"), *[F.count(c).alias(f"n{i}") for i, c in enumerate(extra)]
    )

    def entry(name: str, status: str, values: Column) -> Column:
        return F.struct(F.lit(name).alias("column"), F.lit(status).alias("status"), values.alias("non_null"))

    entries = [entry(c, "extra", F.col(f"n{i}")) for i, c in enumerate(extra)]
    entries += [entry(c, "imputed", F.lit(0).cast("long")) for c in imputed]
    if not entries:
        return df.sparkSession.createDataFrame([], "column string, status string, non_null long")
    return counts.select(F.inline(F.array(*entries)))


def with_split(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(K.SPLIT, F.lit(name))


def route_split(df: DataFrame, day: Column, mapping: Mapping[str, str] = K.SPLIT_BY_DAY) -> DataFrame:
    """Add the split a row's weekday belongs to and drop rows of other days."""
    return df.withColumn(K.SPLIT, mapped(day, mapping)).where(F.col(K.SPLIT).isNotNull())
