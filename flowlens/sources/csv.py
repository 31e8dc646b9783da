"""Raw CSV scans: header on, every column a string, nothing inferred."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.operators.schema import normalize_columns, union_by_name
from flowlens.workspace import materialize

CSV_GLOB = "*.[cC][sS][vV]"
REPLACEMENT = "\N{REPLACEMENT CHARACTER}"
#: Folders of what the plans generate.
SKIPPED = ("/processed/",)


def csv_reader(spark: SparkSession, encoding: str, mode: str):
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("encoding", encoding)
        .option("mode", mode)
    )


def list_csv(spark: SparkSession, prefix: str | Sequence[str], skip: Sequence[str] = SKIPPED) -> DataFrame:
    """Paths and bytes of the CSV files below a prefix, any case of the suffix, without generated folders.

    Only these columns are read, so file contents are never loaded.
    """
    files = below(spark.read.format("binaryFile")).load(prefix).select("path", "length")
    return files.where(wanted("path", skip))


def below(reader: DataFrameReader) -> DataFrameReader:
    """The reader, for all CSV files below the folders it is given."""
    return reader.option("pathGlobFilter", CSV_GLOB).option("recursiveFileLookup", True)


def wanted(path: str, skip: Sequence[str]) -> Column:
    """Condition on a file's path. On the path among a row's metadata it drops files before any is opened."""
    return reduce(Column.__and__, [~F.col(path).contains(part) for part in skip], F.lit(True))


def plain_path(uri: str) -> Column:
    """A file's path from the escaped URI among a row's metadata."""
    return F.url_decode(F.replace(F.col(uri), F.lit("+"), F.lit("%2B")))


def first_lines(spark: SparkSession, paths: str | Sequence[str], skip: Sequence[str] = SKIPPED) -> DataFrame:
    """The first line of each file that isn't blank, as bytes of unknown encoding: one job for any number of files.

    Only the first split of a file takes part; of its lines one leaves each task. Files without such a line have no
    row.
    """
    lines = below(spark.read.format("text")).load(paths).where(wanted("_metadata.file_path", skip)).select(
        plain_path("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("header"),
        F.monotonically_increasing_id().alias("place"),  # ascends within a split
    )
    filled = lines.where((F.col("block") == 0) & (F.trim(F.col("header").cast("string")) != ""))
    return filled.groupBy("path").agg(F.min_by("header", "place").alias("header"))


def group_by_header(spark: SparkSession, paths: str | Sequence[str], skip: Sequence[str] = SKIPPED) -> DataFrame:
    """One row per distinct header line: its number of files and the first of them."""
    return first_lines(spark, paths, skip).groupBy("header").agg(
        F.count("*").alias("files"), F.min("path").alias("example")
    )


def scan(
    spark: SparkSession, paths: str | Sequence[str], like: str, encoding: str, mode: str, check: bool, skip: Sequence[str]
) -> DataFrame:
    """One scan of the files below the paths with the columns that Spark finds in the file ``like``."""
    schema = csv_reader(spark, encoding, mode).csv(like).schema
    reader = below(csv_reader(spark, encoding, mode)).schema(schema).option("enforceSchema", not check)
    return with_source_file(reader.csv(paths).where(wanted("_metadata.file_path", skip)))


def read_raw_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    encoding: str = "UTF-8",
    mode: str = "PERMISSIVE",
    skip: Sequence[str] = SKIPPED,
) -> DataFrame:
    """One scan over the CSV files below the paths, which must share one header, with normalised
    names and the source file.

    Spark matches columns of several files by position, so files in another order would swap values.
    The scan itself checks every header (``enforceSchema=false``). Where a name occurs twice Spark
    numbers the copies and that check cannot pass; then the headers are compared beforehand. No list of files
    reaches the driver's Python side.
    """
    found = list_csv(spark, paths, skip).agg(F.min_by("path", F.struct(F.col("length") == 0, "path"))).first()[0]
    if found is None:
        raise FileNotFoundError(f"no CSV files in {paths}")
    first = csv_reader(spark, encoding, mode).option("header", False).csv(found).head()
    names = [str(name).lower() for name in first or ()]
    unique = len(set(names)) == len(names)
    if not unique and group_by_header(spark, paths, skip).count() > 1:
        raise ValueError("the files have different headers: read them with read_raw_csv_by_name")
    return scan(spark, paths, found, encoding, mode, unique, skip)


def read_raw_csv_by_name(
    spark: SparkSession,
    paths: str | Sequence[str],
    encoding: str = "UTF-8",
    mode: str = "PERMISSIVE",
    skip: Sequence[str] = SKIPPED,
) -> DataFrame:
    """Scan files with different headers and union them by normalised name: one scan per distinct
    header, not one per file.

    The headers are found by one job over the first splits. With one header the given folders are scanned as they are;
    only with several does each scan get the list of its files, which Spark's scan needs.
    """
    if not paths:
        raise FileNotFoundError("no CSV files to read")
    lines = materialize(first_lines(spark, paths, skip), "headers")
    groups = lines.groupBy("header").agg(F.min("path").alias("example")).collect()  # one row per distinct header
    if not groups:
        raise FileNotFoundError(f"no CSV files with a header in {paths}")
    if len(groups) == 1:
        return scan(spark, paths, groups[0].example, encoding, mode, False, skip)
    parts = []
    for group in sorted(groups, key=lambda g: g.example):
        files = [r.path for r in lines.where(F.col("header") == F.lit(bytes(group.header))).select("path").collect()]
        parts.append(scan(spark, sorted(files), group.example, encoding, mode, False, ()))
    return union_by_name(parts)


def with_source_file(df: DataFrame, name: str = K.SOURCE_FILE) -> DataFrame:
    """Normalise the column names and add the path of the file each row came from."""
    path = F.col("_metadata.file_path").alias(name)
    return normalize_columns(df.select(*[F.col(f"`{c}`") for c in df.columns], path), keep=[name])


def undecodable_rows(df: DataFrame) -> DataFrame:
    """Rows per source file holding a replacement character, the sign of a wrong encoding."""
    texts = [c for c, t in df.dtypes if t == "string" and c != K.SOURCE_FILE]
    broken = F.lit(False)
    for c in texts:
        broken = broken | F.coalesce(F.col(c).contains(REPLACEMENT), F.lit(False))
    return df.groupBy(K.SOURCE_FILE).agg(
        F.count("*").alias("row_count"), F.count_if(broken).alias("undecodable")
    )


def read_with_fallback(
    spark: SparkSession, paths: str | Sequence[str], encodings: Sequence[str] = ("UTF-8", "ISO-8859-1")
) -> DataFrame:
    """Read each file with the first encoding that decodes all of it (the last one if none does).

    This costs one pass over the files per extra encoding; give an explicit encoding where it is known. Rows
    of broken files are dropped by a join; only the names of these files are collected, to be read again.
    """
    groups = []
    pending = paths
    for encoding in encodings[:-1]:
        df = read_raw_csv_by_name(spark, pending, encoding)
        broken = materialize(undecodable_rows(df).where("undecodable > 0").select(K.SOURCE_FILE), "broken")
        groups.append(df.join(broken, K.SOURCE_FILE, "left_anti").select(*df.columns))
        pending = sorted(r[0] for r in broken.select(plain_path(K.SOURCE_FILE)).collect())
        if not pending:
            return union_by_name(groups)
    return union_by_name([*groups, read_raw_csv_by_name(spark, pending, encodings[-1])])


def read_csv_files(spark: SparkSession, paths: str | Sequence[str], encoding: str | Sequence[str] = "UTF-8") -> DataFrame:
    """Files united by name, in one encoding or in the first of several that decodes a file."""
    if isinstance(encoding, str):
        return read_raw_csv_by_name(spark, paths, encoding)
    return read_with_fallback(spark, paths, encoding)
