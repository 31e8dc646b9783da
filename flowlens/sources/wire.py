"""Rows as CSV text lines, and text lines as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowlens import conventions as K

LINEAGE = [K.LABEL, K.SOURCE_FILE, K.SPLIT]
#: What a producer may append after the label.
LINEAGE_SCHEMA = f"`{K.SOURCE_FILE}` string, `{K.SPLIT}` string"
CORRUPT = "_corrupt_record"


def wire_columns(df: DataFrame, tail: Sequence[str] = LINEAGE) -> list[str]:
    """Features in alphabetical order, then those of the tail columns the table has."""
    return sorted(c for c in df.columns if c not in tail) + [c for c in tail if c in df.columns]


def to_wire(df: DataFrame, tail: Sequence[str] = LINEAGE) -> DataFrame:
    """One CSV line per row, quoted where needed."""
    return df.select(F.to_csv(F.struct(*wire_columns(df, tail))).alias("value"))


def wire_schema(features: Sequence[str] = K.WIRE_FEATURES, label: str = K.LABEL) -> str:
    """DDL of the wire record: the features as doubles, then the label."""
    return ", ".join([f"`{f}` double" for f in features] + [f"`{label}` string"])


def parse_wire(lines: DataFrame, schema: str) -> DataFrame:
    """Parse lines leniently: short rows fill with NULL, extra fields drop, bad numbers are NULL."""
    return lines.select(F.from_csv("value", schema).alias("row")).select("row.*")


def parse_wire_checked(lines: DataFrame, schema: str, tail: str | None = None) -> DataFrame:
    """The lenient parse, with the whole line in an extra column where it was malformed.

    With ``tail`` (DDL of further fields, such as ``LINEAGE_SCHEMA``) a line may end with all of these or none.
    """
    options = {"columnNameOfCorruptRecord": CORRUPT}
    parsed = [F.from_csv("value", f"{s}, {CORRUPT} string", options) for s in [schema, *([f"{schema}, {tail}"] if tail else [])]]
    rows = lines.select(*(p.alias(f"row{i}") for i, p in enumerate(parsed)))
    if not tail:
        return rows.select("row0.*")
    longer = F.col(f"row1.{CORRUPT}").isNull()
    names = [f.name for f in StructType.fromDDL(schema)]
    picked = [F.when(longer, F.col(f"row1.`{n}`")).otherwise(F.col(f"row0.`{n}`")).alias(n) for n in names]
    return rows.select(*picked, F.when(~longer, F.col(f"row0.{CORRUPT}")).alias(CORRUPT))


def split_malformed(lines: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed lines)."""
    checked = parse_wire_checked(lines, schema)
    good = checked.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = checked.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
    return good, bad


def text_stream(spark: SparkSession, source: str = "text", **options) -> DataFrame:
    """Lines as a stream. ``text`` (a folder) can be replayed; ``socket`` cannot."""
    reader = spark.readStream.format(source)
    path = options.pop("path", None)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path) if path else reader.load()


def replay_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of wire lines as a bounded stream."""
    options = {"maxFilesPerTrigger": files_per_trigger} if files_per_trigger else {}
    return text_stream(spark, "text", path=path, **options)
