"""Row cleaning and its audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens import conventions as K
from flowlens.functions.predicates import all_finite, all_values, infinity_as_nan
from flowlens.workspace import materialize

#: Repeated hashes that may be broadcast, 16 bytes each.
BROADCAST_HASHES = 500_000
#: From so many columns on, three reads with exchanged hashes are taken rather than one with exchanged rows.
WIDE_COLUMNS = 16


def drop_invalid(df: DataFrame, numeric: Sequence[str], label: str = K.LABEL) -> DataFrame:
    """Keep rows with a label and only ordinary numbers, in one filter."""
    return df.where(F.col(label).isNotNull() & all_finite(numeric))


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows without a value in any of the columns. As in Spark's ``dropna``, NaN is no value."""
    return df.dropna("any", subset=list(cols))


def inf_to_nan(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: infinity_as_nan(F.col(c)) for c in cols})


def drop_nan(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    keep = F.lit(True)
    for c in cols:
        keep = keep & ~F.isnan(F.col(c))
    return df.where(keep)


def dedup(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Distinct rows. Columns in ``ignore`` do not count; of equal rows their smallest values are kept.

    Copies collapse in the map-side aggregate, so a row repeated any number of times sends one row
    per task through the shuffle.
    """
    if not ignore:
        return df.dropDuplicates()
    content = [c for c in df.columns if c not in ignore]
    if len(ignore) == 1:
        return df.groupBy(*content).agg(F.min(ignore[0]).alias(ignore[0])).select(*df.columns)
    kept = df.groupBy(*content).agg(F.min(F.struct(*ignore)).alias("kept"))
    return kept.select(*[F.col(f"kept.{c}").alias(c) if c in ignore else F.col(c) for c in df.columns])


def dedup_by_hash(df: DataFrame, ignore: Sequence[str] = (), most: int = BROADCAST_HASHES) -> DataFrame:
    """``dedup`` for wide rows with few copies: hashes travel instead of rows.

    A first job shuffles 128 bits per row and writes the hashes that occur more than once. A row whose hash occurs once
    is distinct and never leaves its task; the others are compared in full, so that two texts of one
    hash stay two rows. Where more than ``most`` hashes repeat, they are too many to send to every task, and
    ``dedup`` shuffles the rows. The rows are read three times: give a written table or a plain scan of one, whose
    rows are the same each time.
    """
    content = [F.col(f"`{c}`") for c in df.columns if c not in ignore]
    halves = F.struct(F.xxhash64(*content), F.xxhash64(F.lit(1), *content))  # two seeds
    hashes = df.select(halves.alias("__hash")).groupBy("__hash").agg(F.count("*").alias("n"))
    repeated = materialize(hashes.where("n > 1").select("__hash"), "hashes")
    if repeated.count() > most:
        return dedup(df, ignore)
    known, rows = F.broadcast(repeated), df.withColumn("__hash", halves)
    single = rows.join(known, "__hash", "left_anti").select(*df.columns)
    copies = rows.join(known, "__hash", "left_semi").select(*df.columns)
    return single.unionByName(dedup(copies, ignore))


def clean_rows(
    df: DataFrame,
    numeric: Sequence[str],
    label: str = K.LABEL,
    ignore: Sequence[str] = (),
    by_hash: bool | None = None,
) -> DataFrame:
    """Drop invalid rows, then duplicates. Unless ``by_hash`` says otherwise, those of wide rows are found by
    hashes, which reads the rows three times (see ``dedup_by_hash``)."""
    valid = drop_invalid(df, numeric, label)
    if by_hash is None:
        by_hash = len(df.columns) >= WIDE_COLUMNS
    return (dedup_by_hash if by_hash else dedup)(valid, ignore)


STEPS = [("nulls", "n0", "n1"), ("infinite", "n1", "n2"), ("duplicates", "n2", "n3")]


def clean_audit(
    df: DataFrame,
    numeric: Sequence[str],
    label: str = K.LABEL,
    loss_limit: float = K.LOSS_LIMIT,
    cleaned: DataFrame | None = None,
) -> DataFrame:
    """Rows left after each cleaning step, rows each step removed, and steps that removed too many.

    The first step takes rows without a value (NULL, or NaN as in ``drop_nulls``), the second those
    with an infinite one, the third copies.

    With the cleaned table at hand (written, so that counting it is cheap) this is one pass without
    a shuffle. Otherwise it is one pass and one shuffle: a row's own values say how far it gets, and
    rows that drop out early are blanked first, so they collapse map-side instead of travelling with
    all their columns.
    """
    state = (
        F.when(~(all_values(numeric) & F.col(label).isNotNull()), 0)
        .when(~all_finite(numeric), 1)
        .otherwise(2)
    )
    judged = df.withColumn("__state", state)
    if cleaned is not None:
        groups = judged.groupBy("__state").agg(F.count("*").alias("__n"))
        distinct = F.lit(cleaned.count())
    else:
        blanked = [F.when(F.col("__state") == 2, F.col(c)).alias(c) for c in df.columns]
        groups = judged.select("__state", *blanked).groupBy("__state", *df.columns).agg(F.count("*").alias("__n"))
        distinct = F.count_if(F.col("__state") == 2)

    def total(floor: int):
        return F.coalesce(F.sum(F.when(F.col("__state") >= floor, F.col("__n"))), F.lit(0))

    counts = groups.agg(total(0).alias("n0"), total(1).alias("n1"), total(2).alias("n2"), distinct.alias("n3"))
    rows = []
    for i, (name, before, after) in enumerate(STEPS):
        removed = F.col(before) - F.col(after)
        rows.append(
            F.struct(
                F.lit(i + 1).alias("step_no"),
                F.lit(name).alias("step"),
                F.col(before).alias("rows_before"),
                F.col(after).alias("rows_after"),
                removed.alias("removed"),
                (removed > F.col(before) * F.lit(loss_limit)).alias("excessive"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))
