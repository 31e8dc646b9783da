"""Samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens import conventions as K


def bernoulli_sample(df: DataFrame, fraction: float = K.SEARCH_FRACTION, seed: int = K.SEED) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def stratified_sample(
    df: DataFrame, cls: str, fraction: float | Mapping = K.SEARCH_FRACTION, seed: int = K.SEED
) -> DataFrame:
    """A random sample per class.

    One fraction for all classes needs no list of the classes: keeping each row with that
    probability is the same draw. Different fractions go through ``sampleBy``.
    """
    if isinstance(fraction, Mapping):
        return df.sampleBy(cls, fractions=dict(fraction), seed=seed)
    return df.where(F.col(cls).isNotNull()).sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, keys: Sequence[str], percent: int = 30) -> DataFrame:
    """A sample decided by the row's key alone, so it does not depend on partitions or run."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    slot = F.conv(F.substring(F.md5(key), 1, 4), 16, 10).cast("long") % 100
    return df.where(slot < percent)
