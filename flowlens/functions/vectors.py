"""Distances between arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(a: str, b: str) -> Column:
    """Squared Euclidean distance of two array columns; NULL where one is NULL or their lengths differ."""
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.when(F.size(a) == F.size(b), F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x))


def euclidean(a: str, b: str) -> Column:
    return F.sqrt(squared_distance(a, b))
