"""Column-name normalisation, for plan-time names and for names held in a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEPT = set("0123456789abcdefghijklmnopqrstuvwxyz_")


def normalize_name(name: str) -> str:
    """`` Flow Bytes/s `` -> ``flow_bytess``."""
    return "".join(ch for ch in "_".join(name.split()).lower() if ch in _KEPT)


def normalized(col: Column) -> Column:
    """The same rule for names stored as values."""
    trimmed = F.regexp_replace(col, r"^\s+|\s+$", "")
    return F.regexp_replace(F.lower(F.regexp_replace(trimmed, r"\s+", "_")), "[^0-9a-z_]", "")
