"""Joins to lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowlens.workspace import materialize


def sized(table: DataFrame) -> DataFrame:
    """The lookup table written once, so that the planner knows its bytes.

    Below ``spark.sql.autoBroadcastJoinThreshold`` Spark then broadcasts it and the large side, with whatever
    hot keys it has, isn't shuffled. Above it the join is an ordinary equi-join, in which adaptive execution
    splits skewed partitions. Nothing passes through the driver to find out.
    """
    return materialize(table, "lookup")


def lookup_join(df: DataFrame, table: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a large table to a lookup table of any size."""
    return df.join(sized(table), on, how)
