"""Connected components as joins and grouped minima, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.workspace import discard, materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _star(edges: DataFrame) -> DataFrame:
    """One round: every larger neighbour is tied to the smallest one around, then every node to its smallest.

    Minima are hash aggregates that combine before the exchange. They are written before they are joined, so
    that the joins are ordinary equi-joins of two tables whose skewed partitions adaptive execution can split.
    So no task gathers the neighbours of a hub.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = materialize(least, "minima")
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = materialize(large.distinct(), "edges", replaces=least)
    least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "minima")
    tied = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    small = large.join(least, "u").select(tied.alias("u"), F.col("m").alias("v"))
    small = materialize(small.distinct(), "edges", replaces=least)
    discard(large)
    return small


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node that an edge names.

    Alternates the two star steps until the edges no longer change, which takes a number of rounds that
    grows with the logarithm of the graph. Each round is written to the shared folder, so a lost executor
    costs one round. Nulls, loops, repeated and reversed edges are allowed; no edges give no rows.
    """
    pairs = edges.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pairs = materialize(pairs, "edges")
    state = _state(pairs)
    while state[0]:
        older, pairs = pairs, _star(pairs)
        discard(older)
        last, state = state, _state(pairs)
        if state == last:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(pairs.select(F.col("u").alias("node"), F.col("v").alias("root")))
