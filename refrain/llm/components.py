"""Connected components of links between rows, as joins and groupings alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.sources.storage import stage_table


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``links(a, b)`` reaches.

    Alternates two contractions: every node hands its larger neighbours, then its smaller ones, to the
    smallest node it knows. Hub nodes are split by the joins; each round is written to the shared folder,
    so the plan does not grow and lost executors cost one round. Nulls and self links are ignored.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stage_table(ordered.distinct(), "links")
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), "m"), F.struct("u", "m"))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        after = stage_table(small, "links")
        if _print(after) == _print(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        edges = after


def _print(edges: DataFrame) -> tuple:
    """Content of an edge list as a few numbers."""
    one = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.sum(F.shiftrightunsigned(one, 24)), F.bit_xor(one)).first()
    return tuple(row)
