"""Connected components by alternating star operations, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import salted_join, written


def _least_neighbours(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("least"), F.count("*").alias("n"))
    return written(least, "star-least")


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of the links (a, b): the smallest id it is connected with.

    Each round points all larger neighbours of a node to the smallest one (large
    star), then all smaller ones (small star); the edges end as one star around
    each smallest node after a number of rounds that grows with the logarithm of
    the nodes.  A node with very many neighbours is dealt to several tasks.  Each
    step is a written table.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = written(edges.distinct(), "star-edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            salted_join(both, _least_neighbours(both), ["u"], "n", "v")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("least", "u").alias("v"))
        )
        large = written(large.distinct(), "star-large")
        least = _least_neighbours(large)
        small = salted_join(large, least, ["u"], "n", "v").where("v <> least")
        edges = small.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            least.select("u", F.col("least").alias("v"))
        )
        edges = written(edges.distinct(), "star-edges")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
