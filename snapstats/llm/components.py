"""Connected components of a graph of ids, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum")).first()
    return row["n"], row["sum"]


def _either(u: str, v: str, other_u: str, other_v: str) -> F.Column:
    return F.explode(F.array(F.struct(F.col(u).alias("u"), F.col(v).alias("v")), F.struct(F.col(other_u).alias("u"), F.col(other_v).alias("v")))).alias("x")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest id reachable from it.

    Loops, repeated edges and edges with a null end are ignored. Only minima are gathered for a node, so a node
    with very many edges is no burden; every round is stored in the shared folder.
    """
    pair = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pair = cut(pair)
    before = _state(pair)
    while True:
        # One scan gives both directions of an edge, and one join both edges that a row leads to: no branches of a union.
        least = pair.select(_either("u", "v", "v", "u")).select("x.*").groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = pair.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pair = cut(large.join(least, "u").select(_either("u", "m", "v", "m")).select("x.*").where("u <> v").distinct())
        after = _state(pair)
        if after == before:
            break
        before = after
    return pair.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(pair.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
