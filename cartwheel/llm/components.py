"""Connected components of a graph given as a table of edges.

Rounds of large and small stars: every node hands its larger neighbours, then
its smaller ones, to the smallest node it knows.  Each round shrinks the graph
towards stars whose centre is the smallest node of its component.  A node with
very many neighbours is never gathered in one place: minima are combined
before the shuffle, and the joins' hot keys can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum of a set of edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _with_least(pairs: DataFrame) -> DataFrame:
    """Neighbour pairs (u, v) with the smallest of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("_m")).withColumn("_m", F.least("u", "_m"))
    return pairs.join(least, "u")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root) for every node that has an edge to another one; root is
    the smallest node of the component.  Edges go both ways; loops, repeated
    edges and edges with a NULL end are ignored."""
    pairs = edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    pairs = stored(pairs.select("u", "v").distinct(), "edges")
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        star = _with_least(large)  # v < u in every row
        small = star.where("v != _m").select(F.col("v").alias("u"), F.col("_m").alias("v")).unionByName(
            star.select("u", F.col("_m").alias("v"))).distinct()
        pairs = stored(small, "edges")
        last, mark = mark, _mark(pairs)
        if mark == last:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
