"""Connected components as joins: alternating large-star and small-star contraction.

Each round contracts every vertex's neighbourhood to its smallest member, so that any graph turns into
stars around the smallest vertex of each component in O(log^2 n) rounds, few in practice. Only
aggregates by vertex (combined before the shuffle) and joins are used. The minima are stored before
they are joined, so both join sides are plain exchanges and adaptive execution can split a hot vertex. A round's tables
are removed as soon as the next edges are stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import remove, stored


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free digest of an edge set, to see when a round changed nothing."""
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Label each vertex that has an edge with the smallest vertex it can reach.

    edges: two columns of longs; loops, repeats, either direction and nulls are allowed (rows with a null
    or a loop link nothing). Returns ``vertex, root`` with one row per vertex that has a link, roots
    included; an empty table gives an empty table.
    """
    spark = edges.sparkSession
    u, v = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    now, path = stored(edges.where(f"{a} != {b}").select(u.alias("u"), v.alias("v")).distinct(), "edges")
    before, mark = None, _mark(now)
    while mark != before:  # every round lowers a label or changes nothing
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low, low_path = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low", 2 * mark[0])
        large = now.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, large_path = stored(large.where("u != v").distinct(), "large", mark[0])
        least, least_path = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low", mark[0])
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edge = small.unionByName(least.select("u", F.col("m").alias("v")))
        old, (now, path) = path, stored(edge.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", 2 * mark[0])
        for done in (old, low_path, large_path, least_path):
            remove(spark, done)
        before, mark = mark, _mark(now)
    roots = now.select(F.col("v").alias("vertex")).distinct().select("vertex", F.col("vertex").alias("root"))
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("root")).unionByName(roots)
