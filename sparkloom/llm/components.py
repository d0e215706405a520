"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a, b``).

    ``component`` is the smallest node that can be reached. Each round ties the
    larger neighbours of a node to its smallest neighbour, then the smaller ones
    (large star, small star); it ends when a round changes nothing. The edges of
    a round are a written table, so lineage stays short; nothing but two numbers
    comes to the driver.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Now a > b in every edge: the small star ties a node's smaller neighbours, and itself, to the smallest.
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        new = written(small, "edges")
        now = new.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        dropped(edges)
        edges = new
        if state == tuple(now):
            break
        state = tuple(now)
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
