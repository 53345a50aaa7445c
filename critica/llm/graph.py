"""Connected components of an edge list, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from critica.llm.common import stored


def _signature(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("h")).first()
    return r.n, r.h


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (bigint columns u, v); root is the smallest node of the component.

    Rounds go on until nothing changes, so every component is whole however long its chains are. Each round writes its
    edges to the shared folder, so lineage stays short and a lost executor repeats one round. Edge counts never grow
    beyond the input's. Minima are pre-aggregated before every shuffle and written before they are joined, so both sides
    of a join are plain tables and adaptive execution can split a hub. An empty edge list gives an empty result; self
    loops and repeated edges are allowed.
    """
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "edges")
    before = _signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        # u > v in every edge, so the neighbours above v are the u of its edges
        large = stored(edges.select(F.col("v").alias("u"), F.col("u").alias("above")).join(low, "u")
                       .select(F.col("above").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        # small star: every neighbour at or below u, and u itself, to the least of them
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = stored(small, "edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
