"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evseq.llm.common import written


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): component is the least node of each component.

    ``edges`` has columns u, v of one comparable type; loops and repeats are
    fine.  Large-star and small-star steps alternate: each is a minimum per
    node (a partial aggregate) joined back to the edges, so a node with very
    many edges is neither collected nor sent to one task by the aggregate, and
    AQE may split it in the join.  Every round is written to the shared folder;
    the loop ends when a round leaves the edges as they are.
    """
    edges = written(edges.select("u", "v").filter("u <> v").distinct(), f"{name}-edges")
    nodes = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v").alias("node"))).distinct()
    current, before = edges, None
    while True:
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = large.distinct()  # u > v in every row
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(parent, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.union(parent.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        current = written(small, f"{name}-round")
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
    label = current.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "node")
    return nodes.join(label, "node", "left").select("node", F.coalesce("m", "node").alias("component"))
