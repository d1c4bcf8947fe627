"""Connected components of an edge table by alternating large and small stars.

Each pass re-hangs neighbours onto the smallest node known, so the edge table shrinks towards one star per
component in a logarithmic number of passes.  All steps are hash aggregations (combined map-side) and joins
on node ids; a node with very many edges is one aggregate row per task, and AQE splits it in the join.
Every pass is written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize_counted


def _state(edges: DataFrame) -> tuple:
    """Size and an order-free checksum."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge whose component is smaller than the node itself.

    Nodes that are not listed are their own component.  Null ends and loops are ignored.
    """
    pairs = edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).filter(F.col(a).isNotNull() & F.col(b).isNotNull()).filter("x > y").distinct()
    current, _ = materialize_counted(pairs, "edges")
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large, _ = materialize_counted(both.filter("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct(), "large-star")
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x").filter("y != m").select(F.col("y").alias("x"), F.col("m").alias("y")).unionByName(low.select("x", F.col("m").alias("y"))).distinct()
        current, _ = materialize_counted(small, "small-star")
        new = _state(current)
        if new == state:
            break
        state = new
    return current.select(F.col("x").alias("node"), F.col("y").alias("component"))
