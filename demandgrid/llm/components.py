"""Connected components of a graph of ids, by alternating large and small stars on the executors.

Each round writes its edges to the shared scratch folder, which also cuts the lineage. Minima are taken with partial sums
before the shuffle and joined back, so a node with very many neighbours is split by the skew join and never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import materialize


def _to_smallest(edges: DataFrame) -> DataFrame:
    """``u, v, least``: the smallest of ``u`` and its neighbours ``v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least, "u").withColumn("least", F.least("least", "u"))


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _to_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()
    stars = _to_smallest(large)  # in these edges v < u
    small = stars.select("u", F.col("least").alias("v")).unionByName(
        stars.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    )
    return small.distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` of all ids in ``u, v``; a component is named by its smallest id.

    Loops and repeated edges are allowed; without edges the result is empty.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges, last = materialize(edges, "links"), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()  # one row
        if mark == last or not mark[0]:
            break
        last, edges = mark, materialize(_round(edges), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
