"""Connected components of an edge table, by alternating star operations.

Large-star links the larger neighbours of each node to its smallest neighbour,
small-star the smaller ones; both keep the components. Edges are never
gathered on the driver; each round is written to the checkpoint folder. Few
edges stay in one partition, so that rounds don't deal them over empty tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgecast.session import SMALL_ROWS, packed, step


def _star(edges: DataFrame, large: bool, few: bool = False) -> DataFrame:
    """(u, v) with v < u, of edges of that form; one star step. It makes no more edges than it gets; ``few``: at most SMALL_ROWS."""
    low = edges.groupBy("u").agg(F.min("v").alias("low"))
    low = F.broadcast(low) if few else low
    if large:
        # only smaller neighbours can be a node's smallest, and only larger ones are linked to it
        hung = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u", "left")
        out = hung.select(F.col("v").alias("u"), F.coalesce("low", "u").alias("v"))
    else:
        # the edge to the smallest neighbour stays; the other neighbours are linked to that one
        hung = edges.join(low, "u")
        out = hung.select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("low").alias("v"))
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node that has an edge to another one; comp is the
    smallest node of the component. ``edges`` has two long columns, in any
    direction; loops and repeated edges don't matter."""
    a, b = edges.columns
    cur = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    cur, before = step(cur), None
    rows = cur.count()
    while True:
        few = rows <= SMALL_ROWS
        cur = packed(cur, rows)
        cur = step(_star(_star(cur, True, few), False, few))
        rows, total = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (rows, total) == before or not rows:
            break
        before = rows, total
    leaves = cur.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return leaves.unionByName(leaves.select(F.col("comp").alias("node"), "comp").distinct())
