"""Connected components of an edge table, as Spark joins.

Alternates two steps until nothing changes (large-star / small-star): every
node links its larger neighbours, then its smaller ones, to the smallest node
around it. Each step is one grouped minimum and one join; groups are never
collected, so a node with very many edges is reduced map-side and its edge
rows can be split by a skewed join. Rounds grow with the logarithm of the
longest path. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm._io import staged


def _directed(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller end, once each."""
    return edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u != v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node go to the least of the node's surroundings."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    above = edges.select(F.col("v").alias("u"), F.col("u").alias("n"))
    return above.join(least, "u").select(F.col("n").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Neighbours below a node, and the node, go to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return below.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame | None:
    """(node, component) for every node of ``edges`` (src, dst of one type);
    the component is its smallest node. Edges with a null end are ignored;
    nodes with only loops do not appear. None if there is no edge."""
    current = staged(_directed(edges.where("src is not null and dst is not null")), "edges")
    size = current.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
    if not size[0]:
        return None
    while True:
        current = staged(_small_star(_large_star(current)), "edges")
        after = current.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if after == size:
            break
        size = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
