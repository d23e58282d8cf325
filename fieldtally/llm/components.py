"""Connected components of a link table, by alternating star steps.

Every step replaces links by links to the smallest neighbour and is written to
the shared folder. Nothing about single vertices reaches the driver. A vertex
with very many links costs a map-side minimum and a join whose large side
adaptive execution splits.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``a``, ``b`` (long) to ``node``, ``component``: the smallest vertex that
    links reach. Vertices without a link to another one are not returned."""
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct(), "links")
    state = None
    while True:
        edges = staged(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex links its larger neighbours to its smallest one."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select(F.col("a"), F.least("a", "least").alias("least"))
    return (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex links its smaller neighbours and itself to the smallest."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return (moved.union(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct())
