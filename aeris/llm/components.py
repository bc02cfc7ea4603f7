"""Connected components of an undirected graph as alternating large-star and small-star rounds.

Every round is a few shuffles whose groups are reduced with ``min`` (map-side combined); no neighbour list of a
node is ever gathered, so a node with millions of links costs no more than its rows. Each round is written to the
shared checkpoint folder, and only two numbers per round (rows and changed rows) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(least.select(F.col("u").alias("k"), "m"), F.col("u") == F.col("k"))
             .where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (two long columns, any order, repeats and loops allowed);
    component is the smallest node that can be reached. Rows with a null end are no links and are left out.
    An empty table gives an empty table."""
    a, b = edges.columns
    now = stored(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                 .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).distinct(), "cc")
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(mark).alias("s")).first()
        if state == before or state["n"] == 0:
            break
        before = state
        now = stored(_small_star(_large_star(now)), "cc")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
