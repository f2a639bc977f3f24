"""Connected components of a link table by alternating star steps, each a grouped minimum and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.llm.common import drop_stored, stored

#: Edges of a task; a table of few edges is stored by as many tasks as there are cores, whatever the number of shuffle partitions.
EDGES = 100_000


def _dealt(df: DataFrame, edges: int) -> DataFrame:
    """``df`` of about so many edges in no more tasks than these need."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-edges // EDGES))
    return df.coalesce(tasks) if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def _star(edges: DataFrame, large: bool, count: int) -> DataFrame:
    """One step over edges (u, v): every node learns the least node next to it and hands it to the others.

    The least neighbour of a node is a grouped minimum with partial aggregation, and meets the edges in a join of one
    row per node, so a node with very many neighbours is never gathered in one place: the minima are stored, which lets
    adaptive execution split a crowded node's edges.
    """
    if large:  # both directions; a node hands its minimum to its larger neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(_dealt(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), count), "least")
        return _dealt(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), count)
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = stored(_dealt(down.groupBy("u").agg(F.min("v").alias("m")), count), "least")
    return _dealt(down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                  .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), count)


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of ``links`` (u, v) the least node it is connected to.

    Links to itself, repeated and NULL links do not matter; a table without links gives no rows. Every round is stored
    in the shared folder, and the rounds end when one changes nothing; their number grows with the logarithm
    of the longest path.
    """
    edges = stored(links.select("u", "v").filter("u <> v").distinct(), "links")
    before, count = None, edges.count()
    while count:
        large = stored(_star(edges, True, count), "star")
        after = stored(_star(large, False, count), "star")
        drop_stored(large)
        mark = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_stored(edges)
        edges = after
        if mark == before:
            break
        before, count = mark, mark[0]
    # A fixed point is a forest of stars: every node points at its least one.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
