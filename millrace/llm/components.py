"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node link to its smallest neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, link to the smallest."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``label``, the smallest id reachable, of each linked node.

    ``edges``: a and b, long ids. Links are rearranged into stars round by
    round (about log2 of the longest path), each round stored, so that neither
    the driver nor one task ever holds a component. Minima are combined before
    they are shuffled; joins on a hub are split at run time.
    """
    spark = edges.sparkSession
    edges = written(spark, edges.select("a", "b").where("a <> b").distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = written(spark, _small_star(written(spark, _large_star(edges), "large")), "small")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(
        roots.select("id", F.col("id").alias("label"))
    )
