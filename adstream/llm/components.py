"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a minimum per node and a join back, so no task ever holds the neighbours of one
node; steps are written to the shared folder, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.common import saved, scratch


def _stored(least: DataFrame) -> DataFrame:
    """A minimum per node as a table: of an aggregate Spark would not split the join at a hot node."""
    return saved(least, scratch(least.sparkSession, "least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest one it knows."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _stored(down.groupBy("a").agg(F.min("b").alias("least")))
    return (
        down.join(least, "a")
        .select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        .where("a <> b")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) of every linked node.

    ``links`` has two columns ``a`` and ``b`` of long; its direction, order and repetition
    do not matter. An empty table gives an empty result.
    """
    spark = links.sparkSession
    state = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state, before = saved(state.distinct(), scratch(spark, "links")), None
    while True:
        # All links of the final forest go from a node to its root; it no longer changes.
        row = state.agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("a", "b")).alias("x"),
            F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")).alias("s"),
        ).first()
        if tuple(row) == before or row["n"] == 0:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(row)
        state = saved(_small_star(_large_star(state)), scratch(spark, "links"))
