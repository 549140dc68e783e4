"""Connected components by alternating stars, with every step written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow.llm.common import discard, staged


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).head())


def connected_components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, for every node that has a link.

    `links` has long columns a and b; rows with equal or NULL ends are ignored, repeated
    ones count once. No links give no rows. Each round hangs the larger neighbours of a node
    below its smallest neighbour, then does the same for the smaller ones, until
    every component is a star around its smallest node; the rounds needed grow with the
    logarithm of the longest path. Minima are summed up before they are shuffled and
    written out before they are joined, so that a hub's rows can be split over tasks.
    """
    spark = links.sparkSession
    both_ends = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current, path = staged(both_ends.where("a is not null and b is not null and u > v").distinct(), "links")
    state = _state(current)
    while True:
        # All neighbours, the larger ones hung below the smallest.
        sides = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest, path_lowest = staged(sides.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")), "links-low")
        upper = (
            sides.where("v > u")
            .join(lowest, F.col("u") == F.col("n"))
            .select(F.col("v").alias("u"), F.least("m", F.col("u")).alias("v"))
            .distinct()
        )
        upper, path_upper = staged(upper, "links-large")
        # The smaller ones, all of which `upper` lists as v.
        least, path_least = staged(upper.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")), "links-least")
        moved = upper.join(least, F.col("u") == F.col("n")).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following, path_next = staged(moved.unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct(), "links")
        after = _state(following)
        for old in (path, path_lowest, path_upper, path_least):
            discard(spark, old)
        current, path = following, path_next
        if after == state:
            break
        state = after
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
