"""Connected components of a link table by alternating large-star and small-star steps.

Each step moves links to the smallest neighbour of a node. A step is one minimum per node, combined before the shuffle, and
one join; minima are written first so that both join sides are plain shuffles which Spark can split where one node has a
large share of all links. The links never outgrow the input, nothing is gathered per node, and the lineage ends in
written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.sources.shared import written


def _star(links: DataFrame, larger_only: bool) -> DataFrame:
    """Links (a, b) moved to the smallest member around each `a`."""
    least = written(links.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("least")), "components-least")
    moved = links.join(least, "a")
    if larger_only:
        return moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
        least.select("a", F.col("least").alias("b"))
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of `links` (columns a, b); the root is the smallest node of the component.

    Links to oneself and repeated links are ignored; without links the result is empty.
    """

    def kept(frame: DataFrame) -> DataFrame:
        pair = frame.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return written(pair.filter(F.col("a") != F.col("b")).distinct(), "components-links")

    def state(frame: DataFrame):
        return tuple(frame.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())

    links = kept(links)
    seen = state(links)
    while seen[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = kept(_star(kept(_star(both, True)), False))
        if (now := state(links)) == seen:
            break
        seen = now
    # every node but the roots now has just one link, to its root
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
