"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import written


def component_roots(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component, for every node that has a link and isn't the root.

    ``links`` has the columns ``a`` and ``b``. Each round joins every node with the least of its
    neighbours (a map-side reduced minimum, so a hub is no hot group; skewed joins are split
    by Spark) and writes its links. The number of rounds is about the logarithm of the
    longest path. Nothing but a count and a checksum reaches the driver.
    """
    stars = written(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    seen = None
    while True:
        now = tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen or not now[0]:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
        stars = written(_small(_large(stars)), "stars")


def _large(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    near = both.join(least, F.col("a") == F.col("n"))
    return near.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them; ``a > b`` in every link."""
    least = links.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    rest = links.join(least, F.col("a") == F.col("n")).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select(F.col("n").alias("a"), F.col("m").alias("b")).unionByName(rest).distinct()
