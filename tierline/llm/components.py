"""Connected components of a table of links, by alternating stars.

Each round points the neighbours of a node to the smallest of them, first those
larger than the node and then the others, until all links are stars. A round is a
minimum per node and a join; links and components never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node of its component) from links (a, b).

    Only nodes with a link to another node are listed; ids are integers. Without
    links the result is empty.
    """
    star = stored(_small_star(links.filter("a <> b").select("a", "b")), "links")
    while not _settled(star):
        star = stored(_small_star(_large_star(star)), "links")
    centres = star.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return stored(
        star.select(F.col("a").alias("node"), F.col("b").alias("label")).union(centres).distinct(),
        "components",
    )


def _settled(links: DataFrame) -> bool:
    """Whether the links (larger, smaller) are stars: no node has two centres, no centre one.

    That needs no further round to see that it changes nothing.
    """
    ends = links.select(F.inline(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )))
    of_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return of_node.filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    """The larger neighbours of each node, linked to the smallest of all."""
    both = links.union(links.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    found = both.join(least, "a").filter("b > a")
    return found.select(F.col("b").alias("a"), F.least("m", F.col("a")).alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    smaller = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), "m")
    return smaller.union(least.select("a", "m")).toDF("a", "b").distinct()
