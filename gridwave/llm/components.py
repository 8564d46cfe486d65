"""Connected components of a link table by alternating star joins.

Every pass links each node's larger neighbours to its least neighbour, then
each node's smaller neighbours.  The links turn into one star per component
within about log(n) pairs of passes.  Only minima per node and joins are used:
no neighbour list is gathered, and every pass reads a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwave.llm.common import written


def _least(rows: DataFrame) -> DataFrame:
    """Rows (u, v) with ``m``, the least of u and all its v."""
    low = rows.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return rows.join(low, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    return least.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v")))


def _tidy(links: DataFrame) -> DataFrame:
    return links.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links of long ids -> (node, root): the least node of its component.

    Only nodes that are not the least of their component have a row.  Nulls
    and links of a node to itself are ignored.
    """
    now = written(_tidy(links.select("u", "v").filter("u IS NOT NULL AND v IS NOT NULL")), "links")
    mark = None
    while True:
        now = written(_tidy(_small_star(_tidy(_large_star(now)))), "links")
        # Equal tables have equal marks; the sum is of 64-bit hashes as decimals, so it cannot overflow.
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(found)
