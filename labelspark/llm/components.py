"""Connected components of links between whole numbers, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelspark.llm.common import cut

#: Tables of two numbers up to so many rows are sent to all tasks: 32 MB at most. Larger ones are joined by shuffle.
BROADCAST_ROWS = 1 << 20


def sendable(table: DataFrame, rows: int) -> DataFrame:
    """The table, to be broadcast if it has few rows; else cut, so that adaptive execution may split the join for a hot key."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else cut(table)


def components(links: DataFrame) -> tuple[DataFrame, int]:
    """``node``, ``root``: the smallest node that can be reached, for each node of ``a``, ``b`` links that is not a root
    itself; and the number of these rows.

    Each round hangs every larger neighbour of a node, then every smaller one, on the smallest neighbour, until only
    stars are left. Minima are taken before the shuffle, and no task needs the links of a node together. Null ends and
    links of a node to itself join nothing and are left out.
    """
    ends = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = cut(ends.distinct())
    rows = stars.count()
    while rows and not _are_stars(stars):
        both = stars.select(F.inline(F.expr("array(struct(a, b), struct(b AS a, a AS b))")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.filter("b > a").join(sendable(least, 2 * rows), "a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if rows > BROADCAST_ROWS:
            large = cut(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        # A link to the minimum itself becomes that of its leaf, any other one that of its smaller end.
        small = large.join(sendable(least, rows), "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        stars = cut(small.distinct())
        rows = stars.count()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")), rows


def _are_stars(links: DataFrame) -> bool:
    """Whether each node is either a root or has one link to a smaller node."""
    roles = links.select(F.inline(F.expr("array(struct(a AS node, 1 AS leaf, 0 AS root), struct(b AS node, 0 AS leaf, 1 AS root))")))
    seen = roles.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("root").alias("root"))
    return seen.filter("leaf + root > 1").isEmpty()
