"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.session import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``src, dst``): root is the smallest node of its component.

    Alternates two star operations. The large star links every larger neighbour of a node to the smallest one around,
    the small star every smaller one; both keep the components and shrink distances, so the rounds needed grow
    with the logarithm of a path's length. A node with many neighbours is a sum and a join, never a list. Each round is
    written to the shared folder, which cuts the lineage.
    """
    def flat(pairs: DataFrame) -> DataFrame:
        return pairs.where("src <> dst").distinct()

    current = stage(flat(edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))), "cc")
    while True:
        both = current.union(current.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = flat(both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")))
        # src > dst in every pair from here
        down = large.groupBy("src").agg(F.min("dst").alias("m"))
        joined = large.join(down, "src")
        small = flat(
            joined.select(F.col("dst").alias("src"), F.col("m").alias("dst")).union(down.select("src", F.col("m").alias("dst")))
        )
        after = stage(small, "cc")
        # all stars: no node is both above and below another
        if after.select("src").intersect(after.select("dst")).isEmpty() and after.groupBy("src").count().where("count > 1").isEmpty():
            break
        current = after
    roots = after.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    return roots.union(after.select(F.col("dst").alias("node"), F.col("dst").alias("root"))).distinct()
