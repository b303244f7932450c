"""Connected components of a table of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, stored


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every linked node.

    ``links`` has two columns of the same type; a row with a null links
    nothing, and repeated rows or links of a node with itself change nothing.
    No links give no rows.  Each round hangs all neighbours of a node onto the
    smallest among them; rounds end when no node that others hang on hangs on
    another.  A node's neighbours are only ever aggregated or joined, never
    gathered.
    """
    a, b = links.columns
    edges = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = stored(edges, "links")
    while True:
        # Stars: every node hangs on one other, which hangs on none.
        tops = edges.groupBy("u").agg(F.count("*").alias("n"))
        hung = edges.select(F.col("v").alias("u")).distinct().join(tops, "u", "left_semi")
        if not tops.filter("n > 1").select("u").unionByName(hung).limit(1).count():
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, before = stored(large, "links"), edges
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = stored(small.filter("u <> v").distinct(), "links")
        discard(large, before)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
