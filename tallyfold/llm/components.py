"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.session import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that has an edge; the root is the smallest node reached.

    ``edges`` has long columns ``a, b``; direction, repeats and loops do not matter. Each round
    is two grouped minima and two joins over the edges, so no component is gathered anywhere,
    and the rounds grow with the logarithm of the longest path. Every round is written to the
    shared folder.
    """
    now = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v")
        .distinct(),
        "edges",
    )
    state = None
    while True:
        summary = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if summary == state or not summary[0]:
            break
        state = summary
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        now = written(small, "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
