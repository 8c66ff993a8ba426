"""Connected components of links between ids, by alternating star contractions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from standwise.sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest id reachable, for every id in a link (a, b).

    Each round points the neighbours of every id to their smallest one, first the larger
    neighbours, then the smaller ones; chains shrink by half at least, and the rounds end
    when every id points straight to the smallest of its component. All steps are sums per
    id and joins on it; rounds are cut by staged tables.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    edges = stage(edges.distinct())
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        small = small.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
        found = stage(small.union(least.select("hi", F.col("m").alias("lo"))).distinct())
        # Stars are reached when no id points to one that itself points on.
        onward = found.join(found.select(F.col("hi").alias("lo")), "lo", "left_semi")
        if onward.isEmpty() and found.count() == found.select("hi").distinct().count():
            break
        edges = found
    roots = found.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return found.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
