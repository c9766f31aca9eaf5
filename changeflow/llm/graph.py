"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Scratch


def components(links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(id, root) of every node that is not the smallest of its component.

    ``links`` has two long columns.  Large-star and small-star steps turn the
    links into stars around the smallest nodes; rounds grow with the logarithm
    of the nodes.  A hub of many links is counted with partial sums and its
    joins are between written tables, which Spark splits where they are skewed.
    """
    u, v = links.columns
    edges = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u <> v").distinct()
    edges = scratch.save(edges, f"{name}-0")
    print_of = [F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(2**40)))]
    before, at = edges.agg(*print_of).first(), 0
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-{at}-a")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.save(large, f"{name}-{at}-b")
        least = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-{at}-c")
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        edges = scratch.save(small, f"{name}-{at + 1}")
        after = edges.agg(*print_of).first()
        scratch.drop(f"{name}-{at}", *[f"{name}-{at}-{x}" for x in "abc"])
        if after == before:
            break
        before, at = after, at + 1
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
