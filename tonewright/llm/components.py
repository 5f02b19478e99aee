"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonewright.sources.workspace import materialize, temporary


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    met = both.join(least, "a").where("b > a")
    return met.select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    met = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return met.unionByName(least.withColumnRenamed("m", "b"))


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` of all nodes that have a link; the label is the least node reachable.

    ``links`` has columns ``a`` and ``b`` that can be ordered. Each round is written to the shared
    folder, which cuts the lineage, and the number of rounds grows with the logarithm of the
    longest path. Nothing but a count and a checksum goes to the driver.
    """
    spark = links.sparkSession
    with temporary(spark):
        ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        edges = materialize(ordered.distinct(), "edges")
        seen = None
        while True:
            check = edges.agg(
                F.count("*").alias("n"),
                F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"),
            ).first()
            if (check["n"], check["sum"]) == seen or not check["n"]:
                break
            seen = (check["n"], check["sum"])
            edges = materialize(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        named = edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
        )
        return materialize(named, "components", lasting=True)
