"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom import session
from creditloom.llm.common import prepare


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b) but the smallest of its component, which is the component.

    Every round moves each node's links to its smallest neighbour, until all components are stars.  The minima are
    stored tables, so that the joins with them shuffle on both sides and a hub's rows can be split.  Self-links and
    nulls are ignored; no links give an empty result.
    """
    spark = prepare(links.sparkSession)
    folders: list[str] = []

    def stored(df: DataFrame) -> DataFrame:
        folders.append(session.scratch_dir(spark, "stars"))
        df.write.parquet(folders[-1])
        return spark.read.schema(df.schema).parquet(folders[-1])

    def clean(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").distinct()

    edges = stored(clean(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).dropna()))
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = stored(clean(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))))
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        done = folders[:-1]
        edges = stored(clean(small.unionByName(least.select("u", F.col("m").alias("v")))))
        session.remove(spark, *done, folders[-2])
        folders = folders[-1:]
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Every node has one link, and none leads to a node that has a link itself."""
    twice = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("u").alias("x"))
    chained = edges.join(edges.select(F.col("u").alias("x")), F.col("v") == F.col("x"), "left_semi").select("v")
    return twice.unionByName(chained.select(F.col("v").alias("x"))).isEmpty()
