"""Connected components of a distributed edge list."""

from pyspark.sql import DataFrame, functions as F

from formbook.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.filter("v > u").join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge; the root is the smallest node reached.

    ``edges`` has two columns of the same orderable type. Large-star and small-star steps alternate until nothing
    changes. Each step is a minimum per node, combined before its shuffle, and
    a join that Spark may split at a node with many edges. Every round is
    staged, so a lost executor costs one round at most.
    """
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    edges, before = staged(edges.distinct(), "edges"), None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = mark
        edges = staged(_small_star(_large_star(edges)), "edges")
