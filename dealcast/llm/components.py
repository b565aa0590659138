"""Connected components by alternating star contraction, on Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dealcast.llm import common as C


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.where("b > a").join(low, "a").select(F.col("low").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them.
    ``edges`` has a < b."""
    low = edges.groupBy("b").agg(F.min("a").alias("low"))
    met = edges.join(low, "b")
    return (met.select(F.col("low").alias("a"), "b").union(met.select(F.col("low").alias("a"), F.col("a").alias("b")))
            .where("a <> b").distinct())


def components(links: DataFrame, rows_a_task: int = 50_000) -> DataFrame:
    """(rep, comp) for every node of the links (a, b); ``comp`` is the smallest
    node that it reaches. Each turn writes its edges; the turns end when the
    edges are stars. A table of few edges is read by few tasks, by its size."""
    def few(df: DataFrame) -> DataFrame:
        written = C.materialize(df)
        return written.coalesce(max(1, -(-written.count() // rows_a_task)))

    edges = few(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b"))
    edges = few(edges.distinct())
    while True:
        # stars: no node has two smaller ones, and no smaller one is itself linked to a smaller one
        twice = edges.groupBy("b").count().where("count > 1").select(F.lit(1).alias("x")).limit(1)
        chain = edges.select("a").join(edges.select(F.col("b").alias("a")), "a", "left_semi").select(F.lit(1).alias("x")).limit(1)
        if twice.union(chain).isEmpty():
            break
        edges = few(_small_star(_large_star(edges)))
    return C.materialize(edges.select(F.col("b").alias("rep"), F.col("a").alias("comp"))
                         .union(edges.select(F.col("a").alias("rep"), F.col("a").alias("comp")).distinct()))
