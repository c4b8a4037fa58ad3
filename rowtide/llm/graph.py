"""Connected components of a set of links, by rounds of joins."""

from pyspark.sql import functions as F

from rowtide.session import written


def stars(edges):
    """Whether each node of `edges` (v, u) either hangs under one other node, which hangs under none, or under none."""
    ends = edges.select(F.col("v").alias("x"), F.lit(1).alias("under"), F.lit(0).alias("over")).unionAll(
        edges.select("u", F.lit(0), F.lit(1)))
    ends = ends.groupBy("x").agg(F.sum("under").alias("under"), F.max("over").alias("over"))
    return ends.where("under > 1 or under = 1 and over = 1").agg(F.count("*")).first()[0] == 0


def components(spark, links):
    """(node, root) for every node of `links` (a, b: long); `root` is the smallest node it is connected to.

    Alternates two steps until only stars are left, which no step changes: every
    node hangs its larger neighbours under its smallest one, then its smaller ones.
    Trees lose about half of their height per round. Each round is a written table, so lost executors
    cost one round and plans stay short; a node with very many neighbours is only
    met in sums and in joins that adaptive execution may split.
    """
    edges = written(spark, links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    while not stars(edges):
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(
            edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).where("v <> u").distinct()
        large = written(spark, large)
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u")).alias("v"),
                                            F.col("m").alias("u")).where("v <> u").distinct()
        edges = written(spark, small)
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionAll(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
