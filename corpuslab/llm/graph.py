"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.session import written_table


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, label`` for every node of ``edges`` (columns ``a, b``); label: the smallest node of its component.

    Each round hangs the larger neighbours of every node below its smallest neighbour (large star), then the smaller
    ones (small star); the number of rounds grows with the logarithm of the longest path. Both steps are a minimum per
    node, pre-aggregated per task, and a join whose hot side adaptive execution can split.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written_table(e, name)
    before = None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
        before = mark
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        e = written_table(small.select("e.a", "e.b").filter("a <> b").distinct(), name)
