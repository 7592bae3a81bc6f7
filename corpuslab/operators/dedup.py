"""Exact duplicate removal on vectors, first occurrence wins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.functions import rules
from corpuslab.functions import vectors as vx


def first_occurrences(vectors: DataFrame, order: list[str], vec: str = "embedding") -> DataFrame:
    """The ``order`` tuple of each distinct vector's first row and its number of copies.

    Only the 32-byte key and the position are shuffled, pre-aggregated per task, so one group of
    copies may hold any share of the table.
    """
    keyed = vectors.select(vx.identity_key(F.col(vec)).alias("_key"), *order)
    copies = F.count(F.lit(1)).alias("copies")
    if len(order) == 1:
        return keyed.groupBy("_key").agg(F.min(order[0]).alias(order[0]), copies).drop("_key")
    first = F.min(F.struct(*order)).alias("_first")
    return keyed.groupBy("_key").agg(first, copies).select("_first.*", "copies")


def dedup_vectors(vectors: DataFrame, order: list[str], vec: str = "embedding") -> DataFrame:
    """All columns of the first rows plus ``copies``; ``order`` must identify a row (it is the join key)."""
    return vectors.join(first_occurrences(vectors, order, vec), order)


def dedup_summary(vectors: DataFrame, vec: str = "embedding", bytes_per_value: int = 2) -> DataFrame:
    """One row of counts, shares and estimated sizes before and after."""
    keyed = vectors.select(vx.identity_key(F.col(vec)).alias("_key"), F.size(vec).alias("_width"))
    groups = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.max("_width").alias("_width"))
    facts = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("original_count"),
        F.count(F.lit(1)).alias("unique_count"),
        F.max("_width").alias("embedding_dim"),
    )
    dup = F.col("original_count") - F.col("unique_count")

    def megabytes(rows: str):
        return F.col(rows) * F.col("embedding_dim") * F.lit(bytes_per_value) / F.lit(rules.MEGABYTE)

    share = F.coalesce(F.try_divide(dup * F.lit(100.0), F.col("original_count")), F.lit(0.0))
    return facts.select(
        "original_count",
        "unique_count",
        "embedding_dim",
        dup.alias("duplicate_count"),
        share.alias("duplicate_percentage"),
        share.alias("size_reduction_percentage"),
        F.try_divide(F.col("original_count"), F.col("unique_count")).alias("compression_ratio"),
        megabytes("original_count").alias("original_mb"),
        megabytes("unique_count").alias("deduplicated_mb"),
    )


def verify_dedup(original: DataFrame, deduplicated: DataFrame, vec: str = "embedding") -> DataFrame:
    """One row: are all output vectors unique, and does each occur in the input."""
    before = original.select(vx.identity_key(F.col(vec)).alias("_key")).distinct().withColumn("_known", F.lit(True))
    after = deduplicated.groupBy(vx.identity_key(F.col(vec)).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    return (
        after.join(before, "_key", "left")
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("unique_rows"),
            F.count_if(F.col("_known").isNull()).alias("unknown_rows"),
        )
        .select(
            "rows",
            "unique_rows",
            "unknown_rows",
            (F.col("rows") == F.col("unique_rows")).alias("all_unique"),
            (F.col("unknown_rows") == 0).alias("is_subset"),
        )
    )
