"""Sharding: proportional stratified interleaving.

Every source is shuffled with a seed and its rows get the fractional rank ``(rank + 0.5) / rows of the source``.
Sorting all rows by that fraction interleaves the sources in proportion, so any contiguous stretch has the overall
mixture. The order is cut into shards whose row counts differ by at most one.

No source is ever sorted as a whole: rows are ranked inside blocks (a prefix of the shuffle hash for the rank in
a source, a stretch of fractions for the global rank) and only block totals take part in running sums.

Edge cases: null source is a source of its own; null text has no bytes (size 1, checksum 0); repeated rows each take
a slot, rows that agree in all columns are interchangeable; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslab.llm.common import offsets_before

LEAST_BLOCK = 256
SEED = "shards-1"


def interleave(
    docs: DataFrame, shards: int, source: str = "source", key: str = "doc_id", seed: str = SEED, rows: int | None = None
) -> DataFrame:
    """Adds ``shard`` (0..shards-1), ``slot`` (0.. inside the shard) and ``fraction`` to every row.

    ``key`` orders rows of equal hash. ``rows`` saves a count when the caller knows it.
    """
    spent = {"_hash", "_block", "_rank", "_n", "_before", "_start", "_source_rows", "_at", "shard", "slot", "fraction"}
    docs = docs.drop(*(spent & set(docs.columns)))
    total = docs.count() if rows is None else rows
    # blocks of about sqrt(rows): neither a block nor the list of block totals becomes large
    blocks = max(1, math.ceil(total / max(LEAST_BLOCK, math.isqrt(total))))
    span = 1 << 32
    hashed = docs.withColumn("_hash", F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))).withColumn(
        "_block", F.floor(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint") * F.lit(blocks) / F.lit(span))
    )

    # rank inside the source: rows of earlier hash blocks of that source plus the rank inside the block
    counts = hashed.groupBy(F.col(source).alias("_s"), F.col("_block").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_s", "_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.partitionBy("_s")).alias("_source_rows"),
    )
    inside = Window.partitionBy(source, "_block").orderBy("_hash", key)
    ranked = (
        hashed.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(starts, F.col(source).eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b")))
        .withColumn("fraction", (F.col("_start") + F.col("_rank") + 0.5) / F.col("_source_rows"))
        .drop("_s", "_b", "_start", "_rank", "_source_rows", "_block")
        .withColumn("_block", F.floor(F.col("fraction") * blocks))
    )

    # rank over all rows in order of the fraction, block by block in the same way
    totals = ranked.groupBy(F.col("_block").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    before = offsets_before(totals, ["_b"], "_n", "_before").drop("_n")
    across = Window.partitionBy("_block").orderBy("fraction", "_hash", F.col(source).asc_nulls_first(), key)
    placed = ranked.withColumn("_at", F.row_number().over(across) - 1).join(before, F.col("_block") == F.col("_b"))
    at = F.col("_before") + F.col("_at")
    cut = placed.withColumn("_at", at).withColumn("shard", F.floor(F.col("_at") * shards / F.lit(max(1, total))).cast("int"))
    # shard s starts at ceil(s * total / shards)
    start = F.ceil(F.col("shard").cast("bigint") * F.lit(total) / F.lit(shards))
    return cut.withColumn("slot", (F.col("_at") - start).cast("bigint")).drop("_hash", "_block", "_b", "_before", "_at")


def write_shards(docs: DataFrame, path: str, shards: int, **options) -> None:
    """One folder ``shard=N`` per shard, rows in slot order inside it."""
    placed = interleave(docs, shards, **options)
    placed.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard").parquet(path)


def shard_digests(docs: DataFrame, shards: int = 16, seed: str = SEED) -> DataFrame:
    """The contract's rows: sizes, checksums, law, shard and slot of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
    )
    placed = interleave(narrow, shards, seed=seed, rows=docs.count())
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
