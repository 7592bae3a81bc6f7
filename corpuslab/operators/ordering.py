"""Positions, running offsets, samples and top-n lists without a single-task sort.

A plain window over one large group would sort that group in one task. Here every window runs over
blocks of limited size, and only one row per block takes part in the running sums.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslab.session import cut_lineage

BLOCK = 1 << 20
RANGE_SPLITS = 1000
RANGE_ROWS = 100_000
HASH_DIGITS = 4


def id_block(column: str, width: int = BLOCK) -> Column:
    """Order-preserving block number of a unique integer id: at most ``width`` rows per block."""
    return F.floor(F.col(column) / F.lit(width)).cast("bigint")


def position_in_group(
    df: DataFrame, group: list[str], block: Column, order: list[Column | str], out: str = "pos"
) -> DataFrame:
    """0-based position of each row in its group, ordered by (``block``, ``order``).

    Sorting happens per (group, block). A group may hold any share of the table as long as its
    blocks stay small.
    """
    rows = df.withColumn("_block", block)
    counts = rows.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group, "_block").orderBy(*order)
    keys = [*group, "_block"]
    return (
        rows.join(offsets, keys)
        .withColumn(out, (F.col("_offset") + F.row_number().over(inside) - 1).cast("bigint"))
        .drop("_block", "_offset")
    )


def running_offsets(counts: DataFrame, order: list[str], n: str, out: str = "offset") -> DataFrame:
    """Exclusive running total of ``n`` over all rows in ``order`` (a unique tuple), in parallel.

    A bounded hash sample of the tuples gives range limits, about one per ``RANGE_ROWS`` rows; totals
    per range (at most ``RANGE_SPLITS`` + 1 rows) are summed first, then each range is summed on its
    own. ``counts`` is stored first, since it is read several times.
    """
    counts = cut_lineage(counts)
    splits = min(RANGE_SPLITS, counts.count() // RANGE_ROWS)
    key = F.struct(*order)
    limits = sorted(
        tuple(r) for r in counts.select(*order).distinct().orderBy(F.xxhash64(*order)).limit(splits).collect()
    ) if splits else []
    types = dict(counts.dtypes)

    def literal(values: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(types[c]).alias(c) for v, c in zip(values, order)])

    if limits:
        bounds = F.array(*[literal(v) for v in limits])
        part = F.size(F.filter(bounds, lambda b: b <= key))
    else:
        part = F.lit(0)
    placed = counts.withColumn("_range", part)
    everything = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_range")
        .agg(F.sum(n).alias("_total"))
        .select("_range", F.coalesce(F.sum("_total").over(everything), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_inner", F.coalesce(F.sum(n).over(inside), F.lit(0)))
        .join(F.broadcast(starts), "_range")  # at most RANGE_SPLITS + 1 rows
        .withColumn(out, (F.col("_start") + F.col("_inner")).cast("bigint"))
        .drop("_range", "_start", "_inner")
    )


def global_index(
    df: DataFrame, file: str, block: Column, order: list[Column | str], out: str = "global_pos"
) -> DataFrame:
    """0..N-1 over all files in name order, rows in ``(block, order)`` order inside a file."""
    rows = df.withColumn("_block", block)
    counts = rows.groupBy(file, "_block").agg(F.count(F.lit(1)).alias("_n"))
    offsets = running_offsets(counts, [file, "_block"], "_n", "_offset").drop("_n")
    inside = Window.partitionBy(file, "_block").orderBy(*order)
    return (
        rows.join(offsets, [file, "_block"])
        .withColumn(out, (F.col("_offset") + F.row_number().over(inside) - 1).cast("bigint"))
        .drop("_block", "_offset")
    )


def hash_sample(
    df: DataFrame,
    id_col: str,
    quota: Column,
    group: list[str] | None = None,
    seed: str = "42",
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """Exactly ``quota`` rows per group (all rows if there are fewer), the smallest by md5(seed || id).

    Equivalent to shuffling each group with a seed and taking the first rows. ``quota`` may use the
    group size as column ``n``. Rows are counted per hash prefix, prefixes past the quota drop out in
    the join, and ranking runs per prefix (about n / 16**digits rows), never over a whole group.
    """
    group = group or []
    hashed = df.withColumn("_hash", F.md5(F.concat(F.lit(seed), F.col(id_col).cast("string"))))
    hashed = hashed.withColumn("_prefix", F.substring("_hash", 1, digits))
    counts = hashed.groupBy(*group, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    upto = whole.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefixes = (
        counts.withColumn("n", F.sum("_n").over(whole))
        .withColumn("_quota", quota)
        .withColumn("_left", F.col("_quota") - (F.sum("_n").over(upto) - F.col("_n")))
        .filter(F.col("_left") > 0)
        .select(*group, "_prefix", "_left")
    )
    inside = Window.partitionBy(*group, "_prefix").orderBy("_hash", id_col)
    ranked = hashed.join(prefixes, [*group, "_prefix"]).withColumn("_rank", F.row_number().over(inside))
    return ranked.filter(F.col("_rank") <= F.col("_left")).select(*df.columns)


def top_per_group(
    df: DataFrame, group: list[str], order: list[Column], limit: Column, most: int, spread_by: list[str],
    slices: int = 32, out: str = "rank",
) -> DataFrame:
    """Rank rows in each group and keep ranks up to ``limit`` (a column, never above ``most``).

    Slices of a group are ranked first, so the final ranking of a group reads at most
    ``slices * most`` rows however large the group is; both steps prune before their shuffle.
    """
    part = df.withColumn("_slice", F.pmod(F.xxhash64(*spread_by), F.lit(slices)))
    first = F.row_number().over(Window.partitionBy(*group, "_slice").orderBy(*order))
    part = part.withColumn("_rank", first).filter(F.col("_rank") <= most).drop("_rank", "_slice")
    last = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return part.withColumn(out, last).filter(F.col(out) <= most).filter(F.col(out) <= limit)


def exact_percentiles(df: DataFrame, columns: list[str], points: list[float], splits: int = 256) -> DataFrame:
    """Linear-interpolated percentiles of numeric columns, exact at any size: ``column, p, value``.

    Equal values are counted once, the distinct values are cut into ranges at approximate
    quantiles, and only ranges that hold a wanted rank are ordered. The built-in ``percentile`` would
    hold all distinct values of a column in one buffer.
    """
    spark = df.sparkSession
    grid = F.expr("array(" + ", ".join(f"{i / splits}D" for i in range(1, splits)) + ")")
    facts = df.agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(F.col(c).cast("double"), grid, 10 * splits).alias(f"q_{i}") for i, c in enumerate(columns)],
    ).first()
    limits, ranks, weights = [], [], []
    for i, name in enumerate(columns):
        n = facts[f"n_{i}"]
        cuts = sorted({v for v in facts[f"q_{i}"] or [] if math.isfinite(v)}) or [0.0]
        limits.append([-math.inf, *cuts, math.inf])
        wanted = set()
        for p in points if n else []:
            low = int(p * (n - 1))
            part = p * (n - 1) - low
            for rank, weight in ((low, 1 - part), (min(low + 1, n - 1), part)):
                wanted.add(rank)
                weights.append((name, p, rank, float(weight)))
        ranks.append(sorted(wanted))

    wanted_ranks = F.element_at(F.array(*[F.array(*[F.lit(r) for r in rs]).cast("array<bigint>") for rs in ranks]), F.col("c") + 1)
    ids = range(len(columns))
    doubles = df.select(*[F.col(c).cast("double").alias(f"x_{i}") for i, c in enumerate(columns)])
    ranged = Bucketizer(  # binary search per value
        splitsArray=limits, inputCols=[f"x_{i}" for i in ids], outputCols=[f"r_{i}" for i in ids], handleInvalid="keep"
    ).transform(doubles)
    cells = [F.struct(F.lit(i).alias("c"), F.col(f"x_{i}").alias("x"), F.col(f"r_{i}").cast("int").alias("_range")) for i in ids]
    counted = ranged.select(F.inline(F.array(*cells))).filter("x IS NOT NULL").groupBy("c", "x", "_range").agg(
        F.count(F.lit(1)).alias("n")
    )
    before = Window.partitionBy("c").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = counted.groupBy("c", "_range").agg(F.sum("n").alias("_size")).withColumn(
        "_before", F.coalesce(F.sum("_size").over(before), F.lit(0))
    )
    hit = ranges.filter(
        F.exists(wanted_ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_size")))
    )
    inside = Window.partitionBy("c", "_range").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = (
        counted.join(F.broadcast(hit), ["c", "_range"])  # at most two ranges per column and point
        .withColumn("_end", F.col("_before") + F.sum("n").over(inside))
        .withColumn("_start", F.col("_end") - F.col("n"))
    )
    inner = F.filter(wanted_ranks, lambda r: (r >= F.col("_start")) & (r < F.col("_end")))
    names = F.array(*[F.lit(c) for c in columns])
    found = ordered.select(F.element_at(names, F.col("c") + 1).alias("column"), "x", F.explode(inner).alias("r"))
    shares = spark.createDataFrame(weights, "column STRING, p DOUBLE, r BIGINT, w DOUBLE")
    return found.join(F.broadcast(shares), ["column", "r"]).groupBy("column", "p").agg(
        F.sum(F.col("x") * F.col("w")).alias("value")
    )
