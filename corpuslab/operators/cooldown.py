"""Anchored cooldown: a key is blocked from its first error for a fixed time; later errors do not extend it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.session import cut_lineage, scratch_path

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
COOLDOWN_SECONDS = 24 * 60 * 60
KEY_LIMIT = 1_000_000
UNION_LIMIT = 50


def micros(column: str, dtype: str) -> Column:
    """Microseconds since the epoch; times without zone are read as they stand, whatever the session's zone."""
    if dtype != "timestamp_ntz":
        return F.unix_micros(column)
    days = F.unix_date(F.to_date(column)).cast("bigint")
    minutes = (days * 24 + F.hour(column)) * 60 + F.minute(column)
    return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), F.col(column)) * 1_000_000).cast("bigint")


def from_micros(column: Column, dtype: str) -> Column:
    """Inverse of :func:`micros`."""
    if dtype != "timestamp_ntz":
        return F.timestamp_micros(column)
    seconds = (column.cast("decimal(24,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.expr(EPOCH) + F.make_dt_interval(secs=seconds)


def cooldown_anchors(
    errors: DataFrame, key: str, stamp: str, seconds: int = COOLDOWN_SECONDS, key_limit: int = KEY_LIMIT
) -> DataFrame:
    """``key, anchor_ts``: every error that starts a cooldown.

    Keys with up to ``key_limit`` distinct times are folded in place. Longer ones are walked one
    cooldown window at a time: each step is a pre-aggregated minimum over that window's rows, so no
    task ever holds such a key. One window holds at most one anchor, which makes both ways equal.
    """
    dtype = dict(errors.dtypes)[stamp]
    times = errors.select(key, micros(stamp, dtype).alias("_t")).distinct()
    sizes = times.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    long_keys = sizes.filter(F.col("_n") > key_limit).select(key)
    if long_keys.isEmpty():
        anchors = _fold(times, key, seconds)
    else:
        long_keys = cut_lineage(long_keys)
        short = _fold(times.join(long_keys, key, "left_anti"), key, seconds)
        anchors = short.unionByName(_walk(times.join(long_keys, key, "left_semi"), key, seconds))
    return anchors.select(key, from_micros(F.col("_anchor"), dtype).alias("anchor_ts"))


def _fold(times: DataFrame, key: str, seconds: int) -> DataFrame:
    gap = seconds * 1_000_000

    def step(anchors, t):
        opens = (F.size(anchors) == 0) | (t - F.element_at(anchors, -1) >= gap)
        return F.when(opens, F.concat(anchors, F.array(t))).otherwise(anchors)

    listed = times.groupBy(key).agg(F.sort_array(F.collect_list("_t")).alias("_t"))
    empty = F.array().cast("array<bigint>")
    guarded = F.aggregate(
        "_t", empty, lambda a, t: F.when(F.size(a) == 0, F.array(t)).otherwise(step(a, t))
    )
    return listed.select(key, F.explode(guarded).alias("_anchor"))


def _walk(times: DataFrame, key: str, seconds: int) -> DataFrame:
    """Window by window over a table partitioned by window, so every row is read once in all."""
    spark = times.sparkSession
    path = scratch_path(spark, "cooldown")
    gap = seconds * 1_000_000
    times.withColumn("_window", F.floor(F.col("_t") / F.lit(gap))).write.partitionBy("_window").parquet(path)
    placed = spark.read.parquet(path)
    windows = [r[0] for r in placed.select("_window").distinct().orderBy("_window").collect()]
    state = spark.createDataFrame([], placed.select(key, F.col("_t").alias("_anchor")).schema)
    found = state
    for step, w in enumerate(windows, 1):
        here = placed.filter(F.col("_window") == w).join(state, key, "left")
        ready = here.filter(F.col("_anchor").isNull() | (F.col("_t") - F.col("_anchor") >= gap))
        opened = cut_lineage(ready.groupBy(key).agg(F.min("_t").alias("_anchor")))
        found = found.unionByName(opened)
        if step % UNION_LIMIT == 0:
            found = cut_lineage(found)
        state = cut_lineage(state.join(opened.select(key), key, "left_anti").unionByName(opened))
    return found


def available_keys(anchors: DataFrame, key: str, now, seconds: int = COOLDOWN_SECONDS) -> DataFrame:
    """``key, last_anchor, available`` at ``now``: free again once the full cooldown has passed."""
    last = anchors.groupBy(key).agg(F.max("anchor_ts").alias("last_anchor"))
    age = F.col("_now") - F.col("last_anchor")
    return last.withColumn("_now", now).withColumn("available", age >= F.make_dt_interval(secs=F.lit(seconds))).drop("_now")
