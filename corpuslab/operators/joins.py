"""Join helpers. Hot keys are left to adaptive execution, which splits skewed sides of sort-merge joins by size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def small_table(df: DataFrame, max_rows: int) -> DataFrame | None:
    """``df`` as a broadcast-hinted local table if it has at most ``max_rows`` rows, else None.

    Reads at most ``max_rows + 1`` rows, so the check itself is bounded.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def attach_bounded(facts: DataFrame, dim: DataFrame, keys: list[str], max_rows: int, how: str = "inner") -> DataFrame:
    """Broadcast ``dim`` when its checked size allows, else an ordinary join."""
    local = small_table(dim, max_rows)
    return facts.join(dim if local is None else local, keys, how)


def missing_keys(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Wanted keys without a counterpart, with how often each was asked for.

    Both sides are reduced to distinct keys before the anti join, so repeats cannot skew it.
    """
    asked = wanted.groupBy(key).agg(F.count(F.lit(1)).alias("times"))
    return asked.join(present.select(key).distinct(), key, "left_anti")


def missing_report(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """One row: entries asked for, entries without output (repeats count each time)."""
    asked = wanted.groupBy(key).agg(F.count(F.lit(1)).alias("times"))
    seen = present.select(key).distinct().withColumn("_seen", F.lit(True))
    return asked.join(seen, key, "left").agg(
        F.coalesce(F.sum("times"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("_seen").isNull(), F.col("times"))), F.lit(0)).alias("missing"),
    )


def pending_files(listed: DataFrame, processed: DataFrame, outputs: DataFrame, key: str = "file") -> DataFrame:
    """Listed files that are neither marked processed nor have an output."""
    done = processed.select(key).unionByName(outputs.select(key)).distinct()
    return listed.select(key).distinct().join(done, key, "left_anti")


def latest_per_key(df: DataFrame, key: str, order: list[str], payload: list[str]) -> DataFrame:
    """Last write per key: ``payload`` of the row with the greatest ``order`` tuple."""
    last = F.max_by(F.struct(*payload), F.struct(*order)).alias("_last")
    return df.groupBy(key).agg(last).select(key, *[F.col(f"_last.{c}").alias(c) for c in payload])


def ttl_lookup(
    requests: DataFrame, entries: DataFrame, key: str, stamp: str, now: Column, ttl: str = "INTERVAL 7 DAYS"
) -> DataFrame:
    """Requests with the latest entry of their key and whether it is still fresh (strictly younger than ``ttl``)."""
    payload = [c for c in entries.columns if c != key]
    newest = latest_per_key(entries, key, [stamp], payload)
    found = requests.join(newest, key, "left")
    fresh = (now - F.col(stamp)) < F.expr(ttl)
    return found.withColumn("hit", F.coalesce(fresh, F.lit(False)))
