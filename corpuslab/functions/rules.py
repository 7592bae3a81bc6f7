"""Small decision formulas used by reports and by the choice of k."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scan limits and report thresholds.
K_MIN, K_MAX, K_MAX_ELBOW = 2, 20, 30
FALLBACK_K = 10
SMALL_SET, LARGE_SET = 1000, 100000
NORM_TOLERANCE = 0.1
MEMORY_LIMIT_MB = 1000
MEGABYTE = 1024 * 1024

# Report lines.
ADVICE_NON_FINITE = "CRITICAL: Dataset contains NaN or infinite values. Clean data before clustering."
ADVICE_NOT_UNIT = "INFO: Embeddings may not be normalized. Consider normalizing before clustering."
ADVICE_DUPLICATES = "WARNING: %.1f%% duplicate embeddings found. Consider deduplication."
ADVICE_SMALL = "WARNING: Dataset is very small for clustering. Consider gathering more data."
ADVICE_LARGE = (
    "INFO: Large dataset detected. Consider using batch processing or sampling for initial experiments."
)
ADVICE_MEMORY = "INFO: High memory usage. Consider using float32 instead of float64 for memory efficiency."


def scan_bounds(n: int, k_min: int = K_MIN, k_max: int = K_MAX, adaptive: bool = True) -> tuple[int, int]:
    """First and last k of a scan over ``n`` points."""
    low = max(2, min(k_min, n - 1))
    ceiling = min(k_max, n - 1)
    if adaptive:
        ceiling = min(math.isqrt(max(n, 0)) + 5, ceiling)
    return low, max(low, ceiling)


def scan_bounds_columns(n: Column, k_min: int, k_max: int, adaptive: bool = True) -> tuple[Column, Column]:
    """:func:`scan_bounds` as column expressions."""
    last = n - F.lit(1)
    low = F.greatest(F.lit(2), F.least(F.lit(k_min), last))
    limits = [F.lit(k_max), last]
    if adaptive:
        limits.append(F.floor(F.sqrt(n)) + F.lit(5))
    return low.cast("bigint"), F.greatest(low, F.least(*limits)).cast("bigint")


def fallback_k(n: int) -> int:
    return max(1, min(FALLBACK_K, n))


def chord_distance(k: Column, y: Column, k1: Column, y1: Column, k2: Column, y2: Column) -> Column:
    """Distance of a point of the curve from the line through its two ends (length zero counts as one)."""
    span = F.sqrt((k2 - k1) * (k2 - k1) + (y2 - y1) * (y2 - y1))
    area = F.abs((y2 - y1) * k - (k2 - k1) * y + k2 * y1 - y2 * k1)
    return area / F.when(span == 0, F.lit(1.0)).otherwise(span)


def advice(non_finite: Column, mean_norm: Column, duplicates: Column, rows: Column, megabytes: Column) -> Column:
    """Array of report lines, in a fixed order."""
    share = F.try_divide(duplicates * F.lit(100.0), rows)
    lines = [
        F.when(non_finite > 0, F.lit(ADVICE_NON_FINITE)),
        F.when(F.abs(mean_norm - 1.0) > NORM_TOLERANCE, F.lit(ADVICE_NOT_UNIT)),
        F.when(duplicates > 0, F.format_string(ADVICE_DUPLICATES, share)),
        F.when(rows < SMALL_SET, F.lit(ADVICE_SMALL)).when(rows > LARGE_SET, F.lit(ADVICE_LARGE)),
        F.when(megabytes > MEMORY_LIMIT_MB, F.lit(ADVICE_MEMORY)),
    ]
    return F.array_compact(F.array(*lines))
