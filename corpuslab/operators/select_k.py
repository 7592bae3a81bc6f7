"""Choosing the number of clusters: elbow and cosine silhouette."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslab.functions import rules
from corpuslab.functions import vectors as vx
from corpuslab.functions.vectors import pairwise_squared, to_matrix
from corpuslab.operators import cluster as cl


@dataclass(frozen=True)
class Scan:
    """Chosen k, the curve it was chosen from and the model fitted for each k."""

    k: int
    values: dict[int, float]
    fits: dict[int, cl.Fit] = field(default_factory=dict)


def curve(spark, values: dict[int, float], name: str) -> DataFrame:
    return spark.createDataFrame(sorted((int(k), float(v)) for k, v in values.items()), f"k INT, {name} DOUBLE")


def elbow_distances(points: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Adds ``distance`` to the chord and ``selected`` (greatest distance, smallest k on ties).

    A curve has one row per k, at most a few dozen per group.
    """
    group = group or []
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    k1, k2 = F.min("k").over(whole), F.max("k").over(whole)
    y1, y2 = F.min_by("inertia", "k").over(whole), F.max_by("inertia", "k").over(whole)
    measured = points.withColumn("distance", rules.chord_distance(F.col("k"), F.col("inertia"), k1, y1, k2, y2))
    best = F.row_number().over(whole.orderBy(F.desc("distance"), "k"))
    return measured.withColumn("selected", best == 1)


def elbow_choice(values: dict[int, float]) -> int:
    """:func:`elbow_distances` for a curve the driver already holds."""
    ks = sorted(values)
    if not ks:
        return 1
    first, last = np.array([ks[0], values[ks[0]]]), np.array([ks[-1], values[ks[-1]]])
    along = last - first
    length = float(np.hypot(*along)) or 1.0
    gaps = [abs(float(along[1] * (k - first[0]) - along[0] * (values[k] - first[1]))) / length for k in ks]
    return ks[int(np.argmax(np.round(gaps, 12)))]


def seeded_inertia(vectors: DataFrame, seeds: np.ndarray, ks: list[int], vec: str = "embedding") -> dict[int, float]:
    """Inertia of the first k seeds for every k, in one scan."""
    fits = cl.run_lloyd(vectors, {(k, 0): seeds[:k] for k in ks}, 0, 0.0, vec)
    return {fit.k: fit.inertia for fit in fits}


def elbow_scan(
    vectors: DataFrame, k_min: int = rules.K_MIN, k_max: int = rules.K_MAX_ELBOW, sample: int | None = None,
    n: int | None = None, seed: int = 42, id_col: str = "id", vec: str = "embedding", n_init: int = 3,
) -> Scan:
    """Inertia over k; models are fitted on ``sample`` rows (None: all) and scored on all rows."""
    n = vectors.count() if n is None else n
    if n <= 1:
        return Scan(1, {1: 0.0})
    low, high = rules.scan_bounds(n, k_min, k_max)
    fits = _fit(vectors, list(range(low, high + 1)), sample, n, seed, id_col, vec, n_init)
    values = {k: fit.inertia for k, fit in fits.items()}
    return Scan(elbow_choice(values), values, fits)


def _fit(vectors, ks, sample, n, seed, id_col, vec, n_init):
    """Fits for all k; those made on a sample get the counts and inertia of the whole table."""
    if sample is None or n <= sample:
        return cl.fit_kmeans_scan(vectors, ks, n_init=n_init, seed=seed, id_col=id_col, vec=vec)
    fits = cl.fit_on_sample(vectors, ks, sample, id_col, vec, n_init=n_init, seed=seed)
    whole = cl.lloyd_pass(vectors, {k: fit.centers for k, fit in fits.items()}, vec)
    return {k: replace(fit, counts=whole[k].counts, inertia=whole[k].inertia) for k, fit in fits.items()}


def silhouette(labelled: DataFrame, cluster: str = "cluster", vec: str = "embedding") -> float:
    """Mean cosine silhouette of given labels, linear in rows; all-zero vectors are left out."""
    usable = labelled.filter(vx.sum_squares(F.col(vec)) > 0).select(
        array_to_vector(vx.as_double(F.col(vec))).alias("features"), F.col(cluster).cast("double").alias("prediction")
    )
    return ClusteringEvaluator(metricName="silhouette", distanceMeasure="cosine").evaluate(usable)


def _units(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    points = to_matrix(batch.column(0))
    size = np.sqrt((points * points).sum(1))
    points, size = points[size > 0], size[size > 0]
    return points, points / size[:, None]


def silhouette_scan(vectors: DataFrame, models: dict[int, np.ndarray], vec: str = "embedding") -> dict[int, float]:
    """Mean cosine silhouette of every model, two scans for all of them.

    The first scan sums unit vectors per (model, cluster); with those sums the mean distance of a
    point to a cluster is one dot product, so no pair of points is ever formed. Models with fewer
    than two non-empty clusters are left out.
    """
    tables = {m: np.asarray(c, dtype=np.float64) for m, c in models.items()}

    def sums(batches):
        totals = {m: np.zeros_like(c) for m, c in tables.items()}
        counts = {m: np.zeros(len(c), dtype=np.int64) for m, c in tables.items()}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            points, units = _units(batch)
            for m, centers in tables.items():
                label = pairwise_squared(points, centers).argmin(1)
                np.add.at(totals[m], label, units)
                counts[m] += np.bincount(label, minlength=len(centers))
        rows = [(m, c) for m in tables for c in range(len(tables[m])) if counts[m][c]]
        if rows:
            yield pa.record_batch(
                [
                    pa.array([m for m, _ in rows], pa.int32()),
                    pa.array([c for _, c in rows], pa.int32()),
                    pa.array([int(counts[m][c]) for m, c in rows], pa.int64()),
                    pa.array([totals[m][c] for m, c in rows], pa.list_(pa.float64())),
                ],
                names=["model", "cluster", "n", "total"],
            )

    merged = (
        vectors.select(vec)
        .mapInArrow(sums, "model INT, cluster INT, n BIGINT, total ARRAY<DOUBLE>")
        .groupBy("model", "cluster")
        .agg(F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total"))
        .collect()
    )
    total = {m: np.zeros_like(c) for m, c in tables.items()}
    count = {m: np.zeros(len(c)) for m, c in tables.items()}
    for row in merged:
        total[row.model][row.cluster] = row.total
        count[row.model][row.cluster] = row.n
    usable = {m for m in tables if (count[m] > 0).sum() >= 2}

    def scores(batches):
        score = dict.fromkeys(usable, 0.0)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            points, units = _units(batch)
            for m in usable:
                label = pairwise_squared(points, tables[m]).argmin(1)
                score[m] += float(row_silhouettes(units, label, total[m], count[m]).sum())
        if score:
            yield pa.record_batch(
                [pa.array(list(score), pa.int32()), pa.array(list(score.values()), pa.float64())], names=["model", "s"]
            )

    if not usable:
        return {}
    summed = vectors.select(vec).mapInArrow(scores, "model INT, s DOUBLE").groupBy("model").agg(F.sum("s").alias("s"))
    return {row.model: row.s / count[row.model].sum() for row in summed.collect()}


def row_silhouettes(units: np.ndarray, label: np.ndarray, total: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Silhouette of each unit vector from cluster sums; singletons score 0."""
    rows = np.arange(len(label))
    near = units @ total.T
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.where(count > 0, 1.0 - near / count, np.inf)
        size = count[label]
        own = np.where(size > 1, (size - near[rows, label]) / (size - 1), 0.0)
        mean[rows, label] = np.inf
        other = mean.min(1)
        top = np.maximum(own, other)
        value = np.where(top > 0, (other - own) / top, 0.0)
    return np.where(size > 1, value, 0.0)


def silhouette_choice(
    vectors: DataFrame, k_min: int = rules.K_MIN, k_max: int = rules.K_MAX, adaptive: bool = False,
    sample: int | None = None, n: int | None = None, seed: int = 42, id_col: str = "id", vec: str = "embedding",
    n_init: int = 10,
) -> Scan:
    """Cosine silhouette over k: greatest score wins, smallest k on ties."""
    n = vectors.count() if n is None else n
    if n <= 2:
        return Scan(1, {1: 0.0})
    low, high = rules.scan_bounds(n, k_min, k_max, adaptive)
    fits = _fit(vectors, list(range(low, high + 1)), sample, n, seed, id_col, vec, n_init)
    scores = silhouette_scan(vectors, {k: fit.centers for k, fit in fits.items()}, vec)
    if not scores or max(scores.values()) <= -1.0:
        return Scan(rules.fallback_k(n), {rules.fallback_k(n): 0.0})
    return Scan(min(scores, key=lambda k: (-scores[k], k)), dict(sorted(scores.items())), fits)
