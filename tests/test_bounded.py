from __future__ import annotations

import numpy as np
import pytest

from corpuslab.operators import bounded, cluster


def frame(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, embedding array<double>").repartition(3)


def blobs(k, n, d, seed, spread=0.3, scale=1.0, offset=0.0):
    rng = np.random.default_rng(seed)
    middles = rng.standard_normal((k, d)) * 3
    return (middles[rng.integers(0, k, n)] + rng.standard_normal((n, d)) * spread) * scale + offset


@pytest.mark.parametrize("k,n,scale,offset", [(1, 50, 1, 0), (5, 400, 1e-7, 0), (8, 500, 1, 1e5), (150, 2000, 1, 0)])
def test_same_as_plain_rounds(spark, k, n, scale, offset):
    points = blobs(k, n, 6, k, scale=scale, offset=offset)
    data, start = frame(spark, points), points[:k]
    found = bounded.run_bounded(data, start, 6)
    centers = start.copy()
    for _ in range(6):
        label = ((points[:, None, :] - centers[None]) ** 2).sum(2).argmin(1)
        centers = np.stack([points[label == c].mean(0) if (label == c).any() else centers[c] for c in range(k)])
    label = ((points[:, None, :] - centers[None]) ** 2).sum(2).argmin(1)
    assert np.allclose(found.fit.centers, centers, rtol=1e-9, atol=1e-12 * scale)
    assert [r.label for r in found.labelled.orderBy("id").collect()] == label.tolist()
    assert np.isclose(found.fit.inertia, ((points - centers[label]) ** 2).sum(), rtol=1e-8)
    assert found.fit.counts.tolist() == np.bincount(label, minlength=k).tolist()


def test_bounds_save_most_distances(spark):
    points = blobs(100, 4000, 8, 1)
    found = bounded.run_bounded(frame(spark, points), points[:100], 12)
    assert found.skipped > 0.6


def test_fit_converges_like_the_scan(spark):
    points = blobs(6, 600, 4, 2, spread=0.05)
    found = bounded.fit_bounded(frame(spark, points), 6)
    plain = cluster.run_lloyd(frame(spark, points), {(6, 0): found.fit.centers}, 5, 0.0)[0]
    assert np.isclose(found.fit.inertia, plain.inertia, rtol=1e-9) and found.fit.iterations < 300


def test_grouped_centers_find_the_nearest():
    rng = np.random.default_rng(0)
    matrix, points = rng.standard_normal((3000, 5)), rng.standard_normal((500, 5))
    matrix[7] = matrix[2999]  # equal centres: the lower one
    points[0] = matrix[7]
    model = bounded.Centers(matrix)
    label, gap, second, computed = model.nearest(points)
    every = np.sqrt(((points[:, None, :] - matrix[None]) ** 2).sum(2))
    assert label.tolist() == every.argmin(1).tolist()
    assert np.allclose(gap, every.min(1), atol=1e-7) and np.allclose(second, np.sort(every, axis=1)[:, 1], atol=1e-7)
    assert computed < 0.6 * every.size


def test_centers_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(bounded, "CENTER_BLOCK", 7)
    rng = np.random.default_rng(3)
    matrix, points = rng.standard_normal((21, 4)), rng.standard_normal((200, 4))
    centers = spark.createDataFrame([(i * 10, [float(x) for x in c]) for i, c in enumerate(matrix)], "cluster int, center array<double>")
    got = bounded.assign_to_table(frame(spark, points), centers).orderBy("id").collect()
    want = ((points[:, None, :] - matrix[None]) ** 2).sum(2).argmin(1) * 10
    assert [r.cluster for r in got] == want.tolist()


def test_seeds_do_not_depend_on_scale_or_offset(spark):
    points = np.random.default_rng(4).standard_normal((50, 3))
    for scale, offset in ((1.0, 0.0), (1e-7, 0.0), (1e6, 0.0), (1.0, 1e6)):
        data = frame(spark, points * scale + offset)
        _, found = cluster.seed_candidates(data, 5, 1, 1, "id", "embedding")
        seeds = cluster.spread_seeds(*[found[0][0], 5, np.random.default_rng(0), found[0][1]])
        assert len(np.unique(seeds, axis=0)) == 5
    two = frame(spark, np.repeat(points[:2] + 1e6, 20, axis=0))
    _, found = cluster.seed_candidates(two, 5, 1, 1, "id", "embedding")
    assert len(cluster.spread_seeds(found[0][0], 5, np.random.default_rng(0), found[0][1])) == 2
