from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from corpuslab.operators import cluster


def brute(rows, start, slices, seed, least_share, patience, most_rounds, place, luck):
    """The same rounds in numpy; ``place`` and ``luck`` are the hashes of the rows."""
    centers, met = np.array(start, float), np.zeros(len(start), int)
    smooth, best, waited, turn = None, np.inf, 0, 0
    for turn in range(max(most_rounds, slices)):
        mine = np.flatnonzero(place == turn % slices)
        points = rows[mine]
        gaps = ((points[:, None] - centers[None]) ** 2).sum(2)
        label = gaps.argmin(1)
        for c in range(len(centers)):
            met[c] += (label == c).sum()
            centers[c] += (points[label == c] - centers[c]).sum(0) / max(met[c], 1)
        cost = gaps.min(1).mean()
        smooth = cost if smooth is None else smooth * (1 - 2 / (slices + 1)) + cost * 2 / (slices + 1)
        waited = 0 if smooth < best else waited + 1
        best = min(best, smooth)
        if turn + 1 >= slices and waited >= patience:
            break
        apart = ((centers[:, None] - centers[None]) ** 2).sum(2)
        np.fill_diagonal(apart, np.inf)
        few = np.flatnonzero((met < least_share * met.max()) & (met * apart.min(1) <= smooth * met.sum() / len(met)))[: len(points) // 2]
        if len(few) and turn + 1 < max(most_rounds, slices):
            drawn = mine[np.lexsort((mine, luck[turn][mine]))][:len(few)]
            stay = np.delete(met, few[:len(drawn)])
            centers[few[:len(drawn)]] = rows[drawn]
            met[few[:len(drawn)]] = stay.min()
    return centers, turn + 1


def test_rounds_like_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = np.vstack([rng.standard_normal((900, 3)), rng.standard_normal((60, 3)) + 8, rng.standard_normal((40, 3)) - 9]).astype(np.float32).astype(float)
    data = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "id long, embedding array<float>")
    slices, seed, rounds = 4, 7, 30
    start = np.vstack([rows[:3], [[500.0, 500, 500]], [[-700.0, 0, 0]]])  # two centres that no row is near to
    hashes = data.select("id", F.pmod(F.xxhash64("id", F.lit(f"slice {seed}")), F.lit(slices)).alias("p"),
                         *[F.xxhash64("id", F.lit(f"replace {seed}/{t}")).alias(f"l{t}") for t in range(rounds)]).orderBy("id").toPandas()
    want, turns = brute(rows, start, slices, seed, 0.01, 5, rounds, hashes.p.to_numpy(), [hashes[f"l{t}"].to_numpy() for t in range(rounds)])
    fit = cluster.run_minibatch(data, {(5, 0): start}, slices, seed=seed, patience=5, most_rounds=rounds)[0]
    assert np.allclose(fit.centers, want, rtol=1e-9) and fit.iterations == turns
    assert fit.counts.min() > 0  # the far centres were replaced


def test_slices_cover_the_table_and_go(spark, tmp_path):
    data = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(500)], "id long, embedding array<float>")
    table, path = cluster.slice_table(data, 5, "id", "embedding", 1)
    assert table.count() == 500 and table.select("slice").distinct().count() == 5
    plan = table.filter("slice = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slice" in plan
    cluster.remove_table(spark, path)
    fit = cluster.fit_minibatch(data, [7], 100)[7]
    assert fit.inertia < 1e-6 and fit.counts.sum() == 500
