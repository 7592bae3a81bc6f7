from __future__ import annotations

import numpy as np
import pytest

from corpuslab.llm import common, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x int, component string, n string, width int, at int"


@pytest.mark.parametrize("kind", ["random", "pairs", "graded", "singular", "multiple"])
@pytest.mark.parametrize("d", [1, 2, 5, 33, 64])
def test_components_of_known_matrices(kind, d):
    rng = np.random.default_rng(d)
    values = {
        "random": rng.random(d), "pairs": np.repeat(rng.random(d), 2)[:d], "graded": 10.0 ** rng.uniform(-14, 4, d),
        "singular": np.r_[rng.random(d - d // 2), np.zeros(d // 2)], "multiple": np.full(d, 3.0),
    }[kind]
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    v = (q * values) @ q.T
    found, vectors = whitening.top_components(v, 4)
    size = values.max()
    assert np.abs(found - np.sort(values)[::-1][:4]).max() < 1e-12 * size
    assert np.abs(v @ vectors - vectors * found).max() < 1e-12 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12


def test_polar_factor():
    a = np.random.default_rng(1).standard_normal((20, 20))
    u = whitening.polar_factor(a)
    left, _, right = np.linalg.svd(a)
    assert np.abs(u - left @ right).max() < 1e-12


def brute(rows):
    x = {i: np.floor(256 * np.array(v, np.float64)).astype(np.int64) for i, v in rows}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(0)
    c = fit - sums / n
    v = c.T @ c / n
    values, vectors = np.linalg.eigh(v)
    return x, n, sums, values[::-1], vectors[:, ::-1], np.trace(v)


def test_like_brute_force(spark, sf):
    table = common.table(spark, sf, "embeddings")
    copies = table.selectExpr("vec_id + 1000000 AS vec_id", "embedding", "label").where("vec_id % 3 = 0")
    x, n, sums, values, vectors, trace = brute([(r.vec_id, r.embedding) for r in table.unionByName(copies).collect()])
    got = whitening.whiten(table.unionByName(copies)).toPandas()
    assert len(got) == 4 * len(x) and set(got.n) == {n}
    assert got.identity_error.max() < 1e-9
    for c, part in got.groupby("component"):
        want = np.array([(x[i] - sums / n) @ vectors[:, c - 1] / np.sqrt(values[c - 1]) for i in part.vec_id])
        assert min(np.abs(part.whitened - want).max(), np.abs(part.whitened + want).max()) < 1e-9
        assert np.allclose(part.explained, values[c - 1] / trace, rtol=1e-9)
        assert [int(((n * x[i] - sums) ** 2).sum()) for i in part.vec_id] == part.deviation.tolist()


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    extra = (None,) * 6
    rows = [(1, [0.5, 0.25], *extra), (1, [0.5, 0.25], *extra), (None, [-0.5, 1.0], *extra), (3, [2.0, -0.0], *extra), (4, None, *extra),
            (5, [], *extra), (6, [1.0, None], *extra), (7, [1.0, nan], *extra), (8, [-inf, 1.0], *extra), (9, [1.0, 2.0, 3.0], *extra)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (3, 1), (3, 2)]
    assert {r.n for r in got} == {3}
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame(rows[:2], SCHEMA)).collect() == []  # one distinct vector has no variance


def test_large_entries(spark):
    rows = [(i, [1e10 * i, float(i)]) for i in range(1, 4)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.vec_id, r.deviation) for r in got} == {(1, None), (2, 0), (3, None)}
    cut = whitening.integer_vectors(spark.createDataFrame([(1, [1e300]), (2, [-1e300])], "vec_id long, embedding array<double>"))
    assert sorted(r.x[0] for r in cut.collect()) == [1024 - 2**63, 2**63 - 1024]
