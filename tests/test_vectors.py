from __future__ import annotations

import io
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslab.functions import rules
from corpuslab.functions import vectors as vx
from corpuslab.operators import cluster as cl
from corpuslab.operators import dedup, encode, profile
from corpuslab.operators import select_k as sk
from corpuslab.plans import jobs, queries_vectors
from corpuslab.sources import comments as src

SHAPE = "file STRING, pos BIGINT, id STRING, embedding ARRAY<FLOAT>, original_pos BIGINT"


def frame(spark, matrix):
    return spark.createDataFrame(
        [(f"f{i % 3}", i, str(i), [float(x) for x in row], i) for i, row in enumerate(matrix)], SHAPE
    )


def blobs(n=240, d=6, k=3, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(k, d)) * 8
    return (centers[np.arange(n) % k] + rng.normal(size=(n, d)) * 0.3).astype(np.float32)


def test_signed_zero_is_distinct_and_first_copy_stays(spark):
    rows = frame(spark, [[0.0, 1.0], [-0.0, 1.0], [0.0, 1.0], [2.0, 3.0], [2.0, 3.0]])
    kept = dedup.dedup_vectors(rows, ["pos"])
    assert {r.pos: r.copies for r in kept.collect()} == {0: 2, 1: 1, 3: 2}
    by_file = dedup.first_occurrences(rows, ["file", "pos"]).collect()
    assert {(r.file, r.pos) for r in by_file} == {("f0", 0), ("f1", 1), ("f0", 3)}
    assert tuple(dedup.verify_dedup(rows, kept).first()) == (3, 3, 0, True, True)
    assert dedup.verify_dedup(rows, rows).first().all_unique is False
    assert dedup.dedup_summary(rows).first().duplicate_percentage == pytest.approx(40.0)


def test_profile_of_broken_vectors(spark):
    nan, inf = float("nan"), float("inf")
    checks = profile.sanity_checks(frame(spark, [[nan, 1.0], [inf, -inf], [0.0, 0.0]]), expected_dim=2).first()
    assert (checks.nan_count, checks.inf_count, checks.has_missing) == (1, 2, True)
    assert np.isnan(checks.mean_value) and np.isnan(checks.max_norm)


def test_profile_matches_numpy(spark):
    x = np.random.default_rng(1).normal(5, 2, size=(50, 4)).astype(np.float32).astype(float)
    row = profile.sanity_checks(frame(spark, x), expected_dim=4).first()
    norms = np.linalg.norm(x, axis=1)
    want = [x.min(), x.max(), x.mean(), x.std(), norms.min(), norms.max(), norms.mean()]
    got = [row.min_value, row.max_value, row.mean_value, row.std_value, row.min_norm, row.max_norm, row.mean_norm]
    assert got == pytest.approx(want)
    stats = profile.dimension_stats(frame(spark, x)).orderBy("dim").collect()
    assert [s["std"] for s in stats] == pytest.approx(list(x.std(axis=0)))


def test_unit_and_distances(spark):
    row = spark.range(1).select(
        vx.unit(F.expr("array(3f, 4f)")).alias("u"), vx.unit(F.expr("array(0f, 0f)")).alias("z"),
        vx.cosine_distance(F.expr("array(1f, 0f)"), F.expr("array(0f, 2f)")).alias("c"),
        vx.euclidean(F.expr("array(1f, 1f)"), F.expr("array(4f, 5f)")).alias("e"),
    ).first()
    assert (row.u, row.z, row.c, row.e) == ([pytest.approx(0.6), pytest.approx(0.8)], [0.0, 0.0], pytest.approx(1.0), 5.0)


def test_histogram_of_one_value(spark):
    bins = profile.histogram(spark.range(5), F.lit(2.0)).orderBy("bin").collect()
    assert len(bins) == 50 and bins[0].lo == 1.5 and sum(b.n for b in bins) == 5
    assert profile.histogram(spark.range(0), F.lit(2.0)).count() == 0


def test_advice(spark):
    def lines(*values):
        return spark.range(1).select(rules.advice(*[F.lit(v) for v in values]).alias("a")).first().a

    assert lines(0, 1.0, 0, 5000, 1.0) == []
    assert lines(0, 1.0, 0, 1000, 1.0) == [] and lines(0, 1.0, 0, 100_000, 1.0) == []
    assert lines(1, 0.5, 1, 999, 1001.0) == [
        rules.ADVICE_NON_FINITE, rules.ADVICE_NOT_UNIT, rules.ADVICE_DUPLICATES % 0.1, rules.ADVICE_SMALL, rules.ADVICE_MEMORY
    ]
    assert lines(0, 1.05, 0, 100_001, 1.0) == [rules.ADVICE_LARGE]


def test_kmeans_finds_blobs_and_is_repeatable(spark):
    x = blobs()
    rows = frame(spark, x)
    fit, again = cl.fit_kmeans(rows, 3, n_init=3), cl.fit_kmeans(rows, 3, n_init=3)
    assert np.array_equal(fit.centers, again.centers)
    labels = {r.pos: r.cluster for r in cl.assign(rows, fit.centers).collect()}
    assert all(labels[i] == labels[i % 3] for i in range(len(x))) and len(set(labels.values())) == 3
    means = np.array([x[i::3].mean(axis=0) for i in range(3)], dtype=float)
    assert fit.inertia == pytest.approx(sum(((x[i::3] - means[i]) ** 2).sum() for i in range(3)), rel=1e-4)


def test_lloyd_never_gets_worse(spark):
    rows, seeds = frame(spark, blobs(seed=3)), blobs(seed=9)[:4].astype(float)
    costs = [cl.run_lloyd(rows, {(4, 0): seeds}, i, -1.0)[0].inertia for i in range(4)]
    assert all(a >= b - 1e-9 for a, b in zip(costs, costs[1:]))


def test_more_clusters_than_points(spark):
    fit = cl.fit_kmeans(frame(spark, [[0.0, 1.0], [1.0, 0.0], [5.0, 5.0]]), 5, n_init=2)
    assert len(fit.centers) == 3 and fit.inertia == pytest.approx(0.0)


def brute_silhouette(x, labels):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    gap, out = 1 - unit @ unit.T, []
    for i in range(len(x)):
        same = (labels == labels[i]) & (np.arange(len(x)) != i)
        if not same.any():
            out.append(0.0)
            continue
        a = gap[i, same].mean()
        b = min(gap[i, labels == c].mean() for c in set(labels) - {labels[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouette_both_ways(spark):
    x = np.vstack([blobs(60, seed=4), np.full((1, 6), 40.0)]).astype(np.float32)
    centers = np.vstack([x[:4], x[-1:]]).astype(float)
    labels = vx.pairwise_squared(x.astype(float), centers).argmin(1)
    want = brute_silhouette(x.astype(float), labels)
    rows = frame(spark, np.vstack([x, np.zeros((1, 6))]))  # the zero row is left out of the score
    assert sk.silhouette_scan(rows, {7: centers})[7] == pytest.approx(want, abs=1e-6)
    assert sk.silhouette(cl.assign(rows, centers)) == pytest.approx(want, abs=1e-6)
    assert sk.silhouette_scan(rows, {1: centers[:1]}) == {}


def test_choice_of_k(spark):
    rows = frame(spark, blobs(k=4))
    assert sk.silhouette_choice(rows, k_max=6, n_init=3).k == 4
    assert sk.elbow_scan(rows, sample=100).k in (3, 4)
    assert sk.silhouette_choice(frame(spark, blobs(2))).k == 1
    assert sk.elbow_scan(frame(spark, blobs(1))).k == 1
    assert sk.elbow_choice({2: 5.0, 3: 5.0, 4: 5.0, 5: 5.0}) == 2
    table = sk.elbow_distances(sk.curve(spark, {2: 10.0, 3: 4.0, 4: 3.0, 5: 2.5}, "inertia"))
    assert table.filter("selected").first().k == sk.elbow_choice({2: 10.0, 3: 4.0, 4: 3.0, 5: 2.5}) == 3


def test_extremes_of_small_clusters(spark):
    rows = frame(spark, [[0.0, 0.0], [2.0, 0.0], [9.0, 9.0]]).withColumn("cluster", F.expr("int(pos div 2)"))
    centers = cl.centroids(rows).select("cluster", "center")
    got = cl.extremes(cl.with_distance(rows, centers), 3, 3).collect()
    assert sorted((r.cluster, r.kind, r.rank, r.pos) for r in got) == [
        (0, "farthest", 1, 1), (0, "farthest", 2, 0), (0, "nearest", 1, 0), (0, "nearest", 2, 1),
        (1, "farthest", 1, 2), (1, "nearest", 1, 2),
    ]


def test_pca_keeps_distances(spark):
    x = np.random.default_rng(2).normal(size=(40, 5)) * np.array([5, 3, 1, 0, 0]) + 7
    out = cl.pca_project(frame(spark, x), 3).orderBy("pos").collect()
    p = np.array([r.embedding for r in out])
    assert np.abs(p.mean(axis=0)).max() < 1e-4
    assert np.linalg.norm(p[0] - p[1]) == pytest.approx(np.linalg.norm(x[0] - x[1]), rel=1e-4)
    assert len(cl.pca_project(frame(spark, x), 0).first().embedding) == 5


def test_encoder_gives_unit_vectors(spark):
    df = spark.createDataFrame([(i, f"word{i} again again") for i in range(30)] + [(99, None)], "i INT, t STRING")
    first = {r.i: r.embedding for r in encode.embed(df, "t", encode.hashed_token_encoder(16), batch_rows=7).collect()}
    second = {r.i: r.embedding for r in encode.embed(df.repartition(5), "t", encode.hashed_token_encoder(16)).collect()}
    assert first == second and len(first) == 31
    assert np.linalg.norm(np.array(list(first.values())), axis=1) == pytest.approx(1.0, abs=1e-6)


def test_npz_import(spark):
    def archive(**arrays):
        buffer = io.BytesIO()
        np.savez_compressed(buffer, **arrays)
        return buffer.getvalue()

    x = np.arange(6, dtype=np.float16).reshape(3, 2)
    files = [
        ("/d/a.npz", bytearray(archive(embeddings=x, ids=np.array(["p", "q", "r"]), original_indices=np.array([5, 6, 9])))),
        ("/d/b.npz", bytearray(archive(embeddings=x, ids=np.array([1, 2, 3])))),
    ]
    df = src.import_npz(spark.createDataFrame(files, "path STRING, content BINARY"), rows_per_batch=2)
    got = sorted((r.file, r.pos, r.id, r.original_pos, r.embedding) for r in df.collect())
    assert got[2] == ("a.npz", 2, "r", 9, [4.0, 5.0]) and got[3] == ("b.npz", 0, "1", None, [0.0, 1.0]) and len(got) == 6
    broken = [("/d/c.npz", bytearray(archive(embeddings=x)))]
    with pytest.raises(Exception, match="ids"):
        src.import_npz(spark.createDataFrame(broken, "path STRING, content BINARY")).collect()


def test_cluster_job_and_outputs(spark, tmp_path):
    x = np.vstack([blobs(90), blobs(90)[:10]])
    comments = spark.range(100).select(
        F.concat(F.lit("f"), F.col("id") % 3).alias("file"), F.floor(F.col("id") / 3).alias("pos"),
        F.col("id").cast("string").alias("id"), F.concat(F.lit("t"), "id").alias("text"),
    )
    job = jobs.ClusterJob(k=3, choose="guarded", dedup=True, normalize=True, n_init=2, nearest=4, farthest=2, tag="fixed_k")
    done = jobs.run_cluster_job(frame(spark, x), comments, job, "base")
    summary = done.summary.first()
    assert (summary.num_points_original, summary.num_points, summary.num_clusters) == (100, 90, 3)
    assert done.extremes.groupBy("cluster").count().filter("count = 6").count() == 3
    assert done.extremes.filter("text IS NULL").count() == 0
    assert summary.outputs[0].closest_path == "base_fixed_k3_cluster_0_nearest_4.json"
    jobs.write_cluster_job(done, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "results")).count() == 90
    assert spark.read.json(str(tmp_path / "out" / "clusters")).count() == 18
    report = spark.read.json(str(tmp_path / "out" / "summary")).first()
    assert report.per_cluster_counts["0"].closest_saved == 4


def test_dedup_and_profile_jobs(spark, tmp_path):
    rows = frame(spark, [[0.0, 1.0], [0.0, 1.0], [1.0, 0.0]])
    assert jobs.run_dedup_job(rows, str(tmp_path / "d"), ["pos"]).first().all_unique
    jobs.run_profile_job(rows, "x.npz", str(tmp_path / "p"), 2)
    text = "".join(p.read_text() for p in (tmp_path / "p").glob("*.json"))
    assert json.loads(text)["sanity_checks"]["duplicate_count"] == 1


def test_presets_match_the_seven_variants():
    p = jobs.PRESETS
    assert len(p) == 7 and p["raw"].k == 10 and p["fixed"].k == 3 and p["silhouette_fast"].pca_dims == 100


def test_sampled_fit_meets_every_row(spark, monkeypatch):
    # three far rows among 6,000; a sample of 1,000 rows has none of them
    rng = np.random.default_rng(8)
    places = np.array([[0, 0], [10, 0], [0, 10], [10, 10]], dtype=float)
    rows = [(str(i), [float(x) for x in places[i % 4] + rng.normal(0, 0.1, 2)]) for i in range(6_000)]
    table = spark.createDataFrame(rows, "id string, embedding array<double>")
    drawn = {r.id for r in cl.hash_sample(table, "id", F.lit(cl.batch_size(6_000))).collect()}
    far = [i for i, _ in rows if i not in drawn][:3]
    table = table.withColumn("embedding", F.when(F.col("id").isin(far), F.array(F.lit(300.0), F.lit(300.0))).otherwise(F.col("embedding")))
    monkeypatch.setattr(queries_vectors.st, "vectors", lambda *_: table)
    got = queries_vectors.kmeans_sampled(spark, "").collect()
    sizes = [r.cluster_size for r in got]
    assert sum(sizes) == 6_000 and len(sizes) == 5 and min(sizes) == 3 and got[0].inertia < 200


def test_pass_sends_one_row_per_centre(spark):
    """Whatever the number of tasks, the driver gets a row per model and cluster; sums agree with a plain count."""
    rng = np.random.default_rng(5)
    points = np.round(rng.normal(size=(900, 6)), 3) + 1000.0
    frame = spark.createDataFrame([(str(i), p.tolist()) for i, p in enumerate(points)], "id STRING, embedding ARRAY<DOUBLE>").repartition(9)
    models = {0: points[:3], 1: points[10:15], 2: points[20:23], 3: points[[30, 30, 31]], 4: points[40:41]}
    assert not hasattr(cl, "DIRECT_ROWS")  # no way past the aggregation
    for m, found in cl.lloyd_pass(frame, models).items():
        gaps = ((points[:, None] - models[m][None]) ** 2).sum(2)
        label = gaps.argmin(1)
        assert found.counts.tolist() == np.bincount(label, minlength=len(models[m])).tolist()
        assert np.allclose(found.sums, [points[label == c].sum(0) for c in range(len(models[m]))])
        assert np.isclose(found.inertia, gaps.min(1).sum())
    assert cl.lloyd_pass(frame.filter("false"), models)[1].counts.sum() == 0
