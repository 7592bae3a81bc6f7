"""Clustering jobs on all rows, row keys and comment texts."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslab.operators import cluster as cl
from corpuslab.operators import enrich
from corpuslab.operators.encode import hashed_token_encoder
from corpuslab.plans import jobs

SHAPE = "file STRING, pos BIGINT, id STRING, embedding ARRAY<FLOAT>, original_pos BIGINT"


def table(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def test_rare_vectors_get_their_centres(spark):
    spots = F.when(F.col("pos") == 7, 1).when(F.col("pos") == 20_000, 2).when(F.col("pos") == 30_002, 3).otherwise(0)
    rows = spark.range(30_003).select(F.col("id").alias("pos"), F.col("id").cast("string").alias("id")).withColumn(
        "embedding", F.array(spots.cast("float"), (spots * spots).cast("float")))
    fit = cl.fit_kmeans(rows, 4, n_init=3)
    assert len(fit.centers) == 4 and fit.inertia == pytest.approx(0.0, abs=1e-9)
    assert sorted(fit.counts) == [1, 1, 1, 30_000]


def test_far_vectors_are_found(spark):
    far = F.when(F.col("id") % 10_000 == 3, 2000.0).otherwise(0.0)
    rows = spark.range(40_000).select(
        F.col("id").cast("string").alias("id"),
        F.array((far + F.sin("id") * 2).cast("float"), (F.cos(F.col("id") * 7) * 2).cast("float")).alias("embedding"))
    fit = cl.fit_kmeans(rows, 2, n_init=3)
    assert sorted(fit.counts) == [4, 39_996] and fit.inertia < 200_000


def test_non_finite_vectors_are_refused(spark):
    for odd in (float("nan"), float("inf"), float("-inf")):
        rows = table(spark, [("f", 0, "a", [1.0, 2.0], None), ("f", 1, "b", [odd, 1.0], None)])
        with pytest.raises(ValueError, match="NaN or infinite"):
            cl.fit_kmeans(rows, 1, n_init=1)


def two_archives(spark):
    values = [[1.0, 0.0], [0.0, 1.0], [1.0, 1.0], [2.0, 1.0], [5.0, 5.0], [6.0, 5.0]]
    rows = [(f"{f}_embeddings.npz", i, f"{f}{i}", values[3 * n + i], None) for n, f in enumerate("ab") for i in range(3)]
    comments = [(f"{f}.json", i, f"{f}{i}" if f == "a" else str(i), f"text {f}{i}") for f in "ab" for i in range(3)]
    return table(spark, rows), spark.createDataFrame(comments, "file STRING, pos BIGINT, id STRING, text STRING")


def test_each_row_gets_its_own_text(spark):
    vectors, comments = two_archives(spark)
    got = {r.id: r.text for r in enrich.enrich_per_file(vectors, comments).collect()}
    assert got == {f"{f}{i}": f"text {f}{i}" for f in "ab" for i in range(3)}  # b is found by position
    ids = {r.id: r.text for r in enrich.enrich_priority(vectors, comments, ["file", "pos"]).collect()}
    assert ids == {"a0": "text a0", "a1": "text a1", "a2": "text a2", "b0": None, "b1": None, "b2": None}


def test_rows_of_several_files_stay_apart(spark):
    vectors, comments = two_archives(spark)
    for name in ("dedup", "report"):
        outcome = jobs.run_cluster_job(vectors, comments, replace(jobs.PRESETS[name], k=2, n_init=2))
        assert outcome.labelled.count() == 6 and outcome.summary.first().num_points == 6
        texts = {r.id: r.text for r in outcome.texts.collect()}
        assert texts["b2"] == "text b2" and len(texts) == 6


def test_repeated_keys_are_refused(spark):
    vectors, _ = two_archives(spark)
    with pytest.raises(ValueError, match="share file"):
        jobs.run_cluster_job(vectors.union(vectors), None, jobs.PRESETS["raw"])


def test_errors_of_a_scan_are_not_swallowed(spark):
    rows = table(spark, [("f", i, str(i), [float("nan"), 1.0], None) for i in range(30)])
    with pytest.raises(ValueError):
        jobs.run_cluster_job(rows, None, jobs.PRESETS["elbow"])
    assert np.isfinite(jobs.PRESETS["elbow"].seed) and all(p.sample is None for p in jobs.PRESETS.values())


def test_embed_job_writes_its_report(spark, tmp_path):
    comments = spark.createDataFrame(
        [("a.json", 0, "0", "x y"), ("a.json", 1, "1", "z"), ("b.json", 0, "0", "x")], "file STRING, pos BIGINT, id STRING, text STRING")
    totals = jobs.run_embed_job(comments, hashed_token_encoder(8), str(tmp_path / "o")).first()
    assert tuple(totals) == (2, 2, 3, 3, 8)
    assert spark.read.json(str(tmp_path / "o" / "processing_report")).first().total_vectors == 3
    assert spark.read.json(str(tmp_path / "o" / "files")).count() == 2
