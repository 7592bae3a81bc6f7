"""The branches that only large tables take, forced by small limits and checked against plain logic."""

from __future__ import annotations

import difflib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslab.functions.text import squash_name
from corpuslab.operators import cooldown as cd
from corpuslab.operators import fuzzy, joins, ordering


def test_attach_bounded_falls_back(spark):
    facts = spark.range(100).select("id", (F.col("id") % 7).alias("k"))
    dim = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for limit in (3, 100):
        got = joins.attach_bounded(facts, dim, ["k"], limit)
        assert got.filter("v = k * 2").count() == 100


def test_positions_in_blocks(spark):
    ids = random.Random(1).sample(range(100_000), 3000)
    df = spark.createDataFrame([(i, "big" if i % 3 else f"f{i % 7}") for i in ids], "id BIGINT, file STRING")
    got = ordering.position_in_group(df, ["file"], ordering.id_block("id", 500), ["id"])
    want = {}
    for file in {r.file for r in got.collect()}:
        want.update({i: p for p, i in enumerate(sorted(r.id for r in got.filter(F.col("file") == file).collect()))})
    assert {r.id: r.pos for r in got.collect()} == want


def test_running_offsets_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(ordering, "RANGE_ROWS", 20)
    rows = [(f"f{i % 40:02d}", i // 40, (i * 7) % 5 + 1) for i in range(400)]
    counts = spark.createDataFrame(rows, "file STRING, block INT, n BIGINT")
    got = {(r.file, r.block): r.o for r in ordering.running_offsets(counts, ["file", "block"], "n", "o").collect()}
    total, want = 0, {}
    for file, block, n in sorted(rows):
        want[(file, block)] = total
        total += n
    assert got == want


def test_hash_sample_counts_and_order(spark):
    import hashlib

    df = spark.range(2000).select("id", F.when(F.col("id") < 1500, "big").otherwise("small").alias("g"))
    got = ordering.hash_sample(df, "id", F.floor(F.col("n") * 0.1), ["g"], digits=2)
    for g, low, high, size in (("big", 0, 1500, 150), ("small", 1500, 2000, 50)):
        want = sorted(range(low, high), key=lambda i: hashlib.md5(f"42{i}".encode()).hexdigest())[:size]
        assert {r.id for r in got.filter(F.col("g") == g).collect()} == set(want)
    assert ordering.hash_sample(df, "id", F.lit(5000)).count() == 2000


def test_top_per_group_overlap_and_limits(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("g"), "id", ((F.col("id") * 37) % 101).alias("x"))
    got = ordering.top_per_group(df, ["g"], [F.col("x"), F.col("id")], F.lit(10), 10, ["id"], slices=7)
    for g in (0, 1):
        want = sorted(((i * 37) % 101, i) for i in range(g, 500, 2))[:10]
        assert [(r.x, r.id) for r in got.filter(F.col("g") == g).orderBy("rank").collect()] == want


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_exact_percentiles(spark, n):
    rng = np.random.default_rng(n)
    a, b = rng.normal(size=n), rng.integers(0, 3, size=n).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a DOUBLE, b DOUBLE")
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r.column, r.p): r.value for r in ordering.exact_percentiles(df, ["a", "b"], points, splits=16).collect()}
    for name, values in (("a", a), ("b", b)):
        for p in points:
            assert got[(name, p)] == pytest.approx(float(np.quantile(values, p)), abs=1e-9)


def greedy(times, gap):
    anchors = []
    for t in sorted(times):
        if not anchors or t - anchors[-1] >= gap:
            anchors.append(t)
    return anchors


@pytest.mark.parametrize("key_limit", [10, 10_000])
def test_cooldown_walk_equals_greedy(spark, key_limit):
    rng = random.Random(3)
    rows = [("hot", rng.randrange(20 * 86400)) for _ in range(200)] + [(f"k{i % 5}", rng.randrange(9 * 86400)) for i in range(30)]
    rows += [("edge", 0), ("edge", 10 * 3600), ("edge", 23 * 3600), ("edge", 24 * 3600), ("edge", 49 * 3600)]
    df = spark.createDataFrame(rows, "k STRING, s BIGINT").select("k", F.timestamp_seconds("s").alias("ts"))
    got = cd.cooldown_anchors(df, "k", "ts", key_limit=key_limit).select("k", F.unix_seconds("anchor_ts").alias("s"))
    want = {(k, a) for k in {r[0] for r in rows} for a in greedy([s for q, s in rows if q == k], 86400)}
    assert {tuple(r) for r in got.collect()} == want


def test_times_without_zone_ignore_the_session_zone(spark):
    times = ["2024-03-10 01:30:00.000001", "2024-03-11 01:30:00", "2024-03-11 01:30:00.000001", "1969-12-31 23:59:59.5"]
    df = spark.createDataFrame([(t,) for t in times], "s STRING").selectExpr("1 AS k", "CAST(s AS TIMESTAMP_NTZ) AS ts")
    for zone in ("America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = cd.cooldown_anchors(df, "k", "ts").select(F.col("anchor_ts").cast("string").alias("t"))
        assert sorted(r.t for r in got.collect()) == [times[3], times[0], times[2]]


def test_available_after_full_cooldown(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1)], "k STRING, s BIGINT").select("k", F.timestamp_seconds("s").alias("anchor_ts"))
    got = cd.available_keys(df, "k", F.timestamp_seconds(F.lit(86400)))
    assert {r.k: r.available for r in got.collect()} == {"a": True, "b": False}


def test_ttl_is_strict(spark):
    entries = spark.createDataFrame([("a", 0), ("b", 1)], "k STRING, s BIGINT").select("k", F.timestamp_seconds("s").alias("ts"))
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "k STRING")
    got = joins.ttl_lookup(asked, entries, "k", "ts", F.timestamp_seconds(F.lit(7 * 86400)))
    assert {r.k: r.hit for r in got.collect()} == {"a": False, "b": True, "c": False}


@pytest.mark.parametrize("block_names", [20_000, 7])
def test_best_match_equals_brute_force(spark, block_names):
    rng = random.Random(5)
    words = ["red", "blue", "song", "live", "mix", "2024", "the", "night"]
    name = lambda: "_".join(rng.sample(words, rng.randint(1, 4)))
    targets = sorted({name() for _ in range(40)} | {"", "zzz"})
    files = [(rng.randrange(3), name()) for _ in range(30)]
    candidates = spark.createDataFrame([(d, s, f"{s}.json") for d, s in files], "dir_rank INT, stem STRING, file STRING")
    squash = lambda s: "".join(c for c in s.lower() if c.isascii() and c.isalnum())
    want = {}
    for t in targets:
        scored = []
        for d, s in sorted(files, key=lambda f: (f[0], f[1] + ".json")):
            a, b = squash(t), squash(s)
            scored.append((1.0 if a and a in b else difflib.SequenceMatcher(None, a, b).ratio(), s + ".json"))
        best = max(scored, key=lambda x: x[0])
        if best[0] >= 0.5:
            want[t] = best
    got = fuzzy.best_match(spark.createDataFrame([(t,) for t in targets], "target STRING"), candidates, 0.5, block_names)
    assert {r.target: (pytest.approx(r.score), r.file) for r in got.collect()} == want
    assert spark.createDataFrame([("A-1 é",)], "s STRING").select(squash_name(F.col("s"))).first()[0] == "a1"


def test_missing_counts_repeats(spark):
    wanted = spark.createDataFrame([("a",), ("a",), ("b",), ("",)], "k STRING")
    have = spark.createDataFrame([("b",), ("b",)], "k STRING")
    assert {tuple(r) for r in joins.missing_keys(wanted, have, "k").collect()} == {("a", 2), ("", 1)}
    assert tuple(joins.missing_report(wanted, have, "k").first()) == (4, 3)
