from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from corpuslab.llm import exact


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        body = (text or "").translate({ord(c): None for c in " \t\n\x0b\x0c\r"})
        groups[hashlib.sha256(body.encode()).hexdigest()].append((-len(text or ""), i is None, i or 0, i))
    out = []
    for h, members in groups.items():
        keep = min(members)[3]
        out += [(m[3], keep, len(members), m[3] == keep, h) for m in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 40_000])
def test_filter_holds_its_keys(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    made = exact.build_filter(keys)
    assert exact.probe_filter(keys, *made).all()
    others = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert exact.probe_filter(others, *made).mean() < 0.02
    assert len(made[3]) < max(64, 2 * n)


def test_like_brute_force(spark, odd, none):
    got = exact.exact_digests(odd).collect()
    want = brute([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted([tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in got], key=str) == want
    assert exact.exact_digests(none).count() == 0


def test_snapshot_and_batch(spark):
    old = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "d d")], "doc_id long, text string")
    new = spark.createDataFrame([(4, "ab"), (5, "a  b"), (6, "x"), (7, "x"), (8, "dd")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact.dedup_against_snapshot(old, new).collect()}
    assert got == {1: (5, 3), 4: (5, 3), 5: (5, 3), 2: (2, 1), 3: (3, 2), 8: (3, 2), 6: (6, 2), 7: (6, 2)}


def test_bytes_are_compared(spark):
    docs = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r"), (4, " r")], "doc_id long, text string")
    pairs = spark.createDataFrame([(bytearray(b"k"), 1, 2), (bytearray(b"l"), 3, 4)], "digest binary, old_id long, new_id long")
    assert [bytes(r.digest) for r in exact.same_bytes(pairs, docs, "text", "doc_id").collect()] == [b"l"]


def test_ids_that_are_null_or_repeat(spark):
    """60 ids each carrying two texts, every text under two ids; then texts without an id."""
    rows = [(i, f"text {i}") for i in range(60)] + [((i + 7) % 60, f"text {i} ") for i in range(60)] + [(None, f" text {i}") for i in range(0, 60, 2)]
    got = exact.exact_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted([tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in got], key=str) == brute(rows)
