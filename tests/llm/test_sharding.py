from __future__ import annotations

import zlib
from collections import Counter

from corpuslab.llm import sharding


def laws(rows, shards, n):
    counts = Counter(r.shard for r in rows)
    assert sum(counts.values()) == n and set(counts) <= set(range(shards))
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_rows_law_and_digests(documents):
    docs = documents.collect()
    got = sharding.shard_digests(documents).collect()
    laws(got, 16, len(docs))
    texts = {r.doc_id: r.text or "" for r in docs}
    for r in got:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_every_shard_has_the_mixture(spark):
    docs = spark.createDataFrame([(i, "big" if i % 4 else f"s{i % 3}") for i in range(4000)], "doc_id long, source string")
    rows = sharding.interleave(docs, 10).collect()
    laws(rows, 10, 4000)
    for s in range(10):
        assert abs(sum(r.source == "big" for r in rows if r.shard == s) - 300) <= 2


def test_blocks_do_not_matter(documents, monkeypatch):
    place = lambda: {r.doc_id: (r.shard, r.slot) for r in sharding.shard_digests(documents).collect()}
    first = place()
    monkeypatch.setattr(sharding, "LEAST_BLOCK", 3)
    monkeypatch.setattr(sharding.math, "isqrt", lambda n: 3)
    assert place() == first


def test_edges(odd, none, tmp_path, spark):
    rows = sharding.shard_digests(odd).collect()
    laws(rows, 16, odd.count())
    kept = sharding.interleave(odd, 4)
    laws(kept.collect(), 4, odd.count())
    assert {"n", "text", "_rank"} & set(kept.columns) == {"n", "text"}
    assert sharding.shard_digests(none).count() == 0
    sharding.write_shards(odd.select("doc_id", "text", "source"), str(tmp_path / "s"), 4)
    laws(spark.read.parquet(str(tmp_path / "s")).collect(), 4, odd.count())
