from __future__ import annotations

import corpus_pipeline as cp
from test_jaccard import brute

from corpuslab.llm import decontaminate, langid, mixing


def test_stages(spark, sf, documents, tmp_path):
    docs, seen = documents, {}
    for name, stage in cp.STAGES:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        seen[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = seen[name][1]
        assert docs.columns[:5] == documents.columns
    assert [n for n, _ in cp.STAGES] == ["language_id", "jaccard_join", "decontaminate", "mixing", "sharding"]
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = seen["language_id"]
    assert len(ids(before) - ids(after)) <= 4
    before, after = seen["jaccard_join"]
    groups = brute([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert ids(after) == {c for _, c in groups.values()}
    before, after = seen["decontaminate"]
    leaks = {r.doc_id for r in decontaminate.find_leaks(before, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert leaks and ids(after) == ids(before) - leaks
    before, after = seen["mixing"]
    assert ids(after) == {r.doc_id for r in mixing.mix(before).filter("drawn").collect()}
    before, after = seen["sharding"]
    assert ids(after) == ids(before)
    whole = {(r.doc_id, r.shard, r.slot) for r in cp.run(spark, sf).collect()}
    assert whole == {(r.doc_id, r.shard, r.slot) for r in docs.collect()}


def test_rejects_what_has_no_language(spark, odd, sf):
    kept = cp.identify_language(spark, odd, sf)
    assert kept.columns == odd.columns and not {0, 1, 2, 13} & {r.doc_id for r in kept.collect()}
    assert langid.UNKNOWN == "und"


def test_empty_table(spark, none, sf):
    docs = none
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0


def test_copies_with_repeated_or_null_ids(spark, sf):
    words = lambda w: " ".join(f"{w}{i}" for i in range(30))
    rows = [(1, words("a")), (1, words("a")), (None, words("b")), (None, words("b")), (None, words("a")), (2, words("c")), (2, words("d"))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.join_near_duplicates(spark, docs, sf).collect()
    assert sorted(((r.doc_id or 0, r.text) for r in kept)) == sorted([(1, words("a")), (0, words("b")), (2, words("c")), (2, words("d"))])
    placed = cp.assign_shards(spark, docs, sf).collect()
    assert sorted((r.doc_id or 0, r.text) for r in placed) == sorted((i or 0, t) for i, t in rows)
    assert len({(r.shard, r.slot) for r in placed}) == len(rows)
