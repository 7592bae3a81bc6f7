from __future__ import annotations

import json
import random

import pytest

from corpuslab.sources import comments as src


@pytest.fixture
def tiny_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
           if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "211")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.set(key, old[key]) if key in old else spark.conf.unset(key)


def random_items(rng, n):
    texts = ['a,b', '"quoted", and \\ back\\\\', "[1, 2", "}]", "é中\U0001f600", "", " ", "x" * 300, "\n\t", "{,}", '\\"', "plain"]
    items = []
    for _ in range(n):
        text = "".join(rng.choice(texts) for _ in range(rng.randint(0, 3)))
        items.append(rng.choice([
            text, {"comment": text}, {"id": rng.randint(0, 9), "comment": text}, {"x": [text, {"comment": [1, 2, [3]]}]}, 7, None,
            {"comment": None}, [text, [text]], {"id": text, "comment": "c", "more": {"a": [[]]}}]))
    return items


def same(spark, folder):
    want = src.parse_comment_files(src.comment_files(spark, folder)).collect()
    rows, bad = src.read_large_comments(spark, folder)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, want))
    assert sorted(map(tuple, bad.collect())) == sorted(map(tuple, src.rejected_files(src.comment_files(spark, folder)).collect()))
    return len(want)


def test_like_the_whole_file_parser(spark, tmp_path, tiny_blocks):
    rng = random.Random(5)
    for i in range(8):
        body = json.dumps(random_items(rng, rng.randint(0, 50)), ensure_ascii=i % 2 == 0, indent=None if i % 3 else 1)
        (tmp_path / f"f{i}.json").write_text(rng.choice(["", " \n"]) + body + rng.choice(["", "\n ", "  "]), encoding="utf-8")
    assert same(spark, str(tmp_path)) > 80


def test_bad_files_keep_their_reason(spark, tmp_path, tiny_blocks):
    bodies = ["[", '["a"', '["a",', '["a",]', '["a",,"b"]', '["a" "b"]', '["a"}', '["a\\,b"]', '[{"comment": "x"], "y"]', '["a"b"]',
              "[]", " [ ] ", "[1, 2]", '{"comment": ["a", "b"]}', "true", '["a"] ["b", "c"]', '["a"], "b"', '["a"]]', '["open, ["x"]',
              '["' + "long " * 100 + '", {"comment": "b"}] trailing, [1', '["' + "cut " * 100 + ', "b"]', ',["a"]', '["a", "\\u00e9\\"", "z"]']
    for i, body in enumerate(bodies):
        (tmp_path / f"b{i:02d}.json").write_text(body, encoding="utf-8")
    same(spark, str(tmp_path))


def test_many_tasks_read_one_file(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        (tmp_path / "one.json").write_text(json.dumps([f"comment, {i} \"{'y' * (i % 50)}\"" for i in range(20_000)]))
        records = src.json_blocks.records(spark, str(tmp_path), "*.json", 0)
        assert records.rdd.getNumPartitions() > 8
        assert records.select("block").distinct().count() > 8
        rows = src.read_comments(spark, str(tmp_path), split_above=1000)
        assert rows.count() == 20_000 and rows.selectExpr("max(pos)").first()[0] == 19_999
        assert rows.filter("pos = 12345").first().text == f"comment, 12345 \"{'y' * (12345 % 50)}\""
        assert rows.filter("id <> cast(pos as string)").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sizes_choose_the_way(spark, tmp_path, tiny_blocks):
    (tmp_path / "small.json").write_text('["a"]')
    (tmp_path / "large.json").write_text(json.dumps(["b" * 30] * 20))
    rows = src.read_comments(spark, str(tmp_path), split_above=100)
    assert {(r.file, r["n"]) for r in rows.groupBy("file").count().withColumnRenamed("count", "n").collect()} == {("small.json", 1), ("large.json", 20)}


def test_block_states_without_broadcast(spark, tmp_path, tiny_blocks, monkeypatch):
    monkeypatch.setattr(src.json_blocks, "BROADCAST_BLOCKS", 1)
    (tmp_path / "large.json").write_text(json.dumps(random_items(random.Random(1), 80)))
    same(spark, str(tmp_path))
