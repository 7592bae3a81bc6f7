from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpuslab.functions import rules
from corpuslab.functions import text as tx
from corpuslab.sources import comments as src
from corpuslab.sources import sinks


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "s STRING").select(column(F.col("s")).alias("r")).first().r


@pytest.mark.parametrize("raw, want", [
    ("\t see https://x.y/z \n\n now\r\nhere ", "see    now here"),
    ("http://only.link", ""),
    ("\t", ""),
    ("a\x00\x1f", "a"),
    ("a ", "a "),
])
def test_clean_comment(spark, raw, want):
    # the inner blanks around the link and the line break are kept one by one
    assert one(spark, tx.clean_comment, raw) == want


@pytest.mark.parametrize("raw, want", [("{ hi }", "hi"), ("{}", ""), ("{a} b", "{a} b"), (" x ", "x")])
def test_unwrap_braces(spark, raw, want):
    assert one(spark, tx.unwrap_braces, raw) == want


@pytest.mark.parametrize("raw", ["", "  　", "\x1c\x85", " hi ", "​x"])
def test_prepare_comment_strips_like_python(spark, raw):
    text = raw.strip()
    assert one(spark, tx.prepare_comment, raw) == ("query: " + text if text else "query: empty comment")


def test_sample_quota(spark):
    sizes = [1, 49, 50, 149, 150, 250, 350, 1000]
    df = spark.createDataFrame([(n,) for n in sizes], "n BIGINT").select("n", tx.sample_quota(F.col("n")).alias("q"))
    assert [r.q for r in df.orderBy("n").collect()] == [1, 1, 1, 1, 2, 3, 4, 10]


def test_file_names(spark):
    row = spark.range(1).select(
        tx.video_of_file(F.lit("abc_comments.json")).alias("a"), tx.video_of_file(F.lit("abc.json")).alias("b"),
        tx.embedding_base(F.lit("x_embeddings.npz")).alias("c"), tx.txt_to_json_name(F.lit("t.txt")).alias("d"),
        tx.dedup_file_name(F.lit("e.npz")).alias("e"), tx.squash_name(F.lit("A-b C!")).alias("f"),
        tx.search_key(F.lit("s"), F.lit("t")).alias("g"), tx.spaced_name(F.lit(" A-b C! ")).alias("h"),
    ).first()
    assert tuple(row) == ("abc", None, "x", "t.json", "e_deduplicated.npz", "abc", "s t", "ab c")


@pytest.mark.parametrize("n, adaptive, want", [
    (1, True, (2, 2)), (2, True, (2, 2)), (3, True, (2, 2)), (100, True, (2, 15)), (10_000, True, (2, 30)),
    (100, False, (2, 30)),
])
def test_scan_bounds(spark, n, adaptive, want):
    assert rules.scan_bounds(n, 2, 30, adaptive) == want
    low, high = rules.scan_bounds_columns(F.col("id"), 2, 30, adaptive)
    assert tuple(spark.range(n, n + 1).select(low, high).first()) == want


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def test_comment_files(spark, tmp_path):
    inbox = tmp_path / "in"
    write(inbox, "mixed.json", '["a", {"id":"z","comment":"c"}, {"comment":"d"}, 7, {"x":1}]')
    write(inbox, "null +id.json", '[{"id":null,"comment":"e"}, {"id": 7, "comment": "f"}]')
    write(inbox, "empty.json", "[]")
    write(inbox, "bad.json", "[oops")
    write(inbox, "obj.json", '{"k":"v"}')
    rows = sorted(tuple(r) for r in src.read_comments(spark, str(inbox)).collect())
    assert rows == [
        ("mixed.json", 0, "0", "a"), ("mixed.json", 1, "z", "c"), ("mixed.json", 2, "2", "d"),
        ("null +id.json", 0, "0", "e"), ("null +id.json", 1, "7", "f"),
    ]
    files = src.comment_files(spark, str(inbox))
    assert {tuple(r) for r in src.rejected_files(files).collect()} == {
        ("empty.json", "no valid comments"), ("bad.json", "malformed"), ("obj.json", "not an array"),
    }
    counts = {r.file: r.comments for r in src.count_comments(files).collect()}
    assert counts == {"mixed.json": 3, "null +id.json": 2}


def test_txt_files_keep_line_order_over_splits(spark, tmp_path):
    inbox = tmp_path / "in"
    lines = [f"{{ line {i} }}" if i % 2 else f"line {i}" for i in range(500)]
    write(inbox, "v.txt", "\n".join(["", *lines, "  ", "{}"]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = src.read_txt_comments(spark, str(inbox))
        got = [(r.file, r.pos, r.text) for r in df.orderBy("pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [("v.json", i, f"line {i}") for i in range(500)] + [("v.json", 500, "")]


def test_video_list(spark, tmp_path):
    write(tmp_path / "l", "ids", "a\n b\n\na\n")
    listed = src.read_video_list(spark, str(tmp_path / "l" / "ids"))
    assert sorted(r.video_id for r in listed.collect()) == ["", " b", "a", "a"]
    assert src.read_video_list(spark, str(tmp_path / "none")).count() == 0


def test_list_files(spark, tmp_path):
    write(tmp_path / "l", "a_comments.json", "[]")
    write(tmp_path / "l", "b.json", "[]")
    assert [r.file for r in src.list_files(spark, str(tmp_path / "l"), "*.json", "_comments.json").collect()] == ["a_comments.json"]


def test_pick_input_preference(spark):
    files = spark.createDataFrame([("d", "b.npz"), ("d", "a.npz"), ("d", "z_deduplicated.npz")], "dir STRING, file STRING")
    assert src.pick_input(files, ["dir"]).first().file == "z_deduplicated.npz"
    assert src.pick_input(files, ["dir"], "b.npz").first().file == "b.npz"
    assert src.pick_input(files, ["dir"], "none.npz").count() == 0


def test_flatten_nested_pages(spark):
    from corpuslab import schemas

    def thread(key, text, replies):
        return (((key, (text,)), replies),)

    pages = spark.createDataFrame(
        [("v", 0, [thread("t1", "first\nline", 2), thread("t2", "http://x.y", 0)]), ("v", 1, [thread("t3", " third ", 1)])],
        schemas.THREAD_PAGES,
    )
    replies = spark.createDataFrame(
        [("t1", 1, "r1"), ("t1", 2, " "), ("t2", 1, "not announced"), ("t3", 1, "r3")], schemas.REPLIES
    )
    flat = src.flatten_threads(pages, replies)
    arrays = sinks.comment_arrays(sinks.thread_positions(flat), "video_id")
    assert [r.comments for r in arrays.collect()] == [["first line", "r1", "third", "r3"]]


def test_arrays_are_chunked_and_read_back(spark, tmp_path):
    rows = spark.range(25).select(
        F.lit("a b/1+%").alias("file"), F.col("id").alias("pos"), F.concat(F.lit('q"é\n'), "id").alias("text")
    )
    assert {r.chunk: len(r.comments) for r in sinks.comment_arrays(rows, chunk_rows=10).collect()} == {0: 10, 1: 10, 2: 5}
    sinks.write_comment_arrays(sinks.comment_arrays(rows), str(tmp_path / "out"))
    back = src.read_comments(spark, str(tmp_path / "out"), "*.txt")
    assert sorted((r.file, r.pos, r.text) for r in back.collect()) == sorted((r.file, r.pos, r.text) for r in rows.collect())


def test_large_array_is_read_whole(spark, tmp_path):
    item = '"' + "comment text " * 80 + '"'
    (tmp_path / "large.json").write_text("[" + ",".join([item] * 140_000) + "]")  # 146 MB, above the limit of one parsed value
    files = src.comment_files(spark, str(tmp_path))
    assert src.parse_comment_files(files).count() == 140_000
    assert src.rejected_files(files).count() == 0
