"""Readers: comment files, text files, id lists, thread pages and vector archives."""

from __future__ import annotations

import io
import re

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab import schemas
from corpuslab.functions import text as tx
from corpuslab.functions.vectors import from_matrix
from corpuslab.operators.ordering import position_in_group
from corpuslab.session import written_table
from corpuslab.sources import json_blocks

CHUNK_ROWS = 10_000
SPLIT_BYTES = 128 << 20

# Reasons of rejected files.
MALFORMED = "malformed"
NOT_AN_ARRAY = "not an array"
NO_COMMENTS = "no valid comments"


def file_key() -> Column:
    """Logical file name: the ``file=`` folder if the data was written by our sink, else the file's own name."""
    folder = _decoded(_decoded(F.regexp_extract(F.col("_metadata.file_path"), "/file=([^/]+)/", 1)))
    return F.when(folder != "", folder).otherwise(_decoded(F.col("_metadata.file_name")))


def relative_key(root: str) -> Column:
    """Like :func:`file_key`, but files keep their folders below ``root``, so equal names in two folders stay apart."""
    plain = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/") + "/"
    path = _decoded(F.col("_metadata.file_path"))
    below = F.when(F.instr(path, plain) > 0, F.substr(path, F.instr(path, plain) + F.lit(len(plain))))
    folder = _decoded(_decoded(F.regexp_extract(F.col("_metadata.file_path"), "/file=([^/]+)/", 1)))
    return F.when(folder != "", folder).otherwise(F.coalesce(below, _decoded(F.col("_metadata.file_name"))))


def json_items(content: Column) -> Column:
    """Items of a JSON array, NULL for anything else. The size limit of a parsed value holds per item, not per file."""
    return F.from_json(content, "array<variant>")


def _decoded(c: Column) -> Column:
    """Undo percent escapes; a plus sign in a name is a plus sign. Folder names carry two layers."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def _first_position() -> Column:
    chunk = F.regexp_extract(F.col("_metadata.file_path"), "/chunk=([0-9]+)/", 1)
    return F.coalesce(F.nullif(chunk, F.lit("")).cast("bigint"), F.lit(0)) * F.lit(CHUNK_ROWS)


def comment_files(spark: SparkSession, path: str | list[str], glob: str = "*.json", up_to: int | None = None) -> DataFrame:
    """Whole files as ``file, first_pos, content``, those of at most ``up_to`` bytes.

    The file is the unit of parallelism here; :func:`read_large_comments` splits larger arrays.
    """
    files = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    if up_to is not None:
        files = files.filter(F.col("_metadata.file_size") <= up_to)
    return files.select(file_key().alias("file"), _first_position().alias("first_pos"), F.col("value").alias("content"))


def parse_comment_files(files: DataFrame) -> DataFrame:
    """``file, pos, id, text`` for every string item or object with a ``comment``; other items are skipped.

    The id is the item's own, else its raw position (skipped items count).
    """
    return _comment_rows(files.select("file", "first_pos", F.posexplode(json_items(F.col("content"))).alias("i", "_item")))


def _comment_rows(items: DataFrame) -> DataFrame:
    """``file, pos, id, text`` from array items (``file, first_pos, i, _item``)."""
    return items.select("file", *item_columns()).filter(F.col("text").isNotNull())


def item_columns() -> list[Column]:
    """``pos, id, text`` of an array item (``first_pos, i, _item``); no text for items that are no comment."""
    is_text = F.schema_of_variant("_item") == "STRING"
    comment = F.try_variant_get("_item", "$.comment", "string")
    pos = (F.col("first_pos") + F.col("i")).cast("bigint")
    given = F.try_variant_get("_item", "$.id", "string")
    return [
        pos.alias("pos"),
        F.when(is_text, pos.cast("string")).otherwise(F.coalesce(given, pos.cast("string"))).alias("id"),
        F.when(is_text, F.try_variant_get("_item", "$", "string")).otherwise(comment).alias("text"),
    ]


def _usable(item: Column) -> Column:
    is_text = F.schema_of_variant(item) == "STRING"
    return is_text | F.try_variant_get(item, "$.comment", "string").isNotNull()


def count_comments(files: DataFrame) -> DataFrame:
    """``file, first_pos, comments`` of files with at least one usable comment, without exploding."""
    items = json_items(F.col("content"))
    number = F.size(F.filter(items, _usable)).cast("bigint")
    return files.select("file", "first_pos", number.alias("comments")).filter("comments > 0")


def rejected_files(files: DataFrame) -> DataFrame:
    """Files without any usable comment, with the reason; narrow, evaluated per file."""
    usable = F.exists("_items", _usable)
    other = F.try_parse_json("content").isNotNull()
    return (
        files.select("file", json_items(F.col("content")).alias("_items"), other.alias("_other"))
        .withColumn(
            "reason",
            F.when(F.col("_items").isNull() & ~F.col("_other"), F.lit(MALFORMED))
            .when(F.col("_items").isNull(), F.lit(NOT_AN_ARRAY))
            .when(~F.coalesce(usable, F.lit(False)), F.lit(NO_COMMENTS)),
        )
        .filter(F.col("reason").isNotNull())
        .select("file", "reason")
    )


def read_comments(
    spark: SparkSession, path: str | list[str], glob: str = "*.json", split_above: int = SPLIT_BYTES
) -> DataFrame:
    """Comments of all files: whole files up to ``split_above`` bytes, larger ones block by block."""
    if file_names(spark, path, glob).filter(F.col("bytes") > split_above).isEmpty():
        return parse_comment_files(comment_files(spark, path, glob))
    small = parse_comment_files(comment_files(spark, path, glob, split_above))
    return small.unionByName(read_large_comments(spark, path, glob, split_above)[0])


def file_names(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    """``file_id, file, first_pos, bytes`` of every file; contents are not read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return listing.select(
        F.xxhash64("_metadata.file_path").alias("file_id"), file_key().alias("file"), _first_position().alias("first_pos"),
        F.col("_metadata.file_size").alias("bytes"))


def read_large_comments(
    spark: SparkSession, path: str | list[str], glob: str = "*.json", larger_than: int = 0
) -> tuple[DataFrame, DataFrame]:
    """``file, pos, id, text`` and ``file, reason`` of files above ``larger_than`` bytes, each read by many tasks.

    A file that is no array counts as another kind of value when it starts like an object or is a single scalar.
    """
    names = file_names(spark, path, glob).filter(F.col("bytes") > larger_than)
    parsed = written_table(json_blocks.parsed_items(json_blocks.array_items(spark, path, glob, larger_than)), "json-parsed")
    checked = json_blocks.whole_files(parsed)
    good = names.join(checked.filter("whole"), "file_id").select("file_id", "file", "first_pos")
    items = parsed.filter(F.col("value").isNotNull()).join(good, "file_id")
    rows = _comment_rows(items.select("file", "first_pos", F.col("item").alias("i"), F.col("value").alias("_item")))
    usable = parsed.groupBy("file_id").agg(F.max(_usable(F.col("value"))).alias("_usable"))
    first = json_blocks.records(spark, path, glob, larger_than).filter("block = 0").groupBy("file_id").agg(
        F.min_by(F.col("value").cast("string"), "line").alias("_first"))
    other = F.col("_first").rlike(r"\A[ \t\r\n]*\{") | F.try_parse_json("_first").isNotNull()
    starts = first.filter(~F.col("_first").rlike(r"\A[ \t\r\n]*\[") & other).select("file_id", F.lit(True).alias("_object"))
    judged = names.join(checked, "file_id", "left").join(usable, "file_id", "left").join(starts, "file_id", "left")
    whole = F.coalesce("whole", F.lit(False))
    reason = (
        F.when(~whole & F.coalesce("_object", F.lit(False)), F.lit(NOT_AN_ARRAY)).when(~whole, F.lit(MALFORMED))
        .when(~F.coalesce("_usable", F.lit(False)), F.lit(NO_COMMENTS)))
    return rows, judged.select("file", reason.alias("reason")).filter(F.col("reason").isNotNull())


def list_files(spark: SparkSession, path: str, glob: str = "*", suffix: str = "") -> DataFrame:
    """Names in a folder as ``file``; only paths and sizes are read, not contents."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    names = listing.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))
    return names.filter(F.endswith("file", F.lit(suffix)))


def read_lines(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """``file, block, line, text``: lines of splittable text files with an order that survives splitting.

    ``block`` is where the split starts in the file and ``line`` grows within it.
    """
    raw = spark.read.option("pathGlobFilter", glob).text(path)
    return raw.select(
        file_key().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("text"),
    )


def read_txt_comments(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """``file, pos, text``: non-blank lines, outer braces removed, file renamed to its JSON name."""
    lines = read_lines(spark, path, glob).filter(F.length(tx.strip_controls(F.col("text"))) > 0)
    placed = position_in_group(lines, ["file"], F.col("block"), ["line"])
    return placed.select(
        tx.txt_to_json_name(F.col("file")).alias("file"), "pos", tx.unwrap_braces(F.col("text")).alias("text")
    )


def line_comments(df: DataFrame, key: str, text: str) -> DataFrame:
    """The same rule for text that is already a column: ``key, pos, text`` per kept line."""
    lines = F.split(F.col(text), r"\r\n|\n|\r")
    kept = F.filter(lines, lambda s: F.length(tx.strip_controls(s)) > 0)
    return df.select(key, F.posexplode(kept).alias("pos", "_line")).select(
        key, F.col("pos").cast("bigint").alias("pos"), tx.unwrap_braces(F.col("_line")).alias("text")
    )


def read_video_list(spark: SparkSession, path: str, drop_blank: bool = False) -> DataFrame:
    """One id per line, untouched; a missing file gives an empty list."""
    try:
        ids = spark.read.text(path).select(F.col("value").alias("video_id"))
    except AnalysisException:
        return spark.createDataFrame([], "video_id STRING")
    return ids.filter(F.length("video_id") > 0) if drop_blank else ids


def flatten_threads(pages: DataFrame, replies: DataFrame) -> DataFrame:
    """Cleaned comments of paged threads: ``video_id, page, item, seq, text``.

    ``seq`` 0 is the top-level comment and 1..n are its replies, which are taken only where the
    thread announces some. Comments that are empty after cleaning are dropped.
    """
    threads = pages.select("video_id", "page", F.posexplode("items").alias("item", "_t")).select(
        "video_id",
        "page",
        "item",
        F.col("_t.snippet.topLevelComment.id").alias("parent_id"),
        F.col("_t.snippet.topLevelComment.snippet.textDisplay").alias("_raw"),
        F.coalesce(F.col("_t.snippet.totalReplyCount"), F.lit(0)).alias("_replies"),
    )
    return join_replies(threads, replies)


def join_replies(threads: DataFrame, replies: DataFrame) -> DataFrame:
    """Union of top-level comments and the replies of threads that announce replies."""
    tops = threads.select(
        "video_id", "page", "item", F.lit(0).cast("bigint").alias("seq"), tx.clean_comment(F.col("_raw")).alias("text")
    )
    open_threads = threads.filter("_replies > 0").select("video_id", "page", "item", "parent_id")
    cleaned = replies.select("parent_id", "seq", tx.clean_comment(F.col("text")).alias("text"))
    below = cleaned.join(open_threads, "parent_id").drop("parent_id")
    return tops.unionByName(below).filter(F.length("text") > 0)


def video_stats(videos: DataFrame, count: str = "comment_count") -> DataFrame:
    """A missing count means comments are disabled and counts as zero."""
    return videos.select(
        *[c for c in videos.columns if c != count],
        F.coalesce(F.col(count), F.lit(0)).cast("bigint").alias(count),
        F.col(count).isNull().alias("disabled"),
    )


def import_npz(archives: DataFrame, rows_per_batch: int = 8192) -> DataFrame:
    """Decode vector archives (``path, content`` as given by the binaryFile source) to vector rows.

    An archive lacking ``embeddings`` or ``ids`` fails the job, as it cannot be read; without
    ``original_indices`` the original position is unknown (NULL).
    """
    schema = pa.schema([
        ("file", pa.string()), ("pos", pa.int64()), ("id", pa.string()),
        ("embedding", pa.list_(pa.float32())), ("original_pos", pa.int64()),
    ])

    def decode(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                with np.load(io.BytesIO(content), allow_pickle=False) as data:
                    vectors, ids = data["embeddings"], data["ids"]
                    origin = data["original_indices"] if "original_indices" in data else None
                name = path.rsplit("/", 1)[-1]
                for at in range(0, len(vectors), rows_per_batch):
                    part = vectors[at:at + rows_per_batch]
                    pos = np.arange(at, at + len(part))
                    yield pa.record_batch([
                        pa.array([name] * len(part), pa.string()),
                        pa.array(pos, pa.int64()),
                        pa.array(ids[at:at + len(part)].astype(str).tolist(), pa.string()),
                        from_matrix(np.asarray(part, dtype=np.float32)),
                        pa.array([None] * len(part) if origin is None else origin[at:at + len(part)], pa.int64()),
                    ], schema=schema)

    return archives.select("path", "content").mapInArrow(decode, schemas.VECTORS)


def read_npz(spark: SparkSession, path: str) -> DataFrame:
    return import_npz(spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path))


def pick_input(files: DataFrame, group: list[str], preferred: str | None = None) -> DataFrame:
    """One archive per group: the preferred name, else the first deduplicated one, else the first.

    A preferred name that is not there yields no row, as the caller asked for that file.
    """
    name = F.col("file")
    usable = files.filter(name == preferred) if preferred else files.filter(F.endswith(name, F.lit(".npz")))
    rank = F.when(F.endswith(name, F.lit("_deduplicated.npz")), F.lit(0)).otherwise(F.lit(1))
    return usable.groupBy(*group).agg(F.min(F.struct(rank.alias("rank"), name.alias("file"))).alias("_best")).select(
        *group, F.col("_best.file").alias("file")
    )


def pick_combined(files: DataFrame, group: list[str]) -> DataFrame:
    """One combined comment list per group, by name pattern, else the only JSON file."""
    name = F.col("file")
    rank = (
        F.when(name.rlike(r"\Aall.*_comments.*\.json\z"), 0)
        .when(name.rlike(r"\Acombined.*_comments.*\.json\z"), 1)
        .when(name.rlike(r"\A.*all.*comments.*\.json\z"), 2)
    )
    json_files = files.filter(F.endswith(name, F.lit(".json")))
    return (
        json_files.groupBy(*group)
        .agg(
            F.min(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), name.alias("file")))).alias("_best"),
            F.min(name).alias("_only"),
            F.count(F.lit(1)).alias("_n"),
        )
        .select(*group, F.coalesce(F.col("_best.file"), F.when(F.col("_n") == 1, F.col("_only"))).alias("file"))
        .filter(F.col("file").isNotNull())
    )
