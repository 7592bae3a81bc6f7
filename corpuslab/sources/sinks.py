"""Writers: comment arrays, vectors, results, reports and per-cluster lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslab.operators.ordering import BLOCK, global_index, id_block, running_offsets
from corpuslab.session import cut_lineage
from corpuslab.sources.comments import CHUNK_ROWS


def thread_positions(flat: DataFrame) -> DataFrame:
    """Adds ``pos``: 0-based place of a comment in its video, in (page, item, seq) order.

    Offsets come from one running sum over threads in parallel ranges; rows are ordered only inside
    a block of a thread, so one long thread or video does not end up in one task.
    """
    keys = ["video_id", "page", "item", "_block"]
    rows = flat.withColumn("_block", F.floor(F.col("seq") / F.lit(BLOCK)).cast("bigint"))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    offsets = cut_lineage(running_offsets(counts, keys, "_n", "_offset").drop("_n"))
    starts = offsets.groupBy("video_id").agg(F.min("_offset").alias("_start"))
    local = offsets.join(starts, "video_id")
    inside = Window.partitionBy(*keys).orderBy("seq")
    return (
        rows.join(local, keys)
        .withColumn("pos", (F.col("_offset") - F.col("_start") + F.row_number().over(inside) - 1).cast("bigint"))
        .drop("_block", "_offset", "_start")
    )


def comment_arrays(comments: DataFrame, key: str = "file", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``key, chunk, comments``: texts in position order, at most ``chunk_rows`` per array.

    A list below that size is one array; a longer one continues in further chunks, so an array never
    outgrows a task.
    """
    chunk = F.floor(F.col("pos") / F.lit(chunk_rows)).cast("bigint")
    listed = F.array_sort(F.collect_list(F.struct("pos", "text")))
    return comments.groupBy(key, chunk.alias("chunk")).agg(
        F.transform(listed, lambda e: e["text"]).alias("comments")
    )


def sample_arrays(sampled: DataFrame, file: str = "file", order: str = "pos", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``chunk, comments``: the texts of a sample over all files, in file order, as one list cut into chunks."""
    rows = global_index(sampled.select(file, order, "text"), file, id_block(order), [order], "_at")
    rows = rows.select(F.lit("sample").alias("file"), F.col("_at").alias("pos"), "text")
    return comment_arrays(rows, chunk_rows=chunk_rows).select("chunk", "comments")


def with_empty_videos(arrays: DataFrame, videos: DataFrame, key: str = "file") -> DataFrame:
    """Videos without comments (disabled ones) get one empty array instead of no output."""
    known = arrays.select(key).distinct()
    empty = videos.select(key).distinct().join(known, key, "left_anti")
    return arrays.unionByName(
        empty.select(key, F.lit(0).cast("bigint").alias("chunk"), F.array().cast("array<string>").alias("comments"))
    )


def write_comment_arrays(arrays: DataFrame, path: str, key: str = "file", mode: str = "errorifexists") -> None:
    """One JSON array per ``file=/chunk=`` folder; the comment reader takes the names from the folders."""
    out = arrays.select(F.col(key).alias("file"), "chunk", F.to_json("comments").alias("value"))
    out.write.mode(mode).partitionBy("file", "chunk").text(path)


def write_sample(sampled: DataFrame, path: str, file: str = "file", order: str = "pos", mode: str = "errorifexists") -> None:
    """Sampled comments as JSON arrays; a sample of up to ``CHUNK_ROWS`` comments is one array."""
    write_comment_arrays(sample_arrays(sampled, file, order).withColumn("file", F.lit("sample")), path, mode=mode)


def write_vectors(vectors: DataFrame, path: str, mode: str = "errorifexists") -> None:
    vectors.write.mode(mode).parquet(path)


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One-row nested reports; NULL fields are absent in the output."""
    report.write.mode(mode).option("ignoreNullFields", True).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header; quotes are doubled inside quoted text."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_extremes(picked: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Per-cluster lists as JSON rows under ``cluster=/kind=`` folders, rank order kept as a column."""
    picked.write.mode(mode).partitionBy("cluster", "kind").option("ignoreNullFields", True).json(path)
