"""Bringing comment text back to vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.operators.joins import latest_per_key
from corpuslab.operators.ordering import running_offsets


def text_by_id(comments: DataFrame) -> DataFrame:
    """One text per id; if files share an id, the last file (then position) wins."""
    return latest_per_key(comments, "id", ["file", "pos"], ["text"])


def enrich_by_id(vectors: DataFrame, comments: DataFrame) -> DataFrame:
    """Text by id over all files, empty where there is none."""
    return vectors.join(text_by_id(comments), "id", "left").withColumn("text", F.coalesce("text", F.lit("")))


def file_stem(name: Column) -> Column:
    """File name without extension and without the endings that vector archives add to their source's name."""
    return F.regexp_replace(name, r"(_embeddings|_deduplicated)*(\.[^.]*)?$", "")


def enrich_per_file(vectors: DataFrame, comments: DataFrame) -> DataFrame:
    """Text by id inside the vector's own file, else by position there, empty where there is neither.

    Files are matched by their stem. If a file repeats an id, its last position wins.
    """
    own = comments.filter(F.col("text").isNotNull()).select(file_stem(F.col("file")).alias("_stem"), "id", F.col("pos").alias("_at"), "text")
    rows = vectors.withColumn("_stem", file_stem(F.col("file")))
    # narrow rows decide which place is meant; only the texts of those places move
    wanted = rows.select("_stem", "id").distinct()
    last = own.select("_stem", "id", "_at").join(wanted, ["_stem", "id"], "left_semi").groupBy("_stem", "id").agg(F.max("_at").alias("_last"))
    placed = rows.join(last, ["_stem", "id"], "left").withColumn("_at", F.coalesce("_last", "pos"))
    texts = own.select("_stem", "_at", "text").join(placed.select("_stem", "_at").distinct(), ["_stem", "_at"], "left_semi")
    found = placed.join(texts.groupBy("_stem", "_at").agg(F.max("text").alias("_text")), ["_stem", "_at"], "left")
    return found.select(*[c for c in vectors.columns if c != "text"], F.coalesce("_text", F.lit("")).alias("text"))


def enrich_by_position(vectors: DataFrame, comments: DataFrame) -> DataFrame:
    """Text by (file, position), empty where there is none."""
    texts = comments.select("file", "pos", "text")
    return vectors.join(texts, ["file", "pos"], "left").withColumn("text", F.coalesce("text", F.lit("")))


def text_by_global_index(comments: DataFrame) -> DataFrame:
    """``original_pos, text`` with positions counted over all files in name order.

    Positions inside files are known, so a file's offset is all that is added; skipped items count.
    """
    sizes = comments.groupBy("file").agg((F.max("pos") + 1).alias("_n"))
    offsets = running_offsets(sizes, ["file"], "_n", "_offset").select("file", "_offset")
    rows = comments.select("file", "pos", "text").join(offsets, "file")
    return rows.select((F.col("_offset") + F.col("pos")).alias("original_pos"), "text")


def enrich_priority(vectors: DataFrame, comments: DataFrame, row_key: list[str], few: bool = False) -> DataFrame:
    """Text by original position first, by id where that finds nothing, else NULL.

    A row whose original position is unknown (NULL) is looked up by id only.

    With ``few`` (a short stored table, such as the picked rows of a report) texts are first reduced to
    wanted keys, which Catalyst broadcasts when the table's size allows, so most text is never shuffled.
    """
    by_index = text_by_global_index(comments)
    by_id = comments
    if few:
        by_index = by_index.join(vectors.select("original_pos").distinct(), "original_pos", "left_semi")
        by_id = comments.join(vectors.select("id").distinct(), "id", "left_semi")
    # unknown positions get spread keys that match nothing, so they do not meet in one task
    none = -1 - F.pmod(F.xxhash64(*row_key), F.lit(1 << 30))
    keyed = vectors.withColumn("_index", F.coalesce("original_pos", none))
    by_index = by_index.select(F.col("original_pos").alias("_index"), F.col("text").alias("_by_index"))
    first = keyed.join(by_index, "_index", "left").drop("_index")
    ids = text_by_id(by_id).withColumnRenamed("text", "_by_id")
    return first.join(ids, "id", "left").withColumn("text", F.coalesce("_by_index", "_by_id")).drop("_by_index", "_by_id")
