"""Exact deduplication against an immutable snapshot, screened by binary fuse filters.

A snapshot of documents gets one static binary fuse filter per digest bucket (8-bit fingerprints, three positions per
key, about 1.2 bytes a digest). The filters are built once and written with the snapshot. Digests of an incoming batch
are first grouped among themselves (copies inside the batch meet there), then each distinct digest is screened by the
filter of its bucket. A negative is certainly new. A positive joins the snapshot's exact digests, and what still
matches is compared byte by byte before it counts as a copy.

Only digests, lengths and ids are shuffled; a hot group of copies is reduced to one row per task before any shuffle.
Texts move only for classes that occur on both sides, one text per class and side.

Edge cases: null text counts as empty; documents without any visible character form one group; a repeated doc_id is
kept as repeated rows of one group; a null doc_id loses ties; empty tables give empty results; extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslab.llm.common import mix
from corpuslab.session import written_table

SPACES = " \t\n\x0b\x0c\r"  # fixed values: the characters that do not count
BUCKET_KEYS = 4_096
ROUNDS = 64


# -- binary fuse filter ------------------------------------------------------------------------------------------

def _shape(n: int) -> tuple[int, int, int]:
    """Segment length (a power of two), number of start segments and table length for ``n`` keys."""
    segment = 1 << max(2, math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25))
    segment = min(segment, 1 << 18)
    factor = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(max(n, 2)))
    starts = max(1, math.ceil(n * factor / segment) - 2)
    return segment, starts, (starts + 2) * segment


def _places(hashes: np.ndarray, segment: int, starts: int) -> np.ndarray:
    """Three table positions per key in three consecutive segments, ``(3, n)``."""
    first = ((hashes >> np.uint64(32)) * np.uint64(starts) >> np.uint64(32)).astype(np.int64)
    mask = np.uint64(segment - 1)
    inside = [(hashes >> np.uint64(s)) & mask for s in (0, 18)]
    inside.append((mix(hashes ^ np.uint64(0x5851F42D4C957F2D))) & mask)
    return np.stack([(first + j) * segment + inside[j].astype(np.int64) for j in range(3)])


def _prints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes + np.uint64(0x2545F4914F6CDD1D)) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """``(seed, segment, starts, table)`` of distinct 64-bit keys; peels all keys, a new seed if that fails."""
    keys = np.unique(keys.astype(np.uint64))
    segment, starts, length = _shape(len(keys))
    for seed in range(ROUNDS):
        hashes = mix(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
        places = _places(hashes, segment, starts)
        degree = np.bincount(places.ravel(), minlength=length)
        held = np.zeros(length, np.int64)  # xor of the key numbers that use a cell
        for row in places:
            np.bitwise_xor.at(held, row, np.arange(len(keys)))
        left, order = np.ones(len(keys), bool), []
        cells = np.flatnonzero(degree == 1)
        while len(cells):
            owners, at = np.unique(held[cells], return_index=True)
            alive = left[owners]
            owners, at = owners[alive], at[alive]
            if not len(owners):
                break
            order.append((owners, cells[at]))
            left[owners] = False
            for row in places[:, owners]:
                np.subtract.at(degree, row, 1)
                np.bitwise_xor.at(held, row, owners)
            touched = np.unique(places[:, owners])
            cells = touched[degree[touched] == 1]
        if left.any():
            continue
        table = np.zeros(length, np.uint8)
        prints = _prints(hashes)
        for owners, own in reversed(order):  # no key of a wave uses another key's own cell of that wave
            value = prints[owners].copy()
            for row in places[:, owners]:
                value ^= np.where(row == own, 0, table[row])
            table[own] = value
        return seed, segment, starts, table.tobytes()
    raise ValueError("no seed peels these keys")


def probe_filter(keys: np.ndarray, seed: int, segment: int, starts: int, table: bytes) -> np.ndarray:
    """True where a key may be in the filter: always for its own keys, for about one in 256 others."""
    hashes = mix(keys.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    cells = np.frombuffer(table, np.uint8)[_places(hashes, segment, starts)]
    return (cells[0] ^ cells[1] ^ cells[2]) == _prints(hashes)


# -- Spark side --------------------------------------------------------------------------------------------------

def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def digests(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, digest, n_chars``: the narrow row of every document."""
    body = normalised(F.col(text))
    return docs.select(
        F.col(key).alias("doc_id"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("bigint").alias("n_chars"),
    )


def classes(rows: DataFrame) -> DataFrame:
    """One row per digest: size and best member (most code points, then smallest id), pre-aggregated per task."""
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id"))
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), best.alias("best"))


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """Bucket and 64-bit filter key from different bytes of the digest."""
    number = lambda at: F.conv(F.hex(F.substring("digest", at, 8)), 16, -10).cast("bigint")
    return df.withColumn("bucket", F.pmod(number(1), F.lit(buckets))).withColumn("fuse_key", number(9))


def snapshot_filters(known: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of the snapshot's distinct digests (a bucket has about ``BUCKET_KEYS`` of them)."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        seed, segment, starts, cells = build_filter(part["fuse_key"].to_numpy().view(np.uint64))
        return pd.DataFrame({"bucket": [part["bucket"].iloc[0]], "seed": [seed], "segment": [segment],
                             "starts": [starts], "cells": [cells]})

    keys = _bucketed(known.select("digest"), buckets).select("bucket", "fuse_key")
    return keys.groupBy("bucket").applyInPandas(build, "bucket long, seed long, segment long, starts long, cells binary")


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Rows of distinct incoming digests whose filter says maybe."""
    keyed = _bucketed(incoming, buckets).select("bucket", "fuse_key", "digest")

    def probe(key, part: pd.DataFrame, filter_row: pd.DataFrame) -> pd.DataFrame:
        if len(part) == 0 or len(filter_row) == 0:
            return part[["digest"]].iloc[:0]
        f = filter_row.iloc[0]
        maybe = probe_filter(part["fuse_key"].to_numpy().view(np.uint64), int(f.seed), int(f.segment), int(f.starts), f.cells)
        return part.loc[maybe, ["digest"]]

    return keyed.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(probe, "digest binary")


def same_bytes(pairs: DataFrame, docs: DataFrame, text: str, key: str, by_digest: bool = False) -> DataFrame:
    """Of ``digest, old_id, new_id`` keeps pairs whose normalised texts are equal byte by byte.

    With ``by_digest`` texts are fetched by their SHA-256 and id, as an id may be null or repeat with another text; else
    by id alone. The join is
    always a sort-merge join: the number of copies grows with the table, so no plan may rest on its being small.
    """
    wanted = pairs.select(F.col("digest").alias("_digest"), F.explode(F.array("old_id", "new_id")).alias("_wanted")).distinct()
    texts = docs.select(F.col(key).alias("_id"), normalised(F.col(text)).alias("_text"))
    own = F.col("_id").eqNullSafe(F.col("_wanted"))
    if by_digest:
        own = own & (F.unhex(F.sha2(F.col("_text").cast("binary"), 256)) == F.col("_digest"))
    met = texts.join(wanted.hint("merge"), own).groupBy(F.col("_digest").alias("digest")).agg(
        F.min("_text").alias("_low"), F.max("_text").alias("_high"))
    return met.filter(F.col("_low") == F.col("_high")).select("digest")


def dedup_against_snapshot(
    snapshot: DataFrame, incoming: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` of every row of both tables.

    Rows are equal when their texts are identical without white space; of a group the row with the
    most code points, then the smallest id stays.
    """
    sides = digests(snapshot, text, key).withColumn("fresh", F.lit(False)).unionByName(
        digests(incoming, text, key).withColumn("fresh", F.lit(True)))
    rows = written_table(sides, "exact-rows")  # narrow, scanned several times
    old = written_table(classes(rows.filter("NOT fresh")), "exact-old")
    new = written_table(classes(rows.filter("fresh")), "exact-new")
    buckets = max(1, math.ceil(old.count() / BUCKET_KEYS))
    filters = written_table(snapshot_filters(old, buckets), "exact-filters")

    maybe = screen(new, filters, buckets)
    both = (
        maybe.join(new, "digest").select("digest", F.col("n").alias("new_n"), F.col("best").alias("new_best"))
        .join(old, "digest")
    )
    both = written_table(both, "exact-both")
    pairs = both.select("digest", F.col("best.doc_id").alias("old_id"), F.col("new_best.doc_id").alias("new_id"))
    all_docs = snapshot.select(key, text).unionByName(incoming.select(key, text))
    proven = same_bytes(pairs, all_docs, text, key, by_digest=True)
    # a digest found on both sides is one class; without byte equality the two sides stay apart
    merged = both.join(proven, "digest").select(
        "digest", (F.col("n") + F.col("new_n")).alias("_n"), F.least("best", "new_best").alias("_best"))
    sides = old.withColumn("fresh", F.lit(False)).unionByName(new.withColumn("fresh", F.lit(True)))
    final = sides.join(merged, "digest", "left").select(
        "digest", "fresh", F.coalesce("_n", "n").alias("group_size"), F.coalesce("_best", "best").alias("best"))
    marked = rows.join(final, ["digest", "fresh"])
    return marked.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("group_size").cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("best.doc_id")).alias("kept"), "digest",
    )


def exact_digests(docs: DataFrame) -> DataFrame:
    """The contract's rows. Even hashes of doc_id play the stored snapshot, odd ones the incoming batch."""
    side = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    found = dedup_against_snapshot(docs.filter(~side), docs.filter(side))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
