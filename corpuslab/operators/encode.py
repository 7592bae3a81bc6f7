"""Turning prepared comments into unit-length vectors with a pluggable encoder."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpuslab.functions.vectors import from_matrix
from corpuslab.functions.text import prepare_comment

Encoder = Callable[[list[str]], np.ndarray]

# Batch limits and width of the encoder this toolkit is meant to host.
BATCH_ROWS = 256
MODEL_DIM = 384
TOKEN = r"[a-z0-9]+"


def embed(
    df: DataFrame, text: str, factory: Callable[[], Encoder], out: str = "embedding", batch_rows: int = BATCH_ROWS
) -> DataFrame:
    """Adds ``out``: the encoder's vector of the prepared text, scaled to length one.

    ``factory`` builds the encoder once per Python task; it receives at most ``batch_rows`` texts at
    a time. Rows stay where they are, so embedding never shuffles.
    """

    @arrow_udf("array<float>")
    def encode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = factory()
        for column in columns:
            texts = column.to_pylist()
            parts = [encoder(texts[at:at + batch_rows]) for at in range(0, len(texts), batch_rows)]
            if not parts:
                yield pa.array([], pa.list_(pa.float32()))
                continue
            matrix = np.concatenate(parts).astype(np.float64)
            size = np.sqrt((matrix * matrix).sum(1))
            yield from_matrix(matrix / np.where(size > 0, size, 1.0)[:, None])

    # never evaluated twice, whatever filters later steps add
    encode = encode.asNondeterministic()
    return df.withColumn(out, encode(prepare_comment(F.col(text))))


def hashed_token_encoder(dim: int = 64) -> Callable[[], Encoder]:
    """Deterministic stand-in for tests and offline runs; it is not the transformer.

    Counts of lower-case tokens by md5 bucket over the whole text.
    """

    def factory() -> Encoder:
        token = re.compile(TOKEN)
        buckets: dict[str, int] = {}

        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for row, text in enumerate(texts):
                for word, times in Counter(token.findall(text.lower())).items():
                    if word not in buckets:
                        if len(buckets) > 1_000_000:
                            buckets.clear()
                        buckets[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim
                    out[row, buckets[word]] += times
            return out

        return encode

    return factory


def token_bucket(word: Column, dim: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint"), F.lit(dim)).cast("int")


def hash_embed(df: DataFrame, key: str, text: str, dim: int = 64) -> DataFrame:
    """The same vectors in sparse form, all in SQL: ``key, bucket, weight``.

    Counting per (key, bucket) is pre-aggregated before the shuffle, so a long text sends at most
    ``dim`` rows.
    """
    words = F.regexp_extract_all(F.lower(prepare_comment(F.col(text))), F.lit(f"({TOKEN})"), 1)
    counts = (
        df.select(key, F.explode(words).alias("_word"))
        .groupBy(key, token_bucket(F.col("_word"), dim).alias("bucket"))
        .agg(F.count(F.lit(1)).cast("double").alias("_n"))
    )
    entries = F.collect_list(F.struct("bucket", "_n"))  # at most dim entries per key
    rows = counts.groupBy(key).agg(entries.alias("_e"), F.sqrt(F.sum(F.col("_n") * F.col("_n"))).alias("_len"))
    return rows.select(key, "_len", F.inline("_e")).select(key, "bucket", (F.col("_n") / F.col("_len")).alias("weight"))
