"""Small helpers shared by the operators: table access, words, hashes, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.session import written_table

WORD_CACHE = 1 << 17  # words; bounds the memory of a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (splitmix): spreads every input bit over the word."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """64-bit hash by word, filled on demand and emptied when it gets large."""

    def __missing__(self, word: bytes | str) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes] | list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_words(data: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case (what ``bytes`` methods do by definition)."""
    return data.lower().split()


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """One 64-bit hash per run of ``k`` words; a shorter text is one run, an empty one has none."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < k:
        k = n
    total = np.full(n - k + 1, np.uint64(k), np.uint64)
    for j in range(k):  # a chain, so the order of words counts
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + words[j:n - k + 1 + j])
    return total


def map_batches(
    df: DataFrame, work: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str, rows: int | None = None
) -> DataFrame:
    """``mapInArrow`` with a per-task object: ``work()`` builds it once, it then turns batch into batch.

    With ``rows`` a batch is worked through in slices of that many rows, so that what is made of them is not held at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = work()
        for batch in batches:
            for at in range(0, batch.num_rows, rows or batch.num_rows or 1):
                if (out := step(batch.slice(at, rows))) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def offsets_before(counts: DataFrame, order: list[str], n: str, out: str) -> DataFrame:
    """Exclusive running total over one row per block. ``counts`` holds block totals, never data rows."""
    from pyspark.sql import Window

    before = Window.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(n).over(before), F.lit(0)).cast("bigint"))


def row_marked(docs: DataFrame, key: str = "doc_id", mark: str = "_mark") -> tuple[DataFrame, bool]:
    """Adds a long that names every row: ``key`` itself where no value is null or repeats, else a number given to the
    rows of a written copy (written once, so that it stays the same whenever it is read). Also says whether it is ``key``."""
    spread = docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(key).isNull())
    if spread.isEmpty():
        return docs.withColumn(mark, F.col(key).cast("bigint")), True
    return written_table(docs.withColumn(mark, F.monotonically_increasing_id()), "marked"), False
