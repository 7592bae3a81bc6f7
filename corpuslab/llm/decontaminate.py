"""Benchmark decontamination by greedy string tiling.

Seeds are runs of ``SEED_WORDS`` words. Running Karp-Rabin hashes give the seeds of benchmark items and documents; the
join on equal seeds finds candidate pairs. For each pair whose shared seeds could cover enough of the item, the longest
common word runs that do not overlap are marked one after the other (tiles of at least ``SEED_WORDS`` words, matched
word by word), wherever they stand, so reordered passages count as well. A pair is a leak when tiles cover at least
``COVERAGE`` of the item.

The benchmark is a stated query set: it is read in blocks of at most ``BLOCK_WORDS`` words, each block is broadcast
(its size is bounded by that) and meets all documents in one scan. Documents are never shuffled, and a document is
tiled in the task that holds it, whatever number of copies it has.

Edge cases: seed pairs are held in blocks and joined to runs, so a text of one repeated word needs a run per diagonal;
null or wordless documents and items match nothing; an item shorter than a seed must occur as a whole; a
null item_id or doc_id is kept; repeated rows repeat their pairs; equal items each get their pair; an empty benchmark
gives no pairs; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corpuslab.llm.common import WordHashes, map_batches, mix, text_bytes

SEED_WORDS = 5
COVERAGE = 0.5
BLOCK_WORDS = 1 << 20
WORD = re.compile(r"[^\W_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers never vanish
PIECE = 1 << 14
PAIRS = 1 << 20  # seed pairs that are held at once

Tile = tuple[int, int, int]  # first word in the document, first word in the item, words


def words_of(data: bytes, hashes: WordHashes) -> np.ndarray:
    """Hashes of the lower-cased words of letters and digits of a whole text."""
    return hashes.of(WORD.findall(data.decode("utf-8", "replace").lower()))


def karp_rabin(words: np.ndarray, k: int) -> np.ndarray:
    """Running hash of every run of ``k`` words: drop the word that leaves, append the one that enters."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * BASE + words[j:j + n]
    return mix(total)


def joined(runs: np.ndarray) -> np.ndarray:
    """Rows ``item, diagonal, first, end`` (places of seeds in the document) with those that touch on a diagonal made one."""
    if not len(runs):
        return runs
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1) | (runs[1:, 2] != runs[:-1, 3])
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(runs)])) - 1
    return np.concatenate([runs[first, :3], runs[last, 3:]], 1)


def tile(runs: list[Tile], doc_words: int, item_words: int, k: int) -> list[Tile]:
    """Greedy tiling: always the longest run whose words are all unmarked; ties by place."""
    heap = [(-n, i, j) for i, j, n in runs]
    heapq.heapify(heap)
    used_doc, used_item = set(), np.zeros(item_words, bool)
    tiles, left = [], item_words
    while heap and left:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = ~used_item[j:j + n]
        if used_doc:
            free &= np.fromiter((w not in used_doc for w in range(i, i + n)), bool, n)
        if free.all():
            tiles.append((i, j, n))
            used_item[j:j + n] = True
            used_doc.update(range(i, i + n))
            left -= n
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
        for s, e in zip(edges[::2], edges[1::2]):  # what is still free goes back
            if e - s >= k:
                heapq.heappush(heap, (-int(e - s), i + int(s), j + int(s)))
    return tiles


class Benchmark:
    """Seeds of a block of items, sorted by hash."""

    def __init__(self, rows: list[tuple[int | None, bytes]], k: int = SEED_WORDS):
        hashes, self.k = WordHashes(), k
        self.ids, self.words = [], []
        for item, data in rows:
            words = words_of(data, hashes)
            if len(words):
                self.ids.append(item)
                self.words.append(words)
        self.flat = np.concatenate(self.words) if self.words else np.empty(0, np.uint64)
        self.begin = np.concatenate(([0], np.cumsum([len(w) for w in self.words]))).astype(np.int64)
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in sorted({min(k, len(w)) for w in self.words}):
            mine = [n for n, w in enumerate(self.words) if min(k, len(w)) == length]
            found = [karp_rabin(self.words[n], length) for n in mine]
            value = np.concatenate(found)
            item = np.repeat(mine, [len(f) for f in found])
            place = np.concatenate([np.arange(len(f)) for f in found])
            order = np.argsort(value, kind="stable")
            self.seeds[length] = (value[order], item[order], place[order])

    def runs(self, words: np.ndarray, length: int) -> np.ndarray:
        """Maximal common runs of one document with all items, as rows of ``joined``.

        Seed pairs are made block by block (at most ``PAIRS``, or those of one word of the document), compared word by
        word, as a hash collision is no match, and joined to runs before the next block, so a text of one repeated word
        costs a run per diagonal and not a pair per place.
        """
        value, item, place = self.seeds[length]
        found, size = [np.empty((0, 4), np.int64)], 0
        for at in range(0, max(0, len(words) - length + 1), PIECE):
            own = karp_rabin(words[at:at + PIECE + length - 1], length)
            low = np.searchsorted(value, own, "left")
            many = np.searchsorted(value, own, "right") - low
            hit = np.flatnonzero(many)
            low, many = low[hit], many[hit]
            before = np.cumsum(many) - many
            start = 0
            while start < len(hit):
                end = max(start + 1, int(np.searchsorted(before + many, before[start] + PAIRS, "right")))
                n = many[start:end]
                rows = np.repeat(low[start:end] - (before[start:end] - before[start]), n) + np.arange(n.sum())
                i, j, which = np.repeat(hit[start:end] + at, n), place[rows], item[rows]
                start, same = end, np.ones(len(rows), bool)
                for step in range(length):
                    same &= words[i + step] == self.flat[self.begin[which] + j + step]
                i, j, which = i[same], j[same], which[same]
                part = joined(np.stack([which, i - j, i, i + 1], 1))
                found.append(part)
                size += len(part)
                if size > PAIRS // 4:
                    found = [joined(np.concatenate(found))]
                    size = 0
        return joined(np.concatenate(found))

    def leaks(self, words: np.ndarray, coverage: float) -> list[tuple[int | None, float, list[Tile]]]:
        """``(item_id, coverage, tiles)`` of every item that one document leaks."""
        out: list[tuple[int | None, float, list[Tile]]] = []
        for length in self.seeds:
            runs = self.runs(words, length)
            bounds = np.flatnonzero(np.diff(runs[:, 0], prepend=-1, append=len(self.words)))
            for low, high in zip(bounds[:-1], bounds[1:]):
                n, own = int(runs[low, 0]), runs[low:high]
                size = len(self.words[n])
                first = own[:, 2] - own[:, 1]
                end = own[:, 3] - own[:, 1] + length - 1
                reach = np.zeros(size + 1, np.int64)  # words of the item under any run: an upper bound
                np.add.at(reach, first, 1)
                np.add.at(reach, end, -1)
                if (np.cumsum(reach)[:-1] > 0).sum() < coverage * size:
                    continue
                tiles = tile(list(zip(own[:, 2].tolist(), first.tolist(), (end - first).tolist())), len(words), size, length)
                covered = sum(t[2] for t in tiles)
                if tiles and covered >= coverage * size:
                    out.append((self.ids[n], covered / size, sorted(tiles)))
        return out


def benchmark_blocks(
    benchmark: DataFrame, seed_words: int = SEED_WORDS, key: str = "item_id", text: str = "text"
) -> Iterator[Broadcast]:
    """The stated query set as broadcast blocks, none above about ``BLOCK_WORDS`` words (one item is never split)."""
    items = benchmark.select(F.col(key).cast("bigint").alias("i"), text_bytes(text).alias("b"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("b") / 2 + 1), F.lit(0))).first()[0]  # at least the words
    blocks = max(1, math.ceil(size / BLOCK_WORDS))
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("i", "b"), F.lit(blocks)) == block).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Benchmark([(r.i, bytes(r.b)) for r in part], seed_words))


LEAKS = "doc_id long, item_id long, coverage double, n_tiles int, longest int, tiles array<struct<start: int, end: int>>"
LEAK_TYPES = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(),
              pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """``doc_id, item_id, coverage, n_tiles, longest, tiles`` of every leaking pair.

    ``tiles`` holds ``start, end`` of the tiles as word numbers of the document.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), text_bytes(text).alias("data"))

    def worker(shared: Broadcast):
        def work():
            hashes = WordHashes()

            def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
                out = []
                for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for item, share, tiles in shared.value.leaks(words_of(data, hashes), coverage):
                        out.append((doc, item, share, len(tiles), max(n for _, _, n in tiles),
                                    [{"start": i, "end": i + n} for i, _, n in tiles]))
                if not out:
                    return None
                columns = [pa.array(c, t) for c, t in zip(zip(*out), LEAK_TYPES)]
                return pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "coverage", "n_tiles", "longest", "tiles"])

            return step

        return work

    found = [map_batches(rows, worker(shared), LEAKS) for shared in benchmark_blocks(benchmark, **options)]
    return reduce(DataFrame.unionByName, found)


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, text: str = "text", **options
) -> DataFrame:
    """Documents that leak no item, with all their columns; decided in place, without a join."""

    def checker(shared: Broadcast):
        @arrow_udf("boolean")
        def leaks(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            hashes = WordHashes()
            for column in columns:
                yield pa.array(
                    [bool(shared.value.leaks(words_of(d, hashes), coverage)) for d in column.to_pylist()], pa.bool_())

        return leaks

    for shared in benchmark_blocks(benchmark, **options):
        docs = docs.filter(~checker(shared)(text_bytes(text)))
    return docs
