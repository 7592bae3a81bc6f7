"""Large JSON arrays read by many tasks, by a structural scan of byte blocks.

A JSON array has no safe place to cut at: a comma or bracket may lie inside a string, and whether it does depends on all
quotes before it. So a file is read twice as comma-separated records, which Spark splits at any byte:

1. Every block (a split of the file) is summarised for both cases, starting outside or inside a string: parity of its
   quotes, change and least value of the bracket depth, and how many commas lie at which depth. Prefix sums over the
   blocks of a file (one narrow row each) turn that into the state in which every block starts.
2. With that state each block finds its item ends by itself. Items inside a block are complete; the one that crosses into
   the next block is put together from its parts.

What follows the closing bracket is ignored, and a file with one unreadable item yields nothing, like in the parser of
whole files. Items must quote strings with double quotes. No block is held: tasks work through it batch by batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslab.operators.joins import small_table
from corpuslab.session import written_table

BROADCAST_BLOCKS = 100_000  # rows of the block table that are still broadcast
DEEPEST = 2_000  # depths beyond it are counted together; the parser refuses more than half of it
SPACE = b" \t\r\n"

_STEP = np.zeros(256, np.int32)
_STEP[list(b"[{")] = 1
_STEP[list(b"]}")] = -1


def structure(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per byte: parity of the quotes up to it, and its bracket step. Escaped quotes do not count."""
    quotes = np.flatnonzero(data == 34)
    plain = np.flatnonzero(data != 92)
    at = np.searchsorted(plain, quotes) - 1
    before = np.where(at >= 0, plain[at], -1)
    turn = np.zeros(len(data), np.int8)
    turn[quotes[(quotes - 1 - before) % 2 == 0]] = 1
    return (np.cumsum(turn, dtype=np.int32) & 1).astype(bool), _STEP[data]


def records(spark: SparkSession, path: str | list[str], glob: str, larger_than: int) -> DataFrame:
    """``file_id, block, line, value``: the bytes between commas, in order of ``line`` inside a block."""
    raw = spark.read.option("lineSep", ",").option("pathGlobFilter", glob).text(path)
    return raw.filter(F.col("_metadata.file_size") > larger_than).select(
        F.xxhash64("_metadata.file_path").alias("file_id"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), F.col("value").cast("binary").alias("value"))


def _by_block(batches: Iterator[pa.RecordBatch], keys: int):
    """``(key columns of a block, bytes, lengths, last)`` of consecutive records of one block; each record gets its comma."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ids = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        edges = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(0)) + 1
        for begin, end in zip([0, *edges], [*edges, batch.num_rows]):
            part = batch.slice(begin, end - begin)
            values = part.column(keys).to_pylist()
            yield tuple(part.column(i)[0].as_py() for i in range(keys)), values


class _Summary:
    """Running summary of a block for both starting states."""

    def __init__(self, key: tuple[int, int]):
        self.key, self.parity = key, False
        self.depth, self.least = [0, 0], [None, None]
        self.opened = key[1] > 0  # in the first block the depth counts from the opening bracket on
        self.first: int | None = None
        self.commas: list[dict[int, int]] = [{}, {}]

    def add(self, values: list[bytes]) -> None:
        body = b",".join(values) + b","
        data = np.frombuffer(body, np.uint8)
        if self.first is None:
            start = body.lstrip(SPACE)
            self.first = start[0] if start else None
        ends = np.cumsum([len(v) + 1 for v in values]) - 1
        parity, step = structure(data)
        parity ^= self.parity
        for state in (0, 1):
            depth = self.depth[state] + np.cumsum(np.where(parity == bool(state), step, 0), dtype=np.int32)
            seen = depth
            if state == 0 and not self.opened:
                brackets = np.flatnonzero((step != 0) & ~parity)
                seen = depth[brackets[0]:] if len(brackets) else depth[:0]
                self.opened = len(brackets) > 0
            if len(seen):
                low = int(seen.min())
                self.least[state] = low if self.least[state] is None else min(low, self.least[state])
            levels, counts = np.unique(np.clip(depth[ends[parity[ends] == bool(state)]], -DEEPEST, DEEPEST), return_counts=True)
            for level, n in zip(levels.tolist(), counts.tolist()):
                self.commas[state][level] = self.commas[state].get(level, 0) + n
            self.depth[state] = int(depth[-1])
        self.parity = bool(parity[-1])

    def row(self) -> tuple:
        return (*self.key, self.first, self.parity, *self.depth, *self.least, *(list(c.items()) for c in self.commas))


def block_summaries(rows: DataFrame) -> DataFrame:
    """One row per block, for both states it may start in."""
    schema = ("file_id long, block long, first int, parity boolean, depth0 int, depth1 int, least0 int, least1 int, "
              "commas0 map<int,long>, commas1 map<int,long>")
    commas = pa.map_(pa.int32(), pa.int64())
    types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), *[pa.int32()] * 4, commas, commas]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        held, done = None, []
        for key, values in _by_block(batches, 2):
            if held is None or held.key != key:
                if held is not None:
                    done.append(held.row())
                held = _Summary(key)
            held.add(values)
        if held is not None:
            done.append(held.row())
        if done:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    return rows.select("file_id", "block", "value").mapInArrow(run, schema)


def block_states(summaries: DataFrame) -> DataFrame:
    """``file_id, block, inside, depth, items, closed``: the state in which every block starts, by prefix sums."""
    earlier = Window.partitionBy("file_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def before(c: Column) -> Column:
        return F.coalesce(F.sum(c).over(earlier), F.lit(0))

    rows = summaries.withColumn("inside", before(F.col("parity").cast("int")) % 2 == 1)
    pick = lambda name: F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    rows = rows.withColumn("depth", before(pick("depth")).cast("int"))
    ended = F.coalesce(F.col("depth") + pick("least") <= 0, F.lit(False))
    own = F.coalesce(F.element_at(pick("commas"), F.lit(1) - F.col("depth")), F.lit(0))
    return rows.select(
        "file_id", "block", "inside", "depth", before(own).cast("long").alias("items"),
        (before(ended.cast("int")) > 0).alias("closed"))


def _items_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file_id", pa.int64()), ("item", pa.int64()), ("part", pa.int64()), ("text", pa.binary()),
                        ("closing", pa.bool_()), ("bad", pa.bool_())])
    key, pending, partial = None, [], False
    out: list[tuple] = []

    def leave():
        if pending and not closed:
            out.append((key[0], item, key[1], b",".join(pending), False, False))

    for (file_id, block, inside0, depth0, items0, closed0), values in _by_block(batches, 6):
        if key != (file_id, block):
            if key is not None:
                leave()
            key, pending, partial = (file_id, block), [], block > 0
            inside, depth, item, closed, opened = inside0, depth0, items0, closed0, block > 0
        if closed:
            continue
        if not opened:
            values = list(values)
            values[0] = values[0].lstrip(SPACE)
            if not values[0].startswith(b"["):
                out.append((file_id, item, block, b"", False, True))
                closed = True
                continue
            values[0], depth, opened = values[0][1:], 1, True
        body = b",".join(values) + b","
        data = np.frombuffer(body, np.uint8)
        parity, step = structure(data)
        parity ^= inside
        level = depth + np.cumsum(np.where(parity, 0, step), dtype=np.int32)
        ends = np.cumsum([len(v) + 1 for v in values]) - 1
        zero = np.flatnonzero((level <= 0) & ~parity & (step < 0))
        stop = int(zero[0]) if len(zero) else len(data)
        cuts = ends[(level[ends] == 1) & ~parity[ends] & (ends < stop)]
        start = 0
        for cut in cuts.tolist():
            text = b",".join([*pending, body[start:cut]])
            out.append((file_id, item, block if partial else -1, text, False, False))
            pending, partial, start, item = [], False, cut + 1, item + 1
        if len(zero):
            text = b",".join([*pending, body[start:stop]])
            out.append((file_id, item, block if partial else -1, text, True, data[stop] != 93))
            closed = True
        elif start < len(body):
            pending.append(body[start:-1])
        inside, depth = bool(parity[-1]), int(level[-1])
        if len(out) >= 4096:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
    if key is not None:
        leave()
    if out:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def array_items(spark: SparkSession, path: str | list[str], glob: str = "*.json", larger_than: int = 0) -> DataFrame:
    """``file_id, item, text, closing, bad``: the raw items of the arrays in files above ``larger_than`` bytes.

    ``closing`` marks the item before the closing bracket, ``bad`` a file that does not start or end like an array.
    """
    rows = records(spark, path, glob, larger_than)
    states = written_table(block_states(block_summaries(rows)), "json-blocks")
    local = small_table(states, BROADCAST_BLOCKS)
    columns = ["file_id", "block", "inside", "depth", "items", "closed", "value"]
    if local is None:
        met = rows.join(states.hint("merge"), ["file_id", "block"]).repartition("file_id", "block")
        placed = met.sortWithinPartitions("file_id", "block", "line").select(*columns)
    else:
        placed = rows.join(local, ["file_id", "block"]).select(*columns)  # a broadcast join keeps the order of the scan
    found = placed.mapInArrow(_items_of_blocks, "file_id long, item long, part long, text binary, closing boolean, bad boolean")
    found = written_table(found, "json-items")
    whole = found.filter("part < 0").drop("part")
    crossing = found.filter("part >= 0").groupBy("file_id", "item").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda p: p["text"].cast("string")), ",")
        .cast("binary").alias("text"),
        F.max("closing").alias("closing"), F.max("bad").alias("bad"))
    return whole.unionByName(crossing.select(*whole.columns))


def parsed_items(items: DataFrame) -> DataFrame:
    """``file_id, item, value, closing, fine``: items as variants. An array without items has one that is blank."""
    values = F.from_json(F.concat(F.lit("["), F.col("text").cast("string"), F.lit("]")), "array<variant>")
    parsed = items.select("file_id", "item", "closing", "bad", values.alias("_v"))
    empty = (F.size("_v") == 0) & F.col("closing") & (F.col("item") == 0)
    fine = ~F.col("bad") & F.coalesce((F.size("_v") == 1) | empty, F.lit(False))
    return parsed.select("file_id", "item", F.get("_v", F.lit(0)).alias("value"), "closing", fine.alias("fine"))


def whole_files(parsed: DataFrame) -> DataFrame:
    """``file_id, whole``: whether every item of a file can be read and its array is closed."""
    return parsed.groupBy("file_id").agg((F.min("fine") & F.max("closing")).alias("whole"))
