"""Repeated byte strings across documents, by two-stage suffix sorting.

A byte goes when a string of ``SPAN`` (50) bytes that covers it also starts in a document with a smaller doc_id.

1. **Bringing equal strings together.** Every 50-byte window is keyed by the least hash of its 20-byte grams, a function
   of the window alone, so equal windows have equal keys. Neighbouring windows mostly share a key: a *run* of about 16
   windows. First only (key, text) pairs are shuffled, packed by key range, to see which keys occur in two texts; a key
   that two texts of one task share sends two rows whatever the number of its texts. The keys found set a bitmap of
   fixed size (32 MB), and a second look at the texts takes the bytes of the runs it lets through. A key that passes by
   chance costs a shuffled piece, never a result.
2. **Suffix sorting.** The pieces meet by key, each distinct one about once per task with its smallest doc_id, and are
   joined to blocks of a megabyte. In a block the suffixes that are smaller than their successors are sorted
   directly, eight bytes a round and up to 56; all others are induced by scanning the buckets of first bytes in order.
   Adjacent common prefixes of 50 bytes or more make the classes of equal windows, and a window goes where its class has
   a smaller doc_id.
3. **Cutting.** The windows go back to their texts, which are shuffled for that once.

Equal texts count as one text: a copy with a larger doc_id is removed whole. A key with more than ``HOT`` distinct pieces
is not sorted in one block: its windows are grouped by their bytes instead, which pre-aggregates and spreads, with the
same result.

Edge cases: null text counts as empty; a text below 50 bytes stays; a null doc_id counts as larger than all others, and
rows without one lose nothing to each other; a repeated doc_id is neither smaller nor larger than itself; texts of any
length are worked through in stretches; an empty table gives an empty result; extra columns are ignored, whatever their
names. Equal texts are recognised by SHA-256, equal pieces by a 128-bit hash; windows are compared by their bytes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslab.llm.common import mix, text_bytes
from corpuslab.llm.phrases import bitmap, held
from corpuslab.session import written_table

SPAN = 50
GRAM = 20
EIGHT = 8  # bytes read at once
MOST_WINDOWS = 62  # of a piece; one bit each in a signed long
DEPTH = 56  # bytes that the direct sort looks at, a multiple of eight and at least SPAN
STRETCH = 1 << 18  # bytes worked on at once
RUNS = 1 << 18  # runs held before they are sent
PACKED = 1 << 24  # bytes of text whose keys meet in one packet range
KEY_BITS = 28  # of the bitmap of shared keys
BLOCK = 1 << 20  # bytes of pieces sorted together
HOT = 1 << 15  # distinct pieces of one key that are still sorted in a block
ROWS = 256  # rows turned into Python objects at once
MIXER = np.uint64(0x9E3779B97F4A7C15)
LAST_ID = (1 << 63) - 1
SEPARATOR = 0xFF  # never a byte of UTF-8


# -- runs of windows ---------------------------------------------------------------------------------------------

def unaligned(data: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The eight bytes from every position on as one number; zeros behind the end."""
    padded = np.concatenate([data, np.zeros(EIGHT + DEPTH, np.uint8)])
    return np.ndarray((len(data) + DEPTH,), kind, padded, strides=(1,))


def window_keys(data: np.ndarray) -> np.ndarray:
    """Least gram hash of the ``SPAN`` bytes from every position on (meaningful where that many are left)."""
    eights, n = unaligned(data), len(data)
    least = mix(eights[:n])
    for offset in (EIGHT, GRAM - EIGHT):
        least = mix(least * MIXER + eights[offset:offset + n])
    have, want = 1, SPAN - GRAM + 1
    while have < want:
        step = min(have, want - have)
        if step >= len(least):
            break
        least[:-step] = np.minimum(least[:-step], least[step:])
        have += step
    return least


def window_runs(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``key, part, start, windows`` of all runs in ``data``, the parts of ``lengths`` bytes (50 at least) in a row."""
    keys = mix(window_keys(data)) >> np.uint64(16)  # least hashes lie close to zero
    ends = np.cumsum(lengths)
    part = np.repeat(np.arange(len(lengths)), lengths - SPAN + 1)
    at = np.arange(len(part)) + part * (SPAN - 1)  # every earlier part has SPAN - 1 positions without a window
    key = keys[at]
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))
    size = np.diff(np.append(new, len(key)))
    cuts = -(-size // MOST_WINDOWS)
    inner = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    first = np.repeat(new, cuts) + inner * MOST_WINDOWS
    windows = np.minimum(np.repeat(size, cuts) - inner * MOST_WINDOWS, MOST_WINDOWS)
    begin = ends - lengths
    return key[first], part[first], at[first] - begin[part[first]], windows


def stretches(batch: pa.RecordBatch, mark: int, text: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``data, lengths, marks, offsets`` of about ``STRETCH`` bytes; long texts are cut with an overlap of 49 bytes."""
    parts, size = [], 0

    def packed():
        data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
        return data, np.array([len(p[2]) for p in parts]), np.array([p[0] for p in parts], np.int64), np.array([p[1] for p in parts])

    for at in range(0, batch.num_rows, ROWS):
        rows = batch.slice(at, ROWS)
        for m, body in zip(rows.column(mark).to_pylist(), rows.column(text).to_pylist()):
            for begin in range(0, max(0, len(body) - SPAN + 1), STRETCH):
                piece = body[begin:begin + STRETCH + SPAN - 1]
                parts.append((m, begin, piece))
                size += len(piece)
                if size >= STRETCH:
                    yield packed()
                    parts, size = [], 0
    if parts:
        yield packed()


def pack(columns: list[np.ndarray]) -> tuple[int, bytes]:
    """Number and compressed byte planes of equally long columns of 64-bit numbers."""
    raw = b"".join(c.view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return len(columns[0]), pa.compress(raw, codec="zstd", asbytes=True)


def unpack(n: int, body: bytes, columns: int) -> np.ndarray:
    raw = pa.decompress(body, n * 8 * columns, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(columns, 8, n)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint64)[:, :, 0]


def key_packets(texts: DataFrame, ranges: int) -> DataFrame:
    """``part, n, body``: distinct (key, text) pairs of ``mark, data``, packed by range of the key.

    48 bits of both are enough: a key that is shared by chance costs work only, and two texts of one key escape only if
    their marks agree as well. Of a key that several texts of the task share, the first and the last one go.
    """

    def send(found: list[tuple]) -> pa.RecordBatch:
        key, mark = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((mark, key))
        key, mark = key[order], mark[order]
        pair = np.concatenate([[True], (key[1:] != key[:-1]) | (mark[1:] != mark[:-1])])
        key, mark = key[pair], mark[pair]  # a text may have a key in many runs: the last text must be kept with one of them
        new = np.concatenate([[True], key[1:] != key[:-1]])
        ends = np.concatenate([new[1:], [True]])
        key, mark = key[new | ends], mark[new | ends]
        part = (key * np.uint64(ranges) >> np.uint64(48)).astype(np.int64) if ranges < 1 << 16 else (key % np.uint64(ranges)).astype(np.int64)
        order = np.lexsort((key, mark, part))  # rows of one text together compress
        key, mark, part = key[order], mark[order], part[order]
        edges = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(part))
        packed = [pack([key[x:y], mark[x:y]]) for x, y in zip(edges[:-1], edges[1:])]
        return pa.record_batch(
            [pa.array(part[edges[:-1]]), pa.array([p[0] for p in packed], pa.int32()), pa.array([p[1] for p in packed], pa.binary())],
            names=["part", "n", "body"])

    def run(batches):
        found, n = [], 0
        for batch in batches:
            for data, lengths, marks, _ in stretches(batch, 0, 1):
                key, part, _, _ = window_runs(data, lengths)
                found.append((key, marks[part].view(np.uint64) >> np.uint64(16)))
                n += len(key)
                if n >= RUNS:
                    yield send(found)
                    found, n = [], 0
        if found:
            yield send(found)

    return texts.select("mark", "data").mapInArrow(run, "part long, n int, body binary")


def shared_keys(packets: DataFrame, ranges: int | None = None) -> DataFrame:
    """``id``: keys of two or more texts. A range has the keys of about ``PACKED`` bytes of text.

    With the number of ``ranges`` there are as many partitions, which adaptive execution does not join to larger ones: what
    a task receives comes as one Arrow batch.
    """

    def judge(pairs: list[np.ndarray]) -> pa.RecordBatch:
        key, mark = np.concatenate(pairs, axis=1)
        order = np.argsort(key, kind="stable")
        key, mark = key[order], mark[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        shared = key[new][np.minimum.reduceat(mark, new) != np.maximum.reduceat(mark, new)]
        return pa.record_batch([pa.array(shared.view(np.int64))], names=["id"])

    def run(batches):
        part, pairs = None, []
        for batch in batches:
            for own, n, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if own != part and pairs:
                    yield judge(pairs)
                    pairs = []
                part = own
                pairs.append(unpack(n, body.as_buffer(), 2))
        if pairs:
            yield judge(pairs)

    dealt = packets.repartition(ranges, "part") if ranges else packets.repartition("part")
    return dealt.sortWithinPartitions("part").mapInArrow(run, "id long")


# -- suffix sorting ----------------------------------------------------------------------------------------------

def _direct_sort(data: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """``positions`` in the order of their first ``DEPTH`` bytes; each round looks only at those still tied."""
    eights = unaligned(data, ">u8")
    first = eights[positions].astype(np.uint64)
    order = np.argsort(first, kind="stable")
    out, first = positions[order], first[order]
    group = np.cumsum(np.concatenate([[True], first[1:] != first[:-1]])) if len(out) else np.empty(0, np.int64)
    tied = np.arange(len(out))
    for depth in range(EIGHT, DEPTH, EIGHT):
        twin = group[1:] == group[:-1]
        keep = np.concatenate([twin, [False]]) | np.concatenate([[False], twin]) if len(group) else np.empty(0, bool)
        tied, group = tied[keep], group[keep]
        if not len(tied):
            break
        following = eights[out[tied] + depth].astype(np.uint64)
        order = np.lexsort((following, group))
        following, group, out[tied] = following[order], group[order], out[tied[order]]
        group = np.cumsum(np.concatenate([[True], (group[1:] != group[:-1]) | (following[1:] != following[:-1])]))
    return out


def suffix_order(data: np.ndarray) -> np.ndarray:
    """All suffixes of ``data`` in order of at least their first ``SPAN`` bytes, by two-stage sorting."""
    n = len(data)
    change = np.flatnonzero(data[1:] != data[:-1])  # the type of an equal run is that of its last byte
    rising = np.zeros(n, bool)
    if len(change):
        next_change = np.searchsorted(change, np.arange(n - 1))
        has = next_change < len(change)
        where = change[next_change[has]]
        rising[:-1][has] = data[where] < data[where + 1]
    small = _direct_sort(data, np.flatnonzero(rising))
    small_ends = np.cumsum(np.bincount(data[small], minlength=256))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[data[-1]].append(np.array([n - 1]))  # the last suffix is larger than the empty one behind it
    out = []
    for byte in range(256):
        found = induced[byte]
        for entries in found:  # grows while it is read: predecessors with the same byte follow in the same bucket
            before = entries[entries > 0] - 1
            same = before[(data[before] == byte) & ~rising[before]]
            if len(same):
                found.append(same)
        bucket = np.concatenate([*found, small[small_ends[byte - 1] if byte else 0:small_ends[byte]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[data[before] > byte]  # a larger byte in front makes a suffix larger than its successor
        heads = data[before]
        before = before[np.argsort(heads, kind="stable")]
        counts = np.bincount(heads, minlength=256)
        ends = np.cumsum(counts)
        for head in np.flatnonzero(counts):
            induced[head].append(before[ends[head] - counts[head]:ends[head]])
    return np.concatenate(out)


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one before it, at most ``DEPTH``; the first shares none."""
    eights = unaligned(data)
    out = np.zeros(len(order), np.int64)
    todo = np.arange(1, len(order))
    for depth in range(0, DEPTH, EIGHT):
        differ = eights[order[todo] + depth] ^ eights[order[todo - 1] + depth]
        lowest = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, EIGHT, np.log2(np.maximum(lowest, 1).astype(np.float64)).astype(np.int64) // 8)
        out[todo] += equal
        todo = todo[differ == 0]
    return out


def removed_windows(pieces: list[bytes], first: np.ndarray) -> np.ndarray:
    """Per piece the bits of its windows that also occur in a piece with a smaller ``first``."""
    lengths = np.array([len(p) for p in pieces]) + 1
    data = np.frombuffer(b"".join(p + bytes([SEPARATOR]) for p in pieces), np.uint8)
    begin = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(pieces)), lengths)
    left = np.repeat(begin + lengths, lengths) - np.arange(len(data)) - 1  # bytes up to the separator
    order = suffix_order(data)
    order = order[left[order] >= SPAN]
    new = common_prefixes(data, order) < SPAN
    own = first[owner[order]]
    least = np.minimum.reduceat(own, np.flatnonzero(new))[np.cumsum(new) - 1]
    gone = order[least < own]
    masks = np.zeros(len(pieces), np.int64)
    np.add.at(masks, owner[gone], np.int64(1) << (gone - begin[owner[gone]]))
    return masks


# -- pieces ------------------------------------------------------------------------------------------------------

def shared_pieces(texts: DataFrame, known: Broadcast) -> DataFrame:
    """``place, piece, rank, mark, at`` of the runs whose key is in the bitmap ``known``.

    Of equal pieces in a task only those of the smallest rank go on; the others are settled, which a null ``piece`` says,
    and are placed by themselves. ``at`` is the start times 64 plus the number of windows.
    """
    names = ["place", "piece", "rank", "mark", "at"]

    def send(first: dict[bytes, list], settled: list[tuple]) -> pa.RecordBatch:
        rows = [(row[3], piece, *row[:3]) for piece, same in first.items() for row in same]
        if settled:
            away = mix(np.array([(m ^ at) & LAST_ID for _, m, at, _ in settled], np.uint64)) >> np.uint64(16)
            rows += [(int(p), None, r, m, at) for p, (r, m, at, _) in zip(away, settled)]
        types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches):
        first: dict[bytes, list] = {}
        settled: list[tuple] = []
        for batch in batches:
            own_marks, own_ranks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            numbered = pa.record_batch([pa.array(range(batch.num_rows)), batch.column(2)], names=["row", "data"])
            for data, lengths, row_of, offsets in stretches(numbered, 0, 1):
                key, part, start, windows = window_runs(data, lengths)
                hit = np.flatnonzero(held(known.value, key, KEY_BITS))
                begin = (np.cumsum(lengths) - lengths)[part[hit]] + start[hit]
                body = data.tobytes()
                ats = (offsets[part[hit]] + start[hit]) * 64 + windows[hit]
                source = row_of[part[hit]]
                places = zip(own_ranks[source].tolist(), own_marks[source].tolist(), ats.tolist(), key[hit].tolist())
                for row, b, w in zip(places, begin.tolist(), windows[hit].tolist()):
                    piece = body[b:b + w + SPAN - 1]
                    same = first.get(piece)
                    if same is None or row[0] < same[0][0]:
                        settled += same or []
                        first[piece] = [row]
                    elif row[0] == same[0][0]:
                        same.append(row)
                    else:
                        settled.append(row)
                if len(first) + len(settled) >= RUNS // 8:
                    yield send(first, settled)
                    first, settled = {}, []
        if first or settled:
            yield send(first, settled)

    return texts.select("mark", "rank", "data").mapInArrow(run, "place long, piece binary, rank long, mark long, at long")


def sorted_blocks(pieces: DataFrame) -> DataFrame:
    """``rank, mark, at, mask, piece_id, piece``: the windows of every run that a smaller document has.

    Rows come in order of key and piece. Complete keys are gathered to blocks and sorted. Runs that share piece and rank
    with an earlier one have no ``mask`` but the ``piece_id`` whose mask is theirs; so have the pieces of a key with more
    than ``HOT`` of them, which come with their bytes, to be settled by :func:`grouped_windows`.
    """
    names = ["rank", "mark", "at", "mask", "piece_id", "piece"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def every(at: int) -> int:
        return (1 << (at & 63)) - 1

    def solve(block: list[tuple]) -> list[tuple]:
        masks = removed_windows([p for p, *_ in block], np.array([r for _, r, _, _ in block], np.int64))
        return [(r, m, at, mask, xxhash.xxh3_128_digest(p), None) for (p, r, m, at), mask in zip(block, masks.tolist())]

    def run(batches):
        out, block, size, group = [], [], 0, []
        place, last, least, hot = None, None, None, False
        for batch in batches:
            for k, piece, rank, mark, at in zip(*(c.to_pylist() for c in batch.columns)):
                if k != place:
                    if len(group) > 1 or hot:
                        if hot:
                            out += [(r, m, a, None, xxhash.xxh3_128_digest(p), p) for p, r, m, a in group]
                        else:
                            block += group
                            size += sum(len(row[0]) for row in group)
                    group, place, last, hot = [], k, None, False
                    if size >= BLOCK:
                        out += solve(block)
                        block, size = [], 0
                if piece is None:
                    out.append((rank, mark, at, every(at), None, None))
                elif piece == last:
                    if rank > least:
                        out.append((rank, mark, at, every(at), None, None))
                    else:
                        out.append((rank, mark, at, None, xxhash.xxh3_128_digest(piece), None))
                else:
                    last, least = piece, rank
                    group.append((piece, rank, mark, at))
                    if len(group) > HOT:
                        hot = True
                        out += [(r, m, a, None, xxhash.xxh3_128_digest(p), p) for p, r, m, a in group]
                        group = []
            if len(out) >= 4096:
                yield batch_of(out)
                out = []
        if hot:
            out += [(r, m, a, None, xxhash.xxh3_128_digest(p), p) for p, r, m, a in group]
        elif len(group) > 1:
            block += group
        if block:
            out += solve(block)
        if out:
            yield batch_of(out)

    ordered = pieces.repartition("place").sortWithinPartitions("place", "piece", "rank", "mark", "at")
    return ordered.mapInArrow(run, "rank long, mark long, at long, mask long, piece_id binary, piece binary")


def grouped_windows(pieces: DataFrame) -> DataFrame:
    """``piece_id, mask`` of the pieces of very frequent keys (``rank, piece_id, piece``), by grouping windows by content."""
    windows = pieces.select("piece_id", "rank", "piece", F.explode(F.sequence(F.lit(0), F.length("piece") - SPAN)).alias("i"))
    windows = windows.select("piece_id", "rank", "i", F.substr("piece", F.col("i") + 1, F.lit(SPAN)).alias("window"))
    least = windows.groupBy("window").agg(F.min("rank").alias("least"))
    bit = F.when(F.col("least") < F.col("rank"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("i"))).otherwise(F.lit(0))
    return windows.join(least.hint("merge"), "window").groupBy("piece_id").agg(F.bit_or(bit.cast("long")).alias("mask"))


def removed_runs(pieces: DataFrame) -> DataFrame:
    """``rank, mark, at, mask`` of all runs that lose windows."""
    found = written_table(sorted_blocks(pieces), "repeats-masks")
    narrow = ["rank", "mark", "at", "mask"]
    masks = found.filter("mask IS NOT NULL AND piece_id IS NOT NULL").select("piece_id", "mask").unionByName(
        grouped_windows(found.filter("piece IS NOT NULL")))
    late = found.filter("mask IS NULL").select("rank", "mark", "at", "piece_id").join(masks.hint("merge"), "piece_id")
    return found.filter("mask <> 0").select(*narrow).unionByName(late.filter("mask <> 0").select(*narrow)).distinct()


# -- cutting -----------------------------------------------------------------------------------------------------

def cut_text(data: bytes, ats: list[int], masks: list[int]) -> tuple[int, int, bytes]:
    """Removed bytes, maximal removed runs and what is left of a text."""
    at, mask = np.array(ats, np.int64), np.array(masks, np.int64)
    run, bit = np.nonzero((mask[:, None] >> np.arange(MOST_WINDOWS)) & 1)
    starts = (at[run] >> 6) + bit
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + SPAN, -1)
    covered = np.cumsum(edge)[:-1] > 0
    spans = np.count_nonzero(covered[1:] & ~covered[:-1]) + int(covered[:1].sum())
    return int(covered.sum()), int(spans), np.frombuffer(data, np.uint8)[~covered].tobytes()


def cut_texts(texts: DataFrame) -> DataFrame:
    """``sha, rank, n_removed, n_spans, kept`` of texts with removed windows (``ats``, ``masks``)."""

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                shas, bodies, ats, masks = (part.column(i).to_pylist() for i in (0, 2, 3, 4))
                found = [cut_text(*row) for row in zip(bodies, ats, masks)]
                yield pa.record_batch(
                    [pa.array(shas, pa.binary()), part.column(1), pa.array([f[0] for f in found], pa.int64()),
                     pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.binary())],
                    names=["sha", "rank", "n_removed", "n_spans", "kept"])

    return texts.select("sha", "rank", "data", "ats", "masks").mapInArrow(
        run, "sha binary, rank long, n_removed long, n_spans long, kept binary")


def repeated_rows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``doc_id, rank, sha, n_bytes, first`` of every document, and ``sha, rank, n_removed, n_spans, kept`` of the texts
    that lose a part."""
    data = text_bytes(text)
    sha = F.unhex(F.sha2("data", 256))
    rank = F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID))
    whole = docs.select(F.col(key).alias("doc_id"), rank.alias("rank"), data.alias("data"))
    rows = written_table(whole.select("doc_id", "rank", sha.alias("sha"), F.length("data").cast("long").alias("n_bytes")), "repeats-rows")
    firsts = rows.groupBy("sha").agg(F.min("rank").alias("first"))
    texts = whole.filter(F.length("data") >= SPAN).select("rank", "data", F.xxhash64("data").alias("mark"))

    context = docs.sparkSession.sparkContext
    size = rows.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = max(1, math.ceil(size / PACKED))
    keys = shared_keys(key_packets(texts, ranges), ranges)
    known = context.broadcast(bitmap(keys, "id", KEY_BITS))
    gone = written_table(removed_runs(shared_pieces(texts, known)), "repeats-gone")
    known.destroy()
    gone = gone.groupBy("rank", "mark").agg(F.collect_list(F.struct("at", "mask")).alias("_g"))
    gone = gone.select("rank", "mark", F.col("_g.at").alias("ats"), F.col("_g.mask").alias("masks"))
    return rows.join(firsts.hint("merge"), "sha"), cut_texts(texts.join(gone.hint("merge"), ["rank", "mark"]).withColumn("sha", sha))


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes that are left) of every document."""
    rows, cut = repeated_rows(docs, text, key)
    bodies = docs.select(F.col(key).alias("_id"), text_bytes(text).alias("data")).withColumn("sha", F.unhex(F.sha2("data", 256)))
    bodies = bodies.withColumn("rank", F.coalesce(F.col("_id").cast("long"), F.lit(LAST_ID))).drop("_id").dropDuplicates(["sha", "rank"])
    cut = cut.dropDuplicates(["sha", "rank"])
    copy = (F.col("rank") > F.col("first")) & (F.col("n_bytes") >= SPAN)
    met = rows.join(bodies, ["sha", "rank"]).join(cut, ["sha", "rank"], "left")
    return met.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(b"")).otherwise(F.coalesce("kept", "data")).alias("kept"))


def repeat_digests(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    rows, cut = repeated_rows(docs, text, key)
    cut = cut.select("sha", "rank", "n_removed", "n_spans", F.sha2("kept", 256).alias("_kept")).dropDuplicates(["sha", "rank"])
    copy = (F.col("rank") > F.col("first")) & (F.col("n_bytes") >= SPAN)
    met = rows.join(cut.hint("merge"), ["sha", "rank"], "left")
    return met.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("_kept", F.lower(F.hex("sha")))).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, unnest(generate_series(0, n - 50)) AS i, h FROM d WHERE n >= 50),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS b FROM w),
g AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY b) AS f FROM s) WHERE f < doc_id),
e AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM g),
r AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM e),
p AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS z FROM r GROUP BY doc_id, span),
q AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS y FROM p),
k AS (SELECT doc_id, string_agg(substr(h, 2 * y + 1, 2 * (a - y)), '' ORDER BY a) AS kept, max(z) AS z,
             sum(z - a) AS gone, count(*) AS spans FROM q JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN k.doc_id IS NULL THEN h ELSE kept || substr(h, 2 * z + 1) END)) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""
