from __future__ import annotations

import hashlib
import random

import numpy as np

from corpuslab.llm import repeats

LAST = 1 << 63


def brute(rows):
    """The rule, window by window."""
    texts = [(i, (text or "").encode()) for i, text in rows]
    first = {}
    for i, body in texts:
        for j in range(len(body) - 49):
            first[body[j:j + 50]] = min(first.get(body[j:j + 50], LAST), LAST if i is None else i)
    out = []
    for i, body in texts:
        gone = np.zeros(len(body) + 2, bool)
        for j in range(len(body) - 49):
            if first[body[j:j + 50]] < (LAST if i is None else i):
                gone[j + 1:j + 51] = True
        kept = bytes(b for b, g in zip(body, gone[1:]) if not g)
        out.append((i, len(body), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted([tuple(r[c] for c in columns) for r in repeats.repeat_digests(df).collect()], key=str)


def planted(seed):
    """Texts of few letters with shared passages of 40 to 200 bytes, copies, near copies and runs of one letter."""
    rng = random.Random(seed)
    letters = ["ab", "abcdefgh ", "aéß中 b"][seed % 3]
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [make(rng.randint(40, 200)) for _ in range(6)] + ["a" * 90, "x" * 49, "x" * 50]
    rows = []
    for i in range(60):
        text = "".join(rng.choice([make(rng.randint(0, 80)), rng.choice(shared)]) for _ in range(rng.randint(0, 8)))
        rows.append((rng.randint(0, 45), text))  # ids repeat
    rows += [(i + 100, rows[i][1]) for i in range(10)] + [(i + 200, rows[i][1][:-1] + "!") for i in range(10)]
    return rows + [(None, rows[3][1]), (None, shared[0]), (None, shared[0]), (7, None), (8, "")]


def test_suffix_order():
    rng = np.random.default_rng(0)
    for _ in range(100):
        data = rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 300)).astype(np.uint8)
        order, body = repeats.suffix_order(data), data.tobytes()
        assert sorted(order) == list(range(len(body)))
        heads = [body[i:i + 50] for i in order]
        assert heads == sorted(heads)
        if len(order) > 1:
            shared = repeats.common_prefixes(data, order)
            for k, (a, b) in enumerate(zip(order[:-1], order[1:])):
                n = 0
                while n < 50 and max(a, b) + n < len(body) and body[a + n] == body[b + n]:
                    n += 1
                assert min(shared[k + 1], 50) >= n


def test_equal_windows_have_equal_keys():
    rng = np.random.default_rng(1)
    passage = rng.integers(97, 100, 70).astype(np.uint8)
    texts = [np.concatenate([rng.integers(97, 100, 33 + k).astype(np.uint8), passage, rng.integers(97, 100, 60).astype(np.uint8)]) for k in range(3)]
    keys = [repeats.window_keys(t)[33 + k:33 + k + 21].tolist() for k, t in enumerate(texts)]
    assert keys[0] == keys[1] == keys[2]


def test_like_brute_force(spark):
    for seed in range(3):
        rows = planted(seed)
        assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_small_bounds(spark, monkeypatch):
    """Stretches, blocks, ranges and the limit of a key so small that every path is taken, and a bitmap without effect."""
    rows = planted(4)
    for name, value in (("HOT", 1), ("STRETCH", 64), ("RUNS", 40), ("BLOCK", 200), ("PACKED", 500), ("KEY_BITS", 7)):
        monkeypatch.setattr(repeats, name, value)
    data = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    pieces = spark.createDataFrame(
        [(1, b"a" * 60, 5, 1, 11), (1, b"b" * 60, 4, 2, 11), (1, b"a" * 55, 2, 3, 6), (2, b"a" * 50, 9, 4, 1), (2, b"a" * 50, 9, 5, 1)],
        "place long, piece binary, rank long, mark long, at long")
    found = repeats.sorted_blocks(pieces).collect()
    assert {r.piece is not None for r in found} == {True, False} and any(r.mask is None and r.piece is None for r in found)
    assert result(data) == brute(rows)


def test_packets():
    rng = np.random.default_rng(0)
    columns = [rng.integers(0, 1 << 48, 1000, dtype=np.uint64) for _ in range(2)]
    n, body = repeats.pack(columns)
    assert (repeats.unpack(n, body, 2) == np.stack(columns)).all()


def test_odd_rows(spark, odd, none):
    assert result(odd.filter("length(text) < 100000 OR text IS NULL")) == brute(
        [(r.doc_id, r.text) for r in odd.collect() if r.text is None or len(r.text) < 100_000])
    assert repeats.repeat_digests(odd).count() == odd.count()
    assert repeats.repeat_digests(none).count() == 0


def test_texts_that_are_left(spark):
    rows = planted(1)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeats.remove_repeats(frame).collect()
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got]
    assert sorted(found, key=str) == brute(rows)


def test_hot_key_sends_two_rows_a_task(spark):
    """A passage in every text: each of its keys is sent twice per task, whatever the number of texts."""
    rng = random.Random(0)
    own = lambda: "".join(rng.choice("abcdefghijklmnop ") for _ in range(40))
    passage = own() * 2
    frame = spark.createDataFrame([(i << 20, (own() + passage + own()).encode()) for i in range(400)], "mark long, data binary").repartition(2)
    packets = repeats.key_packets(frame, 3).collect()
    keys = np.concatenate([repeats.unpack(r.n, bytes(r.body), 2)[0] for r in packets])
    assert np.unique(keys, return_counts=True)[1].max() <= 4
    shared = {r.id for r in repeats.shared_keys(repeats.key_packets(frame, 3)).collect()}
    data = np.frombuffer(passage.encode(), np.uint8)
    assert set((repeats.mix(repeats.window_keys(data)[:31]) >> np.uint64(16)).tolist()) <= shared


def test_key_that_a_text_has_twice(spark):
    """The text with the larger mark has the shared passage two times: its key is still sent with both marks."""
    rng = random.Random(1)
    own = lambda: "".join(rng.choice("abcdefghijklmnop ") for _ in range(60))
    passage = own()
    bodies = [own() + passage + own(), own() + passage + own() + passage + own()]
    for marks in ((1 << 20, 2 << 20), (2 << 20, 1 << 20)):
        frame = spark.createDataFrame([(m, b.encode()) for m, b in zip(marks, bodies)], "mark long, data binary").coalesce(1)
        assert repeats.shared_keys(repeats.key_packets(frame, 2)).count() > 0
    rows = [(i, bodies[i % 2]) for i in range(2)] + [(2, own() + passage), (3, (passage + own()) * 3)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)) == brute(rows)
