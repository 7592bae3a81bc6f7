from __future__ import annotations

import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpuslab.operators.cooldown import cooldown_anchors
from corpuslab.operators.encode import hashed_token_encoder
from corpuslab.streaming import ingest
from corpuslab.streaming.cooldown import Cooldown, cooldown_stream
from corpuslab.streaming.ledger import Ledger

ENCODER = hashed_token_encoder(8)


def test_files_are_processed_once_and_bad_ones_set_aside(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    job = ingest.WatchJob(str(inbox), str(tmp_path / "out"))
    (inbox / "a_comments.json").write_text('["x", {"id": "q", "comment": "y"}]')
    (inbox / "bad.json").write_text("[oops")
    (inbox / "note.txt").write_text("ignored")
    ingest.drain(spark, job, ENCODER)
    assert {(r.file, r.id) for r in ingest.vectors(spark, job).collect()} == {("a_comments.json", "0"), ("a_comments.json", "q")}
    assert [(r.file, r.reason) for r in ingest.dead_letters(spark, job).collect()] == [("bad.json", "malformed")]
    (inbox / "b_comments.json").write_text('["z"]')
    ingest.drain(spark, job, ENCODER)
    ingest.drain(spark, job, ENCODER)
    counts = {r.file: (r.comments, r.batch_id) for r in ingest.finished(spark, job).collect()}
    assert counts == {"a_comments.json": (2, 0), "b_comments.json": (1, 1)}
    assert ingest.vectors(spark, job).count() == 3


def test_equal_names_in_two_folders(spark, tmp_path):
    inbox = tmp_path / "in box+"
    for folder, text in (("a", '["x", "y"]'), ("b", '["z"]')):
        (inbox / folder).mkdir(parents=True)
        (inbox / folder / "x.json").write_text(text)
    (inbox / "x.json").write_text('["top"]')
    job = ingest.WatchJob(str(inbox), str(tmp_path / "out"))
    ingest.drain(spark, job, ENCODER)
    assert {r.file: r.comments for r in ingest.finished(spark, job).collect()} == {"a/x.json": 2, "b/x.json": 1, "x.json": 1}
    assert {(r.file, r.pos, r.original_pos) for r in ingest.vectors(spark, job).collect()} == {
        ("a/x.json", 0, None), ("a/x.json", 1, None), ("b/x.json", 0, None), ("x.json", 0, None)}
    (inbox / "c").mkdir()
    (inbox / "c" / "x.json").write_text('["late"]')
    ingest.drain(spark, job, ENCODER)
    assert ingest.vectors(spark, job).count() == 5 and ingest.dead_letters(spark, job).count() == 0


def test_replayed_batch_replaces_itself_and_skips_finished_files(spark, tmp_path):
    job = ingest.WatchJob(str(tmp_path / "in"), str(tmp_path / "out"))
    run = ingest.process_batch(job, ENCODER)
    batch = spark.createDataFrame([("f", 0, '["a", "b"]')], "file STRING, first_pos BIGINT, content STRING")
    run(batch, 0)
    run(batch, 0)
    assert ingest.vectors(spark, job).count() == 2
    run(batch, 1)
    assert ingest.vectors(spark, job).count() == 2 and ingest.finished(spark, job).count() == 1


def test_half_done_file_goes_on(spark, tmp_path):
    """A run that stops in the middle of a file leaves its marks; the next one encodes only the rest."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps([f"text {i}" for i in range(10)]))
    (tmp_path / "in" / "b.json").write_text('["short"]')
    seen = tmp_path / "seen"
    seen.mkdir()

    def encoder(stop):
        def factory():
            def encode(texts):
                if stop and any(t.endswith("text 7") for t in texts):
                    raise RuntimeError("stopped on purpose")
                for t in texts:
                    (seen / f"{stop}-{t.split(': ')[-1]}").touch()
                return np.ones((len(texts), 4), np.float32)
            return encode
        return factory

    job = ingest.WatchJob(str(tmp_path / "in"), str(tmp_path / "out"), step_rows=3)
    with pytest.raises(Exception, match="stopped on purpose"):
        ingest.drain(spark, job, encoder(True))
    assert ingest.finished(spark, job).count() == 0
    first = {p.name.split("-")[1] for p in seen.glob("True-*")}
    ingest.drain(spark, job, encoder(False))
    second = {p.name.split("-")[1] for p in seen.glob("False-*")}
    assert {f"text {i}" for i in range(6)} <= first and second == {f"text {i}" for i in range(6, 10)}
    assert {(r.file, r.comments) for r in ingest.finished(spark, job).collect()} == {("a.json", 10), ("b.json", 1)}
    got = sorted((r.file, r.pos, r.text) for r in ingest.vectors(spark, job).collect())
    assert got == [("a.json", i, f"text {i}") for i in range(10)] + [("b.json", 0, "short")]
    assert not list((tmp_path / "out" / "parsed").glob("batch_id=*"))


def entry(spark, name, n=1, whole=True):
    return spark.createDataFrame([(name, 0, n, whole)], "file STRING, first_pos BIGINT, comments BIGINT, whole BOOLEAN")


def test_ledger_stays_small(spark, tmp_path):
    book = Ledger(str(tmp_path / "m"), buckets=4, compact_after=5)
    most = 0
    for batch in range(24):
        book.append(entry(spark, f"f{batch}", 3, whole=False), batch, 0)
        book.append(entry(spark, f"f{batch}"), batch, -1)
        book.compact(spark, batch)
        most = max(most, len(list((tmp_path / "m").rglob("*.parquet"))))
    assert most <= 2 * 5 + 2 * 4 + 4
    assert {r.file for r in book.entries(spark).filter("whole").collect()} == {f"f{i}" for i in range(24)}
    found = book.lookup(spark.createDataFrame([("f3",), ("f23",), ("other",)], "file STRING"))
    assert {r.file for r in found.collect()} == {"f3", "f23"}
    wanted = spark.createDataFrame([("f3",)], "file STRING")
    plan = book.lookup(wanted)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan


def test_ledger_ignores_a_version_that_was_cut_off(spark, tmp_path):
    book = Ledger(str(tmp_path / "m"), buckets=2, compact_after=2)
    for batch in range(3):
        book.append(entry(spark, f"f{batch}"), batch, -1)
    entry(spark, "ghost").selectExpr("*", "0L AS step", "2L AS batch_id", "0 AS bucket").write.partitionBy("bucket").parquet(f"{book.path}/base/version=2")
    (tmp_path / "m" / "base" / "version=2" / "_SUCCESS").unlink()
    assert {r.file for r in book.entries(spark).collect()} == {"f0", "f1", "f2"}
    assert book.compact(spark, 2) and book.version(spark) == 2
    assert {r.file for r in book.entries(spark).collect()} == {"f0", "f1", "f2"}


def run_cooldown(spark, base, source, schema, lateness):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    cooldown_stream(stream, "k", "ts", lateness=lateness).writeStream.format("parquet").option("path", f"{base}/o").option(
        "checkpointLocation", f"{base}/c").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("k STRING, anchor_ts TIMESTAMP").parquet(f"{base}/o")


def error_rows(spark, rows):
    return spark.createDataFrame(rows, "k STRING, s BIGINT").select("k", F.timestamp_seconds("s").alias("ts")).coalesce(1)


def test_cooldown_state_survives_runs(spark, tmp_path):
    source, hours = str(tmp_path / "src"), [0, 10, 23, 25, 26, 49, 50]
    start = 1000 * 3600  # the watermark starts at the epoch
    rows = [("k", start + h * 3600) for h in hours]
    for part, want in ((rows[:3], [0]), (rows[3:] + [("tick", start + 400 * 3600)], [0, 25, 49]),
                       ([("k", start + 500 * 3600), ("tick", start + 900 * 3600)], [0, 25, 49, 400, 500])):
        frame = error_rows(spark, part)
        frame.write.mode("append").parquet(source)
        got = run_cooldown(spark, tmp_path, source, frame.schema, "1 hour")
        assert sorted(r.h for r in got.select(((F.unix_seconds("anchor_ts") - start) / 3600).alias("h")).collect()) == want


def test_cooldown_agrees_with_batch_in_any_order(spark, tmp_path):
    """Files shuffled within two days of lateness, over many micro-batches."""
    rng = random.Random(2)
    source, everything = str(tmp_path / "src"), []
    for day in range(10, 50, 2):
        part = [(f"k{rng.randint(0, 4)}", (day * 24 + rng.randint(0, 70)) * 3600 + rng.choice([0, 0, rng.randint(0, 3599)])) for _ in range(25)]
        everything += part
        error_rows(spark, part).write.mode("append").parquet(source)
    tick = error_rows(spark, [("tick", 1000 * 86400)])
    tick.write.mode("append").parquet(source)
    got = run_cooldown(spark, tmp_path, source, tick.schema, "2 days")
    want = cooldown_anchors(error_rows(spark, everything), "k", "ts")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


class Shelf:
    """Stand-in for the state of one key."""

    def __init__(self):
        self.values, self.maps, self.timers = {}, {}, []

    def getValueState(self, name, schema):
        return Cell(self.values, name)

    def getMapState(self, name, key, value):
        return Cell(self.maps, name)

    def registerTimer(self, at):
        self.timers.append(at)


class Cell:
    def __init__(self, store, name):
        self.store, self.name = store, name

    exists = lambda self: self.name in self.store
    get = lambda self: self.store[self.name]
    clear = lambda self: self.store.pop(self.name, None)
    getValue = lambda self, key: self.store[key]
    removeKey = lambda self, key: self.store.pop(key)

    def update(self, value):
        self.store[self.name] = value

    def updateValue(self, key, value):
        self.store[key] = value


class Clock:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = lambda: ms


def test_cooldown_of_a_long_key_stays_small(spark):
    """Chunks of a key with very many errors: what waits is bounded by the lateness, and the state ends."""
    shelf, hour = Shelf(), 3_600_000_000
    key = Cooldown(24 * hour, held=5000)
    key.init(shelf)
    opened, most = [], 0
    for day in range(12):
        times = np.random.default_rng(day).integers(day * 24 * hour, (day + 1) * 24 * hour, 40_000)
        chunks = (pd.DataFrame({"time_us": times[i:i + 1000]}) for i in range(0, len(times), 1000))
        for out in key.handleInputRows(("k",), chunks, Clock(day * 24 * 3_600_000)):
            opened += out["anchor_us"].tolist()
        most = max(most, sum(len(v[0]) for v in shelf.maps.values()))
    for out in key.handleExpiredTimer(("k",), Clock(1 << 40), None):
        opened += out["anchor_us"].tolist()
    everything = np.unique(np.concatenate([np.random.default_rng(d).integers(d * 24 * hour, (d + 1) * 24 * hour, 40_000) for d in range(12)]))
    want, at = [], 0
    while at < len(everything):
        want.append(int(everything[at]))
        at = int(np.searchsorted(everything, want[-1] + 24 * hour))
    assert opened == want
    assert most <= 90_000 and not shelf.maps and not shelf.values


def test_short_steps_are_committed_together(spark, tmp_path, monkeypatch):
    """A file in two chunks and steps of two rows: few writes, every step with its rows, positions of the whole file."""
    writes = []
    monkeypatch.setattr(ingest, "_commit", lambda *a, real=ingest._commit: (writes.append([g[0] for g in a[-1]]), real(*a)))
    monkeypatch.setattr(ingest, "COMMIT_ROWS", 9)
    monkeypatch.setattr(ingest, "PART_ROWS", 4)
    job = ingest.WatchJob(str(tmp_path / "in"), str(tmp_path / "out"), step_rows=2)
    batch = spark.createDataFrame(
        [("f", 0, json.dumps([f"t{i}" for i in range(10)])), ("f", 10, '["u", "v", "w"]'), ("g", 0, '["x"]')],
        "file STRING, first_pos BIGINT, content STRING")
    ingest.process_batch(job, ENCODER)(batch, 0)
    assert writes == [[0, 1, 2, 3], [4, 5, 6]]
    rows = ingest.vectors(spark, job).collect()
    assert sorted((r.file, r.pos, r.step) for r in rows) == [("f", i, i // 2) for i in range(13)] + [("g", 0, 0)]
    marks = {(r.step, r.last) for r in job.ledger.entries(spark).filter("NOT whole").collect()}
    assert marks == {(0, 3), (4, 6)}
