from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from corpuslab.llm import lines


def chunks(text):
    own = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:6], 16) for x in own]
    out, start = [], 0
    for i in range(len(own)):
        if i == len(own) - 1 or i >= 2 and (h[i] + 31 * h[i - 1] + 961 * h[i - 2]) % 4 == 0:
            out.append("\n".join(own[start:i + 1]))
            start = i + 1
    return out


def brute(rows):
    places = defaultdict(set)
    mark = lambda text: hashlib.md5((text or "").encode()).hexdigest()
    for i, text in rows:
        for no, c in enumerate(chunks(text) if text is not None else []):
            if "\n" in c:
                places[c].add((i is None, i or 0, mark(text), no))
    out = []
    for i, text in rows:
        if text is None:
            out.append((i, None, 0, 0, 0))
            continue
        own = chunks(text)
        gone = {no for no, c in enumerate(own) if "\n" in c and min(places[c]) != (i is None, i or 0, mark(text), no)}
        kept = "\n".join(c for no, c in enumerate(own) if no not in gone)
        out.append((i, kept, len(own), len(gone), sum(own[no].count("\n") + 1 for no in gone)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.text, r.n_chunks, r.removed_chunks, r.removed_lines) for r in lines.dedup_lines(df).collect()), key=str)


@pytest.fixture(scope="module")
def passages(spark):
    shared = "\n".join(f"shared line {i}" for i in range(30))
    rows = [(i, f"own {i}\n" * (i % 4) + shared + f"\nend {i}") for i in range(12)] + [(50, "a\nb\na\nb"), (51, "\n\n\n\n")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_shifted_passages_go(passages):
    got = result(passages)
    assert got == brute([(r.doc_id, r.text) for r in passages.collect()])
    assert sum(removed >= 15 for *_, removed in got) >= 11  # most of the passage in all but the first


def test_like_brute_force(documents, odd, none):
    for docs in (documents, odd):
        assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert lines.dedup_lines(none).count() == 0


def test_bytes_are_compared(passages, monkeypatch):
    # with a digest that tells nothing apart only chunks equal byte by byte may go
    monkeypatch.setattr(lines.F, "octet_length", lambda c: lines.F.lit(1))
    got = result(passages)
    want = dict((r[0], r[1]) for r in brute([(r.doc_id, r.text) for r in passages.collect()]))
    assert {r[0]: r[1] for r in got} == want


def test_no_python_in_the_plan(passages):
    plan = lines.dedup_lines(passages)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_ids_that_are_null_or_repeat(spark):
    """Rows of one id, or of none, with different texts: only what occurs elsewhere goes."""
    shared, own = ("\n".join(f"{w} {i}" for i in range(40)) for w in ("shared line", "own line"))
    for ids in ((1, None, None), (1, 2, 2)):
        rows = list(zip(ids, (shared, shared, own)))
        got = result(spark.createDataFrame(rows, "doc_id long, text string"))
        assert got == brute(rows)
        assert own in [text for _, text, *_ in got]
