from __future__ import annotations

import random

from corpuslab.llm import decontaminate as dc
from corpuslab.llm.common import WordHashes


def greedy(doc, item, k):
    """Greedy string tiling by definition: all common runs, longest first."""
    used_d, used_i, covered = set(), set(), 0
    while True:
        best = (k - 1,)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while (i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n]
                       and i + n not in used_d and j + n not in used_i):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if len(best) == 1:
            return covered
        n, i, j = best
        used_d |= set(range(i, i + n))
        used_i |= set(range(j, j + n))
        covered += n


def test_like_the_definition():
    rng = random.Random(2)
    for _ in range(150):
        item = [rng.choice("abcdef") for _ in range(rng.randint(5, 25))]
        doc = [rng.choice("abcdef") for _ in range(rng.randint(0, 20))] + item[10:] + ["x"] + item[:rng.randint(0, 10)]
        bench = dc.Benchmark([(7, " ".join(item).encode())], 3)
        found = bench.leaks(dc.words_of(" ".join(doc).encode(), WordHashes()), 0.01)
        assert round(sum(f[1] for f in found) * len(item)) == greedy(doc, item, 3), (doc, item)


def test_repeated_words_in_bounded_memory(monkeypatch):
    """Every seed of the text meets every seed of the item: 6 million pairs."""
    import tracemalloc

    item, text = b"same " * 300, b"same " * 20_000 + b"other " + b"same " * 20
    bench = dc.Benchmark([(1, item), (2, b"same same same same same other thing and more words")])
    words = dc.words_of(text, WordHashes())
    monkeypatch.setattr(dc, "PAIRS", 1 << 17)
    tracemalloc.start()
    found = bench.leaks(words, 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(1, 1.0, [(0, 0, 300)]), (2, 0.6, [(19_995, 0, 6)])]
    assert peak < 100 << 20


def test_blocks_of_pairs_do_not_matter(monkeypatch):
    rng = random.Random(9)
    for _ in range(40):
        items = [(n, " ".join(rng.choice("ab") for _ in range(rng.randint(3, 30))).encode()) for n in range(4)]
        doc = dc.words_of(" ".join(rng.choice("aab") for _ in range(rng.randint(0, 80))).encode(), WordHashes())
        monkeypatch.setattr(dc, "PAIRS", 1 << 20)
        want = dc.Benchmark(items, 3).leaks(doc, 0.1)
        monkeypatch.setattr(dc, "PAIRS", 4)
        monkeypatch.setattr(dc, "PIECE", 7)
        assert dc.Benchmark(items, 3).leaks(doc, 0.1) == want
        monkeypatch.undo()


def test_reordered_passages_and_clean_documents(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([
        (1, "zz Seven, eight nine ten ELEVEN twelve! and one two three four five six qq"), (2, "one two three four five"),
        (3, item), (4, "quite another text"), (5, item + " " + item), (6, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (11, item), (12, None), (13, "short one")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.coverage, r.n_tiles) for r in dc.find_leaks(docs, bench).collect()}
    assert got == {(d, i): (1.0, n) for d, n in ((1, 2), (3, 1), (5, 1)) for i in (10, 11)}
    assert sorted(r.doc_id for r in dc.without_leaks(docs, bench).collect()) == [2, 4, 6]


def test_blocks_do_not_matter(spark, sf, documents, monkeypatch):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = lambda: sorted((r.doc_id, r.item_id, r.coverage) for r in dc.find_leaks(documents, bench).collect())
    first = rows()
    items = [(r.item_id, r.text) for r in bench.collect()]
    for r in documents.collect():
        for i, text in items:  # plain containment must be found
            if text in r.text:
                assert (r.doc_id, i, 1.0) in first
    monkeypatch.setattr(dc, "BLOCK_WORDS", 1500)
    assert rows() == first and first


def test_edges(odd, none, spark):
    bench = odd.select(dc.F.col("doc_id").alias("item_id"), "text", "n")
    pairs = {(r.doc_id, r.item_id) for r in dc.find_leaks(odd, bench).collect()}
    assert (5, 5) in pairs and (5, 8) in pairs and not any(0 in p or 1 in p for p in pairs)
    assert dc.find_leaks(none, bench).count() == 0 and dc.find_leaks(odd, bench.limit(0)).count() == 0
    assert dc.without_leaks(odd, bench.limit(0)).columns == odd.columns
