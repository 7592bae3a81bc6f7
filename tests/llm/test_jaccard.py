from __future__ import annotations

import random
from collections import defaultdict

import pytest

from corpuslab.llm import graph, jaccard


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[j:j + k]) for j in range(len(words) - k + 1))


def brute(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    where = defaultdict(list)
    for i in sorted(sets):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in where[s]:
                shared[j] += 1
            where[s].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def families(rng):
    """Chains and stars of edited copies around the threshold, passages shared by many, short texts."""
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for _ in range(14):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 30, 120]))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(base))
            base[at:at] = passage
        current = base
        for _ in range(rng.randint(1, 12)):
            start = base if rng.random() < 0.5 else current
            current = start.copy()
            for _ in range(rng.randint(0, 3)):
                current[rng.randrange(len(current))] = rng.choice(vocabulary)
            rows.append(" ".join(current))
    rows += [" ".join(passage)] * 3 + ["", "a", "a b", "A  b", "\x0b\x0c"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k,percent,seed", [(4, 85, 1), (5, 80, 2), (1, 60, 3), (2, 50, 5)])
def test_like_brute_force(spark, k, percent, seed):
    rows = families(random.Random(seed))
    got = jaccard.component_rows(spark.createDataFrame(rows, "doc_id long, text string"), k, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(rows, k, percent)


def test_frequent_shingles_only_change_the_order(spark, monkeypatch):
    rows = families(random.Random(5))
    monkeypatch.setattr(jaccard, "BUFFER", 64)
    monkeypatch.setattr(jaccard, "CARRIED", 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    values, ranks = jaccard.frequent_shingles(docs, 4, "text")
    assert len(values) and sorted(ranks) == list(range(len(values))) and (values[1:] > values[:-1]).all()
    got = jaccard.component_rows(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(rows, 4, 85)


@pytest.mark.parametrize("percent", [1, 8, 50, 80, 85, 100])
def test_prefixes_hold_what_linked_sets_share(percent):
    parts = [jaccard.common_part(n, percent) for n in range(1, 400)]
    assert parts == sorted(parts) and parts[0] == 1
    for n, part in enumerate(parts, 1):
        assert 1 <= part <= jaccard.least_overlap(n, percent) and jaccard.prefix_length(n, percent) <= n


def test_candidates_of_a_shared_passage_grow_with_the_input(spark, monkeypatch):
    """Short texts of their own around one passage: unlike each other, so pairs of them must not be listed."""
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    seen = {}
    write = jaccard.written_table

    def counted(df, name):
        out = write(df, name)
        if name == "jaccard-spans":
            x, y = out.alias("x"), out.alias("y")
            met = (jaccard.F.col("x.shingle") == jaccard.F.col("y.shingle")) & (jaccard.F.col("x.unit") < jaccard.F.col("y.unit"))
            seen["rows"] = x.join(y, met & jaccard.may_link(jaccard.span("x"), jaccard.span("y"), 80)).count()
        return out

    monkeypatch.setattr(jaccard, "written_table", counted)
    passage = " ".join(f"p{j}" for j in range(20))
    rows = {}
    for size in (60, 300):
        texts = [(i, " ".join(f"w{i}x{j}" for j in range(14)) + " " + passage) for i in range(size)]
        texts += [(size + i, t + " more") for i, t in texts[:5]]
        docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
        got = {r.doc_id: r.component_id for r in jaccard.component_rows(docs, 5, 80).collect()}
        assert got == {**{i: i for i in range(size)}, **{size + i: i for i in range(5)}}
        rows[size] = seen["rows"]
    assert rows[300] <= 6 * max(rows[60], 5)


def edited_copies(rng, size, most):
    """Copies of one text of 150 words with up to ``most`` words of their own: some are far from every other one."""
    base = [f"b{j}" for j in range(150)]
    rows = []
    for i in range(size):
        words = base.copy()
        for e, at in enumerate(rng.sample(range(150), rng.randint(1, most))):
            words[at] = f"u{i}x{e}"
        rows.append((i, " ".join(words)))
    return rows


def test_candidates_of_a_group_of_copies_grow_with_the_group(spark, monkeypatch):
    """Members far from their leader, or of a leader far from all, must not meet all others."""
    monkeypatch.setattr(jaccard, "FREQUENT", 2)
    seen = {}
    write = jaccard.written_table

    def kept(df, name):
        seen[name] = write(df, name)
        return seen[name]

    monkeypatch.setattr(jaccard, "written_table", kept)
    rows = edited_copies(random.Random(1), 400, 9)
    got = jaccard.component_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 5, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(rows, 5, 80)
    assert seen["jaccard-inside"].count() <= 8 * len(rows)


def test_guests_of_a_larger_unit(spark, monkeypatch):
    """A chain of edits is cut into units: neighbours link across them, though the leaders do not."""
    seen = {}
    write = jaccard.written_table

    def kept(df, name):
        seen[name] = write(df, name)
        return seen[name]

    monkeypatch.setattr(jaccard, "written_table", kept)
    rng = random.Random(4)
    rows, chain = [], [f"b{j}" for j in range(60)]
    for i in range(60):  # a chain of edits: near neighbours link, far ones do not
        chain[i] = f"c{i}"
        rows.append((i, " ".join(chain)))
    rng.shuffle(rows)
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    got = jaccard.component_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(rows, 4, 85)
    assert seen["jaccard-guests"].count() > 0


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = jaccard.component_rows(documents)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(rows, 4, 85)


def test_edges(odd, none):
    rows = jaccard.component_rows(odd).collect()
    assert len(rows) == odd.count() and jaccard.component_rows(none).count() == 0
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    want = brute([(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None], 4, 85)
    assert {i: v for i, v in by.items() if i is not None} == want
    assert sorted((r.n_shingles, r.component_id) for r in rows if r.doc_id is None and r.n_shingles) == [(1, 4)]
    kept = jaccard.one_per_component(odd)
    assert kept.columns == odd.columns and {5, 3, 0, 1, 2} <= {r.doc_id for r in kept.collect()}
    assert not {6, 7, 8, 9} & {r.doc_id for r in kept.collect()}


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (150, 100), (7, 7), (500, 500)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}
