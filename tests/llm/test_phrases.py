from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpuslab.llm import phrases

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, most, least):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for m in range(1, 5):
                counts[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            if any(100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in candidates.items() if len(q) > len(p)):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def result(df, most, least):
    return sorted(tuple(r[c] for c in COLUMNS) for r in phrases.mine_phrases(df, most, least).collect())


def sample(seed, n=120):
    rng = random.Random(seed)
    words = ["of", "The", "new", "york", "été", "中文", "x" * 80, "y z", "a1", "\U0001f600"]
    fixed = ["New York of the", "the new york", "été été été", "a1 \t the"]
    joints = [" ", " ", " ", "\t", ", ", ". ", "\n", "?!", "  "]
    rows = []
    for _ in range(n):
        parts = [rng.choice([rng.choice(words), rng.choice(fixed)]) + rng.choice(joints) for _ in range(rng.randint(0, 60))]
        rows.append((rng.choice(["en", "fr", None]), "".join(parts)))
    return rows + [("en", None), (None, ""), ("xx", " . ")]


@pytest.mark.parametrize("seed", range(3))
def test_like_brute_force(spark, seed):
    rows = sample(seed)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert result(frame, 2000, 5) == brute(rows, 2000, 5)
    assert result(frame, 7, 30) == brute(rows, 7, 30)


def test_small_bounds(spark, monkeypatch):
    """Slices that cut texts at piece ends, many flushes, and a bitmap in which nearly every bit is set."""
    rows = sample(9)
    monkeypatch.setattr(phrases, "SLICE", 50)
    monkeypatch.setattr(phrases, "ENTRIES", 20)
    monkeypatch.setattr(phrases, "BITMAP_BITS", 7)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert result(frame, 2000, 5) == brute(rows, 2000, 5)


def test_odd_rows(spark, odd, none):
    rows = [(r.lang, r.text) for r in odd.collect() if r.text is None or len(r.text) < 100_000]
    assert result(odd.filter("length(text) < 100000 OR text IS NULL"), 2000, 3) == brute(rows, 2000, 3)
    assert phrases.mine_phrases(odd).count() > 0
    assert phrases.mine_phrases(none).collect() == []


def test_large_counts_stay_exact(spark):
    big = 4_000_000_000_000_000_000
    levels = [spark.createDataFrame([("en", "a", big, 1), ("en", "b", big - 1, 2)], "lang string, phrase string, f long, id long"),
              spark.createDataFrame([("en", "a b", big - 2, 3)], "lang string, phrase string, f long, id long")]
    row = phrases.scored(levels).first()
    assert row.score == 2_000_000 * (big - 2) // (2 * big - 1)


def test_stripes_of_a_hot_prefix_are_spread(spark):
    rng = np.random.default_rng(0)
    text = " ".join(f"the w{rng.integers(0, 3000)}" for _ in range(5000))
    texts = spark.createDataFrame([("en", text.encode())], "lang string, text binary")
    everything = np.full(1 << (phrases.BITMAP_BITS - 6), -1, np.int64)
    shared = spark.sparkContext.broadcast(everything)
    rows = phrases.stripes(texts, 1, shared).selectExpr("prefix", "part", "size(nexts) AS n").collect()
    widest = max(rows, key=lambda r: r.n)
    assert len({r.part for r in rows if r.prefix == widest.prefix}) == 8
    assert widest.n < 1000
