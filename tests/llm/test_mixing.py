from __future__ import annotations

import numpy as np
import pytest

from corpuslab.llm import mixing


def test_raking_meets_every_marginal():
    rng = np.random.default_rng(0)
    cells = [(s, g, t) for s in "abc" for g in "xy" for t in "pq"]
    tokens = rng.uniform(1, 100, len(cells))
    targets = [{"a": 0.5, "b": 0.3, "c": 0.2}, {"x": 0.6, "y": 0.4}, {"p": 0.1, "q": 0.9}]
    share, worst = mixing.rake(cells, tokens, targets)
    assert worst < 1e-8
    for d, target in enumerate(targets):
        for value, wanted in target.items():
            assert abs(sum(s for c, s in zip(cells, share) if c[d] == value) - wanted) < 1e-8
    # the odds ratios of the table are kept
    cube, was = share.reshape(3, 2, 2), tokens.reshape(3, 2, 2)
    odds = lambda m: m[0, 0, 0] * m[1, 1, 0] / (m[0, 1, 0] * m[1, 0, 0])
    assert abs(odds(cube) / odds(was) - 1) < 1e-6


def test_absent_values_and_conflicts():
    share, worst = mixing.rake([("a",), ("b",)], np.array([1.0, 3.0]), [{"a": 1, "z": 3}])
    assert list(share) == [1.0, 0.0] and worst == 0
    _, worst = mixing.rake([("a", "x"), ("b", "y")], np.ones(2), [{"a": 0.9, "b": 0.1}, {"x": 0.5, "y": 0.5}])
    assert worst > 0.1
    with pytest.raises(ValueError):
        mixing.rake([("a",)], np.ones(1), [{"z": 1.0}])


def test_draw_is_calibrated(spark):
    rows = [(i, "w " * (1 + i % 100), "en" if i % 3 else "de", f"s{min(i % 10, 3)}") for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"source": {f"s{i}": 0.25 for i in range(4)}, "lang": {"en": 0.5, "de": 0.5}}
    mixed = mixing.mix(docs, targets).collect()
    assert len(mixed) == len(rows) and max(r.prob for r in mixed) == 1
    drawn = [r for r in mixed if r.drawn]
    total = sum(r.n_tokens for r in drawn)
    for column, target in targets.items():
        for value, wanted in target.items():
            assert abs(sum(r.n_tokens for r in drawn if r[column] == value) / total - wanted) < 0.02
    again = {r.doc_id for r in mixing.sample(docs, targets=targets).collect()}
    assert again == {r.doc_id for r in drawn}
    small = sum(r.n_tokens for r in mixing.sample(docs.withColumn("n_tokens", mixing.word_count(mixing.F.col("text"))),
                                                  targets=targets, budget=50_000).collect())
    assert abs(small / 50_000 - 1) < 0.1


def test_topics(spark):
    rows = [(1, "| a | b | c |"), (2, "12 34 a"), (3, "a b"), (4, "word " * 60), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": mixing.F.lit("x"), "source": mixing.F.lit("y")})
    assert {r.doc_id: r.topic for r in mixing.with_cells(docs).collect()} == {
        1: "table", 2: "data", 3: "note", 4: "prose", 5: "note", 6: "note"}


def test_edges(odd, none):
    mixed = mixing.mix(odd)
    assert mixed.count() == odd.count() and mixed.filter("drawn IS NULL OR prob IS NULL").count() == 0
    assert mixing.sample(odd).columns == odd.columns
    assert mixing.mix(none).count() == 0


def test_one_rare_document_does_not_set_the_scale(spark):
    rows = [(i, "w " * (60 + i % 40), "en" if i % 3 else "de", f"s{min(i % 10, 3)}") for i in range(4_000)]
    schema = "doc_id long, text string, lang string, source string"
    before = mixing.mix(spark.createDataFrame(rows, schema)).collect()
    after = mixing.mix(spark.createDataFrame([*rows, (9_999, "five words of a stranger", "zz", "new")], schema)).collect()
    kept = lambda found: {r.doc_id for r in found if r.drawn}
    assert len(kept(before) ^ kept(after) - {9_999}) <= 0.01 * len(rows)
    assert max(r.prob for r in after) <= 1


def test_full_cells_leave_the_fit():
    rng = np.random.default_rng(1)
    cells = [(s, g, t) for s in "abc" for g in "xy" for t in "pq"]
    tokens = rng.uniform(1e4, 1e5, len(cells))
    tokens[0] = 1.0
    targets = mixing.wanted_shares(cells, tokens)
    fit = mixing.calibrate(cells, tokens, targets)
    present = max(abs(tokens[[c[d] == v for c in cells]].sum() / tokens.sum() - w)
                  for d, target in enumerate(targets) for v, w in target.items())
    assert fit.prob.max() == 1 and fit.residual <= 0.011 * present and fit.kept > 0.7
    half = mixing.calibrate(cells, tokens, targets, budget=tokens.sum() / 2)
    assert abs(half.kept - 0.5) < 1e-6 and half.prob.max() <= 1
    # more is asked of a value than it holds: all of it is drawn and the others fill the budget
    scarce = mixing.calibrate([("a",), ("b",)], np.array([10.0, 990.0]), [{"a": 0.5, "b": 0.5}], budget=500)
    assert np.allclose(scarce.prob, [1.0, 490 / 990]) and abs(scarce.residual - 0.48) < 1e-9
