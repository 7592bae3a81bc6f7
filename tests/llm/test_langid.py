from __future__ import annotations

import numpy as np

from corpuslab.llm import common, langid


def test_held_out_accuracy(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    rows = langid.language_digests(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_gradients():
    rng = np.random.default_rng(0)
    net = langid.ByteConvNet(["a", "b", "c"])
    net.params = {k: v.astype(np.float64) for k, v in net.params.items()}
    windows, labels = rng.integers(1, 256, (4, langid.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, grads = net.step(windows, labels)
    for name, at in (("dense", (3, 1)), ("conv3", (5, 2)), ("bias2", (1,)), ("embed", (int(windows[0, 0]), 2))):
        kept = net.params[name][at]
        losses = []
        for shift in (1e-5, -1e-5):
            net.params[name][at] = kept + shift
            losses.append(net.step(windows, labels)[0])
        net.params[name][at] = kept
        assert abs((losses[0] - losses[1]) / 2e-5 - grads[name][at]) < 1e-3


def test_lookups_equal_the_convolution():
    rng = np.random.default_rng(1)
    net = langid.ByteConvNet(["a", "b"])
    windows = rng.integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    logs = langid.log_probabilities(net.unfold(), windows)
    for label in (0, 1):
        loss, _ = net.step(windows, np.full(5, label))
        assert abs(-logs[:, label].mean() - loss) < 1e-4


def test_whole_text_counts():
    net = langid.ByteConvNet(["a", "b"]).unfold()
    head = b"x" * langid.WINDOW
    assert langid.predict_batch(net, [head + b"yz" * 4000])[1] != langid.predict_batch(net, [head])[1]


def test_edges(odd, none):
    rows = langid.language_digests(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by[i].lang_pred for i in (0, 1, 2, 13)] == ["und"] * 4 and by[5].lang_pred in ("en", "de")
    assert langid.language_digests(none).count() == 0
    unlabelled = odd.withColumn("lang", langid.F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.language_digests(unlabelled).collect()} == {"und"}
    assert "score" in langid.predict(odd, langid.ByteConvNet(["a"]).unfold()).columns
