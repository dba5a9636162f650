import random
import zlib

import numpy as np

from sceneloom.llm import quality

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int"


def corpus(n=900):
    r = random.Random(1)
    words = ["house", "river", "the", "of", "and", "walks", "slow", "green", "under", "light"]
    rows, labels = [], []
    for i in range(n):
        good = r.random() < 0.7
        text = ". ".join(" ".join(r.choice(words) for _ in range(r.randint(5, 12))).capitalize() for _ in range(r.randint(2, 9))) + "."
        if not good:
            text = " ".join(w + r.choice(["***", "$$$", "!!!"]) for w in text.split()) if r.random() < 0.5 else " ".join([r.choice(words)] * 60)
        rows.append((i, text))
        if r.random() < 0.5:
            labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    got = {r.doc_id: r for r in quality.score_documents(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert len(got) == len(rows)
    gold = dict(labels)
    held = [r for r in got.values() if r.held_out and r.doc_id in gold]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.values())
    assert np.mean([r.predicted == gold[r.doc_id] for r in held]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())


def test_labels_beyond_the_training_rows_change_nothing(spark):
    rows, labels = corpus(300)
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    d = spark.createDataFrame(rows, DOCS)
    a = quality.score_documents(d, spark.createDataFrame(labels, LABELS)).collect()
    flipped = [(i, 1 - q if held(i) else q) for i, q in labels]
    b = quality.score_documents(d, spark.createDataFrame(flipped, LABELS)).collect()
    assert sorted(a) == sorted(b)


def test_odd_rows(spark):
    rows, labels = corpus(200)
    odd = [(None, None), (1001, ""), (1002, None), (1003, "é" * 200_000), (1004, "\n\n"), (0, rows[0][1])]
    d = spark.createDataFrame(rows + odd, DOCS).selectExpr("*", "1 AS score", "'x' AS value")
    got = quality.score_documents(d, spark.createDataFrame(labels + [(None, 1), (0, None), labels[0]], LABELS)).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    none = quality.score_documents(d, spark.createDataFrame([], LABELS)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.score_documents(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).count() == 0


def test_prior_estimate():
    r = np.random.RandomState(0)
    p, n = r.normal(2, 1, 4000), r.normal(-2, 1, 4000)
    assert abs(quality.estimate_prior(p[:2000], np.concatenate([p[2000:], n[:2000]])) - 0.5) < 0.06
    assert abs(quality.estimate_prior(p[:2000], np.concatenate([p[2000:], n[:500]])) - 0.8) < 0.06


def test_few_labels_are_all_learnt_from(spark, monkeypatch):
    rows, _ = corpus(900)
    labels = [(i, 1) for i in range(0, 40)]
    seen = []
    monkeypatch.setattr(quality, "train", lambda p, u: seen.extend((len(p), len(u))))
    quality.fit(spark.createDataFrame(rows + [rows[1]] * 2000, DOCS), spark.createDataFrame(labels, LABELS), sample=50)
    assert seen[0] == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(40)) and 0 < seen[1] <= 100


def plain_risk(w, p, u, prior):
    """The parts of the risk, sum by sum: that of positives, and that of negatives."""
    g = lambda x: sum(np.tanh(x[: len(w[0])] @ w[0] + w[1]) * w[2]) + x @ w[4] + w[3][0]
    loss = lambda z: np.log(1 + np.exp(-z))
    good = prior * sum(loss(g(x)) for x in p) / len(p)
    bad = sum(loss(-g(x)) for x in u) / len(u) - prior * sum(loss(-g(x)) for x in p) / len(p)
    return good, bad


def test_risk_and_gradient_are_those_of_the_plain_form():
    r = np.random.RandomState(4)
    seen = set()
    for shift in (0.0, 4.0):
        w = [r.normal(size=(5, 3)), r.normal(size=3), r.normal(size=3), r.normal(size=1), r.normal(size=9)]
        p, u = r.normal(size=(6, 9)) + shift * np.sign(w[4]), r.normal(size=(8, 9)) - shift * np.sign(w[4])
        good, bad = plain_risk(w, p, u, 0.6)
        value, grads = quality._risk(w, p, u, 0.6, True)
        assert abs(value - (good + max(0.0, bad))) < 1e-9
        seen.add(bad < 0)
        of = (lambda: sum(plain_risk(w, p, u, 0.6))) if bad >= 0 else (lambda: -plain_risk(w, p, u, 0.6)[1])
        for a, g in zip(w, grads, strict=True):
            for i in np.ndindex(a.shape):
                was = a[i]
                a[i] = was + 1e-5
                up = of()
                a[i] = was - 1e-5
                down = of()
                a[i] = was
                assert abs((up - down) / 2e-5 - g[i]) < 1e-5
    assert seen == {True, False}


def test_ngrams_tell_what_the_shape_does_not(spark):
    """Good and bad texts differ in their words alone, not in lengths, characters or lines."""
    r = random.Random(9)
    good, bad = ["abdo", "bodo", "dabo", "obda"], ["adob", "boda", "doba", "odab"]
    rows = [(i, " ".join(r.choice(bad if i % 3 == 0 else good) for _ in range(40))) for i in range(1200)]
    labels = [(i, int(i % 3 > 0)) for i in range(0, 1200, 2)]
    got = quality.score_documents(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 3 > 0) for r in got if r.held_out]) > 0.95
    assert all(r.prior_estimated for r in got) and 0.5 < got[0].prior < 0.85


def test_hashed_ngrams_are_counts():
    seen = quality._Buckets()
    text = "aa bb aa bb cc é"
    one = quality.hashed_ngrams(text.encode(), text.split(), seen)
    assert abs((one[:256] ** 2).sum() - 1) < 1e-9 and abs((one[256:] ** 2).sum() - 1) < 1e-9
    assert np.allclose(one, quality.hashed_ngrams(text.encode(), text.split(), seen, step=3))
    assert not quality.hashed_ngrams(b"", [], seen).any() and len(quality.features(None, seen)) == quality.WIDTH


def test_a_prior_that_cannot_be_estimated_is_said(spark):
    rows, _ = corpus(200)
    got = quality.score_documents(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, 1) for i in range(10)], LABELS)).collect()
    assert {(r.prior, r.prior_estimated) for r in got} == {(0.5, False)}
