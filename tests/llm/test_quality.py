from __future__ import annotations

import numpy as np
import pyarrow as pa

from wattloom.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def data():
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(400):
        words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(40)]
        good = i % 4 > 0
        rows.append((i, " ".join(words) if good else " ".join([words[0]] * 40) + "!!", float(i)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy_and_threshold(table):
    rows, labels = data()
    docs = table(rows, "doc_id long, text string, score double")
    model = quality.learn(docs, table(labels[:300], LABELS))
    got = quality.score(docs, model).collect()  # the column score is replaced
    held = [r for r in got if r["doc_id"] >= 300]
    assert np.mean([(r["score"] >= quality.THRESHOLD) == (r["doc_id"] % 4 > 0) for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    low = sum(r["score"] < quality.THRESHOLD for r in got if r["doc_id"] < 300)
    assert abs(low - 75) <= 2  # the quantile of the training scores at the share of label 0


def test_sample_bound_conflicting_and_null_labels(table):
    rows, labels = data()
    docs = table(rows, "doc_id long, text string, n double")
    more = [*labels, (None, 1, 0), (5, None, 0), (6, 0, 0), (6, 1, 0)]
    a = quality.learn(docs, table(more, LABELS), limit=50)
    b = quality.learn(docs.repartition(5), table(more, LABELS), limit=50)
    assert np.allclose(a.weights, b.weights)


def test_odd_texts_and_missing_labels(table, docs, corpus, no_docs):
    for labels in ([], [(1, 1, 0)], [(1, 0, 0)]):
        model = quality.learn(docs, table(labels, LABELS))
        assert quality.score(docs, model).count() == len(corpus)
    assert quality.score(no_docs, model).count() == 0
    x = quality.features(pa.array(["", None, "one", "a a b", "x" * 100_000]))
    assert np.isfinite(x).all() and (x[0] == x[1]).all()


def test_distinct_counts_stay_within_texts():
    a = quality.features(pa.array(["a b a b", "a b a b"]))
    assert np.allclose(a[0], a[1])
