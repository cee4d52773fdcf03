from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.llm import negatives as neg

SCHEMA = "vec_id long, embedding array<float>, label int, goals string, tag int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=100, scale=256):
    clean = set()
    for vec_id, v, label, *_ in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        clean.add((vec_id, label, tuple(math.floor(scale * float(np.float32(x))) for x in v)))
    out = []
    for a, own, q in sorted(clean):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, p)), i, other) for i, other, p in clean if i != a]
        positives = sorted((s, i) for s, i, other in scored if other == own)[:5]
        for s, i in positives:
            fit = sorted((t, j) for t, j, other in scored if other != own and 80 * -s <= 100 * -t <= 100 * -s)
            out += [(a, i, r + 1, j, -s, -t) for r, (t, j) in enumerate(fit[:5])]
    return Counter(out)


def mined(df, **more):
    got = neg.mine(df, F.col("vec_id") % 100 == 0, **more)
    assert got.columns == COLUMNS
    return Counter(tuple(r) for r in got.collect())


def test_equal_to_brute_force_with_copies_ties_and_odd_rows(table, monkeypatch):
    monkeypatch.setattr(neg, "CANDIDATES", 150)
    monkeypatch.setattr(neg, "PAGE", 32)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 8)) * rng.uniform(0.05, 1, (900, 1))
    x[300:420] = x[100]  # a hot vector, an anchor among its copies
    x[500:520] = 0
    x[600] = 0  # an anchor without direction
    rows = [(i, v.tolist(), int(rng.integers(0, 4)), "g", 1) for i, v in enumerate(x)]
    rows += rows[95:105]  # repeated rows
    rows += [(1000, None, 1, "g", 1), (1100, [1.0] * 8, None, "g", 1), (None, [1.0] * 8, 1, "g", 1)]
    rows += [(1200, [float("nan")] * 8, 1, "g", 1), (1300, [float("inf")] * 8, 1, "g", 1), (1400, [None] + [1.0] * 7, 1, "g", 1)]
    rows += [(1500, [2.0, 1.0], 1, "g", 1), (1600, [], 2, "g", 1)]  # shorter vectors end in zeros
    got, want = mined(table(rows, SCHEMA).repartition(5)), brute(rows)
    assert got == want and len(want) > 100


def test_clustered_vectors_are_pruned_and_exact(table, monkeypatch):
    monkeypatch.setattr(neg, "CANDIDATES", 100)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 12)) * 2
    x = (centres[rng.integers(0, 6, 1500)] + rng.normal(size=(1500, 12)) * 0.3).astype(np.float32)
    rows = [(i, v.tolist(), int(i * 7 % 5), "g", 1) for i, v in enumerate(x)]
    assert mined(table(rows, SCHEMA)) == brute(rows)


def test_walk_stops_before_the_end_of_the_list(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 6)) * 100
    member = np.array([[300.0, 0, 0, 0, 0, 0], [280.0, 30, 0, 0, 0, 0]]).round()
    seen = []
    whole = neg._products
    monkeypatch.setattr(neg, "_products", lambda u, v, e: seen.append(len(v)) or whole(u, v, e))
    goals = [[neg.Goal(neg.LEAST, neg.MOST, neg.LEAST, 5)] for _ in member]
    members = {"ids": np.array([-1, -2]), "labels": np.array(["a", "a"]), "x": member, "goals": goals}
    block = {"ids": np.arange(4000), "labels": np.array(["a"] * 4000), "x": x.round()}
    found = list(neg.walk(members, block, member[0] / 300, True, 5))
    for i in range(2):
        scores = (block["x"] @ member[i]).astype(int)
        best = sorted(zip(-scores, range(4000)))[:5]
        assert [(v, s) for m, _, v, s in found if m == i] == [(v, -s) for s, v in best]
    assert sum(seen) < 2000


def test_scores_beyond_53_and_64_bits(table):
    rng = np.random.default_rng(7)
    big = [[1.1e7 + float(d), float(d)] for d in rng.integers(-90, 90, 40) / 256]
    rows = [(i, v, i % 2) for i, v in enumerate(big)]
    q = [[math.floor(256 * x) for x in v] for v in big]
    score = [sum(a * b for a, b in zip(q[0], p)) for p in q]
    assert 2**53 < min(score) and max(score) < 2**63
    liked = sorted((-score[i], i) for i in range(2, 40, 2))[:5]
    want = Counter()
    for s, i in liked:
        hard = sorted((-score[j], j) for j in range(1, 40, 2) if 80 * -s <= 100 * score[j] <= 100 * -s)[:5]
        want.update((0, i, r + 1, j, -s, -t) for r, (t, j) in enumerate(hard))
    df = table(rows, "vec_id long, embedding array<double>, label int")
    assert mined(df) == want
    huge = table([(i, [1e300 * (i + 1)], i % 2) for i in range(5)], "vec_id long, embedding array<double>, label int")
    assert mined(huge) == Counter({(0, p, r, j, neg.MOST, neg.MOST): 1 for p in (2, 4) for r, j in ((1, 1), (2, 3))})


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1, "g", 1)], [(0, [1.0], 1, "g", 1), (1, [1.0], 1, "g", 1)], [(5, [1.0], 1, "g", 1)]])
def test_few_or_no_rows(table, rows):
    assert not mined(table(rows, SCHEMA))


def test_negative_and_zero_positives(table):
    rows = [(0, [1.0, 0.0], 1, "g", 1), (1, [-1.0, 0.0], 1, "g", 1), (2, [0.0, 1.0], 1, "g", 1), (3, [-0.9, 0.0], 2, "g", 1), (4, [0.0, -1.0], 2, "g", 1)]
    assert mined(table(rows, SCHEMA)) == brute(rows)
