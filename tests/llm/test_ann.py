from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score double"


def brute(ids, x, asked, k):
    out = {}
    for q in asked:
        own = x[ids.index(q)]
        far = sorted((math.sqrt(((x[i] - own) ** 2).sum()), ids[i]) for i in range(len(ids)) if ids[i] != q)
        out[q] = far[:k]
    return out


def test_small_table_is_exact_with_ties_and_unusable_rows(table):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[200:260] = x[7]  # many copies, query rows among them
    rows = [(i, v.tolist(), 0.0) for i, v in enumerate(x)]
    odd = [(1000, None, 0.0), (1100, [0.0] * 8, 0.0), (1200, [float("nan")] * 8, 0.0), (1300, [1.0] * 3, 0.0)]
    odd += [(None, [1.0] * 8, 0.0), (1400, [None] + [1.0] * 7, 0.0), (1500, [float("inf")] * 8, 0.0)]
    got = ann.search(table(rows + odd, SCHEMA), F.col("vec_id") % 100 == 0, 10).collect()
    want = brute(list(range(300)), x.astype(float), [0, 100, 200], 10)
    found = {q: [(r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in want}
    for q in want:
        assert [v for _, v in found[q]] == [v for _, v in want[q]]
        assert [s for s, _ in found[q]] == pytest.approx([s for s, _ in want[q]], rel=1e-12)
    assert {r["query_id"] for r in got} == set(want)


def test_learned_partitions_reach_the_recall(table, monkeypatch):
    monkeypatch.setattr(ann, "PER_PART", 400)
    monkeypatch.setattr(ann, "CANDIDATES", 300)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 2
    x = (centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 16))).astype(np.float32)
    rows = [(i, v.tolist(), 0.0) for i, v in enumerate(x)]
    got = ann.search(table(rows, SCHEMA).repartition(4), F.col("vec_id") % 100 == 0, 10).collect()
    want = brute(list(range(3000)), x.astype(float), range(0, 3000, 100), 10)
    assert len(got) == 300
    hits = sum((r["query_id"], r["vec_id"]) in {(q, v) for q in want for _, v in want[q]} for r in got)
    assert hits / 300 >= 0.9


def test_parts_are_balanced():
    rng = np.random.default_rng(2)
    graph = ann.neighbour_graph(rng.normal(size=(1000, 6)), 10)
    sizes = np.bincount(ann.balanced_parts(graph, 3, rng))
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 4


def test_few_or_no_candidates(table):
    assert ann.search(table([], SCHEMA), F.lit(True)).count() == 0
    got = ann.search(table([(0, [1.0, 2.0], 0.0), (1, [2.0, 2.0], 0.0), (2, [2.0, 2.0], 0.0)], SCHEMA), F.col("vec_id") == 0)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]


@pytest.mark.parametrize("per_part", [4_000, 100])
def test_repeated_ids_give_distinct_neighbours(table, monkeypatch, per_part):
    """Repeated rows count once; an id with two vectors is as near as its nearest."""
    monkeypatch.setattr(ann, "PER_PART", per_part)
    monkeypatch.setattr(ann, "RECALL", 1.0)
    monkeypatch.setattr(ann, "CANDIDATES", 64)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 6)).astype(np.float32)
    x[30:45] = x[0]  # copies of a query
    rows = [(i, x[i].tolist(), 0.0) for i in range(400)]
    rows += [rows[0]] * 12 + [rows[30]] * 12 + [rows[100]] * 2 + [rows[200]]
    near = x[100] + rng.normal(size=(15, 6)).astype(np.float32) * 0.01
    rows += [(7, v.tolist(), 0.0) for v in near]  # one id with many vectors near a query
    rows += [(300, x[9].tolist(), 0.0)]  # a query with two vectors
    got = ann.search(table(rows, SCHEMA).repartition(4), F.col("vec_id") % 100 == 0, 10).collect()
    for q in (0, 100, 200, 300):
        own = [np.array(v, float) for i, v, _ in rows if i == q]
        least: dict[int, float] = {}
        for i, v, _ in rows:
            if i != q:
                least[i] = min([least.get(i, math.inf), *(math.sqrt(((np.array(v) - o) ** 2).sum()) for o in own)])
        want = sorted((s, i) for i, s in least.items())[:10]
        found = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        assert len({r["vec_id"] for r in found}) == 10
        if per_part == 4_000:
            assert [r["vec_id"] for r in found] == [i for _, i in want]
            assert [r["score"] for r in found] == pytest.approx([s for s, _ in want], rel=1e-9, abs=1e-12)


def test_parts_grow_with_the_vectors(table, monkeypatch):
    """Twice the vectors, twice the parts, up to the documented limit."""
    assert ann.MAX_PARTS * ann.PER_SAMPLED == 65_536
    monkeypatch.setattr(ann, "PER_PART", 100)
    monkeypatch.setattr(ann, "PER_SAMPLED", 10)
    rng = np.random.default_rng(4)
    learned = []
    monkeypatch.setattr(ann, "learn_router", lambda x, parts, real=ann.learn_router: learned.append(real(x, parts)) or learned[-1])
    for n in (1000, 2000):
        x = rng.normal(size=(n, 6)).astype(np.float32)
        ann.search(table([(i, v.tolist(), 0.0) for i, v in enumerate(x)], SCHEMA), F.col("vec_id") % 100 == 0, 10)
    a, b = (len(r.b2) for r in learned)
    assert (a, b) == (32, 64)


def test_very_far_and_very_near_vectors_keep_their_neighbours(table):
    rows = [(0, [1e200, 0.0], 0.0), (1, [-1e200, 0.0], 0.0), (2, [1e-200, 0.0], 0.0), (3, [2e-200, 0.0], 0.0)]
    df = table(rows, "vec_id long, embedding array<double>, score double")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.search(df, F.col("vec_id") < 4, 3).collect()}
    assert len(got) == 12
    assert got[0, 3] == (1, pytest.approx(2e200)) and got[2, 1] == (3, pytest.approx(1e-200))
