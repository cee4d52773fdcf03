from __future__ import annotations

import re

import numpy as np
import pytest

from wattloom.llm import near_dedup


def sets_of(texts, width):
    out = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    return out


def brute(rows, width, percent):
    """Links of all pairs by full sets, closed by union."""
    sets = sets_of([r[1] for r in rows], width)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return {(r[0], len(sets[i]), least.get(find(i)), r[0] == least.get(find(i))) for i, r in enumerate(rows)}


@pytest.mark.parametrize("width", [4, 5])
def test_groups_match_brute_force(docs, corpus, width):
    got = near_dedup.find_groups(docs, width, 80).collect()
    assert len(got) == len(corpus)
    assert {tuple(r) for r in got} == brute(corpus, width, 80)


def test_chain_is_one_group_and_blocks_find_cross_links(table, monkeypatch):
    """Neighbours of a chain are alike, its ends are not; small blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(words[5 * i : 5 * i + 120]), 0) for i in range(30)]
    rows += [(100 + i, " ".join(words[::-1][7 * i : 7 * i + 90]), 0) for i in range(25)]
    got = near_dedup.find_groups(table(rows, "doc_id long, text string, n long"), 5, 80).collect()
    assert {tuple(r) for r in got} == brute(rows, 5, 80)


def test_repeated_rows_null_ids_and_empty_table(table, no_docs):
    rows = [(None, "a b c d e f", 0), (None, "a b c d e f", 0), (4, "g h i j k l", 0), (4, "g h i j k l", 0)]
    got = near_dedup.find_groups(table(rows, "doc_id long, text string, component_id long"), 5).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(4, 2, 4, True)] * 2 + [(None, 2, None, True)] * 2, key=str)
    assert near_dedup.find_groups(no_docs).count() == 0


def test_likelihood_keeps_what_may_reach_the_threshold():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 4000, np.uint64)
    for shared, expect in ((900, True), (200, False)):
        a, b = pool[:1000], np.concatenate([pool[:shared], pool[2000 : 3000 - shared]])
        x = near_dedup.registers(np.concatenate([a, b]), np.array([1000, 1000]))
        more, less = (x[0] > x[1]).sum(), (x[0] < x[1]).sum()
        keep, at = near_dedup.hopeful(np.array([more]), np.array([less]), np.array([1000]), np.array([1000]), 80)
        assert keep[0] == expect
        assert abs(at[0] - shared / (2000 - shared)) < 0.15


def test_sketches_merge_by_maximum():
    values = np.random.default_rng(1).integers(0, 1 << 63, 900, np.uint64)
    whole = near_dedup.registers(values, np.array([900]))
    parts = near_dedup.registers(values, np.array([400, 500]))
    assert (whole[0] == parts.max(axis=0)).all()
