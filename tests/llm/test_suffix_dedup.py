from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from wattloom.llm import scan, suffix_dedup


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        rest = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(bool(g) and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize("length,small", [(200, 2048), (60, 3), (20, 1)])
def test_removal_matches_brute_force(docs, corpus, length, small, monkeypatch):
    """Also with anchors counted as very frequent, which are sorted by window digests."""
    monkeypatch.setattr(suffix_dedup, "SMALL", small)
    got = suffix_dedup.summary(docs, length).collect()
    want = [(r[0], *w) for r, w in zip(corpus, brute([r[1] for r in corpus], length))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_very_long_text_is_cut_into_slices(docs, corpus, monkeypatch):
    monkeypatch.setattr(scan, "SLICE", 3000)
    got = suffix_dedup.summary(docs, 50).collect()
    want = [(r[0], *w) for r, w in zip(corpus, brute([r[1] for r in corpus], 50))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_text_is_replaced_and_other_columns_stay(table, no_docs):
    same = "x" * 10 + "".join(chr(97 + i % 23) + str(i) for i in range(120))
    rows = [(1, same + " left", "k"), (None, "right " + same, "k"), (3, None, None), (3, None, None)]
    got = suffix_dedup.remove_repeats(table(rows, "doc_id long, text string, kept string"), 100).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, " left", "k"), (None, "right ", "k"), (3, None, None), (3, None, None)], key=str)
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    assert suffix_dedup.summary(no_docs).count() == 0


def test_rows_of_a_frequent_anchor_stand_for_many_windows(table, monkeypatch):
    """A line and a passage that many texts share: single windows are rows only where blocks agree in part."""
    rng = np.random.default_rng(3)
    say = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    line, passage = say(60), say(300)
    texts = [say(200) + (passage if i % 3 == 0 else line) + say(200) for i in range(120)]
    texts += [texts[0], texts[3][:150] + "#" + texts[3][151:], texts[4][:260] + "#" + texts[4][261:], None, "", line]
    kept, own = {}, suffix_dedup.written

    def counted(df, tag):
        out = own(df, tag)
        kept.setdefault(tag, []).append(out)
        return out

    monkeypatch.setattr(suffix_dedup, "written", counted)
    monkeypatch.setattr(suffix_dedup, "SMALL", 20)
    got = suffix_dedup.summary(table([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), 120).collect()
    want = [(i, *w) for i, w in enumerate(brute(texts, 120))]
    assert sorted(map(tuple, got)) == want
    parts = [len(r.part) for r in kept["run-texts"][0].filter("many").select("part").collect()]
    windows, rows = sum(parts) - 119 * len(parts), sum(x.count() for x in kept["blocks"])
    assert len(parts) > 100 and 3 * rows < windows
