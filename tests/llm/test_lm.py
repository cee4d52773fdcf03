from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wattloom.llm import lm


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


@pytest.mark.parametrize("head", [200_000, 5])
def test_counts_and_base_score(docs, corpus, head, monkeypatch):
    """With a small head the counts of most words are joined."""
    monkeypatch.setattr(lm, "HEAD", head)
    count = Counter(t for r in corpus if fold(r[0]) % 7 != 2 for t in tokens(r[1]))
    n, v = sum(count.values()), len(count)
    want = {}
    for r in corpus:
        own = tokens(r[1])
        base = sum(math.log10((count[t] + 1) / (n + v + 1)) for t in own)
        want[r[0]] = (fold(r[0]) % 7 == 2, len(own), sum(count[t] > 0 for t in own), n, base)
    got = lm.score_texts(docs).collect()
    assert len(got) == len(corpus)
    for r in got:
        w = want[r["doc_id"]]
        assert tuple(r)[1:5] == w[:4]
        assert r["base_score"] == pytest.approx(w[4], rel=1e-9)
        assert r["score"] < 0


def test_probabilities_are_normalised():
    rng = np.random.default_rng(0)
    noise = rng.dirichlet(np.ones(lm.CLASSES))
    vocab = lm.Vocabulary(1, 1, np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), np.zeros(32), noise)
    model = lm.Model.of(vocab, [rng.normal(0, 0.3, s) for s in lm.SHAPE])
    for one, two in ((3, 4), (lm.CLASSES, lm.CLASSES), (0, lm.CLASSES)):
        cls = np.arange(lm.CLASSES)
        assert (10 ** model.log10(cls, np.full(len(cls), one), np.full(len(cls), two))).sum() == pytest.approx(1, abs=1e-4)


def test_held_out_texts_are_likelier_than_by_frequencies(table):
    """Texts in two languages: context tells which."""
    rng = np.random.default_rng(2)
    sides = [[f"{p}{i}" for i in range(60)] for p in "uv"]
    rows = [(i, " ".join(rng.choice(sides[i % 2], 200))) for i in range(1600)]  # one pass, as at any size
    got = lm.score_texts(table(rows, "doc_id long, text string")).toPandas()
    held = got[got.held_out]
    assert len(held) > 20 and held.score.sum() > held.base_score.sum() * 0.95


def test_repeated_rows_and_empty_table(table, no_docs):
    assert lm.score_texts(no_docs).count() == 0
    rows = [(5, "b c d", 1.0)] * 3 + [(None, None, 2.0)]
    got = lm.score_texts(table(rows, "doc_id long, text string, score double")).collect()
    assert len(got) == 4 and len({tuple(r) for r in got}) == 2


def test_classes_grow_with_the_words(table):
    """Four times the distinct words: twice the classes and parameters, all of them trained."""
    sizes = []
    for words in (400_000, 1_600_000):
        rows = table([(0, 1)], "a int, b int").selectExpr(f"explode(sequence(1L, {words}L)) AS token")
        vocab = lm.vocabulary(rows.selectExpr("token", "0 AS shape", "if(token <= 3000, 9L, 1L) AS n"))
        assert (vocab.classes >= 0).sum() == vocab.words
        sizes.append((vocab.words, [x.shape[0] for x in lm.initial(vocab.noise, vocab.near)]))
    (small, _), (large, shape) = sizes
    assert small > lm.WORDS and large == pytest.approx(2 * small, rel=0.01)
    n = large + 32
    assert shape == [lm.CONTEXTS + 33, lm.WIDTH, lm.WIDTH, n, n]  # contexts are bounded
    trainer = lm.Trainer(lm.initial(vocab.noise, vocab.near), vocab.noise, 1)
    at = np.arange(large - 1000, large)
    before = [x.copy() for x in trainer.p]
    trainer.learn(at, at % 1000, at % 1000)
    assert (trainer.p[3][at] != before[3][at]).any(axis=-1).all()
    assert (trainer.p[0][:1000] != before[0][:1000]).any(axis=-1).all()
    assert lm.Model.of(vocab, trainer.p).norm.nbytes < 18e6


def test_score_of_a_text_token_by_token(docs, corpus, monkeypatch):
    """The score again in plain Python, from the parameters and the counts; few words are contexts."""
    monkeypatch.setattr(lm, "CONTEXTS", 40)
    kept = {}
    monkeypatch.setattr(lm.Model, "of", staticmethod(lambda vocab, p, of=lm.Model.of: kept.update(p=p, v=vocab) or of(vocab, p)))
    got = {(r["doc_id"], r["n_tokens"]): r["score"] for r in lm.score_texts(docs).collect()}
    (r, c1, c2, q, bias), vocab = kept["p"], kept["v"]
    count, distinct = Counter(), set()
    for d in corpus:
        if fold(d[0]) % 7 != 2:
            count.update(tokens(d[1]))
    for doc_id, text, _ in corpus[:30]:
        (_, _, hashes, _, shapes), = lm.tokens(pa.array([text or ""]))
        cls, _, _ = vocab.look_up(hashes, shapes)
        near = [int(c) if c < 40 else 40 + int(s) for c, s in zip(cls, shapes)]
        total = 0.0
        for k, (c, word) in enumerate(zip(cls, tokens(text))):
            one = near[k - 1] if k else 72
            two = near[k - 2] if k > 1 else 72
            h = r[one].astype(float) @ c1 + r[two].astype(float) @ c2
            z = q.astype(float) @ h + bias
            total += (z[c] - np.log(np.exp(z - z.max()).sum()) - z.max()) / np.log(10)
            if c >= vocab.words:
                total += np.log10(count[word] + 1) - vocab.rest[c - vocab.words]
        assert got[doc_id, len(hashes)] == pytest.approx(total, rel=1e-4)
