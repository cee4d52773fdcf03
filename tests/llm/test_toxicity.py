from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from wattloom.llm import toxicity as tox

LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("You are a complete idiot.", "directed"),
        ("What an idiot you are!", "directed"),
        ("the idiot went home", "insult"),
        ("She said you are an idiot.", "reported"),
        ('He wrote: "You are all idiots. An idiot." ', "reported"),
        ("You are not an idiot.", "denied"),
        ("You aren’t stupid", "denied"),
        ("I will kill you", "threat"),
        ("we're going to hunt them down", "threat"),
        ("kill yourself", "wish"),
        ("I will not kill you", None),
        ("he said he will kill you", None),
        ("the bug will kill the process", None),
        ("killing time in trashcans", None),
        ("", None),
    ],
)
def test_clauses(text, kind):
    counts = dict(zip(tox.KINDS, tox.Grammar(tox.INSULTS).count(text).tolist()))
    assert {k: n for k, n in counts.items() if n} == ({kind: 1} if kind else {})


def test_attacks_of_a_clause_add_up():
    own = tox.Grammar()
    text = "you idiot, you moron, I will kill you. The scum left.\nNot an idiot"
    counts = dict(zip(own.kinds, own.count(text).tolist()))
    assert {k: n for k, n in counts.items() if n} == {"threat": 1, "directed": 2, "insult": 1, "denied": 1}


def test_learned_stems_are_read_by_the_same_grammar():
    own = tox.Grammar(stems=["zorg"])
    for text, kind in (("a Zorgling", "learned"), ("not zorglings", "denied"), ("she said zorg", "reported"), ("ozorg", None)):
        counts = dict(zip(own.kinds, own.count(text).tolist()))
        assert {k: n for k, n in counts.items() if n} == ({kind: 1} if kind else {})


def test_composition_equals_one_after_another():
    parts = [tox.reported_speech(), tox.negation(), tox.target(), tox.threat(), tox.insult()]
    whole, rng = tox.grammar(), np.random.default_rng(2)
    for _ in range(300):
        symbols = rng.choice(tox.WORD, 25).tolist()
        want = symbols
        for part in parts:
            state, out = part.start, []
            for s in want:
                state, mid = part.step(state, s)
                out.append(mid)
            want = out
        state, got = whole.start, []
        for s in symbols:
            state, mid = whole.step(state, s)
            got.append(mid)
        assert got == want


def data(n=600):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        own = rng.choice(words, 30).tolist()
        bad = i % 4 == 0
        for _ in range(3 if bad else 0):
            own.insert(int(rng.integers(30)), ["zorg" + str(rng.choice(["ling", "i", "ers", "a"])), "moron"][i % 8 // 4])
        rows.append((i, " ".join(own) + ".", float(i)))
        labels.append((i, 1, int(bad) if rng.random() > 0.03 else 1))
    return rows, labels


def test_held_out_accuracy_with_a_learned_word(table):
    rows, labels = data()
    docs = table(rows, "doc_id long, text string, score double")
    model = tox.learn(docs, table(labels[:450], LABELS))
    assert "zor" in model.stems and len(model.stems) < 5
    got = tox.score(docs, model).collect()
    held = [r for r in got if r["doc_id"] >= 450]
    assert all((r["score"] >= tox.THRESHOLD) == (r["doc_id"] % 4 == 0) for r in held)
    plain = tox.Grammar(model.insults, model.stems)
    for r in held:  # the score again, from the text
        z = np.log2(1 + plain.count(r["text"])) @ model.weights[:-1] + model.weights[-1]
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-z)))


def test_copies_are_one_context(table):
    rows = [(i, "the same words in every copy of this text", 0) for i in range(80)]
    rows += [(100 + i, f"w{i} nice words x{i} here", 0) for i in range(40)]
    docs = table(rows, "doc_id long, text string, n int")
    labels = table([(i, 1, 1) for i in range(80)] + [(100 + i, 1, 0) for i in range(40)], LABELS)
    model = tox.learn(docs, labels)
    assert not model.stems and model.insults == tox.INSULTS


def test_sample_bound_conflicting_and_null_labels(table):
    rows, labels = data()
    docs = table(rows, "doc_id long, text string, n double")
    more = [*labels, (None, 1, 0), (5, 1, None), (6, 0, 0), (6, 1, 1)]
    a = tox.learn(docs, table(more, LABELS), limit=100)
    b = tox.learn(docs.repartition(5), table(more, LABELS), limit=100)
    assert a.insults == b.insults and a.stems == b.stems and np.allclose(a.weights, b.weights)


def test_odd_texts_missing_labels_and_clashing_names(table, corpus, no_docs):
    docs = table([(*r, "kept") for r in corpus], "doc_id long, text string, n long, __text_to_score string")
    for labels in ([], [(1, 1, 0)], [(1, 0, 1)]):
        model = tox.learn(docs, table(labels, LABELS))
        got = tox.score(docs, model).collect()
        assert len(got) == len(corpus) and {r["__text_to_score"] for r in got} == {"kept"}
        assert all(0 <= r["score"] < tox.THRESHOLD for r in got)
    assert tox.score(no_docs, model).count() == 0
    x = tox.Grammar(tox.INSULTS).features(pa.array(["", "idiot " * 50_000, "x" * 100_000]))
    assert x[:, 2].tolist() == [0, np.log2(50_001), 0]
