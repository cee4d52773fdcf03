from __future__ import annotations

import numpy as np
import pytest

from wattloom.llm import langid

SCHEMA = "doc_id long, text string, lang string, score double"
PARTS = {"aa": ["pel", "tor", "mun", "sak"], "bb": ["éli", "oux", "eau", "ché"], "cc": ["zzy", "qx", "wvu", "kkj"]}


def say(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang], 3)) for _ in range(n))


@pytest.fixture
def model(table):
    rng = np.random.default_rng(0)
    rows = [(i, say(rng, lang, 30), lang, 0.0) for i in range(40) for lang in PARTS]
    return langid.learn(table([*rows, (1, None, "aa", 0.0), (2, "x", None, 0.0)], SCHEMA))


def test_languages_mixtures_and_texts_without_letters(table, model):
    rng = np.random.default_rng(1)
    rows = [(i, say(rng, lang, 12), lang, 9.0) for i in range(10) for lang in PARTS]
    mixed = say(rng, "aa", 60) + " " + say(rng, "bb", 40)
    odd = [(100, mixed, None, 0.0), (101, None, None, 0.0), (102, "", None, 0.0), (103, "12 !! 3", None, 0.0), (None, "pel", None, 0.0)]
    got = {(r["doc_id"], r["lang"]): r for r in langid.predict(table(rows + odd, SCHEMA), model).collect()}
    assert all(r["lang_pred"] == k[1] for k, r in got.items() if k[1])
    r = got[(100, None)]
    assert r["lang_pred"] == "aa" and r["score"] == pytest.approx(0.6, abs=0.03)
    assert set(k for k, v in r["shares"].items() if v > 0) == {"aa", "bb"}
    for k in (101, 102, 103):
        assert (got[(k, None)]["lang_pred"], got[(k, None)]["score"]) == ("und", 0.0)
    assert got[(None, None)]["lang_pred"] == "aa"


def test_nothing_learned_and_empty_table(table, no_docs):
    empty = table([], SCHEMA)
    none = langid.learn(empty)
    assert [r["lang_pred"] for r in langid.predict(table([(1, "word", "x", 0.0)], SCHEMA), none).collect()] == ["und"]
    assert langid.predict(no_docs, none).count() == 0


def test_counts_match_brute_force(table):
    texts = ["Ab c", "é\nab", "", "abab"]
    got = langid.count_grams(table([(1, t, "x", 0.0) for t in texts], SCHEMA), "text", "lang").collect()
    grams = sum(len(w.encode()) for t in texts for w in t.split())
    assert sum(r["n"] for r in got) == grams  # one trigram around each byte of a word
