from __future__ import annotations

import random

import pytest

WORDS = "ka lo mi nu po ra se ti vu wex yon zal bru dem fip gol".split()


@pytest.fixture
def table(spark):
    """Rows -> DataFrame, written nowhere."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def corpus() -> list[tuple]:
    """Documents with copies, near copies, shared passages, odd texts, nulls and an extra column."""
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))
    base, passage = say(120), say(60)
    texts = [base] * 3
    for k in range(12):  # near copies: a few words changed
        words = base.split()
        for _ in range(k):
            words[rng.randrange(len(words))] = "new" + str(k)
        texts.append(" ".join(words))
    texts += [say(20) + " " + passage + " " + say(20) for _ in range(6)]
    texts += [say(rng.randrange(1, 80)) for _ in range(25)]
    texts += [None, "", " \n\t ", "one", "One", "two words", "a" * 900, "ab" * 500, "é" * 300, "日本語 " * 120]
    texts += [passage, passage + "\n" + passage]
    texts.append(" ".join(say(5) for _ in range(3000)))
    return [(i * 3 - 5, t, i % 4) for i, t in enumerate(texts)] + [(None, "a row without an id", 1)]


SCHEMA = "doc_id long, text string, n long"


@pytest.fixture
def docs(table, corpus):
    return table(corpus, SCHEMA).repartition(3)


@pytest.fixture
def no_docs(table):
    return table([], SCHEMA)
