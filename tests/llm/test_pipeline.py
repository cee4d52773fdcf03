from __future__ import annotations

import re

import numpy as np
import pytest

from wattloom.llm import scan

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_words_match_a_pattern(corpus):
    import pyarrow as pa

    texts = [r[1] for r in corpus]
    data, offsets = scan.buffers(pa.array(texts))
    seen = {}
    for a, b, hashes, counts, _ in scan.words(data, offsets):
        at = 0
        for text, n in zip(texts[a:b], counts):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
            own = re.findall(r"[^\x20\x09-\x0D]+", low)
            assert len(own) == n
            for word, h in zip(own, hashes[at : at + n]):
                assert seen.setdefault(word, h) == h
            at += n
    assert len(set(seen.values())) == len(seen)


def test_long_text_is_hashed_in_pieces(monkeypatch):
    import pyarrow as pa

    text = " ".join(f"w{i % 97}" for i in range(4000)) + " " + "y" * 5000 + " end"
    data, offsets = scan.buffers(pa.array([text]))
    whole = next(scan.words(data, offsets))[2]
    monkeypatch.setattr(scan, "SLICE", 1000)
    cut = next(scan.words(data, offsets))[2]
    assert (whole == cut).all() and len(cut) == 4002


def test_stages_in_a_row(spark, table, tmp_path):
    """Rejected, copied, near-copied and repeated material goes; the clean rest stays and is packed."""
    import corpus_pipeline

    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(3, 8)))
    say = lambda n: " ".join(word() for _ in range(n))
    rows, labels = [], []

    def put(text, good):
        rows.append((len(rows), text, "en", "s", len(text)))
        labels.append((len(labels), int(good), 0))

    for _ in range(60):
        put(say(120), True)
    for _ in range(20):
        put(" ".join([word() + "###"] * 50), False)
    base = rows[0][1].split()
    put(rows[1][1], True)  # a copy: the larger id stays
    put(" ".join([*base[:60], "changed", *base[61:]]), True)  # a near copy
    passage = say(60)
    for _ in range(3):
        put(say(50) + " " + passage + " " + say(50), True)
    folder = str(tmp_path)
    docs = table(rows, COLUMNS)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    table(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]
    left = docs
    results = []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, left, folder).write.parquet(path)
        left = spark.read.parquet(path)
        results.append(left)
        if name != "packing":
            assert left.columns == docs.columns
    ids = [sorted(r[0] for r in x.select("doc_id").collect()) for x in results[:4]]
    clean = [r[0] for r in rows if "###" not in r[1]]
    assert ids[0] == clean
    assert ids[1] == [i for i in clean if i != 1]
    assert ids[2] == [i for i in ids[1] if i != 81] and ids[3] == ids[2]
    texts = {r["doc_id"]: r for r in results[3].collect()}
    assert all(passage[50:250] not in texts[i]["text"] for i in (82, 83, 84))
    assert texts[5]["text"] == rows[5][1] and all(r["n_chars"] == len(r["text"]) for r in texts.values())
    pieces = results[4].collect()
    assert {p["doc_id"] for p in pieces} == set(ids[3])
    done = corpus_pipeline.run(spark, folder)
    assert done.agg({"length": "sum"}).first()[0] == sum(p["length"] for p in pieces)


def test_columns_of_any_name_survive(spark, table):
    """Every name that the stages use inside, as a user's column."""
    from pyspark.sql import functions as F

    from wattloom.llm import exact_dedup, langid, near_dedup, quality, suffix_dedup, toxicity

    inside = "__a __b __k __k1 __k2 __id __rest __text __digest __text_to_score __text_to_identify __text_to_score_ k1 k2 kept digest n batch".split()
    rng = np.random.default_rng(9)
    say = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))
    shared = say(60)
    texts = [say(80) for _ in range(8)] + [say(30) + " " + shared, say(30) + " " + shared, None]
    rows = [(i, t, *[f"{c}{i}" for c in inside]) for i, t in enumerate([*texts, texts[0]])]
    rows.append(rows[1])
    docs = table(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in inside))
    labels = table([(i, i % 2, i % 2) for i in range(8)], "doc_id long, quality int, toxic int")
    langs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "x").otherwise("y"))
    for got in (
        suffix_dedup.remove_repeats(docs, 200),
        near_dedup.keep_one(docs, 5, 80),
        exact_dedup.keep_new(docs, exact_dedup.new_index(spark, 2)),
        quality.score(docs, quality.learn(docs, labels)),
        langid.predict(docs, langid.learn(langs)),
        toxicity.score(docs, toxicity.learn(docs, labels)),
    ):
        assert got.columns[: len(docs.columns)] == docs.columns
        found = got.collect()
        assert found and all(r[c] == f"{c}{r['doc_id']}" for r in found for c in inside)


def test_run_on_odd_and_empty_tables(spark, table, tmp_path):
    """Null texts and ids, no labels, no documents."""
    import corpus_pipeline

    odd = [(None, "no id", None, None, None), (1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0)]
    for k, rows in enumerate((odd, [])):
        folder = f"{tmp_path}/{k}"
        table(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
        table([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        done = corpus_pipeline.run(spark, folder)
        # without labels every score is 0.5, below the threshold
        assert done.count() == 0 and "sequence_id" in done.columns


def test_registration():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op5_chat", "op8_exact_dedup", "op11_negatives"])
def test_queries_match_their_sql(spark, name):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
    from compare import compare, connect

    from wattloom.llm.queries import ORACLE, QUERIES

    folder = "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, folder).toPandas(), connect(folder).execute(ORACLE[name]).df()) == "ok"
