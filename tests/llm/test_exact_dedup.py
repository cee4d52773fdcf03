from __future__ import annotations

import hashlib
from collections import Counter

from wattloom.llm import exact_dedup


def brute(rows):
    groups, count = {}, Counter()
    for r in rows:
        t = r[1] or ""
        count[t] += 1
        if r[0] is not None:
            groups[t] = max(groups.get(t, r[0]), r[0])
    out = []
    for r in rows:
        t = r[1] or ""
        out.append((r[0], groups.get(t), count[t], r[0] == groups.get(t), hashlib.sha256(t.encode()).hexdigest()))
    return out


def test_new_index_matches_brute_force(spark, docs, corpus):
    got = exact_dedup.deduplicate(docs, exact_dedup.new_index(spark, 4)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(corpus), key=str)


def test_second_batch_is_deduplicated_against_the_first(spark, table):
    index = exact_dedup.new_index(spark, 4)
    schema = "doc_id long, text string, digest string"
    first = exact_dedup.keep_new(table([(1, "a", "x"), (2, "b", "x"), (3, "a", "x")], schema), index)
    assert sorted(r[0] for r in first.collect()) == [2, 3]
    rows = table([(9, "a", None), (10, "c", None), (11, "c", None), (None, None, "y")], schema)
    got = {r["doc_id"]: r for r in exact_dedup.deduplicate(rows, index).collect()}
    assert (got[9]["keep_id"], got[9]["kept"], got[9]["group_size"]) == (3, False, 1)
    assert (got[10]["kept"], got[11]["kept"], got[None]["kept"]) == (False, True, True)
    assert index.read(spark).count() == 4
    again = exact_dedup.DigestIndex("digests_again", index.path, 4).attach(spark)
    assert exact_dedup.keep_new(rows, again).count() == 0


def test_a_batch_run_again_gives_the_same_decisions(spark, table):
    """Also where the first run was lost after a part of the append."""
    index = exact_dedup.new_index(spark, 4)
    schema = "doc_id long, text string"
    exact_dedup.deduplicate(table([(1, "a")], schema), index, batch="one").collect()
    rows = table([(5, "a"), (6, "b"), (7, "b"), (8, "c"), (None, "d")], schema)
    first = sorted(map(tuple, exact_dedup.deduplicate(rows, index, batch="two").collect()), key=str)
    size = index.read(spark).count()
    again = sorted(map(tuple, exact_dedup.deduplicate(rows, index, batch="two").collect()), key=str)
    assert again == first and index.read(spark).count() == size == 4
    assert sorted(str(r[0]) for r in exact_dedup.keep_new(rows, index, batch="two").collect()) == ["7", "8", "None"]
    assert exact_dedup.keep_new(rows, index, batch="three").count() == 0
    torn = exact_dedup.new_index(spark, 4)
    exact_dedup.deduplicate(table([(1, "a")], schema), torn, batch="one").collect()
    exact_dedup.deduplicate(rows.filter("text = 'b'"), torn, batch="two").collect()  # a part of it
    whole = sorted(map(tuple, exact_dedup.deduplicate(rows, torn, batch="two").collect()), key=str)
    assert whole == first


def test_repeated_rows_keep_one_and_empty_batch(spark, table, no_docs):
    rows = [(1, "a", 0), (1, "a", 0), (2, "", 0), (2, None, 0), (None, "z", 0), (None, "z", 0)]
    index = exact_dedup.new_index(spark, 2)
    got = exact_dedup.keep_new(table(rows, "doc_id long, text string, n long"), index).collect()
    assert sorted((str(r[0]), r[1] or "") for r in got) == [("1", "a"), ("2", ""), ("None", "z")]
    assert exact_dedup.deduplicate(no_docs, exact_dedup.new_index(spark, 2)).count() == 0


def test_no_python_on_the_main_path(spark, docs):
    df = exact_dedup.deduplicate(docs, exact_dedup.new_index(spark, 4))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
