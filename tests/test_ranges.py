from __future__ import annotations

import json
import random

import numpy as np
import pytest
from test_scenario import DOC

from wattloom.operators import scenario
from wattloom.sources import ranges, readers


def odd_document(rng, measures):
    """Names and texts with braces, quotes, escapes and commas; members of very different sizes."""
    marks = ['}', '{', '"', "\\", ",", "\\\\", '\\"', "é", "𝄞", " ", "\n", "]", "a"]
    word = lambda n: "".join(rng.choice(marks) for _ in range(rng.randrange(n)))
    doc = {}
    for k in range(measures):
        years = {str(2020 + j): round(rng.random(), 6) for j in range(rng.choice([1, 3, 200]))}
        doc[f"m{k}{word(6)}"] = {word(9) + str(j): {word(5) + "k": years} for j in range(rng.randrange(1, 5))}
    doc["last" + word(4)] = {"x}": 1}
    return doc


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", [200, 5_000, None])
def test_equal_to_the_whole_text_reader(spark, tmp_path, indent, size):
    rng = random.Random(7)
    for k in range(4):
        text = json.dumps(odd_document(rng, rng.randrange(0, 25)), indent=indent, ensure_ascii=k % 2 == 0)
        (tmp_path / f"s{k}.json").write_text(text + ("\n" if k % 2 else ""), encoding="utf-8")
    whole = readers.read_documents(spark, str(tmp_path))
    want = scenario.measure_objects(whole, keep=["scenario"]).collect()
    cut = ranges.read_measure_texts(spark, str(tmp_path), range_bytes=size)
    got = scenario.measure_bodies(cut, keep=["scenario"]).collect()
    key = lambda r: (r["scenario"], r["meas"])
    assert sorted(map(key, got)) == sorted(map(key, want))
    bodies = {key(r): r["body"] for r in want}
    assert all({n: json.loads(t) for n, t in r["body"].items()} == {n: json.loads(t) for n, t in bodies[key(r)].items()} for r in got)


def test_one_document_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    text = json.dumps({f"m{k}": {"a": {"b" * 50: k}} for k in range(2000)})
    (tmp_path / "one.json").write_text(text)
    parts = []
    real = ranges._cut

    def counted(keep):
        inner = real(keep)

        def apply(batches):
            from pyspark import TaskContext

            for batch in inner(batches):
                if len(batch):
                    (tmp_path / f"task-{TaskContext.get().partitionId()}").touch()
                yield batch

        return apply

    monkeypatch.setattr(ranges, "_cut", counted)
    got = ranges.read_measure_texts(spark, str(tmp_path / "one.json"), range_bytes=10_000)
    parts = list(tmp_path.glob("task-*"))
    assert len(parts) > 8 and got.count() == 1999
    assert got.select("scenario").distinct().collect()[0][0] == "one"


def test_rows_and_weights_of_a_scenario(spark, tmp_path, frame):
    (tmp_path / "ref.json").write_text(json.dumps(DOC, indent=1))
    cut = ranges.read_measure_texts(spark, str(tmp_path), range_bytes=64)
    docs = frame([(json.dumps(DOC),)], "value string")
    assert sorted(map(str, scenario.flatten_scenario(cut, "text", cut=True).collect())) == sorted(map(str, scenario.flatten_scenario(docs).collect()))
    assert sorted(map(str, scenario.gap_weights(cut, "text", cut=True).collect())) == sorted(map(str, scenario.gap_weights(docs).collect()))


@pytest.mark.parametrize(
    "text", ['{"a": {"b": 1}, "c": 1', '{"a": {"b": 1}', '{"a": "x', '{"a": 1}}', '{"a": 1} x', '{"a": 1}{"b": 2}', "[1, 2]", "x", '{"a": {"b": "}", "c": 1}'],
)
def test_a_document_that_is_not_one_object_fails(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="JSON object"):
        ranges.read_measure_texts(spark, str(tmp_path)).collect()


def test_empty_and_single_member_objects(spark, tmp_path):
    for k, text in enumerate(["{}", " { } \n", '{"a": 1}', '{"a": {"x": "1"}, "b": {}}\n\n']):
        (tmp_path / f"{k}.json").write_text(text)
    assert [r["meas"] for r in ranges.read_measure_texts(spark, str(tmp_path)).collect()] == ["a"]


def test_effects_compose():
    """The function of a text is that of its parts, wherever it is cut after a brace."""
    rng = random.Random(3)
    for _ in range(100):
        raw = "".join(rng.choice(['{', '}', '"', "\\", ",", "a", "["]) for _ in range(60)).encode() + b"}"
        cuts = [i + 1 for i, c in enumerate(raw) if c == ord("}")]
        at = rng.choice(cuts)
        if raw[at - 2 : at - 1] == b"\\":
            continue
        whole = ranges.Effect.of(np.frombuffer(raw, np.uint8), 0, 0)
        left = ranges.Effect.of(np.frombuffer(raw[:at], np.uint8), 0, 0)
        both = left.then(ranges.Effect.of(np.frombuffer(raw[at:], np.uint8), 0, at))
        assert both == whole
