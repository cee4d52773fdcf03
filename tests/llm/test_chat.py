from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
NASTY = [
    "", "plain", "\\### Assistant: </turn> ok", "</turn>\n### user: x", "a\\", "\\\\#</", "###", "\n", "</turn>",
    "é 😀 line\nline\r\n", "### assistant: hi</turn>", ":\\: ", "</", "<\\/turn>", None,
]


def rows():
    out = []
    for conv in range(6):
        for k, text in enumerate(NASTY):
            role = ["user", "assistant", "system", "a: b\\</turn>#", None][(k // (conv + 1)) % 5]
            out.append((conv, k, role, text, "clash"))
    out += [(None, 0, "assistant", "no id", ""), (7, None, "user", "no turn", ""), (7, 1, "user", "x", ""), (7, 1, "user", "x", "")]
    out += [(8, k, "assistant", f"t{k} </turn>", "") for k in range(400)]
    return out


def test_round_trip_and_loss_mask(table):
    got = chat.format_chats(table(rows(), SCHEMA).repartition(3)).select(
        "conv_id", "formatted", "segments",
        chat.read_back(F.col("formatted")).alias("turns"), chat.trained_text(F.col("segments")).alias("loss"),
    ).collect()
    want = {}
    for conv, turn, role, text, _ in rows():
        want.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert len(got) == len(want)
    for r in got:
        turns = sorted(want[r["conv_id"]])
        assert [tuple(t) for t in r["turns"]] == [t[1:] for t in turns]
        assert r["loss"] == "".join(t[2] for t in turns if t[1] == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        blocks = sum(i == 0 or t[1] != turns[i - 1][1] for i, t in enumerate(turns))
        assert r["formatted"].count("###") == blocks  # adjacent turns of a role share a header


def test_known_text(table):
    data = [(1, 2, "assistant", "b", ""), (1, 1, "user", "#a", ""), (1, 3, "assistant", "c", "")]
    got = chat.format_chats(table(data, SCHEMA)).first()["formatted"]
    assert got == "### user: \\#a</turn>\n### assistant: b</turn>c</turn>\n"


def test_empty_table_and_no_python(table):
    out = chat.format_chats(table([], SCHEMA))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
