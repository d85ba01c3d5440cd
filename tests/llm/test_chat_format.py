"""Windows read back to their turns; budget, history and mask."""

import hashlib

import pytest

from tidemark.llm import chat_format as C

TURNS = [
    (1, 0, "system", "Be <brief> \\ and kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hi </turn> there\n"),
    (1, 3, "user", None), (1, 4, "assistant", ""), (2, 0, "user", "x " * 4000), (2, 1, "assistant", "yes " * 3000),
    (3, None, None, "no turn"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"), (3, 1, "assistant", "B"),
    (None, 0, "user", "no id"), (4, 0, "system", "only a system turn"),
] + [(5, k, ("user", "assistant")[k % 2], f"turn {k} " * 60) for k in range(30)]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(TURNS, SCHEMA)


def expected(turns):
    out = {}
    for conv in {t[0] for t in turns}:
        own = [t for t in turns if t[0] == conv]
        own.sort(key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        chars = sum(len(C.render(t[2] or "", t[3] or "")[0]) for t in own)
        out[conv] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


@pytest.mark.parametrize(("budget", "history"), [(1024, 256), (64, 0), (200, 500), (1, 1)])
def test_windows_read_back_to_the_conversations(turns, budget, history):
    got = C.read_back(C.format_windows(turns, budget, history)).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == expected(TURNS)


def test_budget_history_and_system_turn(turns):
    rows = [r for r in C.format_windows(turns, 600, 200).collect() if r["conv_id"] in (1, 5)]
    long = [r for r in rows if r["conv_id"] == 5]
    assert len(long) > 3 and all(r["n_tokens"] <= 600 for r in long)
    assert all(r["n_repeated"] > 0 for r in long if r["window"])
    for r in long:  # repeated targets are masked
        told = C.parse(r["text"])[r["n_repeated"] :]
        assert len(r["loss_spans"]) == sum(role == "assistant" for role, *_ in told)


def test_system_turn_is_in_every_window(spark):
    rows = [(1, 0, "system", "rules")] + [(1, k, "user", f"message {k} " * 20) for k in range(1, 12)]
    got = C.format_windows(spark.createDataFrame(rows, SCHEMA), 200, 60).collect()
    assert len(got) > 2 and all(C.parse(r["text"])[0][:2] == ("system", "rules") for r in got)


def test_control_conversation_and_empty_table(spark, turns):
    got = {r["conv_id"]: r for r in C.formatting_report(turns.withColumnsRenamed({})).collect()}
    assert got[-7]["n_turns"] == 2 and got[-7]["loss_chars"] == 26
    none = spark.createDataFrame([], SCHEMA)
    assert C.format_windows(none).count() == 0
    assert [r["conv_id"] for r in C.formatting_report(none).collect()] == [-7]


def test_escape_is_reversible():
    for text in ("", "\\", "<turn a>", "\\<\\\\>", "</turn>\n<turn user>x"):
        assert C.unescape(C.escape(text)) == text
        assert C.parse(C.render(text, text)[0])[0][:2] == (text, text)
