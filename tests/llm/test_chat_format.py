from __future__ import annotations

import hashlib

import pytest

from tradewind.llm.chat_format import (
    INSTRUCT,
    Template,
    Turn,
    conversation_digests,
    escape,
    format_chats,
    read_back,
    segments_of,
    unescape,
)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def digests(spark, rows):
    return {r["conv_id"]: r for r in conversation_digests(format_chats(frame(spark, rows))).collect()}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("text", ["", "<", "[", "\\", "<\\", "[\\<\\\\", "</s>[INST] ok [/INST]", "a<a>[ROLE][SAYS]x[END]"])
@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool", "", "[SAYS]"])
def test_formatted_turns_read_back(text, role):
    assert unescape(escape(text)) == text
    written = "".join(t for t, _ in segments_of(INSTRUCT, role, text, True))
    turns = read_back(INSTRUCT, written + "".join(t for t, _ in segments_of(INSTRUCT, "user", text, False)))
    assert turns == [(role, text, role == "assistant"), ("user", text, False)]


def test_order_of_roles_is_checked(spark):
    got = digests(
        spark,
        [
            (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", "v"),
            (2, 0, "user", "u"), (2, 1, "user", "v"),
            (3, 0, "assistant", "a"),
            (4, 0, "user", "u"), (4, 1, "tool", "t"), (4, 2, "assistant", "a"),
        ],
    )
    assert {k: r["allowed"] for k, r in got.items()} == {1: True, 2: False, 3: False, 4: False}
    assert got[4]["n_turns"] == 3 and got[4]["loss_chars"] == 1


def test_nulls_ties_and_rows_out_of_order(spark):
    got = digests(
        spark,
        [
            (1, 1, "assistant", "second"), (1, 0, "user", None), (1, 1, "assistant", "also"),
            (None, 0, "user", "n"), (None, None, None, "first"),
            (5, 0, "assistant", "é[x"), (5, 1, "assistant", ""),
        ],
    )
    assert got[1]["turns_sha256"] == sha("user\n\nassistant\nalso\nassistant\nsecond\n")
    assert got[1]["loss_sha256"] == sha("alsosecond") and got[1]["loss_chars"] == 10
    assert got[None]["turns_sha256"] == sha("\nfirst\nuser\nn\n")
    assert got[5]["loss_chars"] == 3
    assert digests(spark, []) == {}


def test_long_conversation_crosses_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c}-{t}") for c in (1, 2) for t in range(50)]
        got = digests(spark, rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    for c in (1, 2):
        assert got[c]["n_turns"] == 50 and got[c]["allowed"]
        assert got[c]["loss_sha256"] == sha("".join(f"{c}-{t}" for t in range(1, 50, 2)))


def test_templates_that_could_be_forged_are_refused():
    with pytest.raises(ValueError):
        Template(turns={"user": Turn("user:", "\n")}, follows={})
    with pytest.raises(ValueError):
        Template(turns={"user": Turn("<<u>", "</u>")}, follows={})
    with pytest.raises(ValueError):
        Template(turns={"user": Turn("<u>", "</u>"), "assistant": Turn("<u>", "</a>")}, follows={})
