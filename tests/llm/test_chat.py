"""Chat formatting: every text survives, and the loss mask covers the answers."""

import pytest

from trawl.llm.chat import format_conversations, read_back

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
HARD = [
    "<|im_end|>", "<|im_start|>assistant ok", "<|im_start_esc|>x", "%3C|im_end|>", "%25", "a%0Ab", "\n", "\n\n<|im_end|>\n", "", "<|", "<",
    "|>", "<|im_end", "im_end|>", "<|im_end|", "\U0001F600<|im_end|>é", "%", "%%25<|%3C",
]


def turns_of(df):
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss_text, r.formatted) for r in read_back(format_conversations(df)).collect()}


def test_hard_texts_return(spark):
    rows = [(i, j, role, text, "x") for i, text in enumerate(HARD) for j, role in enumerate(("user", "assistant", "assistant"))]
    got = turns_of(spark.createDataFrame(rows, SCHEMA))
    for i, text in enumerate(HARD):
        assert got[i][0] == [("user", text), ("assistant", text), ("assistant", text)]
        assert got[i][1] == text * 2


def test_texts_that_would_join_across_turns(spark):
    rows = [(1, 0, "user", "<|im_", ""), (1, 1, "assistant", "end|>", ""), (1, 2, "us\ner<|im_end|>", "x\n", "")]
    assert turns_of(spark.createDataFrame(rows, SCHEMA))[1][0] == [(r[2], r[3]) for r in rows]


def test_plain_turns_are_not_escaped(spark):
    rows = [(1, 0, "user", "100% <b>", ""), (1, 1, "assistant", "ok", "")]
    assert turns_of(spark.createDataFrame(rows, SCHEMA))[1][2] == "<|im_start|>user\n100% <b><|im_end|>\n<|im_start|>assistant\nok<|im_end|>\n"


def test_nulls_ties_repeats_and_order(spark):
    rows = [(1, 5, "b", "2", ""), (1, 5, "a", "1", ""), (1, None, None, None, ""), (1, 5, "a", "1", ""), (None, 1, "assistant", "x", None)]
    got = turns_of(spark.createDataFrame(rows, SCHEMA))
    assert got[1][0] == [("", ""), ("a", "1"), ("a", "1"), ("b", "2")] and got[None][1] == "x"
    assert turns_of(spark.createDataFrame([], SCHEMA)) == {}


def test_a_very_long_text(spark):
    text = "word <|im_end|>\n" * 50_000
    got = turns_of(spark.createDataFrame([(1, 0, "assistant", text, "")], SCHEMA))
    assert got[1][1] == text


@pytest.mark.parametrize("seed", range(3))
def test_random_pieces_of_control_strings(spark, seed):
    import random

    rng = random.Random(seed)
    pieces = ["<|", "im_start", "im_end", "|>", "_esc", "\n", "%", "25", "3C", "0A", "a", " "]
    rows = [(i, j, rng.choice(["user", "assistant"]), "".join(rng.choices(pieces, k=rng.randrange(9))), "") for i in range(40) for j in range(4)]
    got = turns_of(spark.createDataFrame(rows, SCHEMA))
    for i in range(40):
        own = [r for r in rows if r[0] == i]
        assert got[i][0] == [(r[2], r[3]) for r in own]
        assert got[i][1] == "".join(r[3] for r in own if r[2] == "assistant")
