"""Chat formatting: exact round trips of turns and trained replies."""

from reviewlake.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "\\e\\l\\b", "[ROLE:x] y [/ROLE]", "<", "]", "", " ", "a\nb\n", "\\", "é😀<s>"]


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string, example int")


def test_round_trip(spark):
    rows = [(conv, at, role, text, None, 7) for conv in range(3) for at, text in enumerate(NASTY)
            for role in [("user", "assistant", "system", "tool [x]", "")[(conv + at) % 5]]]
    formatted = chat.format_conversations(turns(spark, rows))
    back = formatted.select("conv_id", chat.read_turns(formatted.formatted).alias("turns")).collect()
    for row in back:
        want = [(role, text) for conv, _, role, text, _, _ in sorted(rows, key=lambda x: x[:2]) if conv == row.conv_id]
        assert [(turn.role, turn.text) for turn in row.turns] == want


def test_examples(spark):
    rows = [(1, 0, "user", "q [1]", None, 1), (1, 1, "assistant", "a1", None, 1), (1, 2, "user", "q2", None, 1),
            (1, 3, "assistant", "<a2>", None, 1), (2, 0, "user", "alone", None, 1)]
    examples = chat.expand_targets(chat.format_conversations(turns(spark, rows))).orderBy("conv_id", "example").collect()
    assert [(x.conv_id, x.example) for x in examples] == [(1, 0), (1, 1), (2, None)]
    assert examples[0].prompt == "[INST] q \\b1\\r [/INST]<s> " and examples[0].target == "a1 </s>"
    assert examples[1].prompt == "[INST] q \\b1\\r [/INST]<s> a1 </s>[INST] q2 [/INST]<s> "
    text = examples[1].prompt + examples[1].target
    assert text[examples[1].loss_start:examples[1].loss_start + examples[1].loss_length] == "\\la2\\g"


def test_odd_rows(spark):
    rows = [(None, None, None, None, None, None), (None, 0, "assistant", None, None, None), (5, 0, "user", "x", None, 0),
            (5, 0, "user", "x", None, 0), (6, 0, "assistant", "y" * 300_000, None, 0)]
    got = {row.conv_id: row for row in chat.digest_examples(
        chat.expand_targets(chat.format_conversations(turns(spark, rows)))).collect()}
    assert got[None].n_turns == 2 and got[None].loss_chars == 0
    assert got[5].n_turns == 2 and got[5].loss_chars == 0
    assert got[6].loss_chars == 300_000
    assert chat.format_conversations(turns(spark, [])).count() == 0


def test_no_python(spark):
    df = chat.digest_examples(chat.expand_targets(chat.format_conversations(turns(spark, []))))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
