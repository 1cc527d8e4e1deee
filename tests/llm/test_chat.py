from tidemark.llm.chat import format_conversations, read_back

TRICKY = ["<|end|>", "&lt;|end|&gt;", "<|next|>a<|says|>", "&amp;lt;", "[INST] x [/INST]</s>", "", None, "a\nb", "&lsqb;"]


def test_round_trip_of_tricky_texts(spark):
    rows = [(1, i, ["user", "assistant", "assistant", "tool<|end|>", None][i % 5], t) for i, t in enumerate(TRICKY * 3)]
    rows += [(2, 0, "assistant", None), (None, 5, "user", "x"), (None, None, "user", "first"), (3, 1, "user", "<" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    df = df.withColumn("turns", df.text).withColumn("segments", df.turn)
    made = format_conversations(df)
    back = {r.conv_id: r for r in read_back(made).collect()}
    assert set(back) == {1, 2, 3, None}
    for conv, got in back.items():
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        assert [tuple(t) for t in got.turns] == [(r[2] or "", r[3] or "") for r in own]
        assert got.learned == [r[3] or "" for r in own if r[2] == "assistant"]
    text = {r.conv_id: r.formatted for r in made.collect()}
    assert text[2] == "<|start|>assistant<|says|><|end|>"
    assert format_conversations(df.limit(0)).count() == 0


def test_adjacent_turns_share_a_block_and_ties_are_sorted(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert format_conversations(df).first().formatted == (
        "<|start|>user<|says|>a<|next|>a<|next|>b<|end|><|start|>assistant<|says|>c<|end|>"
    )


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "b")], "conv_id bigint, turn bigint, role string, text string")
    plan = read_back(format_conversations(df))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
