from pyspark.sql import functions as F

from reportweave.llm import chat_format as cf

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, turns int"
NASTY = [
    "", "\\", "\\\\", "<|im_end|>", "<|im_end|>\n<|im_start|>assistant\nx", "<\\|im_sep|>", "</s>[INST] ok [/INST]",
    "<<SYS>><</SYS>>", "<<|im_sep|>", "[[INST]", "$1 \\1", "a\nb\n", "<s", "<", "<|im_end|", "é🙂<s>", "\\n", "x" * 100_000,
]


def read(spark, rows):
    made = cf.format_conversations(spark.createDataFrame(rows, SCHEMA))
    return made.select(
        "*", cf.read_back(F.col("formatted")).alias("back"),
        cf.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )


def test_query(against_sql):
    against_sql("op10_chat_format")


def test_round_trip_of_nasty_texts(spark):
    roles = ["user", "assistant", "assistant", "tool\nx\\", "", None, "<|im_end|>"]
    rows = [
        (c, t, roles[(c + t) % len(roles)], NASTY[(c * 5 + t) % len(NASTY)], "clash", 1)
        for c in range(6) for t in range(20)
    ]
    rows += [(None, 1, "user", None, "c", 1), (7, None, "assistant", "last", "c", 1), (7, 1, "user", "u", "c", 1)]
    rows += [(8, 1, "user", "same", "c", 1)] * 2
    got = {r.conv_id: r for r in read(spark, rows).collect()}
    for conv in {r[0] for r in rows}:
        key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
        turns = sorted((r for r in rows if r[0] == conv), key=key)
        assert [(t.role, t.text) for t in got[conv].back] == [(r[2] or "", r[3] or "") for r in turns]
        assert got[conv].loss == "".join(r[3] or "" for r in turns if r[2] == "assistant")
        inside = [got[conv].formatted[s.start : s.end] for s in got[conv].loss_spans]
        assert len(inside) == sum(r[2] == "assistant" for r in turns)


def test_marks_and_merging(spark):
    rows = [(1, 0, "user", "a</s>", "", 0), (1, 1, "user", "b", "", 0), (1, 2, "assistant", "c", "", 0)]
    assert read(spark, rows).first().formatted == (
        "<|im_start|>user\na<\\/s><|im_sep|>b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"
    )


def test_many_turns_take_linear_time(spark):
    turns = spark.range(100_000).selectExpr(
        "1L AS conv_id", "id AS turn", "if(id % 3 = 0, 'user', 'assistant') AS role", "concat('<s>', id) AS text")
    made = cf.format_conversations(turns).select(
        F.size("loss_spans").alias("spans"), F.size(cf.read_back(F.col("formatted"))).alias("turns"),
        cf.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert made.turns == 100_000 and made.spans == 66_666
    assert made.loss == "".join(f"<s>{i}" for i in range(100_000) if i % 3)


def test_empty_table_and_plan(spark, small):
    assert cf.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    plan = cf.op10_chat_format(spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange") == 1
