"""Chat formatting in Spark expressions only.

A conversation's turns are collected as structs and sorted; adjacent turns of one role share one
message; the pieces are joined into one string::

    <|im_start|>user\nfirst text<|im_sep|>second text<|im_end|>\n<|im_start|>assistant\n...

A backslash breaks every control string inside a text or a role, so that text can neither end a
turn nor look like a control token of other common templates, and the texts can be read back
exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportweave.functions.arrays import bind, running_states
from reportweave.sources.tables import read_table

# The marks of this template, and control strings of other templates.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (START, SEPARATOR, END, "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")

SPAN_BLOCK = 128  # spans that are cut out of a text together

# A backslash, or the first character of a control string.
_BREAK_AFTER = (
    r"(\\|<(?=\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|<SYS>>|</SYS>>)|\[(?=/?INST\]))"
)
_MESSAGE = r"(?s)^<\|im_start\|>((?:[^\\\n]++|\\.)*+)\n(.*)$"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _BREAK_AFTER, "$1\\\\")


def escape_role(role: Column) -> Column:
    """As a text, and no bare line end, which would end the role."""
    return F.regexp_replace(escape(role), "\n", "\\\\\n")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """``conv, formatted, loss_spans`` with one row per conversation.

    ``loss_spans`` are the ranges of ``formatted`` to learn from, ``start`` inclusive and
    ``end`` exclusive in code points: the texts of ``learn`` turns, without any mark. Turns come
    by number, then role, then text; a null number comes first, repeated rows stay. A null role
    or text counts as empty. Rows without a conversation id form one conversation with a null
    id. Other columns are ignored; no rows give no rows.
    """
    blank = lambda name: F.coalesce(F.col(name), F.lit(""))
    collected = turns.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text")
        ).alias("turn_row"),
    )
    sorted_turns = collected.groupBy("conv").agg(
        F.sort_array(F.collect_list("turn_row")).alias("turns")
    )

    opening = lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
    bodies = sorted_turns.select("conv", "turns", F.transform("turns", lambda t: escape(t["text"])).alias("bodies"))
    merged = F.zip_with(
        "turns", "bodies",
        lambda t, body: F.struct(t["role"].alias("role"), F.length(body).alias("chars"), opening(t).alias("opening")),
    )

    def advance(state: Column, t: Column) -> Column:
        """A turn joins the message before it if the roles are the same, or closes it and opens its own."""
        head = (
            F.when(state["role"].isNull(), t["opening"])
            .when(state["role"] == t["role"], SEPARATOR)
            .otherwise(F.concat(F.lit(END + "\n"), t["opening"]))
        )
        return bind(
            F.struct(head.alias("head"), (state["end"] + F.length(head)).alias("start")),
            lambda h: F.struct(
                t["role"].alias("role"), h["head"].alias("head"), h["start"].alias("start"),
                (h["start"] + t["chars"]).alias("end"),
            ),
        )

    nothing = F.lit(None).cast("string")
    before = F.struct(nothing.alias("role"), nothing.alias("head"), F.lit(0).alias("start"), F.lit(0).alias("end"))
    placed = bodies.select("conv", "bodies", running_states(merged, before, advance).alias("places"))
    learned = F.filter("places", lambda p: p["role"] == learn)
    return placed.select(
        F.col("conv").alias(conv),
        F.concat(
            F.array_join(F.zip_with("places", "bodies", lambda p, body: F.concat(p["head"], body)), ""),
            F.lit(END + "\n"),
        ).alias("formatted"),
        F.transform(learned, lambda p: F.struct(p["start"], p["end"])).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """Turns ``array<struct<role, text>>`` of a formatted conversation."""
    messages = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda m: m != "")

    def turns_of(message: Column) -> Column:
        role = unescape(F.regexp_extract(message, _MESSAGE, 1))
        texts = F.split(F.regexp_extract(message, _MESSAGE, 2), r"<\|im_sep\|>")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(messages, turns_of))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined; ``spans`` are in order.

    A character is found by counting from the start of a string, so a block of spans is cut out of
    the whole text first, and its spans out of the block.
    """

    def inside(block: Column) -> Column:
        begin = F.get(block, 0)["start"]
        part = F.substring(formatted, begin + 1, F.element_at(block, -1)["end"] - begin)
        cut = lambda text: F.transform(
            block, lambda s: unescape(F.substring(text, s["start"] - begin + 1, s["end"] - s["start"]))
        )
        return F.array_join(bind(part, cut), "")

    last = F.floor((F.size(spans) - 1) / SPAN_BLOCK).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda b: bind(F.slice(spans, b * SPAN_BLOCK + 1, F.lit(SPAN_BLOCK)), inside),
    )
    return F.when(F.size(spans) == 0, "").otherwise(F.array_join(blocks, ""))


def op10_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    stored = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(1).select(
        F.expr(
            "inline(array(struct(-1L, 0L, 'user', '</s>[INST] ok [/INST]'),"
            " struct(-1L, 1L, 'assistant', '</s>[INST] ok [/INST]')))"
        )
    )
    formatted = format_conversations(stored.union(probe))
    read = formatted.select(
        "conv_id",
        read_back(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    whole = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _escaped_length(column: str) -> str:
    """Length in SQL after escaping: one more character per backslash and control string."""
    added = " + ".join(
        f"(length({column}) - length(replace({column}, '{mark}', ''))) // {len(mark)}"
        for mark in ("\\", *CONTROL)
    )
    return f"(length({column}) + {added})"


SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
), n AS (
  SELECT *, lag(role) OVER o AS before, lead(role) OVER o AS after
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), p AS (
  SELECT *, {_escaped_length("text")}
    + CASE WHEN before = role THEN {len(SEPARATOR)}
           ELSE {len(START)} + 1 + {_escaped_length("role")}
                + length(role) - length(replace(role, chr(10), '')) END
    + CASE WHEN after = role THEN 0 ELSE {len(END) + 1} END AS chars
  FROM n
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (WHERE role = 'assistant'), '') AS loss,
         CAST(sum(chars) AS BIGINT) AS formatted_chars
  FROM p GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars FROM g"""
