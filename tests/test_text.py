"""Tokens, blanks, filters, masking."""

import random

import regex
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions import text as tx
from reportweave.functions.arrays import running_flags, running_sum

TEXTS = [
    None, "", "   ", "\n\t", "One lesion.", "  two\n\nlines, here ", "é😀x9 8b", "a" * 200,
    "T2/FLAIR high-signal; no change (3.5 mm).", "tail blanks \n", "x" + " y" * 500,
]


def python_tokens(text):
    out = []
    for m in regex.finditer(r"\p{L}+|\p{N}+|[^\p{L}\p{N}]", text or ""):
        if not m.group().isspace():
            out.append((m.group(), m.start(), m.end()))
    return out


def test_tokens_equal_a_plain_scan_and_cut_the_text(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    got = df.select("doc_id", "text", tx.tokens(F.col("text")).alias("t"), tx.words(F.col("text")).alias("w"))
    for row in got.collect():
        expected = python_tokens(row.text)
        assert [(t.tok, t.start, t.end) for t in row.t] == expected
        assert row.w == [t for t, _, _ in expected]
        assert all(row.text[s:e] == t for t, s, e in expected)


def test_running_sum_and_flags_over_many_lengths(spark):
    rnd = random.Random(1)
    rows = [[rnd.randint(0, 9) for _ in range(n)] for n in (0, 1, 2, 3, 31, 32, 33, 64, 65, 300)]
    df = spark.createDataFrame(list(enumerate(rows)), "k int, v array<int>")
    # Flag: the sum of what came before is even.
    got = df.select(
        "k", "v", running_sum(F.col("v")).alias("s"),
        running_flags(F.col("v"), F.lit(0), lambda s, x: s + x, lambda s, x: s % 2 == 0).alias("f"),
    )
    for row in got.collect():
        sums = [sum(row.v[: i + 1]) for i in range(len(row.v))]
        assert row.s == sums
        assert row.f == [(s - v) % 2 == 0 for s, v in zip(sums, row.v)]


def test_blank_text_gets_the_placeholder(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    got = [r[0] for r in df.select(tx.blank_placeholder(F.col("text"))).collect()]
    assert got == [t if t and t.strip() else vocab.PLACEHOLDER for t in TEXTS]


def test_length_band_has_open_ends(spark):
    rows = [("a" * n,) for n in (30, 31, 999, 1000)] + [(None,)]
    df = spark.createDataFrame(rows, "text string")
    kept = df.where(tx.length_between(F.col("text"), 30, 1000)).collect()
    assert sorted(len(r.text) for r in kept) == [31, 999]


def test_pattern_filter_takes_null_as_no_match(spark):
    df = spark.createDataFrame([("sinusitis",), ("none",), (None,)], "text string")
    assert [r.text for r in df.where(tx.contains_pattern(F.col("text"), "sinus|Risk")).collect()] == ["sinusitis"]


def test_mask_ranges_against_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for k in range(60):
        text = "".join(rnd.choice("abc é😀\n") for _ in range(rnd.randint(0, 40)))
        spans = [(a, a + rnd.randint(0, 9)) for a in (rnd.randint(0, 40) for _ in range(rnd.randint(0, 6)))]
        rows.append((k, text, spans))
    rows += [(98, None, [(0, 1)]), (99, "kept", None)]
    df = spark.createDataFrame(rows, "k int, text string, spans array<struct<start:int,end:int>>")
    for row in df.withColumn("m", tx.mask_ranges(F.col("text"), F.col("spans"))).collect():
        if row.text is None:
            assert row.m is None
            continue
        gone = {i for s in row.spans or [] for i in range(s.start, s.end)}
        assert row.m == "".join(c for i, c in enumerate(row.text) if i not in gone), row


def test_section_dump(spark):
    df = spark.sql("select 'full' text, array(named_struct('section','report_body','text','b')) s")
    assert df.select(tx.section_dump(F.col("text"), F.col("s"))).head()[0] == "full\n\nreport_body\nb"


def test_pieces_and_sums_of_long_texts(spark):
    texts = ["", " ", "\u00a0a\u3000b", "x1\t\u0085,\n\n\u00e9t\u00e9 \U0001f600\u00b2 \u0663. ", "w, " * 40 + "end"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select("text", tx.tokens(F.col("text")).alias("t"), tx.words(F.col("text")).alias("w")).collect()
    for r in got:
        assert [t.tok for t in r.t] == r.w and all(r.text[t.start:t.end] == t.tok for t in r.t)
        assert "".join(r.w) == "".join(r.text.split())
    n = 16 * 3 + 1
    sums = spark.range(1).select(running_sum(F.sequence(F.lit(1), F.lit(n))).alias("s")).first().s
    assert sums == [k * (k + 1) // 2 for k in range(1, n + 1)]
