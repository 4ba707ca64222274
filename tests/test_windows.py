import re

import pytest
from against_sql import compare
from pyspark.sql import functions as F

from reportweave.functions import text as tx
from reportweave.operators import inference, windows

TEXTS = [
    "", "  ", "one", "a b c d e f g h i j k l", "  lead x.y ", " ".join(f"w{i}" for i in range(101)),
    "é " * 333 + "end.", "x" * 5000, "　 tab\tnew\nline " * 40,
]


def tokens_of(text):
    return [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+|\d+|[^\w\s]|_", text)]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")


@pytest.mark.parametrize(("limit", "overlap"), [(6, 2), (9, 4), (12, 8), (64, 20), (10_000, 64)])
def test_zones_cover_every_token_once(texts, limit, overlap):
    cut = texts.select(
        "doc_id", tx.words(F.col("text")).alias("w"), windows.text_windows(F.col("text"), limit, overlap).alias("v"),
        windows.window_bounds(F.size(tx.words(F.col("text"))), limit, overlap).alias("b"),
    )
    for r in cut.collect():
        text, all_tokens = TEXTS[r.doc_id], tokens_of(TEXTS[r.doc_id])
        owned = []
        assert len(r.b) == len(r.v)
        for b, v in zip(r.b, r.v, strict=True):
            assert b.first <= b.own_first < b.own_stop <= b.stop and b.stop - b.first <= limit
            assert b.own_first - b.first >= overlap // 2 or b.own_first == 0
            assert b.stop - b.own_stop >= overlap // 2 or b.own_stop == len(r.w)
            owned += range(b.own_first, b.own_stop)
            assert text[v.offset : v.offset + len(v.text)] == v.text
            inside = [t for t in all_tokens if v.offset <= t[1] and t[2] <= v.offset + len(v.text)]
            assert [t[0] for t in inside] == r.w[b.first : b.stop]
            assert [t for t in all_tokens if v.own_from <= t[1] < v.own_to] == all_tokens[b.own_first : b.own_stop]
        assert owned == list(range(len(r.w)))


def test_sub_tokens_and_room_for_the_longest(texts):
    weight = lambda t: F.ceil(F.length(t) / 4).cast("int")
    rows = texts.where("doc_id <> 7").select(
        "doc_id", tx.words(F.col("text")).alias("w"),
        windows.window_bounds(
            F.size(tx.words(F.col("text"))), 14, 4, F.transform(tx.words(F.col("text")), weight), spare=1
        ).alias("b"),
    )
    for r in rows.collect():
        owned = [i for b in r.b for i in range(b.own_first, b.own_stop)]
        assert owned == list(range(len(r.w)))
        for b in r.b:
            assert sum(-(-len(t) // 4) for t in r.w[b.first : b.stop]) <= 14


def test_too_small_a_limit():
    with pytest.raises(ValueError, match="room"):
        windows.window_bounds(F.lit(5), 8, 8)
    with pytest.raises(ValueError, match="room"):
        windows.window_bounds(F.lit(5), 8, 0)


def test_windows_give_what_the_whole_text_gives(spark):
    def model(limit):
        """Labels every word by the word before it; a span takes in the word after it."""
        def load():
            def predict(batch):
                found = []
                for t in batch:
                    words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"\S+", t)]
                    assert len(words) <= limit
                    found.append([
                        {"entity_group": words[k - 1][0] if k else "<s>", "score": 0.5, "word": w, "start": a,
                         "end": words[min(k + 1, len(words) - 1)][2]}
                        for k, (w, a, _) in enumerate(words)
                    ])
                return found
            return predict
        return load

    rows = [(i, " ".join(f"w{chr(97 + k % 26)}" for k in range(n))) for i, n in enumerate([0, 1, 5, 12, 13, 40, 333])]
    df = spark.createDataFrame([*rows, (99, None)], "doc_id bigint, text string")
    cut = inference.annotate_windows(df, model(12), model(12), limit=12, overlap=6, batch_size=7)
    whole = inference.annotate_with_models(df, model(10_000), model(10_000))
    assert cut.columns == whole.columns
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, whole.collect()))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == whole._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_class_hook(spark):
    df = spark.createDataFrame([(1, "good"), (2, None), (3, " "), (4, "none")], "id int, text string")
    def load():
        return lambda texts: [None if t == "none" else {"label": "A" if t == "good" else "B", "score": len(t) / 100} for t in texts]
    found = inference.classify_with_model(df, load, batch_size=3, names={"A": "fine", "B": "blank"})
    got = {r.id: (r.text, r.label) for r in found.collect()}
    assert got == {1: ("good", "fine"), 2: (None, "blank"), 3: (" ", "blank"), 4: ("none", None)}
    with pytest.raises(Exception, match="unknown label"):
        inference.classify_with_model(df, load, names={"A": "fine"}).collect()
    short = lambda: lambda texts: []
    with pytest.raises(Exception, match="0 classes"):
        inference.classify_with_model(df, short).collect()


@pytest.mark.parametrize("name", ["annotate_windows", "section_windows", "classify_by_model"])
def test_queries(spark, name):
    compare(spark, name)
    compare(spark, name, "/root/testdata/sf0.01")


def test_spans_leave_python_in_parts_of_bounded_size():
    import pandas as pd

    many = lambda texts: [[{"word": t, "start": k, "end": k + 1} for k in range(100)] for t in texts]
    sizes = []

    def model(texts):
        sizes.append(len(texts))
        return many(texts)

    texts = [f"t{i}" for i in range(1000)]
    frames = list(inference.model_spans([lambda: model, lambda: many], 30).func(iter([pd.Series(texts)])))
    held = [sum(map(len, f.m0)) + sum(map(len, f.m1)) for f in frames]
    assert max(held) < inference.HELD_SPANS + 2 * 30 * 100
    assert [spans[0]["word"] for f in frames for spans in f.m1] == texts
    assert sizes == [30] * 33 + [10]

    rows = [[f"r{i}w{k}" for k in range(i % 4)] for i in range(600)]
    frames = list(inference.model_window_spans([lambda: many], 7).func(iter([pd.Series(rows)])))
    assert len(frames) > 1 and max(sum(len(w) for r in f.m0 for w in r) for f in frames) < 2 * inference.HELD_SPANS
    assert [[w[0]["word"] for w in r] for f in frames for r in f.m0] == rows


def test_model_that_leaves_out_a_text_is_an_error():
    import pandas as pd

    short = lambda texts: [[] for _ in texts[1:]]
    with pytest.raises(ValueError, match="1 of 2 texts"):
        list(inference.model_spans([lambda: short]).func(iter([pd.Series(["a", "b"])])))
