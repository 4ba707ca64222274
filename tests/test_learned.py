"""The tagger that decodes whole texts, and the classifier learned by grouping."""

from itertools import product
from math import exp, log
from collections import Counter

import pytest
from pyspark.sql import functions as F

from against_sql import compare
from reportweave.functions import arrays
from reportweave.operators import bayes, lookup, sequence

TRAIN = [
    (1, ["a", "b", "c", "b", "c"], ["O", "B-x", "I-x", "B-y", "O"]),
    (2, ["a", "b", "c", "c"], ["O", "B-x", "I-x", "I-x"]),
    (3, ["c", "c", "b", "a"], ["O", "O", "B-y", "O"]),
    (4, [], []),
]
SHAPE = "doc_id bigint, tokens array<string>"


def plain_scores():
    """Scores as the docstring of ``sequence_fit`` gives them."""
    names = sorted({t for _, _, tags in TRAIN for t in tags} | {"O"})
    seen = Counter((w, t) for _, words, tags in TRAIN for w, t in zip(words, tags))
    of_tag = Counter(t for _, _, tags in TRAIN for t in tags)
    moves = Counter(m for _, _, tags in TRAIN for m in zip(["<s>", *tags], tags))
    of_prev = Counter(p for _, _, tags in TRAIN for p in ["<s>", *tags][: len(tags)])

    def emit(word, tag):
        if (word, tag) in seen or tag == "O":
            if not any(w == word for w, _ in seen):
                return 0
            return round(1000 * log((seen[word, tag] + 0.5) / (of_tag[tag] + 1)))

    def move(prev, tag):
        if tag.startswith("I-") and prev not in ("B-" + tag[2:], tag):
            return None
        return round(1000 * log((moves[prev, tag] + 1) / (of_prev[prev] + len(names))))

    return names, emit, move


def brute_path(words):
    names, emit, move = plain_scores()
    best = None
    for path in product(names, repeat=len(words)):
        parts = [emit(w, t) for w, t in zip(words, path)]
        parts += [move(p, t) for p, t in zip(["<s>", *path], path)]
        if None not in parts:
            # Ties: the larger last tag, then the larger tag before it, and so on.
            best = max(best or (-10**9, []), (sum(parts), path[::-1]))
    return list(best[1][::-1]) if words else []


@pytest.mark.parametrize("block", [2, 128])
def test_decode_equals_all_paths(spark, monkeypatch, block):
    monkeypatch.setattr(arrays, "FOLD_BLOCK", block)
    monkeypatch.setattr(lookup, "HOT_KEYS", 1)
    model = sequence.sequence_fit(spark.createDataFrame(TRAIN, SHAPE + ", ner_tags array<string>"))
    texts = [list("abcbc"), list("ccccc"), list("bcabc"), ["b", "?", "c", "c"], ["?"], [], None, list("bbccb")]
    docs = spark.createDataFrame(list(enumerate(texts)), SHAPE)
    got = {r.doc_id: r.tags for r in sequence.sequence_decode(docs, model).collect()}
    assert got == {k: brute_path(words or []) for k, words in enumerate(texts)}
    for tags in got.values():
        assert all(not t.startswith("I-") or p in ("B-" + t[2:], t) for p, t in zip(["", *tags], tags))


def test_decode_long_text_and_empty_model(spark):
    model = sequence.sequence_fit(spark.createDataFrame(TRAIN, SHAPE + ", ner_tags array<string>"))
    docs = spark.createDataFrame([(1, ["b", "c", "a"] * 7_000)], SHAPE)
    tags = sequence.sequence_decode(docs, model).head().tags
    assert len(tags) == 21_000 and tags[3:6] == tags[9_000:9_003]
    nothing = sequence.sequence_fit(spark.createDataFrame([], SHAPE + ", ner_tags array<string>"))
    short = spark.createDataFrame([(1, ["b", "c"])], SHAPE)
    assert sequence.sequence_decode(short, nothing).head().tags == ["O", "O"]
    assert sequence.sequence_decode(short.where("doc_id > 1"), model).collect() == []


def test_running_states(spark, monkeypatch):
    monkeypatch.setattr(arrays, "FOLD_BLOCK", 3)
    for n in (0, 1, 3, 4, 11):
        states = arrays.running_states(F.sequence(F.lit(1), F.lit(n)) if n else F.array().cast("array<int>"),
                                       F.lit(0), lambda s, v: s * 2 + v)
        got = spark.range(1).select(states.alias("s")).head().s
        state, wanted = 0, []
        for v in range(1, n + 1):
            state = state * 2 + v
            wanted.append(state)
        assert got == wanted


def test_too_many_values_name_the_column(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("kind"))
    assert len(spark.range(1).select(lookup.bounded_values(df, "kind", 20)).head()[0]) == 20
    with pytest.raises(Exception, match="column kind has more than 19 values"):
        spark.range(1).select(lookup.bounded_values(df, "kind", 19)).collect()


def test_bayes_equals_the_formula(spark, monkeypatch):
    monkeypatch.setattr(lookup, "HOT_KEYS", 2)
    train = [("x", "red red blue"), ("x", "red"), ("y", "blue green"), ("z", ""), (None, "red"), ("y", None)]
    model = bayes.bayes_fit(spark.createDataFrame(train, "label string, text string"))
    texts = ["red", "Blue green blue", "unknown words", "", None, "green " * 50, "red unknown blue"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.label, r.score) for r in bayes.bayes_classify(docs, model).collect()}
    rows = [(label, text.lower().split()) for label, text in train if label and text is not None]
    counts = {c: Counter(w for label, words in rows if label == c for w in words) for c in "xyz"}
    known = set().union(*counts.values())
    for k, text in enumerate(texts):
        words = [w for w in (text or "").lower().split() if w in known]
        logs = {
            c: log(sum(label == c for label, _ in rows) / len(rows))
            + sum(log((counts[c][w] + 1) / (sum(counts[c].values()) + len(known))) for w in words)
            for c in "xyz"
        }
        best = max(logs, key=lambda c: (round(logs[c], 5), c))
        assert got[k][0] == best
        assert got[k][1] == pytest.approx(1 / sum(exp(v - logs[best]) for v in logs.values()), abs=1e-4)


def test_frequent_words_leave_a_text_as_sums_by_class(spark):
    words = " ".join("w" + chr(97 + k // 26) + chr(97 + k % 26) for k in range(500))
    train = spark.createDataFrame([("x", words), ("y", words)], "label string, text string")
    docs = spark.createDataFrame([(1, words + " new new"), (2, None)], "doc_id bigint, text string")
    rows = bayes.frequent_sums(docs, bayes.bayes_fit(train)).collect()
    assert sorted((r.doc_id, r.id, r.word or "") for r in rows) == [
        (1, bayes.REST, "new"), (1, bayes.KNOWN, ""), (1, 0, ""), (1, 1, ""), (2, bayes.KNOWN, "")
    ]
    assert {(r.doc_id, r.id): r.weight for r in rows if r.id < 0} == {(1, bayes.REST): 2, (1, bayes.KNOWN): 500, (2, bayes.KNOWN): 0}


def test_bayes_without_rows(spark):
    empty = spark.createDataFrame([], "label string, text string")
    docs = spark.createDataFrame([(1, "red")], "doc_id bigint, text string")
    assert tuple(bayes.bayes_classify(docs, bayes.bayes_fit(empty)).head()) == (1, None, None)
    some = bayes.bayes_fit(spark.createDataFrame([("x", "red")], empty.schema))
    assert bayes.bayes_classify(docs.where("doc_id > 1"), some).collect() == []


@pytest.mark.parametrize("name", ["tagger_decode", "classify_bayes"])
def test_against_sql(spark, name):
    compare(spark, name)


def test_fit_reads_examples_once(spark):
    uneven = [(1, ["a", "b", None], ["O", "B-x"]), (2, ["a"], ["B-x", "I-x", "O"]), (3, None, ["O"]), (4, ["b"], None)]
    examples = spark.createDataFrame(uneven, SHAPE + ", ner_tags array<string>")
    model = sequence.sequence_fit(examples)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (model.emissions, model.transitions)]
    assert not any("ner_tags" in p or "LogicalRDD" in p for p in plans)
    assert {(r.tok, r.n) for r in model.emissions.collect()} == {("a", 2), ("b", 1)}
    share = lambda n, of: round(1000 * log((n + 1) / (of + 3)))
    got = {(r.prev, r.tag): r.score for r in model.transitions.collect()}
    assert got["<s>", "O"] == share(2, 3) and got["B-x", "I-x"] == share(1, 1) and got["I-x", "O"] == share(1, 1)
    assert got["O", "I-x"] is None and got["O", "B-x"] == share(1, 1)
