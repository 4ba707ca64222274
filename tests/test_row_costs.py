"""Steps that must not do more than they have to: their results, and what their plans hold."""

import random

from pyspark.sql import functions as F

from reportweave.functions.entities import NegationRules
from reportweave.operators import annotation, grouping, relations
from reportweave.plans import queries as q


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def segment_flags(words, rules):
    """Negation of single-word marks, ``m...``, word by word."""
    flags = []
    for i, w in enumerate(words):
        if not w.startswith("m"):
            continue
        first = max([k + 1 for k in range(i) if words[k] in (".", *rules.termination)], default=0)
        stop = min([k + (words[k] == ".") for k in range(i, len(words)) if words[k] in (".", *rules.termination)],
                   default=len(words))
        flags.append(any(x in rules.preceding for x in words[first:i])
                     or any(x in rules.following for x in words[i + 1:stop]))
    return flags


def test_negation_by_ranges_carries_no_state(spark):
    rules = NegationRules(preceding=("no",), following=("excluded",), termination=("but",), eligible=("x", "y"))
    rnd = random.Random(7)
    texts = [[rnd.choice(["no", "excluded", "but", ".", "ma", "mb", "and", "of"]) for _ in range(n)]
             for n in [1, 2, 3, 40, 700] * 6]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = annotation.annotate(df, {"ma": "x", "mb": "y"}, rules)
    got = {r.doc_id: [e.negated for e in r.ents] for r in found.collect()}
    assert got == {i: segment_flags(t, rules) for i, t in enumerate(texts)}
    assert any(any(v) for v in got.values())
    assert "bit_get" not in plan(found) and "array_append" not in plan(found)


def test_trigger_spans_of_a_text(spark):
    df = spark.createDataFrame([(1, "  no cyst , seen  With care"), (2, None), (3, "nothing")],
                               "doc_id bigint, text string")
    got = {r.doc_id: [tuple(s) for s in r.s] for r in df.select("doc_id", q.trigger_spans(F.col("text"), 40).alias("s")).collect()}
    assert got == {1: [("negated", 2, 42), ("asserted", 18, 58)], 2: [], 3: []}


def test_dep_match_removes_doubles_once(spark):
    rows = [(1, 0, i, i // 2, w, "amod") for i, w in enumerate("a b a c".split())]
    deps = spark.createDataFrame(rows, "doc_id bigint, sent bigint, i bigint, head bigint, tok string, dep string")
    child = lambda left, right: [
        {"RIGHT_ID": "a", "RIGHT_ATTRS": left}, {"LEFT_ID": "a", "REL_OP": ">", "RIGHT_ID": "b", "RIGHT_ATTRS": right}]
    patterns = {"one": child({"DEP": "amod"}, {"DEP": "amod"}), "two": child({"TEXT": "b"}, {})}
    found = relations.dep_match(deps, patterns)
    assert sorted(map(tuple, found.collect())) == [(1, 0, 1), (1, 1, 2), (1, 1, 3)]
    assert plan(found).count("Aggregate") == 1
    both = relations.match_patterns(deps, patterns)
    assert sorted((r.pattern, r.tok_i, r.tok_j) for r in both.collect()) == [
        ("one", 0, 1), ("one", 1, 2), ("one", 1, 3), ("two", 1, 2), ("two", 1, 3)]


def test_sentences_need_no_running_sum(spark, tmp_path):
    texts = ["", "a", "a b. c d e! ?", "..", "no end here"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    deps = q.dependencies(spark, str(tmp_path))
    expected = set()
    for d, text in enumerate(texts):
        words, sent, first = text.replace(".", " .").replace("!", " !").split(), 0, 0
        for i, w in enumerate(words):
            expected.add((d, sent, i, w, first + (i - first) // 2))
            if w in (".", "!", "?"):
                sent, first = sent + 1, i + 1
    rows = [(r.doc_id, r.sent, r.i, r.tok, r.head) for r in deps.collect()]
    assert len(rows) == len(expected) and set(rows) == expected
    assert "shiftleft" not in plan(deps)


def test_tags_of_words_need_no_offsets(spark, tmp_path):
    spark.createDataFrame([(1, "the of the end")], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    tags = q.iob_tag_rows(spark, str(tmp_path))
    assert [r.i for r in tags.orderBy("i").collect()] == [0, 1, 2, 3]
    assert plan(tags).count("shiftleft") == plan(q.mentions(spark, str(tmp_path))).count("shiftleft")


def test_patterns_shuffle_a_token_once(spark, monkeypatch):
    """Sentences over many batches, doubles and nulls; no join, and one exchange before the doubles are removed."""
    rnd = random.Random(3)
    rows = []
    for d, size in ((1, 40), (2, 3), (None, 6), (3, 25)):
        for sent in (0, 1, None):
            own = [(d, sent, i, rnd.choice([None, i, rnd.randrange(size)]), rnd.choice("abc"), rnd.choice("pq"))
                   for i in range(size)]
            rows += own + own[:4] + [(d, sent, None, 2, "a", "p")]
    deps = spark.createDataFrame(rows, "doc_id bigint, sent bigint, i bigint, head bigint, tok string, dep string")
    node = lambda name, **more: {"RIGHT_ID": name, **more}
    x, y = node("x", RIGHT_ATTRS={"DEP": "p"}), {"RIGHT_ID": "y", "LEFT_ID": "x", "RIGHT_ATTRS": {"LOWER": "a"}}
    patterns = {op: [x, y | {"REL_OP": op}] for op in (">", "<", ".", "$++", ".*", ";*")}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = relations.match_patterns(deps, patterns)
        got = {tuple(r) for r in found.collect()}
        lone = {tuple(r) for r in relations.match_patterns(deps, patterns | {"one": [x]}).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "Join" not in plan(found) and plan(found).count("RepartitionByExpression") == 1
    linked = {
        ">": lambda a, b: b[3] == a[2], "<": lambda a, b: a[3] is not None and b[2] == a[3],
        ".": lambda a, b: b[2] == a[2] + 1, ".*": lambda a, b: b[2] > a[2], ";*": lambda a, b: b[2] < a[2],
        "$++": lambda a, b: None not in (a[3], b[3]) and a[3] == b[3] != b[2] > a[2] != a[3],
    }
    pairs = [(a, b) for a in rows for b in rows if None not in (*a[:3], *b[:3]) and a[:2] == b[:2] and a[2] != b[2]
             and a[5] == "p" and b[4] == "a"]
    wanted = {(op, a[0], a[2], b[2]) for op, holds in linked.items() for a, b in pairs if holds(a, b)}
    assert got == wanted and {w[0] for w in wanted} == set(linked)
    assert lone == wanted | {("one", r[0], r[2], r[2]) for r in rows if r[5] == "p"}


def test_pairs_of_nodes_are_held_in_parts(monkeypatch):
    parts = lambda *counts: list(relations._parts(relations.np.array(counts)))
    monkeypatch.setattr(relations, "PAIRS", 10)
    assert parts(4, 6, 1, 30, 10, 9) == [(0, 2), (2, 3), (3, 4), (4, 5), (5, 6)]
    assert parts() == []


def test_pieces_of_a_document_are_shuffled_once(spark):
    rows = [(1, 0, 0, "B-x", 1.0, 0, 4), (1, 0, 4, "O", 0.5, 4, 6), (1, 1, 7, "I-x", 0.5, 7, 9), (1, 2, 10, "O", 1.0, 10, 11),
            (None, 0, 3, "I-y", 1.0, 3, 5), (None, 0, 3, "I-y", 1.0, 3, 5), (2, 5, None, "B-x", 1.0, 8, 9),
            (3, 0, 1, "B-x", 1.0, None, 2), (3, 1, 2**62, "O", 1.0, 2**62, None), (3, 1, -1, None, None, -(2**62), 2**62)]
    pieces = spark.createDataFrame(
        rows, "doc_id bigint, word_id bigint, pos bigint, label string, score double, start bigint, end bigint")
    words = grouping.word_labels(pieces)
    assert {tuple(r) for r in words.collect()} == {
        (1, 0, 0, "B-x", 1.0, 0, 6), (1, 1, 7, "I-x", 0.5, 7, 9), (1, 2, 10, "O", 1.0, 10, 11),
        (None, 0, 3, "I-y", 1.0, 3, 5), (2, 5, None, None, None, 8, 9),
        (3, 0, 1, "B-x", 1.0, None, 2), (3, 1, -1, None, None, -(2**62), 2**62)}
    assert dict(words.dtypes)["start"] == "bigint"
    whole = grouping.group_entities(words, index="word_id")
    assert {(r.doc_id, r.ent_pos, r.entity_group, r.start, r.end) for r in whole.collect()} == {
        (1, 0, "x", 0, 9), (None, 0, "y", 3, 5), (3, 0, "x", None, 2)}
    first_plan = whole._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert first_plan.count("Exchange hashpartitioning") == 1
