"""Sections, grouping of predictions, dependency patterns."""

import random

import pytest
from pyspark.sql import functions as F

from against_sql import compare
from reportweave import vocab
from reportweave.functions import labels
from reportweave.functions import text as tx
from reportweave.operators import grouping, relations, sections, tagger

CASES = [
    (["O", "O"], []),
    ([], []),
    (["O", "a", "O", "b"], [("a", 1, 3), ("b", 3, 4)]),
    (["a", "a", "O"], [("a", 0, 1), ("a", 1, 3)]),
]


@pytest.mark.parametrize("tags,expected", CASES)
def test_slices(spark, tags, expected):
    df = spark.createDataFrame([(tags,)], "labels array<string>")
    got = df.select(sections.section_slices(F.col("labels"))).head()[0]
    assert [tuple(s) for s in got] == expected
    kept = df.select(sections.section_slices(F.col("labels"), keep_prefix=True)).head()[0]
    assert sum(s["to"] - s["from"] for s in kept) == len(tags)


def test_documents_to_sections_merge_repeats(spark):
    text = "lost HEAD one two BODY three HEAD four"
    df = spark.createDataFrame([(1, text)] * 100, "doc_id bigint, text string")
    got = sections.section_documents(df, {"head": "report_header", "body": "report_body"}).collect()
    assert len(got) == 100
    for r in got:
        assert [tuple(s) for s in r.sections] == [
            ("report_header", "HEAD one two HEAD four"), ("report_body", "BODY three")]


def test_section_labels_offsets_and_limit(spark):
    row = ("ab cd.", None, "", " x", "tail")
    df = spark.createDataFrame([row], ", ".join(f"{s} string" for s in vocab.SECTIONS))
    r = sections.section_labels(df).head()
    assert r.tokens == ["ab", "cd", ".", "x", "tail"] and r.labels == [1, 0, 0, 4, 5]
    assert sections.section_labels(df, limit=4).head().labels == [1, 0, 0]
    r = sections.section_offsets(df).head()
    assert r.text == "ab cd.  x tail"
    assert [(m.label, r.text[m.start : m.end]) for m in r.marks] == [
        ("report_header", "ab"), ("report_body", "x"), ("report_tail", "tail")]


GROUP_CASES = [
    (["B-x", "I-x", "I-x", "O"], [("x", 0, 3)]),
    (["B-x", "B-x"], [("x", 0, 1), ("x", 1, 2)]),
    (["I-x", "I-x", "O", "I-x"], [("x", 0, 2), ("x", 3, 4)]),
    (["B-x", "I-y"], [("x", 0, 1), ("y", 1, 2)]),
    (["x", "x", "y"], [("x", 0, 2), ("y", 2, 3)]),
    (["O", "O"], []),
]


def test_grouping(spark):
    rows = [(d, i, t, i / 10, i, i + 1) for d, (tags, _) in enumerate(GROUP_CASES) for i, t in enumerate(tags)]
    words = spark.createDataFrame(rows, "doc_id bigint, pos bigint, label string, score double, start bigint, end bigint")
    by_number = sorted(map(tuple, grouping.group_entities(words, index="pos").collect()))
    assert by_number == sorted(map(tuple, grouping.group_entities(words).collect()))
    nested = words.groupBy("doc_id").agg(F.array_sort(F.collect_list(
        F.struct(F.col("pos").alias("word_id"), "label", "score", "start", "end"))).alias("pieces"))
    in_rows = grouping.group_entities_in_rows(nested).select("doc_id", F.posexplode("ents").alias("p", "e"))
    assert sorted((r.doc_id, r.p, r.e.entity_group, r.e.start, r.e.end) for r in in_rows.collect()) == sorted(
        (r.doc_id, r.ent_pos, r.entity_group, r.start, r.end) for r in grouping.group_entities(words).collect())
    got = {}
    for r in grouping.group_entities(words).orderBy("doc_id", "ent_pos").collect():
        got.setdefault(r.doc_id, []).append((r.entity_group, r.start, r.end))
        span = GROUP_CASES[r.doc_id][0][r.start : r.end]
        assert abs(r.score - sum(range(r.start, r.end)) / 10 / len(span)) < 1e-9
    assert [got.get(d, []) for d in range(len(GROUP_CASES))] == [e for _, e in GROUP_CASES]


def test_first_piece_carries_the_word_label(spark):
    df = spark.sql("select array(null, 0, 0, 0, null, 1, 1, null) w, array(7, 8) t")
    got = df.select(labels.first_piece_labels(F.col("w"), F.col("t"))).head()[0]
    assert got == [-100, 7, -100, -100, -100, 8, -100, -100]


def random_forest(seed, n_docs=6):
    rnd = random.Random(seed)
    rows = []
    for d in range(n_docs):
        i = 0
        for sent in range(rnd.randint(1, 4)):
            n = rnd.randint(1, 9)
            order = list(range(n))
            rnd.shuffle(order)
            heads = {order[0]: order[0]}
            for at in range(1, n):
                heads[order[at]] = order[rnd.randrange(at)]
            for j in range(n):
                rows.append((d, sent, i + j, i + heads[j], rnd.choice("abc"), rnd.choice(["p", "q"])))
            i += n
    return rows


SCHEMA = "doc_id bigint, sent bigint, i bigint, head bigint, tok string, dep string"


def ancestors(row, index):
    out, now = [], row
    while now[3] != now[2]:
        now = index[(now[0], now[3])]
        out.append(now[2])
    return out


def test_closure_equals_climbing(spark):
    rows = random_forest(11) + [(50, 0, k, max(k - 1, 0), "a", "p") for k in range(120)]
    index = {(r[0], r[2]): r for r in rows}
    expected = sorted((r[0], r[1], r[2], a, k + 1) for r in rows for k, a in enumerate(ancestors(r, index)))
    got = relations.ancestor_closure(spark.createDataFrame(rows, SCHEMA))
    assert sorted(tuple(r) for r in got.collect()) == expected


def holds(op, a, b, index):
    child = b[3] == a[2] and a[2] != b[2]
    parent = a[3] == b[2] and a[2] != b[2]
    sib = a[3] == b[3] and a[2] != b[2] and a[3] != a[2] and b[3] != b[2]
    return {
        ">": child, "<": parent, ".": b[2] == a[2] + 1, ";": b[2] == a[2] - 1,
        ".*": b[2] > a[2], ";*": b[2] < a[2],
        "$+": sib and b[2] == a[2] + 1, "$-": sib and b[2] == a[2] - 1,
        "$++": sib and b[2] > a[2], "$--": sib and b[2] < a[2],
        ">++": child and b[2] > a[2], ">--": child and b[2] < a[2],
        "<++": parent and b[2] > a[2], "<--": parent and b[2] < a[2],
        ">+": child and b[2] == a[2] + 1, ">-": child and b[2] == a[2] - 1,
        "<+": parent and b[2] == a[2] + 1, "<-": parent and b[2] == a[2] - 1,
        ">>": a[2] in ancestors(b, index), "<<": b[2] in ancestors(a, index),
    }[op]


OPS = [">", "<", ".", ";", ".*", ";*", "$+", "$-", "$++", "$--",
       ">++", ">--", "<++", "<--", ">+", ">-", "<+", "<-", ">>", "<<"]


def test_patterns_equal_brute_force(spark):
    rows = random_forest(21, 4)
    index = {(r[0], r[2]): r for r in rows}
    tokens = spark.createDataFrame(rows, SCHEMA).cache()
    for k, op in enumerate(OPS):
        op2 = OPS[(k * 7 + 3) % len(OPS)]
        pattern = [
            {"RIGHT_ID": "x", "RIGHT_ATTRS": {"DEP": "p"}},
            {"LEFT_ID": "x", "REL_OP": op, "RIGHT_ID": "y", "RIGHT_ATTRS": {}},
            {"LEFT_ID": "y", "REL_OP": op2, "RIGHT_ID": "z", "RIGHT_ATTRS": {"LOWER": {"IN": ["a", "b"]}}},
        ]
        same = lambda a, b: a[0] == b[0] and a[1] == b[1]
        expected = {
            (x[0], x[2], z[2]) for x in rows if x[5] == "p"
            for y in rows if same(x, y) and holds(op, x, y, index)
            for z in rows if same(y, z) and z[4] in "ab" and holds(op2, y, z, index)
        }
        got = relations.match_pattern(tokens, pattern)
        assert {tuple(r) for r in got.collect()} == expected, (op, op2)


def test_relations_are_distinct_per_target(spark):
    mentions = spark.createDataFrame(
        [(1, 0, "descriptor_cyst", 0, 2), (1, 1, "location_eye", 4, 6)],
        "doc_id bigint, ent_pos bigint, entity_group string, tok_start bigint, tok_end bigint")
    rel = spark.createDataFrame([(1, 0, 4), (1, 1, 5), (1, 0, 9)], "doc_id bigint, tok_i bigint, tok_j bigint")
    assert [tuple(r) for r in relations.entity_relations(rel, mentions).collect()] == [
        (1, 0, "descriptor_cyst", 1, "location_eye")]


def test_tagger_backs_off(spark, monkeypatch):
    monkeypatch.setattr("reportweave.operators.lookup.HOT_KEYS", 1)
    examples = spark.createDataFrame(
        [(1, ["a", "b", "c", "b"], ["O", "B-x", "O", "B-y"]), (2, ["a", "b"], ["O", "B-x"])],
        "doc_id bigint, tokens array<string>, ner_tags array<string>")
    model = tagger.tagger_fit(tagger.tag_rows(examples))
    new = spark.createDataFrame([(9, ["a", "b", "c", "b", "b", "new"])], "doc_id bigint, tokens array<string>")
    got = tagger.tagger_apply(tagger.tag_rows(new, tags=None), model).orderBy("i").collect()
    assert [r.tag for r in got] == ["O", "B-x", "O", "B-y", "B-x", "O"]


def test_codes_round_trip(spark):
    df = spark.sql("select array('O','B-x','I-x','O') t, array('B-x','I-x','O') v")
    ids = df.withColumn("ids", labels.encode(F.col("t"), F.col("v")))
    assert ids.head().ids == [2, 0, 1, 2]
    assert ids.select(labels.decode(F.col("ids"), F.col("v"))).head()[0] == ["O", "B-x", "I-x", "O"]


def test_truncate(spark):
    assert spark.range(1).select(tx.truncate(F.array(F.lit(1), F.lit(2)), 1)).head()[0] == [1]


def test_closure_with_gaps_missing_heads_and_cycles(spark):
    deps = lambda rows: spark.createDataFrame([(1, 0, i, h) for i, h in rows], "doc_id bigint, sent bigint, i bigint, head bigint")
    got = relations.ancestor_closure(deps([(0, 0), (2, 0), (4, 2), (5, 4)])).collect()
    assert {(r.i, r.anc, r.depth) for r in got} == {(2, 0, 1), (4, 2, 1), (4, 0, 2), (5, 4, 1), (5, 2, 2), (5, 0, 3)}
    with pytest.raises(Exception, match="cycle"):
        relations.ancestor_closure(deps([(0, 1), (1, 0)])).collect()
    with pytest.raises(Exception, match="head without a token"):
        relations.ancestor_closure(deps([(0, 0), (2, 1)])).collect()


def test_pattern_comparisons(spark):
    rows = [(1, 0, 0, 0, "Bleed", "ROOT", "NOUN", "X"), (1, 0, 1, 0, "big", "amod", "ADJ", None), (1, 0, 2, 0, "old", "amod", "ADJ", "Y")]
    tokens = spark.createDataFrame(rows, "doc_id bigint, sent bigint, i bigint, head bigint, tok string, dep string, pos string, ent_type string")
    root = {"RIGHT_ID": "a", "RIGHT_ATTRS": {"POS": "NOUN"}}
    for attributes, wanted in (
        ({"POS": {"NOT_IN": ["NOUN"]}}, {1, 2}), ({"TEXT": {"REGEX": "^b"}}, {1}), ({"ENT_TYPE": {"!=": "X"}}, {2}),
        ({"LENGTH": {">=": 3}, "LOWER": {"IN": ["old"]}}, {2}), ({"DEP": "amod", "LENGTH": {">": 3}}, set()),
    ):
        node = {"RIGHT_ID": "b", "LEFT_ID": "a", "REL_OP": ">>", "RIGHT_ATTRS": attributes}
        assert {r.tok_j for r in relations.match_pattern(tokens, [root, node]).collect()} == wanted
    with pytest.raises(ValueError, match="unknown comparison"):
        relations.match_pattern(tokens, [{"RIGHT_ID": "a", "RIGHT_ATTRS": {"POS": {"LIKE": "x"}}}])


def test_sections_from_token_labels(spark):
    text = "Head a, b. Body: c  d"
    df = spark.createDataFrame([(k, text) for k in range(100)] + [(100, None)], "doc_id bigint, text string")

    def load():
        names = {"Head": "report_header", "Body": "report_body"}
        return lambda rows: [[names.get(t, "O") for t in tokens] for tokens in rows]

    from reportweave.operators import inference

    found = inference.section_with_model(df, load, batch_size=7)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    got = found.collect()
    expected = [("report_header", "Head a, b."), ("report_body", "Body: c  d")]
    assert all([tuple(s) for s in r.sections] == expected for r in got if r.text)
    assert [r.sections for r in got if r.text is None] == [[]]
    with pytest.raises(Exception, match="as many labels as tokens"):
        sections.sections_from_labels(df.withColumn("labels", F.array(F.lit("O")))).collect()


def test_patterns_together_equal_patterns_alone(spark):
    rows = random_forest(5, 5)
    tokens = spark.createDataFrame(rows, SCHEMA).cache()
    node = lambda name, **more: {"RIGHT_ID": name, **more}
    patterns = {
        "one": [node("x", RIGHT_ATTRS={"LOWER": "a"})],
        "two": [node("x", RIGHT_ATTRS={"DEP": "p"}), node("y", LEFT_ID="x", REL_OP=">>")],
        "same two": [node("x", RIGHT_ATTRS={"DEP": "p"}), node("y", LEFT_ID="x", REL_OP=">>")],
        "four": [node("w"), node("x", LEFT_ID="w", REL_OP=">"), node("y", LEFT_ID="w", REL_OP=".*"),
                 node("z", LEFT_ID="x", REL_OP="<<", RIGHT_ATTRS={"DEP": "q"})],
        "nothing": [node("x", RIGHT_ATTRS={"LOWER": "zzz"}), node("y", LEFT_ID="x", REL_OP="$+")],
    }
    together = {tuple(r) for r in relations.match_patterns(tokens, patterns).collect()}
    alone = {
        (name, *r) for name, pattern in patterns.items()
        for r in relations.match_pattern(tokens, pattern).collect()
    }
    assert together == alone
    assert {r[0] for r in together} == {"one", "two", "same two", "four"}
    assert relations.dep_match(tokens, patterns).columns == ["doc_id", "tok_i", "tok_j"]
    with pytest.raises(ValueError, match="unknown link"):
        relations.match_patterns(tokens, {"x": [node("a"), node("b", LEFT_ID="a", REL_OP="?")]})


def test_numbers_of_deep_and_gappy_trees(spark):
    rows = random_forest(31) + [(60, 0, 3 * k, 3 * max(k - 1, 0), "a", "p") for k in range(20_000)]
    index = {(r[0], r[2]): r for r in rows}
    got = relations.tree_numbers(spark.createDataFrame(rows, SCHEMA))
    assert set(SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")) < set(got.columns)
    found = {(r.doc_id, r.i): r for r in got.collect()}
    assert len(found) == len(rows)
    assert [found[60, 3 * k][-3:] for k in (0, 1, 19_999)] == [(0, 19_999, 0), (1, 19_999, 1), (19_999, 19_999, 19_999)]
    for a in random_forest(31):
        assert found[a[0], a[2]].depth == len(ancestors(a, index))
        for b in random_forest(31):
            if (a[0], a[1]) == (b[0], b[1]):
                x, y = found[a[0], a[2]], found[b[0], b[2]]
                assert (x.pre < y.pre <= x.last) == (a[2] in ancestors(b, index))
    deps = lambda rows: spark.createDataFrame([(1, 0, i, h) for i, h in rows], "doc_id bigint, sent bigint, i bigint, head bigint")
    with pytest.raises(Exception, match="cycle"):
        relations.tree_numbers(deps([(0, 1), (1, 0), (2, 2)])).collect()
    with pytest.raises(Exception, match="head without a token"):
        relations.tree_numbers(deps([(0, 0), (2, 1)])).collect()
    assert relations.tree_numbers(deps([(0, 0)]).where("false")).count() == 0


@pytest.mark.parametrize("name", ["dep_numbers", "dep_ancestors", "dep_match", "dep_closure", "triplet_counts"])
def test_relation_queries(spark, name):
    compare(spark, name)


def test_sentences_are_numbered_together(spark, monkeypatch):
    """No walk over tokens one by one: the work of a batch is a few steps per level of the deepest tree."""
    steps = []
    plain = relations.np.repeat
    monkeypatch.setattr(relations.np, "repeat", lambda *a: steps.append(1) or plain(*a))
    parent, starts = [], []
    for n in range(1, 300):
        starts.append(len(parent))
        parent += [starts[-1] + k // 2 for k in range(n)]
    pre, last, depth = relations._walk(relations.np.array(parent), relations.np.array(starts))
    assert len(steps) == 1 + max(n.bit_length() for n in range(299))
    for s, t in zip(starts, [*starts[1:], len(parent)], strict=True):
        numbers = {}

        def walk(k, d):
            numbers[k] = [len(numbers), 0, d]
            for c in range(k + 1, t):
                if parent[c] == k:
                    walk(c, d + 1)
            numbers[k][1] = len(numbers) - 1

        walk(s, 0)
        assert [numbers[k] for k in range(s, t)] == [[*x] for x in zip(pre[s:t], last[s:t], depth[s:t], strict=True)]
