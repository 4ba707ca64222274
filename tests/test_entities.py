"""Phrase lookup, negation, overlap, tags and counts against plain Python."""

import random
import time

import pytest
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions import entities as en
from reportweave.functions import text as tx
from reportweave.operators import alignment, annotation, counts, gazetteer, longform, negation
from reportweave.operators.lookup import phrase_table

PHRASES = {
    "infarct": "pathology_ischaemic", "old infarct": "pathology_vascular",
    "white matter": "location_white_matter", "matter": "location_other",
    "infarct white matter": "descriptor_damage", "cyst": "descriptor_cyst",
}
RULES = en.NegationRules(
    preceding=("no", "no evidence of"), following=("excluded", "is ruled out"),
    termination=("but",), pseudo=("no change",),
)


def greedy(words, phrases):
    found, i = [], 0
    while i < len(words):
        for n in range(4, 0, -1):
            surface = " ".join(words[i : i + n])
            if len(words[i : i + n]) == n and surface in phrases:
                found.append((phrases[surface], i, i + n))
                i += n
                break
        else:
            i += 1
    return found


def python_negex(words, marks, rules):
    triggers = greedy(words, rules.phrases())
    starts = {0} | {s for k, s, _ in triggers if k == "termination"}
    starts |= {i + 1 for i, w in enumerate(words) if w in rules.sentence_ends}
    bounds = sorted(starts) + [len(words) + 10]
    out = []
    for label, s, e in marks:
        seg = max(b for b in bounds if b <= s)
        nxt = min(b for b in bounds if b > s)
        inside = [(k, a, b) for k, a, b in triggers if seg <= a < nxt]
        hit = any(k == "preceding" and a < s for k, a, _ in inside) or any(
            k == "following" and b > e for k, _, b in inside
        )
        out.append(label in rules.eligible and e <= nxt and hit)
    return out


def random_texts(n, seed):
    rnd = random.Random(seed)
    vocabulary = ["no", "evidence", "of", "change", "old", "infarct", "white", "matter", "cyst",
                  "excluded", "is", "ruled", "out", "but", ".", "word", "Old", "\n"]
    return [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 120))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    rows = list(enumerate(random_texts(60, 3)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), dict(rows)


def test_annotation_equals_plain_greedy_and_negex(spark, texts):
    df, by_id = texts
    for row in annotation.annotate(df, PHRASES, RULES).collect():
        if not by_id[row.doc_id].strip():
            assert row.text == by_id[row.doc_id] and row.ents == []
            continue
        words = [w.lower() for w in row.text.split()]
        marks = greedy(words, PHRASES)
        assert [(e.entity_group, e.tok_start, e.tok_end) for e in row.ents] == marks
        assert [e.negated for e in row.ents] == python_negex(words, marks, RULES)
        assert all(row.text[e.start : e.end] == e.word for e in row.ents)
        assert all(" ".join(e.word.lower().split()) in PHRASES for e in row.ents)


def test_short_form_equals_full_annotation(texts):
    df, _ = texts
    full = annotation.annotate(df, PHRASES, RULES).select(
        "doc_id", F.transform("ents", lambda e: F.struct(e["entity_group"], e["negated"])).alias("e")
    )
    short = annotation.assertions(df, PHRASES, RULES).select("doc_id", "ents")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, short.collect()))


@pytest.mark.parametrize("text,expected", [
    ("no infarct", [True]),
    ("no cyst. infarct", [True, False]),
    ("no cyst but infarct", [True, False]),
    ("infarct excluded", [True]),
    ("infarct. excluded", [False]),
    ("no change infarct", [False]),
    ("white matter no", [False]),
    ("no matter", [False]),
])
def test_negex_cases(spark, text, expected):
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    ents = annotation.annotate(df, PHRASES, RULES).head().ents
    assert [e.negated for e in ents] == expected


def test_blank_text_yields_a_row(spark):
    df = spark.createDataFrame([(1, "   "), (2, None), (3, "")], "doc_id bigint, text string")
    assert [r.ents for r in annotation.annotate(df, PHRASES, RULES).collect()] == [[], [], []]


def test_join_form_equals_row_form(spark, texts):
    df, _ = texts
    row = longform.mention_table(annotation.annotate(df, PHRASES)).select(
        "doc_id", "ent_pos", "entity_group", "start", "end", "tok_start", "tok_end")
    expected = sorted(map(tuple, row.collect()))
    table = phrase_table(spark, PHRASES)
    assert sorted(map(tuple, gazetteer.gazetteer_mentions(df, table, 3).collect())) == expected
    # The way for phrase tables beyond Spark's broadcast threshold.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, gazetteer.gazetteer_mentions(df, table, 3).collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def overlap_reference(ents, spans, closed):
    out = []
    for s, e in ents:
        flag = False
        for group, a, b in spans:
            if (s <= b and a <= e) if closed else (s < b and a < e):
                flag = group == "negated"
                break
        out.append(flag)
    return out


@pytest.mark.parametrize("closed", [True, False])
def test_first_overlap_in_both_forms(spark, closed):
    rnd = random.Random(5)
    docs = []
    for k in range(40):
        ents = [(s, s + rnd.randint(1, 300)) for s in sorted(rnd.sample(range(2000), rnd.randint(0, 8)))]
        spans = [(rnd.choice(["negated", "asserted"]), s, s + rnd.randint(1, 600))
                 for s in (rnd.randint(0, 2000) for _ in range(rnd.randint(0, 5)))]
        docs.append((k, ents, spans))
    docs += [(90, [(0, 5)], [("negated", 5, 9)]), (91, [(0, 5)], [("asserted", 0, 2), ("negated", 0, 5)]), (92, [(3, 4)], [])]
    expected = {(k, i): f for k, e, s in docs for i, f in enumerate(overlap_reference(e, s, closed))}
    mentions = spark.createDataFrame(
        [(k, i, "x", s, e) for k, ents, _ in docs for i, (s, e) in enumerate(ents)],
        "doc_id bigint, ent_pos bigint, entity_group string, start bigint, end bigint")
    spans = spark.createDataFrame(
        [(k, i, g, a, b) for k, _, sp in docs for i, (g, a, b) in enumerate(sp)],
        "doc_id bigint, neg_pos bigint, entity_group string, start bigint, end bigint")
    table = negation.mention_negation(mentions, spans, closed)
    assert {(r.doc_id, r.ent_pos): r.negated for r in table.collect()} == expected
    nested = spark.createDataFrame(
        [(k, [("x", s, e, False) for s, e in ents], sp) for k, ents, sp in docs],
        "doc_id bigint, ents array<struct<entity_group:string,start:int,end:int,negated:boolean>>,"
        "spans array<struct<entity_group:string,start:int,end:int>>")
    got = nested.withColumn("ents", en.first_overlap_negated(F.col("ents"), F.col("spans"), closed))
    assert {(r.doc_id, i): e.negated for r in got.collect() for i, e in enumerate(r.ents)} == expected


@pytest.mark.parametrize("closed", [True, False])
def test_overlap_with_sorted_spans_by_search(spark, closed):
    rnd = random.Random(7)
    docs = []
    for k in range(60):
        ents = [(s, s + rnd.randint(0, 30)) for s in (rnd.randint(0, 200) for _ in range(rnd.randint(0, 12)))]
        spans = [(rnd.choice(["negated", "asserted"]), s, s + rnd.choice([0, 1, 5, 120]))
                 for s in sorted(rnd.randint(0, 200) for _ in range(rnd.randint(0, 20)))]
        docs.append((k, ents, spans))
    nested = spark.createDataFrame(
        [(k, [("x", s, e, False) for s, e in ents], sp) for k, ents, sp in docs],
        "doc_id bigint, ents array<struct<entity_group:string,start:int,end:int,negated:boolean>>,"
        "spans array<struct<entity_group:string,start:int,end:int>>")
    got = nested.withColumn("ents", en.first_overlap_negated(F.col("ents"), F.col("spans"), closed)).collect()
    wanted = {k: [bool(f) for f in overlap_reference(ents, sp, closed)] for k, ents, sp in docs}
    assert {r.doc_id: [e.negated for e in r.ents] for r in got} == wanted
    holes = spark.sql(
        "select array(named_struct('start', 1, 'end', 4, 'negated', true)) e, s from values "
        "(cast(null as array<struct<entity_group:string,start:int,end:int>>)), "
        "(array(named_struct('entity_group', 'negated', 'start', 0, 'end', cast(null as int)),"
        " named_struct('entity_group', 'negated', 'start', 2, 'end', 3))) t(s)")
    flags = [r[0][0].negated for r in holes.select(en.first_overlap_negated(F.col("e"), F.col("s"), closed)).collect()]
    assert flags == [False, True]


def test_overlap_of_many_with_many(spark):
    n = 20_000
    row = spark.range(1).select(
        F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(
            (i * 10).alias("start"), (i * 10 + 4).alias("end"), F.lit(False).alias("negated"))).alias("e"),
        F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(
            F.when(i % 3 == 0, "negated").otherwise("asserted").alias("entity_group"),
            (i * 10 + 2).alias("start"), (i * 10 + 6).alias("end"))).alias("s"))
    begin = time.time()
    flagged = row.select(F.filter(en.first_overlap_negated(F.col("e"), F.col("s")), lambda e: e["negated"]).alias("e"))
    assert flagged.select(F.size("e")).first()[0] == (n + 2) // 3
    assert time.time() - begin < 40  # all pairs are 4 * 10^8


def test_iob_in_both_forms_and_clearing(spark, texts):
    df, _ = texts
    docs = annotation.annotate(df, PHRASES, RULES, keep_tokens="tokens")
    nested = docs.select("doc_id", en.iob_tags(F.col("ents"), F.size("tokens")).alias("t"), "tokens")
    table = alignment.iob_table(longform.token_table(df), longform.mention_table(docs))
    by_doc = {}
    for r in table.collect():
        by_doc.setdefault(r.doc_id, {})[r.i] = r.tag
    for r in nested.collect():
        assert len(r.t) == len(r.tokens)
        if by_doc.get(r.doc_id):
            assert r.t == [by_doc[r.doc_id][i] for i in range(len(r.t))]
    cleared = nested.select(en.clear_tags(F.col("t"), F.col("tokens"), ["Old", "cyst"]).alias("c"), "t", "tokens")
    for r in cleared.collect():
        assert r.c == ["O" if "Old" in w or "cyst" in w else t for t, w in zip(r.t, r.tokens)]


def test_strict_alignment_drops_spans_off_token_edges(spark):
    df = spark.createDataFrame([(1, "old infarct here")], "doc_id bigint, text string")
    spans = spark.createDataFrame(
        [(1, 0, 0, 11), (1, 1, 4, 11), (1, 2, 5, 11), (1, 3, 0, 10)],
        "doc_id bigint, ent_pos bigint, start bigint, end bigint")
    got = alignment.span_align(spans, longform.token_table(df)).collect()
    assert sorted((r.ent_pos, r.tok_start, r.tok_end) for r in got) == [(0, 0, 2), (1, 1, 2)]


def test_domain_counts_keep_zero_rows_and_forms_agree(spark, texts):
    df, _ = texts
    ents = annotation.assertions(df, PHRASES, RULES).drop("text")
    wide = counts.domain_counts_wide(ents).collect()
    assert len(wide) == df.count() and len(wide[0]) == 1 + 92
    long = counts.domain_counts(ents.select("doc_id", F.inline("ents"))).collect()
    total = {}
    for r in long:
        total[(r.doc_id, ("denied_" if r.negated else "asserted_") + r.entity_group)] = r.n
    for r in wide:
        for k, v in r.asDict().items():
            if k != "doc_id":
                assert v == total.get((r.doc_id, k), 0)


def test_triplets_and_tensor(spark):
    mentions = spark.createDataFrame(
        [(1, 0, "pathology_ischaemic", True), (1, 1, "pathology_ischaemic", True),
         (1, 2, "location_eye", False), (1, 3, "descriptor_cyst", False)],
        "doc_id bigint, ent_pos bigint, entity_group string, negated boolean")
    relations = spark.createDataFrame(
        [(1, 3, "location_eye"), (1, 3, "location_skull")],
        "doc_id bigint, ent_pos bigint, target_group string")
    cells = counts.triplet_counts(mentions, relations)
    docs = spark.createDataFrame([(1,), (2,)], "doc_id bigint")
    tensors = {r.doc_id: r.tensor for r in counts.triplet_tensor(docs, cells).collect()}
    at = lambda x, y, z: tensors[1][x * 40 + y * 2 + z]
    assert at(1, 0, 1) == 2
    cyst = vocab.TENSOR_ENTITIES.index("descriptor_cyst")
    eye = vocab.TENSOR_LOCATIONS.index("location_eye")
    assert (at(cyst, 0, 0), at(cyst, eye, 0)) == (1, 1)
    assert sum(tensors[1]) == 5 and len(tensors[1]) == 1080 and sum(tensors[2]) == 0
    bad = spark.createDataFrame([(1, 3, "pathology_vascular")], relations.schema)
    with pytest.raises(Exception, match="not a location"):
        counts.triplet_counts(mentions, bad).collect()
    assert counts.triplet_counts(mentions, bad, "skip").count() == 2
