"""Scores worked out by hand and by plain counting."""

import random

import pytest
from pyspark.sql import functions as F

from against_sql import compare
from reportweave import vocab
from reportweave.functions import labels
from reportweave.operators import alignment, classifier, evaluation, tasks

KEEP = ["a", "b", "c", "d"]
DOCS = [(1, ["a", "b"], ["a"]), (2, ["a"], ["a", "c"]), (3, [], []), (4, ["b", "z"], ["a", "d", "z"])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, gold array<string>, pred array<string>")


def rows(df, *names):
    return {r.label: tuple(None if r[n] is None else round(r[n], 6) for n in names) for r in df.collect()}


def test_confusion_drops_labels_without_gold(docs):
    got = rows(evaluation.multilabel_confusion(docs, KEEP), "tn", "fp", "fn", "tp")
    assert got == {"a": (1, 1, 0, 2), "b": (2, 0, 2, 0)}
    every = rows(evaluation.multilabel_confusion(docs, KEEP, classes="keep_list"), "tn", "fp", "fn", "tp")
    assert every["c"] == (3, 1, 0, 0) and len(every) == 4


def test_report(docs):
    got = rows(evaluation.multilabel_report(docs, KEEP), "precision", "recall", "f1", "support")
    assert got["a"] == (0.666667, 1.0, 0.8, 2) and got["b"] == (0.0, 0.0, 0.0, 2)
    assert got["micro avg"] == (0.666667, 0.5, 0.571429, 4)
    assert got["macro avg"] == (0.333333, 0.5, 0.4, 4)
    # documents: (1, .5, 2/3), (1, 1, 1), (0, 0, 0), (0, 0, 0)
    assert got["samples avg"] == (0.5, 0.375, 0.416667, 4)


def test_specificity_without_negatives_is_null(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["a"]), (2, ["a"], ["b"])], "doc_id bigint, gold array<string>, pred array<string>")
    got = rows(evaluation.specificity(evaluation.multilabel_confusion(df, KEEP)), "specificity")
    assert got == {"a": (None,), "b": (0.0,), "micro avg": (0.0,), "macro avg": (None,), "weighted avg": (None,)}
    metrics = rows(evaluation.domain_metrics(df, keep=KEEP), "sensitivity", "specificity")
    assert metrics["samples avg"] == (None, None) and metrics["b"] == (0.0, 0.0)


def test_binariser_and_errors(docs):
    got = {(r.doc_id, r.label): (r.gold, r.pred) for r in evaluation.binarise_labels(docs, KEEP).collect()}
    assert len(got) == 8 and got[(4, "a")] == (False, True) and got[(1, "b")] == (True, False)
    errors = {(r.doc_id, r.label, r.kind) for r in evaluation.label_errors(docs, KEEP).collect()}
    assert errors == {(1, "b", "false_negative"), (4, "b", "false_negative"), (4, "a", "false_positive")}


def test_errors_carry_asserted_entities(spark):
    df = spark.sql(
        "select 1L doc_id, array('a') gold, array('b') pred, array(named_struct('word','W','entity_group','b',"
        "'negated',false), named_struct('word','V','entity_group','a','negated',true)) ents")
    got = evaluation.label_errors(df, KEEP, ents="ents", classes="keep_list").collect()
    assert {r.kind for r in got} == {"false_positive", "false_negative"}
    assert all([tuple(f) for f in r.found] == [("W", "b")] for r in got)


def test_class_report_against_spark_ml(spark):
    from pyspark.mllib.evaluation import MulticlassMetrics

    rnd = random.Random(2)
    pairs = [(rnd.choice("xyz"), rnd.choice("xyz")) for _ in range(200)]
    got = rows(evaluation.class_report(spark.createDataFrame(pairs, "gold string, pred string")), "precision", "recall", "f1", "support")
    code = {c: float(k) for k, c in enumerate("xyz")}
    metrics = MulticlassMetrics(spark.sparkContext.parallelize([(code[p], code[g]) for g, p in pairs]))
    for c, k in code.items():
        expected = (metrics.precision(k), metrics.recall(k), metrics.fMeasure(k))
        assert got[c][:3] == tuple(round(v, 6) for v in expected)
    assert got["accuracy"][0] == round(metrics.accuracy, 6)


def test_span_scores(spark):
    schema = "doc_id bigint, start bigint, end bigint, label string"
    gold = spark.createDataFrame([(1, 0, 3, "a"), (1, 5, 8, "a"), (2, 0, 2, "b")], schema)
    pred = spark.createDataFrame([(1, 0, 3, "a"), (1, 5, 8, "b"), (1, 6, 9, "a")], schema)
    got = rows(evaluation.span_scores(gold, pred), "tp", "fp", "fn")
    assert got == {"a": (1, 1, 1), "b": (0, 1, 1), "all": (1, 2, 2)}
    empty = rows(evaluation.span_scores(gold, pred.limit(0)), "tp", "fp", "fn", "f1")
    assert empty["all"] == (0, 0, 3, 0.0)


@pytest.mark.parametrize("flags,expected", [
    ((True, True, True, True), "IS_NORMAL_FOR_AGE"), ((True, True, True, None), "IS_NORMAL"),
    ((True, True, False, None), "IS_COMPARATIVE"), ((True, None, None, None), "IS_MISSING"),
    ((None, None, None, None), "ABNORMAL"),
])
def test_normality_class(spark, flags, expected):
    df = spark.createDataFrame([flags], "a boolean, b boolean, c boolean, d boolean")
    assert df.select(labels.normality_class(*[F.col(c) for c in "abcd"])).head()[0] == expected


def test_label_names(spark):
    df = spark.createDataFrame([("IS_NORMAL",)], "l string")
    assert df.select(labels.map_label(F.col("l"), vocab.NORMALITY_DISPLAY)).head()[0] == "Normal"
    bad = spark.createDataFrame([("OTHER",)], "l string")
    with pytest.raises(Exception, match="unknown label"):
        bad.select(labels.map_label(F.col("l"), vocab.NORMALITY_DISPLAY)).collect()
    spelled = spark.createDataFrame([("pathology-ophthalmological",)], "l string")
    assert spelled.select(labels.normalise_label(F.col("l"))).head()[0] in vocab.PATHOLOGIES


def test_class_codes_and_classifier(spark):
    df = spark.createDataFrame([(i, "good clear" if i % 2 else "bad mass", "N" if i % 2 else "A") for i in range(40)],
                               "doc_id bigint, text string, normality_class string")
    assert {(r.normality_class, r.label_id) for r in classifier.class_encode(df, "normality_class").collect()} == {("A", 0), ("N", 1)}
    model = classifier.fit_classifier(df, features=1 << 10)
    got = classifier.classify_documents(model, df).collect()
    assert all(r.label == r.normality_class and 0.5 < r.score <= 1 for r in got)


def test_task_records(spark):
    df = spark.sql(
        "select 't' text, array(named_struct('entity_group','pathology_vascular','negated',false),"
        "named_struct('entity_group','pathology_endocrine','negated',true)) ents")
    r = tasks.choice_tasks(df).head()
    assert r.accept == ["pathology_vascular"] and r.answer == "accept" and len(r.options) == 15
    assert tasks.choice_tasks(df, ignore_negation=True).head().accept == ["pathology_endocrine", "pathology_vascular"]
    r = tasks.relabel_tasks(df.withColumn("accept", F.array(F.lit("old")))).head()
    assert r.accept == ["pathology-vascular"]
    spans = spark.sql("select array(named_struct('token_start',2,'token_end',2,'label','x')) s")
    assert tuple(spans.select(tasks.exclusive_ends(F.col("s"))).head()[0][0]) == ("x", 2, 3)


def test_errors_and_comparison_carry_the_text(spark):
    df = spark.createDataFrame([(1, ["a"], ["b"], "whole text")], "doc_id bigint, gold array<string>, pred array<string>, text string")
    errors = evaluation.label_errors(df, ["a", "b"], classes="keep_list", carry=["text"])
    assert errors.columns == ["doc_id", "text", "label", "kind"] and {r.text for r in errors.collect()} == {"whole text"}
    assert evaluation.gold_vs_pred(df, ["a", "b"], carry=["text"]).first().text == "whole text"


def test_confusion_is_one_aggregate_without_new_rows(spark):
    df = spark.createDataFrame([(1, ["a"], ["b"])], "doc_id bigint, gold array<string>, pred array<string>")
    plan = evaluation.multilabel_confusion(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "explode" not in plan


TOKENISED = "doc_id bigint, tokens array<string>, ents array<struct<tok_start:int,tok_end:int,entity_group:string>>"


def test_spans_over_two_tokenisations(spark):
    gold = spark.createDataFrame([
        (1, ["white", "matter", "and", "oedema"], [(0, 2, "x"), (3, 4, "y")]),
        (2, ["old", "stroke"], [(1, 2, "x")]),
        (3, [], []), (4, None, None), (5, ["a"], [(0, 1, "x")]),
    ], TOKENISED)
    pred = spark.createDataFrame([
        (1, ["white ", "mat", "ter", "", "\u00a0and", "oe", "dema"], [(0, 3, "x"), (5, 7, "y")]),
        (2, ["o", "ld", "stro", "ke"], [(2, 3, "x")]),  # half of the word
        (3, [" "], []), (4, [], None),
    ], TOKENISED)
    got = {r.label: (r.tp, r.fp, r.fn) for r in evaluation.tokenised_span_scores(gold, pred).collect()}
    assert got == {"x": (1, 1, 2), "y": (1, 0, 0), "all": (2, 1, 2)}
    none = evaluation.tokenised_span_scores(gold.where("doc_id > 9"), pred.where("doc_id > 9"))
    assert none.collect() == []


def test_sides_with_other_characters(spark):
    gold = spark.createDataFrame([(1, ["ab"], [(0, 1, "x")]), (2, ["c"], [(0, 1, "x")])], TOKENISED)
    pred = spark.createDataFrame([(1, ["a", "x"], [(0, 2, "x")]), (2, ["c"], [(0, 1, "x")])], TOKENISED)
    with pytest.raises(Exception, match="different characters in document 1"):
        evaluation.tokenised_span_scores(gold, pred).collect()
    skipped = evaluation.tokenised_span_scores(gold, pred, on_difference="skip").where("label = 'all'").first()
    assert (skipped.tp, skipped.fp, skipped.fn) == (1, 0, 0)
    with pytest.raises(ValueError):
        evaluation.tokenised_span_scores(gold, pred, on_difference="drop")


def test_each_side_is_read_once(spark, tmp_path):
    for name in ("gold", "pred"):
        rows_ = [(1, ["a", "b"], [(0, 1, "x")]), (None, ["c"], [(0, 1, "y")]), (3, ["d"], [])]
        spark.createDataFrame(rows_, TOKENISED).write.parquet(str(tmp_path / name))
    scores = evaluation.tokenised_span_scores(*(spark.read.parquet(str(tmp_path / n)) for n in ("gold", "pred")))
    assert scores._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    assert scores._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan parquet") == 2
    assert rows(scores, "tp", "fp", "fn") == {"x": (1, 0, 0), "y": (1, 0, 0), "all": (2, 0, 0)}


def test_spans_in_any_order_are_placed(spark):
    tokens = ["a ", "\u00a0", "bc", "\u2003d", "", "\u00e9f"]
    spans = [[(0, 1), (2, 3), (3, 6)], [(2, 4), (0, 3)], [(0, 6), (1, 2)], [(0, 0), (6, 6)], [], None]
    df = spark.createDataFrame([(i, tokens, None if s is None else [(*e, "x") for e in s]) for i, s in enumerate(spans)], TOKENISED)
    placed = alignment.common_spans(F.col("tokens"), F.col("ents"))
    count = lambda k: len("".join("".join(tokens[:k]).split()))
    got = {r.doc_id: r.s and [tuple(s) for s in r.s] for r in df.select("doc_id", placed.alias("s")).collect()}
    assert got == {i: s and [(count(a), count(b), "x") for a, b in s] for i, s in enumerate(spans)}


def test_scores_of_texts_spaced_apart(spark):
    compare(spark, "span_scores_spaced")


def test_states_of_parts_add_up(spark):
    from reportweave.plans.queries import gold_and_pred

    df = gold_and_pred(spark, "/root/testdata/sf0.001")
    parts = [evaluation.evaluation_state(df.where(F.xxhash64("doc_id") % 3 == k)) for k in (-2, -1, 0, 1, 2)]
    merged = evaluation.report_of(evaluation.merge_states(*parts))
    key = lambda rows: sorted((r.label, *[None if v is None else round(v, 9) for v in r[1:]]) for r in rows)
    whole = key(evaluation.domain_metrics(df).collect())
    assert key(merged.collect()) == whole and len(whole) > 5


def test_state_edges(spark):
    schema = "gold array<string>, pred array<string>"
    keep = ("a", "b", "c")
    rows = [(["a", "a"], ["b"]), (None, ["a"]), (["a", "x"], None), ([], ["c", "x"])]
    df = spark.createDataFrame(rows, schema)
    got = {r.label: r for r in evaluation.domain_metrics(df, keep).collect()}
    assert set(got) == {"a", "micro avg", "macro avg", "weighted avg", "samples avg"}
    assert (got["a"].support, got["a"].precision, got["a"].recall, got["a"].specificity) == (2, 0.0, 0.0, 0.5)
    everything = {r.label for r in evaluation.domain_metrics(df, keep, classes="keep_list").collect()}
    assert everything == {*keep, "micro avg", "macro avg", "weighted avg", "samples avg"}
    nothing = {r.label: r for r in evaluation.domain_metrics(df.where("false"), keep).collect()}
    assert nothing["samples avg"].support == 0 and "a" not in nothing


def test_domain_metrics_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "scored")
    spark.createDataFrame(DOCS, "doc_id bigint, gold array<string>, pred array<string>").write.parquet(path)
    report = evaluation.domain_metrics(spark.read.parquet(path), KEEP)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan or plan.count("FileScan parquet") == 1
