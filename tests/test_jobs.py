"""Whole jobs on a small invented report table."""

import pytest
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions import entities as en
from reportweave.functions import text as tx
from reportweave.operators import annotation
from reportweave.plans import jobs
from reportweave.sources.stored import store

PHRASES = {"infarct": "pathology_ischaemic", "sinusitis": "pathology_infectious", "spine": "pathology_musculoskeletal",
           "goitre": "pathology_endocrine", "cortex": "location_grey_matter"}
RULES = en.NegationRules(preceding=("no",), termination=("and",))


@pytest.fixture(scope="module")
def reports(spark):
    bodies = ["There is an infarct in the cortex today.", "There is no infarct and a goitre is seen here.",
              "Known sinusitis, and a large goitre is present.", "The spine and a goitre were both reported.", None]
    rows = [(k, bodies[k % 5], float(k % 4), float(k % 3), "header", None) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, Narrative string, _X double, _Y double, report_header string, report_tail string")
    for s in vocab.SECTIONS:
        if s not in df.columns:
            df = df.withColumn(s, F.col("Narrative"))
    return store(df, "reports")


def test_masking_then_domains(reports):
    masked = jobs.mask_reports(reports, tx.mask_pattern(F.col("report_body"), "goitre"))
    got = {r.doc_id: r for r in jobs.extract_domains(masked, PHRASES, RULES).collect()}
    assert len(got) == 60 and got[0].asserted_pathology_ischaemic == 1 and got[1].denied_pathology_ischaemic == 1
    assert got[1].asserted_pathology_endocrine == 0 and got[4].asserted_pathology_ischaemic == 0
    assert got[0].asserted_location_grey_matter == 1


def test_training_sets(reports):
    ner = jobs.entity_training_set(reports, PHRASES, size=20, clusters=2).collect()
    assert len(ner) == 20 and all(len(r.tokens) == len(r.ner_tags) for r in ner)
    neg = jobs.negation_training_set(reports, PHRASES, RULES, size=20, clusters=2).collect()
    assert {t for r in neg for t in r.ner_tags} <= {"O", "B-asserted", "B-negated"}
    fine = jobs.fine_tuning_set(reports, PHRASES, size=9).collect()
    assert len(fine) == 9 and all("B-pathology_infectious" not in r.ner_tags for r in fine)
    seg = jobs.segmentation_training_set(reports, 20).collect()
    assert sorted(r.split for r in seg) == ["dev"] * 2 + ["test"] * 2 + ["train"] * 16
    assert all(r.report_tail is not None for r in seg)


def test_records_for_people(reports):
    counted = jobs.extract_domains(reports, PHRASES, RULES, "report_body")
    made = jobs.prospective_tasks(counted, PHRASES, RULES, total=150).collect()
    assert made and all("spine" not in r.text for r in made)
    assert sum(r.domain == "pathology_ischaemic" for r in made) == 10
    dumps = jobs.section_review_tasks(reports, {"there": "report_body"}, 5).collect()
    assert len(dumps) == 5
    seg = jobs.segmentation_tasks(reports, 5).collect()
    assert all(r.text[e.start : e.end] for r in seg for e in r.ents)


def test_evaluation_of_accepted_records(spark, reports):
    found = annotation.annotate(reports.select("doc_id", F.col("Narrative").alias("text")), PHRASES, RULES)
    gold = spark.createDataFrame(
        [(0, "accept", ["pathology-ischaemic"]), (1, "accept", ["pathology-ischaemic"]), (2, "reject", []), (3, "accept", [])],
        "doc_id bigint, answer string, accept array<string>")
    scored = jobs.gold_and_predicted(gold, found)
    metrics, errors = jobs.evaluate_domains(scored)
    rows = {r.label: r for r in metrics.collect()}
    assert rows["pathology_ischaemic"].recall == 0.5 and rows["pathology_ischaemic"].specificity == 1.0
    assert [(r.doc_id, r.kind, [f.entity_group for f in r.found]) for r in errors.collect()] == [
        (1, "false_negative", ["pathology_endocrine"])]
    texts = scored.withColumn("text", F.concat(F.lit("report "), F.col("doc_id")))
    assert [r.text for r in jobs.evaluate_domains(texts, carry=["text"])[1].collect()] == ["report 1"]


def _loads():
    def ner():
        return lambda texts: [[{"entity_group": "haemorrhage", "score": 1.0, "word": "x", "start": 0, "end": 1}] for _ in texts]

    def negation():
        return lambda texts: [[{"entity_group": "negated", "score": 1.0, "word": "no", "start": 0, "end": 2}] for _ in texts]

    return ner, negation


def test_models_run_once_per_text(spark):
    from reportweave.operators import inference

    df = spark.createDataFrame([(1, "no bleed"), (2, None)], "doc_id bigint, text string")
    found = inference.annotate_with_models(df, *_loads())
    exploded = found.where(F.size("ents") > 0).select("doc_id", F.posexplode("ents").alias("p", "e"))
    plan = exploded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert [r.e.negated for r in exploded.collect()] == [True, True]


def test_jobs_take_a_model_backed_annotator(spark):
    from reportweave.operators import inference

    label = next(iter(vocab.DOMAINS))

    def ner():
        return lambda texts: [[{"entity_group": label, "score": 1.0, "word": "x", "start": 9, "end": 12}] for _ in texts]

    annotator = lambda df: inference.annotate_with_models(df, ner, _loads()[1])
    df = spark.createDataFrame([(1, "no bleed in it", "keep")], "doc_id bigint, report_body string, other string")
    got = jobs.extract_domains(df, annotator, text="report_body")
    assert got._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    row = got.first()
    assert row.other == "keep" and row[f"asserted_{label}"] == 1 and row[f"denied_{label}"] == 0
