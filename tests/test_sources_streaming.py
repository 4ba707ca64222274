"""Files in and out, user models, streams, and the plans of registered queries."""

import json

import pytest
from pyspark.sql import functions as F

from reportweave.operators import annotation, counts, inference, sampling, tasks
from reportweave.plans import standins as st
from reportweave.plans.checks import checks
from reportweave.plans.queries import QUERIES
from reportweave.sources import jsonl, reports, schemas, stored, tables
from reportweave.streaming import annotate as stream

CSV = '''IS_NORMAL,Narrative,_X,End Exam Date,report_body,Unused
True,"line one
line two",0.5,2021-09-01,"said ""no""",1
False,NA,bad,not a date,,2
,plain,,2022-01-31,null,3
'''


def test_report_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text(CSV)
    columns = ["Narrative", "report_body", "IS_NORMAL", "_X", "End Exam Date"]
    got = reports.read_reports(spark, str(tmp_path / "r.csv"), columns).collect()
    assert [tuple(r)[:4] for r in got] == [
        ("line one\nline two", 'said "no"', True, 0.5), (None, None, False, None), ("plain", None, None, None)]
    assert [str(r[4]) for r in got] == ["2021-09-01", "None", "2022-01-31"]
    with pytest.raises(ValueError, match="Nope"):
        reports.read_reports(spark, str(tmp_path / "r.csv"), ["Nope"])


def test_csv_index_landing_and_split(spark, tmp_path):
    (tmp_path / "i.csv").write_text(",text\n7,a\n8,b\n")
    df = reports.read_reports(spark, str(tmp_path / "i.csv"), index="doc_id")
    assert [tuple(r) for r in df.collect()] == [("7", "a"), ("8", "b")]
    reports.land_reports(df.drop("doc_id"), str(tmp_path / "landed"))
    landed = tables.load_dataset(spark, str(tmp_path / "landed"))
    assert landed.select("doc_id").distinct().count() == 2
    split = sampling.exact_split(spark.range(10).selectExpr("id", "concat('x\"', id, '\n') t"), ["id"], 1)
    reports.write_reports(split, str(tmp_path / "s"), split="split")
    back = [reports.read_split(spark, str(tmp_path / "s"), s) for s in ("train", "dev", "test")]
    assert [b.count() for b in back] == [8, 1, 1]
    assert {r.t for b in back for r in b.collect()} == {f'x"{k}\n' for k in range(10)}


def test_jsonl_metrics_errors_patterns(spark, tmp_path):
    lines = [{"text": "t", "answer": "accept", "accept": ["a"]}, {"text": "u", "answer": "reject", "accept": []}]
    (tmp_path / "t.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n{broken\n")
    df = jsonl.read_jsonl(spark, str(tmp_path / "t.jsonl"), schemas.CHOICE_TASK).cache()
    assert df.where("_corrupt_record is not null").count() == 1
    assert [r.text for r in tasks.accepted(df).collect()] == ["t"]
    jsonl.write_jsonl(tasks.text_only(tasks.accepted(df)), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).columns == ["text"]
    jsonl.write_metrics(spark.sql("select 'a' label, cast(null as double) specificity"), str(tmp_path / "m"))
    assert "specificity" in spark.read.json(str(tmp_path / "m")).columns
    jsonl.write_errors(spark.sql("select 1 doc_id, 'a' label, 'false_positive' kind"), str(tmp_path / "e"))
    assert (tmp_path / "e" / "label=a" / "kind=false_positive").is_dir()
    (tmp_path / "p.json").write_text(json.dumps({"p": [{"RIGHT_ID": "a", "RIGHT_ATTRS": {}}]}, indent=1))
    assert list(jsonl.read_patterns(spark, str(tmp_path / "p.json"))) == ["p"]


def test_stored_table_goes_to_the_checkpoint_folder(spark):
    stored_table = stored.store(spark.range(3), "t")
    assert stored_table.count() == 3
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = named.split(":")[-1].rstrip("/")
    assert all(f"{path}/t-" in f for f in stored_table.inputFiles())


def test_user_models_run_in_batches(spark):
    def load():
        def predict(texts):
            assert 0 < len(texts) <= 4
            return [[{"entity_group": "x", "score": 0.5, "word": t[:2], "start": 0, "end": 2}] for t in texts]
        return predict

    def negation():
        return lambda texts: [[{"entity_group": "negated", "score": 1.0, "word": "", "start": 2, "end": 3}]
                              if t.startswith("no") else [] for t in texts]

    df = spark.createDataFrame([(k, t) for k, t in enumerate(["no way", "yes", " ", None] * 5)], "doc_id int, text string")
    got = inference.annotate_with_models(df, load, negation, batch_size=4).collect()
    assert len(got) == 20
    for r in got:
        assert r.ents[0].negated == (r.text == "no way")
        assert r.text in ("no way", "yes", "<placeholder>")


def test_stream_gives_the_batch_result(spark, tmp_path):
    docs = tables.read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    docs.repartition(3).write.parquet(str(tmp_path / "in"))
    source = stream.read_report_stream(spark, str(tmp_path / "in"), "doc_id bigint, text string", 1)
    counted = stream.domain_count_stream(source, st.PHRASES, st.RULES).drop("text")
    query = stream.write_stream(counted, str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination(120)
    batch = counts.domain_counts_wide(annotation.assertions(docs, st.PHRASES, st.RULES)).drop("text")
    streamed = spark.read.parquet(str(tmp_path / "out")).select(batch.columns)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def plan_of(spark, name):
    return QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["domain_counts_wide", "iob_tags", "section_documents", "mask_spans"])
def test_row_local_queries_do_not_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert "hashpartitioning" not in plan and "Window" not in plan and "Python" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


@pytest.mark.parametrize("name", ["gazetteer_mentions", "mention_negation", "span_align", "entity_relations",
                                  "stratified_sample", "bootstrap_sample", "tagger_apply"])
def test_no_nested_loop_joins(spark, name):
    plan = plan_of(spark, name)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_every_query_but_the_learned_ones_has_a_check():
    assert set(QUERIES) - set(checks()) == {"cluster_strata", "classify_documents"}
    assert set(checks()) <= set(QUERIES)
