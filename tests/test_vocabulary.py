import random

import pytest
from against_sql import compare
from pyspark.sql import functions as F

from reportweave.functions.entities import NegationRules
from reportweave.operators import annotation, longform, vocabulary
from reportweave.operators.lookup import phrase_table

PHRASES = {
    "a": "pathology_ischaemic", "a b": "descriptor_cyst", "a b c": "location_eye", "b a": "pathology_vascular",
    "é": "descriptor_flow", "c .": "pathology_traumatic",
}
RULES = NegationRules(preceding=("no", "not the"), following=("unlikely",), termination=("but",), pseudo=("no more",))


def texts(seed):
    rng = random.Random(seed)
    words = ["a", "A", "b", "c", "É", "no", "not", "the", "unlikely", "but", "more", ".", "x", "\t", "　"]
    rows = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))) for _ in range(150)]
    return [*rows, None, "", "  ", "a", "no a b c", "  a b a", "a b a b c" * 300]


def columns(df):
    return {(r.doc_id, r.ent_pos): (r.entity_group, r.word, r.start, r.end, r.negated, r.tok_start, r.tok_end) for r in df.collect()}


@pytest.mark.parametrize("bits", [64, 1 << 22])
@pytest.mark.parametrize("rules", [RULES, None])
def test_table_gives_what_the_list_gives(spark, bits, rules):
    docs = spark.createDataFrame(list(enumerate(texts(1))), "doc_id bigint, text string").repartition(3)
    listed = longform.mention_table(annotation.annotate(docs, PHRASES, rules)).drop("score")
    found = vocabulary.vocabulary_entities(docs, phrase_table(spark, PHRASES), rules, 3, bitmap_bits=bits)
    assert sorted(found.columns) == sorted(listed.columns)
    assert columns(found) == columns(listed)
    empty = vocabulary.vocabulary_entities(docs, phrase_table(spark, PHRASES).where("false"), rules, 3, bitmap_bits=bits)
    assert empty.count() == 0
    assert vocabulary.vocabulary_entities(docs.where("false"), phrase_table(spark, PHRASES), rules, 3, bitmap_bits=bits).count() == 0


def test_plan_holds_no_phrase_and_moves_no_text(spark):
    many = spark.range(100_000).select(
        F.concat(F.lit("phrase "), F.col("id").cast("string")).alias("phrase"), F.lit("descriptor_cyst").alias("label")
    )
    docs = spark.createDataFrame([(1, "no phrase 77 but phrase 100000 and phrase 99999.")], "doc_id bigint, text string")
    found = vocabulary.vocabulary_entities(docs, many, RULES, 2)
    rows = [(r.word, r.negated) for r in found.orderBy("ent_pos").collect()]
    assert rows == [("phrase 77", True), ("phrase 99999", False)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "99999" not in plan
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert moved and not any("text" in line for line in moved)


def test_query(spark):
    compare(spark, "gazetteer_negex")
