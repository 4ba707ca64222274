from collections import Counter

import numpy as np

from reportweave.llm import language_id as li

SCHEMA = "doc_id bigint, text string, lang string, lang_pred string, score string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


TRAIN = [(i, t, g) for i, (t, g) in enumerate(
    [("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("the house", "en"), (None, "en"), ("x", None)]
)]


def test_words_first_then_shorter_grams(spark):
    model = li.fit(docs(spark, TRAIN))
    assert model.languages[0] == "en" and set(model.languages) == {"en", "fr"}
    words = Counter(("en", w) for w in "the cat and the dog the house".split())
    assert np.isclose(
        model.table[model.words["the"], 0],
        np.log((words["en", "the"] + 0.5) / (7 + 0.5 * len(model.words) + 1)),
    )
    scorer = li.Scorer(model)
    rows = [model.grams["chien"[:5]]]
    assert np.allclose(scorer.unseen("chien"), model.table[rows].mean(axis=0))
    rows = [model.grams["chie"], model.grams["t"]]
    assert np.allclose(scorer.unseen("chiet"), model.table[rows].mean(axis=0))
    assert not scorer.unseen("ΩΩ").any()
    assert scorer.predict("The the DOG")[0] == "en" and scorer.predict("chiens")[0] == "fr"


def test_edges(spark):
    model = li.fit(docs(spark, TRAIN))
    rows = [(1, None, "x"), (2, "", "x"), (3, "123 -- !", "x"), (4, "le " * 200_000, "x"), (4, "le", "x"), (None, "Ω", "x")]
    got = li.predict(docs(spark, rows), model).collect()
    assert [r.lang_pred for r in got] == ["und", "und", "und", "fr", "fr", "en"]
    assert all(0 <= r.score <= 1 for r in got) and [r.doc_id for r in got] == [1, 2, 3, 4, 4, None]
    assert li.predict(docs(spark, rows).where("false"), model).count() == 0
    nothing = li.fit(docs(spark, [(1, "a", None)]))
    assert nothing.languages == [] and li.Scorer(nothing).predict("a") == ("und", 0.0)


def test_numerals_are_no_letters(spark):
    assert li.words_of("½ ² Ⅷ a½b x_1y É") == ["a", "b", "x", "y", "é"]
    model = li.fit(docs(spark, TRAIN))
    got = li.predict(docs(spark, [(1, "½ ² Ⅷ", "x"), (None, "the½", "x")]), model).collect()
    assert [r.lang_pred for r in got] == ["und", "en"]
    ids = spark.createDataFrame([(None,), (3,)], "doc_id bigint").select(li.held_out().alias("h")).collect()
    assert None not in [r.h for r in ids] and ids[0].h is False


def plain_scores(model, text):
    """Every word by itself: the row of a known word, or the mean of the n-grams that cover it."""
    total = np.zeros(len(model.languages))
    for word in li.words_of(text):
        if word in model.words:
            total += model.table[model.words[word]]
            continue
        rows, at = [], 0
        while at < len(word):
            width = next((k for k in range(5, 0, -1) if at + k <= len(word) and word[at : at + k] in model.grams), 0)
            if width:
                rows.append(model.table[model.grams[word[at : at + width]]])
            at += width or 1
        if rows:
            total += np.mean(rows, axis=0)
    odds = np.exp(total - total.max())
    return model.languages[int(total.argmax())], 1 / odds.sum()


def test_predictions_equal_a_plain_scorer(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet")
    model = li.fit(rows.limit(60), model_words=500, model_grams=800)
    texts = [r.text for r in rows.collect()]
    for memo in (li.MEMO_WORDS, 7):
        scorer = li.Scorer(model, memo=memo)
        for text in texts:
            name, score = scorer.predict(text)
            wanted, sure = plain_scores(model, text)
            assert name == wanted and np.isclose(score, sure)
        assert len(scorer.rows) <= len(model.words) + memo


def test_keep_identified(spark):
    rows = [*TRAIN, (9, "42", "en"), (10, None, None)]
    kept = li.keep_identified(docs(spark, rows))
    assert kept.columns == SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 4]
    unlabelled = docs(spark, [(1, "a", None), (2, "1", None)])
    assert [r.doc_id for r in li.keep_identified(unlabelled).collect()] == [1]


def test_sample_is_bounded(spark):
    rows = spark.range(50_000).withColumnRenamed("id", "doc_id")
    assert 4_000 < li.bounded_sample(rows, "doc_id", 5_000).count() <= 5_000
    assert li.bounded_sample(rows, "doc_id", 60_000).count() == 50_000


def test_sample_is_full_with_hot_buckets(spark, monkeypatch):
    same = "CAST(NULL AS bigint) AS doc_id", "concat('text ', id % 9999) AS text", "'en' AS lang"
    nulls = spark.range(10_000).selectExpr(*same)
    copies = spark.range(10_000).selectExpr("CAST(NULL AS bigint) AS doc_id", "'copy' AS text", "'en' AS lang")
    for _ in range(2):
        rows = spark.range(50_000).withColumnRenamed("id", "doc_id")
        first, again = (sorted(r[0] for r in li.bounded_sample(rows, "doc_id", 5_000).collect()) for _ in "12")
        assert len(set(first)) == 5_000 and first == again
        assert li.bounded_sample(nulls, "doc_id", 6_000).count() == 6_000
        assert li.bounded_sample(copies, "doc_id", 6_000).count() == 6_000
        assert li.bounded_sample(nulls.union(copies), "doc_id", 30_000).count() == 20_000
        monkeypatch.setattr(li, "SAMPLE_BUCKETS", 1)
    assert li.fit(nulls, fit_docs=100).languages == ["en"]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    got = li.op1_language_id(spark, folder).join(truth, "doc_id").where("held_out AND lang_pred <> 'und'").collect()
    assert len(got) > 150
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
