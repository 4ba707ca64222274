"""Normality classes: derivation, encoding, and a text classifier learned on Spark ML."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.operators.lookup import bounded_values


def class_encode(df: DataFrame, column: str, out: str = "label_id") -> DataFrame:
    """Adds the place of a value among the sorted distinct values.

    The values are classes: they come in as one scalar array, and too many are an error.
    """
    names = bounded_values(df, column)
    return df.withColumn(out, (F.array_position(names, F.col(column)) - 1).cast("int"))


def fit_classifier(
    train: DataFrame, text: str = "text", label: str = "normality_class", features: int = 1 << 16
):
    """Fitted Spark ML model: hashed word counts, IDF, logistic regression, label names."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer

    index = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc").fit(
        train
    )
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}]+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(
            featuresCol="_features", labelCol="_label", probabilityCol="_probability",
            rawPredictionCol="_raw", predictionCol="_prediction", maxIter=20, regParam=0.01,
        ),
        IndexToString(inputCol="_prediction", outputCol="label", labels=index.labels),
    ]
    return Pipeline(stages=stages).fit(index.transform(train))


def classify_documents(model, df: DataFrame) -> DataFrame:
    """``df`` with ``label`` and ``score`` (probability of the label)."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df).withColumn(
        "score", F.array_max(vector_to_array("_probability"))
    )
    return scored.select(*df.columns, "label", "score")


def normality_training_set(
    reports: DataFrame, size: int, seed: int | str, doc_id: str = "doc_id", on_short: str = "error"
) -> DataFrame:
    """Equal numbers per normality class: ``size // 5`` of each, text and class only."""
    from reportweave.functions.labels import normality_class
    from reportweave.operators.sampling import stratified_sample

    classed = reports.select(
        doc_id,
        "Narrative",
        normality_class(
            F.col("IS_MISSING"), F.col("IS_COMPARATIVE"), F.col("IS_NORMAL"), F.col("IS_NORMAL_FOR_AGE")
        ).alias("normality_class"),
    )
    quota = size // len(vocab.NORMALITY_CLASSES)
    return stratified_sample(
        classed, ["normality_class"], quota, [doc_id], seed, on_short=on_short
    )
