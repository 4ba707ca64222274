"""A text classifier learned by grouping: multinomial Bayes with add-one smoothing.

Scores are whole numbers (a million times a logarithm, rounded), so sums do not depend on the
order of rows, and equal data give equal classes on any cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportweave.operators.lookup import bounded_values, heaviest

MAX_CLASSES = 1_000
SCALE = 1_000_000
# Beside the classes: the number of known words, and words still to be looked up.
KNOWN, REST = -1, -2


@dataclass
class BayesModel:
    """``words``: ``word, weights, n``; a weight ``(id, weight)`` says what the word adds to a class
    that it was seen in, beyond what any known word adds. ``classes``: ``id, label, prior, zero``;
    ``zero`` is what a known word adds to a class that it was not seen in.
    """

    words: DataFrame
    classes: DataFrame


def words_in(text: str) -> Column:
    """Lower-case runs of letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def _log(value: Column) -> Column:
    return F.round(F.lit(float(SCALE)) * F.ln(value)).cast("bigint")


def bayes_fit(train: DataFrame, text: str = "text", label: str = "label") -> BayesModel:
    """Counts words by class. Rows without a label or a text are left out; more than
    ``MAX_CLASSES`` classes are an error.
    """
    rows = train.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(label).alias("label"), F.col(text).alias("text")
    )
    counts = rows.select("label", F.explode(words_in("text")).alias("word")).groupBy("label", "word").agg(
        F.count("*").alias("n")
    )
    vocabulary = counts.agg(F.count_distinct("word")).scalar()
    names = bounded_values(rows, "label", MAX_CLASSES)
    documents = rows.groupBy("label").agg(F.count("*").alias("documents"))
    total = documents.agg(F.sum("documents")).scalar()
    lengths = counts.groupBy("label").agg(F.sum("n").alias("length"))
    base = F.coalesce("length", F.lit(0)) + vocabulary
    classes = documents.join(lengths, "label", "left").select(
        (F.array_position(names, F.col("label")) - 1).cast("int").alias("id"),
        "label",
        _log(F.col("documents") / total).alias("prior"),
        # Without any word nothing is known, and nothing is added.
        F.when(base > 0, _log(F.lit(1.0) / base)).otherwise(0).alias("zero"),
        base.alias("base"),
    )
    weighted = counts.join(classes.select("label", "id", "zero", "base"), "label")
    weight = _log((F.col("n") + 1) / F.col("base")) - F.col("zero")
    words = weighted.groupBy("word").agg(
        F.collect_list(F.struct("id", weight.alias("weight"))).alias("weights"), F.sum("n").alias("n")
    )
    return BayesModel(words, classes.drop("base"))


def _entry(id_: int, weight: Column | int) -> Column:
    weight = F.lit(weight) if isinstance(weight, int) else weight
    return F.struct(F.lit(id_).alias("id"), weight.cast("bigint").alias("weight"))


def frequent_sums(docs: DataFrame, model: BayesModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, id, word, weight``: what the frequent words of a text add to each class and to
    ``KNOWN``, with a null word; and its other words, with ``REST`` and how often they come.

    Frequent words meet a broadcast where their text is read, so the sums leave the task as a
    row per class, however long the text is.
    """
    hot = heaviest(model.words, ["word"], "n").select("word", F.col("weights").alias("_hot"))
    met = docs.select(doc_id, F.explode_outer(words_in(text)).alias("word")).join(F.broadcast(hot), "word", "left")
    entries = (
        F.when(F.col("_hot").isNotNull(), F.array_append("_hot", _entry(KNOWN, 1)))
        .when(F.col("word").isNull(), F.array(_entry(KNOWN, 0)))
        .otherwise(F.array(_entry(REST, 1)))
    )
    left = F.when(F.col("_hot").isNull(), F.col("word")).alias("word")
    return met.select(doc_id, left, F.inline(entries)).groupBy(doc_id, "id", "word").agg(
        F.sum("weight").alias("weight")
    )


def bayes_classify(docs: DataFrame, model: BayesModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, label, score``: the most likely class and its probability; ``doc_id`` must be unique.

    Words that the model does not know count nowhere, so a text without known words, or null, gets
    the class that is most frequent. Ties go to the label last in the alphabet. A model without
    classes gives null. Only sums by class and the distinct words of a text that are not frequent
    are shuffled; frequent words meet their weights in a broadcast of bounded size.
    """
    sums = frequent_sums(docs, model, text, doc_id)
    cold = model.words.select("word", F.col("weights").alias("_cold"), F.lit(0).alias("_spread"))
    # Sums match nothing and land on all partitions evenly.
    spread = F.when(F.col("word").isNotNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(doc_id, "id"), F.lit(100_000)).cast("int") + 1
    )
    found = sums.withColumn("_spread", spread).join(cold, ["word", "_spread"], "left")
    times = F.col("weight")
    added = F.transform("_cold", lambda w: F.struct(w["id"].alias("id"), (w["weight"] * times).alias("weight")))
    # Class -1 counts the known words; every document has a row of it.
    parts = (
        F.when(F.col("id") != REST, F.array(F.struct("id", "weight")))
        .when(F.col("_cold").isNull(), F.array(_entry(KNOWN, 0)))
        .otherwise(F.array_append(added, _entry(KNOWN, times)))
    )
    sums = found.select(doc_id, F.inline(parts)).groupBy(doc_id, "id").agg(F.sum("weight").alias("total"))
    by_class = sums.groupBy(doc_id).agg(F.map_from_entries(F.collect_list(F.struct("id", "total"))).alias("totals"))
    classes = model.classes.agg(F.array_sort(F.collect_list(F.struct("id", "label", "prior", "zero")))).scalar()
    total = lambda k: F.coalesce(F.try_element_at("totals", k), F.lit(0))
    # A column first: a lambda cannot hold a subquery.
    scored = by_class.withColumn("_classes", classes).select(
        doc_id,
        F.transform(
            "_classes",
            lambda c: F.struct((c["prior"] + total(F.lit(KNOWN)) * c["zero"] + total(c["id"])).alias("s"), c["label"].alias("label")),
        ).alias("scores"),
    ).select(doc_id, "scores", F.array_max("scores").alias("best"))
    shares = F.aggregate("scores", F.lit(0.0), lambda a, c: a + F.exp((c["s"] - F.col("best.s")) / SCALE))
    return scored.select(doc_id, F.col("best.label").alias("label"), F.when(F.col("best").isNotNull(), 1 / shares).alias("score"))
