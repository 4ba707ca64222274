"""A token tagger learned by counting: previous token and token, then token alone, then O.

A baseline where the work is grouping and joining; it does not reach a tuned language model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.operators.lookup import bounded_values, weighted_lookup

START = "<s>"


def tag_rows(examples: DataFrame, tokens: str = "tokens", tags: str | None = "ner_tags",
             doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, i, prev, tok[, tag]`` from token arrays; the previous token comes from the row."""
    fields = lambda t, i: [
        F.coalesce(F.get(F.col(tokens), i - 1), F.lit(START)).alias("prev"),
        t.alias("tok"),
    ] + ([F.get(F.col(tags), i).alias("tag")] if tags else [])
    rows = F.posexplode(F.transform(tokens, lambda t, i: F.struct(*fields(t, i))))
    return examples.select(doc_id, rows.alias("i", "r")).select(
        doc_id, F.col("i").cast("bigint").alias("i"), "r.*"
    )


def tagger_fit(rows: DataFrame) -> DataFrame:
    """Model ``prev, tok, tag, n``: the most frequent tag per pair, and per token (null ``prev``).

    Ties go to the tag last in the alphabet. Rows are counted once; tokens sum the pair counts.
    """
    pairs = rows.groupBy("prev", "tok", "tag").agg(F.count("*").alias("n"))
    singles = pairs.groupBy("tok", "tag").agg(F.sum("n").alias("n"))
    best = [F.max_by("tag", F.struct("n", "tag")).alias("tag"), F.sum("n").alias("n")]
    no_prev = F.lit(None).cast("string").alias("prev")
    return (
        pairs.groupBy("prev", "tok").agg(*best)
        .unionByName(singles.groupBy("tok").agg(*best).select(no_prev, "tok", "tag", "n"))
    )


def tagger_apply(rows: DataFrame, model: DataFrame) -> DataFrame:
    """``rows`` (``prev``, ``tok``) with ``tag`` from the model, O for unknown tokens.

    Frequent words make hot keys, so both lookups broadcast the heaviest keys.
    """
    pairs = model.where("prev is not null").withColumnRenamed("tag", "_pair_tag")
    singles = model.where("prev is null").select("tok", F.col("tag").alias("_tok_tag"), "n")
    rows = rows.drop("tag")
    found = weighted_lookup(rows, pairs, ["prev", "tok"], "n")
    found = weighted_lookup(found, singles, ["tok"], "n")
    return found.select(
        *rows.columns,
        F.coalesce("_pair_tag", "_tok_tag", F.lit(vocab.OUTSIDE)).alias("tag"),
    )


def tag_vocabulary(examples: DataFrame, tags: str = "ner_tags") -> DataFrame:
    """``id, tag`` by sorted order: one array, numbered in place; too many tags are an error."""
    names = bounded_values(examples.select(F.explode(tags).alias("tag")), "tag")
    return examples.sparkSession.range(1).select(F.posexplode(names).alias("id", "tag"))


def vocabulary_array(vocabulary: DataFrame):
    """The vocabulary as a scalar array for ``functions.labels.encode`` and ``decode``."""
    return vocabulary.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("id", "tag"))), lambda r: r["tag"])
    ).scalar()
