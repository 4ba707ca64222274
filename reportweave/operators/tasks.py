"""Records for annotation tools."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions import entities as en
from reportweave.functions.labels import keep_labels, normalise_label


def choice_tasks(
    df: DataFrame,
    options: Sequence[str] = vocab.EVALUATION_PATHOLOGIES,
    text: str = "text",
    ents: str = "ents",
    ignore_negation: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One multiple-choice record per text, pre-filled with its asserted labels."""
    accept = en.asserted_labels(F.col(ents), options, ignore_negation)
    return df.select(
        *carry,
        F.col(text).alias("text"),
        F.lit("choice").alias("_view_id"),
        F.struct(F.lit("multiple").alias("choice_style")).alias("config"),
        F.lit("accept").alias("answer"),
        accept.alias("accept"),
        F.array(
            *[F.struct(F.lit(o).alias("id"), F.lit(o).alias("text")) for o in options]
        ).alias("options"),
    )


def relabel_tasks(
    tasks: DataFrame, ents: str = "ents", keep: Sequence[str] = vocab.EVALUATION_PATHOLOGIES
) -> DataFrame:
    """Accepted options replaced by predicted asserted labels, in hyphen spelling."""
    hyphens = [k.replace("_", "-") for k in keep]
    asserted = F.filter(ents, lambda e: ~e["negated"])
    labels = F.transform(asserted, lambda e: normalise_label(e["entity_group"], "-"))
    accept = F.array_sort(keep_labels(labels, hyphens))
    return tasks.withColumn("accept", accept).drop(ents)


def document_tasks(df: DataFrame, text: str = "text", marks: str = "marks",
                   tokens: str = "tokens", carry: Sequence[str] = ()) -> DataFrame:
    """Text with its spans and tokens: ``text, ents[{start,end,label}], tokens[{id,start,end}]``."""
    return df.select(
        *carry,
        F.col(text).alias("text"),
        F.transform(
            marks,
            lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["label"].alias("label")),
        ).alias("ents"),
        F.transform(
            tokens,
            lambda t, i: F.struct(i.alias("id"), t["start"].alias("start"), t["end"].alias("end")),
        ).alias("tokens"),
    )


def text_only(tasks: DataFrame) -> DataFrame:
    return tasks.select("text")


def accepted(tasks: DataFrame) -> DataFrame:
    """Records a person has accepted."""
    return tasks.where(F.col("answer") == "accept")


def exclusive_ends(spans: Column) -> Column:
    """Token spans with the last token included, as ``tok_start``, ``tok_end`` (exclusive)."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["label"].alias("label"),
            s["token_start"].alias("tok_start"),
            (s["token_end"] + 1).alias("tok_end"),
        ),
    )
