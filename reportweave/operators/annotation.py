"""Entities with assertion status for a table of texts.

The steps are separate columns over the arrays of one row: no shuffle, no Python, and the same
code runs on a streaming table. Steps used once are merged into one projection by Spark.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportweave.functions import entities as en
from reportweave.functions import text as tx
from reportweave.functions.arrays import bind, settled

_MARKS = "array<struct<label:string,tok_start:int,tok_end:int>>"


def find_phrases(df: DataFrame, phrases: Mapping[str, str], out: str) -> DataFrame:
    """Leftmost-longest matches of lower-case phrases in ``_toks``, from the hits in ``_hits``."""
    if not phrases:
        return df.withColumn(out, F.array().cast(_MARKS))
    df = df.withColumn(out, en.longest_phrases(F.col("_toks"), F.col("_hits"), phrases))
    if max(len(p.split(" ")) for p in phrases) == 1:
        return df
    return df.withColumn("_take", en.free_flags(F.col(out))).withColumn(
        out, en.flagged(F.col(out), F.col("_take"))
    )


def _negation(df: DataFrame, rules: en.NegationRules) -> DataFrame:
    """Adds ``_neg``: one flag per element of ``_marks``."""
    df = find_phrases(df, rules.phrases(), "_triggers")
    df = df.withColumn(
        "_events",
        # Texts without a trigger have nothing to decide.
        F.when(
            F.exists("_triggers", lambda t: t["label"].isin("preceding", "following")),
            en.scope_events(F.col("_hits"), F.col("_triggers"), rules.sentence_ends),
        ),
    )
    return decide(df, rules)


def decide(df: DataFrame, rules: en.NegationRules) -> DataFrame:
    """Adds ``_neg`` from ``_events`` (null: nothing to decide) and ``_marks``."""
    flags = en.triggered_marks(F.col("_events"), F.col("_marks"))
    df = df.withColumn("_flags", F.when(F.col("_events").isNotNull(), flags))
    return df.withColumn(
        "_neg",
        bind(
            F.col("_flags"),
            lambda f: F.transform(
                "_marks",
                lambda m, k: F.coalesce(
                    m["label"].isin(list(rules.eligible)) & F.get(f, k), F.lit(False)
                ),
            ),
        ),
    )


def _mark(df: DataFrame, phrases: Mapping[str, str], rules: en.NegationRules | None) -> DataFrame:
    wanted = en.first_words(phrases) | (rules.wanted() if rules else set())
    df = df.withColumn("_hits", en.wanted_words(F.col("_toks"), wanted))
    df = find_phrases(df, phrases, "_marks")
    if rules is None:
        return df.withColumn("_neg", F.transform("_marks", lambda m: F.lit(False)))
    return _negation(df, rules)


def annotate(
    df: DataFrame,
    phrases: Mapping[str, str],
    rules: en.NegationRules | None = None,
    text: str = "text",
    out: str = "ents",
    keep_tokens: str | None = None,
) -> DataFrame:
    """Adds the entities of ``text`` in text order: ``ARRAY<ENTITY_TYPE>``.

    A blank text is replaced by the placeholder first and never fails. ``keep_tokens`` names a
    column for the token array, for callers that need tags per token.
    """
    columns = df.columns
    whole = tx.blank_placeholder(F.col(text))
    work = df.withColumn("_parts", tx.pieces(whole)).withColumn("_lead", tx.leading_blanks(whole))
    work = work.withColumn("_toks", F.transform("_parts", tx.token_of))
    work = _mark(work, phrases, rules)
    work = work.withColumn(
        "_places",
        bind(
            F.col("_parts"),
            lambda parts: bind(
                F.col("_lead"),
                lambda lead: bind(
                    F.col("_marks"), lambda marks: tx.locate_spans(parts, lead, marks)
                ),
            ),
        ),
    )

    def entity(places: Column, negs: Column, m: Column, k: Column) -> Column:
        place = F.get(places, k)
        return F.struct(
            m["label"].alias("entity_group"),
            F.lit(1.0).alias("score"),
            place["word"].alias("word"),
            place["start"].alias("start"),
            place["end"].alias("end"),
            F.get(negs, k).alias("negated"),
            m["tok_start"].alias("tok_start"),
            m["tok_end"].alias("tok_end"),
        )

    ents = bind(
        F.col("_places"),
        lambda places: bind(
            F.col("_neg"),
            lambda negs: F.transform("_marks", lambda m, k: entity(places, negs, m, k)),
        ),
    )
    extra = [F.col("_toks").alias(keep_tokens)] if keep_tokens else []
    return work.select(*[F.col(c) for c in columns if c != out], settled(ents, out), *extra)


def assertions(
    df: DataFrame,
    phrases: Mapping[str, str],
    rules: en.NegationRules,
    text: str = "text",
    out: str = "ents",
) -> DataFrame:
    """Adds labels and assertion status only, ``ARRAY<STRUCT<entity_group,negated>>``.

    For counts and label sets: nothing is spent on offsets.
    """
    columns = [c for c in df.columns if c != out]
    work = df.withColumn("_toks", tx.words(tx.blank_placeholder(F.col(text))))
    work = _mark(work, phrases, rules)
    ents = bind(
        F.col("_neg"),
        lambda negs: F.transform(
            "_marks",
            lambda m, k: F.struct(
                m["label"].alias("entity_group"), F.get(negs, k).alias("negated")
            ),
        ),
    )
    return work.select(*columns, settled(ents, out))
