"""Phrase lookup by join, for vocabularies too large to be literals of a plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportweave.functions import entities as en
from reportweave.functions import text as tx
from reportweave.functions.arrays import bind
from reportweave.operators.lookup import lookup


def gazetteer_mentions(
    docs: DataFrame,
    phrases: DataFrame,
    max_words: int,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Leftmost-longest matches of ``phrases(phrase, label)``: one row per mention.

    Every run of up to ``max_words`` tokens is looked up by its lower-case surface. Runs are
    formed inside the row of their text; only runs that are phrases travel to the grouping by
    document. The phrase table is broadcast when its size allows it.
    """

    def run(parts: Column, token: Column, i: Column) -> Column:
        """A token with the surfaces and ends of the runs it begins."""
        nexts = [token] + [F.get(parts, i + k) for k in range(1, max_words)]
        surfaces = [F.lower(t["tok"]) for t in nexts]
        return F.struct(
            i.alias("tok_start"),
            token["start"].alias("start"),
            *[
                F.concat_ws(" ", *surfaces[:n]).alias(f"s{n}") if n > 1 else surfaces[0].alias("s1")
                for n in range(1, max_words + 1)
            ],
            *[nexts[n - 1]["end"].alias(f"e{n}") for n in range(1, max_words + 1)],
        )

    begins = bind(
        tx.tokens(F.col(text)), lambda parts: F.transform(parts, lambda t, i: run(parts, t, i))
    )
    # One row per run, unpivoted outside the arrays.
    lengths = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(n).alias("n"), F.col(f"s{n}").alias("surface"), F.col(f"e{n}").alias("end")
                )
                for n in range(1, max_words + 1)
            ]
        )
    )
    grams = (
        docs.select(doc_id, F.inline_outer(begins))
        .select(doc_id, "tok_start", "start", lengths)
        .where("end is not null")
        .withColumn("tok_end", F.col("tok_start") + F.col("n"))
    )
    found = lookup(grams, phrases.withColumnRenamed("phrase", "surface"), ["surface"])
    candidate = F.struct("tok_start", "tok_end", "label", "start", "end")
    by_doc = (
        found.groupBy(doc_id)
        .agg(F.array_sort(F.collect_list(candidate)).alias("_all"))
        # Of the runs with one start only the longest, the last in order, is a candidate.
        .withColumn(
            "cands",
            F.filter(
                "_all",
                lambda c, k: ~c["tok_start"].eqNullSafe(F.get("_all", k + 1)["tok_start"]),
            ),
        )
        .withColumn("take", en.free_flags(F.col("cands")))
    )
    return (
        by_doc.select(
            doc_id,
            F.posexplode_outer(en.flagged(F.col("cands"), F.col("take"))).alias("ent_pos", "e"),
        )
        .select(
            doc_id,
            F.col("ent_pos").cast("bigint").alias("ent_pos"),
            F.col("e.label").alias("entity_group"),
            F.col("e.start").cast("bigint").alias("start"),
            F.col("e.end").cast("bigint").alias("end"),
            F.col("e.tok_start").cast("bigint").alias("tok_start"),
            F.col("e.tok_end").cast("bigint").alias("tok_end"),
        )
    )
