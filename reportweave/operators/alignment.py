"""Character spans on token edges, and spans over two tokenisations of one text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions.arrays import bind, running_sum


def span_align(mentions: DataFrame, tokens: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Mentions with ``tok_start`` and ``tok_end`` (exclusive).

    Strict: a span that does not start and end on token edges is dropped.
    """
    spans = mentions.drop("tok_start", "tok_end")
    carried = [c for c in spans.columns if c not in (doc_id, "ent_pos")]
    edges = lambda first, last: F.inline(
        F.array(
            F.struct(F.lit(False).alias("_last"), first[0].alias("_pos"), first[1].alias("_i")),
            F.struct(F.lit(True).alias("_last"), last[0].alias("_pos"), last[1].alias("_i")),
        )
    )
    i = F.col("i")
    token_edges = tokens.select(doc_id, edges((F.col("start"), i), (F.col("end"), i + 1)))
    none = F.lit(None).cast("bigint")
    wanted = spans.select("*", edges((F.col("start"), none), (F.col("end"), none))).drop("_i")
    # Both edges in one join, so the tokens are made and shuffled once.
    return (
        wanted.join(token_edges, [doc_id, "_last", "_pos"])
        .groupBy(doc_id, "ent_pos")
        .agg(
            *[F.first(c).alias(c) for c in carried],
            F.max(F.when(~F.col("_last"), F.col("_i"))).alias("tok_start"),
            F.max(F.when(F.col("_last"), F.col("_i"))).alias("tok_end"),
        )
        .where("tok_start is not null and tok_end is not null")
    )


def iob_table(tokens: DataFrame, mentions: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, i, tok, tag`` from long tables, mentions given as token spans.

    A mention is spread over its tokens first, so the join is an equality on the token.
    """
    covered = mentions.select(
        doc_id,
        "entity_group",
        "tok_start",
        F.explode(F.sequence(F.col("tok_start"), F.col("tok_end") - 1)).alias("i"),
    )
    prefix = F.when(F.col("i") == F.col("tok_start"), "B-").otherwise("I-")
    return tokens.join(covered, [doc_id, "i"], "left").select(
        doc_id,
        "i",
        "tok",
        F.coalesce(F.concat(prefix, F.col("entity_group")), F.lit("O")).alias("tag"),
    )


# ---------------------------------------------------------------- two tokenisations of one text


def solid(text: Column) -> Column:
    """The characters of a text that are no blanks."""
    return F.regexp_replace(text, vocab.JAVA_BLANK_PATTERN, "")


def common_spans(tokens: Column, spans: Column, label: str = "entity_group") -> Column:
    """Token spans as ``ARRAY<STRUCT<start,end,label>>`` in counts of characters that are no blanks.

    ``tokens`` is an array of strings, ``spans`` one of structs with ``tok_start`` and ``tok_end``
    (exclusive). However a text is spaced and cut into tokens, the same characters have the same
    counts. Between sorted, disjoint spans only the distances are counted and summed; spans in any
    other order are looked up in the running sum over all tokens.
    """

    def placed(ends: Column) -> Column:
        upto = lambda i: F.coalesce(F.get(ends, i - 1), F.lit(0))
        return F.transform(
            spans,
            lambda s: F.struct(
                upto(s["tok_start"]).alias("start"),
                upto(s["tok_end"]).alias("end"),
                s[label].alias("label"),
            ),
        )

    def stepped(every: Column, edges: Column) -> Column:
        before = lambda k: F.coalesce(F.get(edges, k - 1), F.lit(0))
        between = lambda e, k: F.slice(every, before(k) + 1, e - before(k))
        gaps = F.transform(edges, lambda e, k: F.length(solid(F.array_join(between(e, k), ""))))
        return bind(
            running_sum(gaps),
            lambda ends: F.transform(
                spans,
                lambda s, k: F.struct(
                    F.get(ends, 2 * k).alias("start"),
                    F.get(ends, 2 * k + 1).alias("end"),
                    s[label].alias("label"),
                ),
            ),
        )

    def either(every: Column, edges: Column) -> Column:
        rises = F.forall(
            F.transform(edges, lambda e, k: e >= F.coalesce(F.get(edges, k - 1), F.lit(0))),
            lambda r: r,
        )
        inside = F.coalesce(F.get(edges, F.size(edges) - 1), F.lit(0)) <= F.size(every)
        lengths = F.transform(every, lambda t: F.length(solid(t)))
        return F.when(rises & inside, stepped(every, edges)).otherwise(
            bind(running_sum(lengths), placed)
        )

    sides = F.flatten(F.transform(spans, lambda s: F.array(s["tok_start"], s["tok_end"])))
    return bind(tokens, lambda every: bind(sides, lambda edges: either(every, edges)))
