"""Report sections: from boundary labels to texts, and back to training labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions import text as tx
from reportweave.functions.arrays import bind, running_sum, settled


# ---------------------------------------------------------------- labels to slices to texts


def section_slices(labels: Column, keep_prefix: bool = False) -> Column:
    """``ARRAY<STRUCT<section,from,to>>`` from one label per token.

    A label other than O opens a section that lasts to the next one or to the end. Tokens
    before the first boundary are lost, or go to a null section with ``keep_prefix``.
    """
    marks = F.filter(
        F.transform(labels, lambda l, i: F.struct(l.alias("section"), i.alias("from"))),
        lambda m: m["section"] != vocab.OUTSIDE,
    )

    def slices(ms: Column) -> Column:
        body = F.transform(
            ms,
            lambda m, k: F.struct(
                m["section"].alias("section"),
                m["from"].alias("from"),
                F.coalesce(F.get(ms, k + 1)["from"], F.size(labels)).alias("to"),
            ),
        )
        if not keep_prefix:
            return body
        first = F.coalesce(F.get(ms, F.lit(0))["from"], F.size(labels))
        prefix = F.array(
            F.struct(
                F.lit(None).cast("string").alias("section"),
                F.lit(0).alias("from"),
                first.alias("to"),
            )
        )
        return F.when(first > 0, F.concat(prefix, body)).otherwise(body)

    return bind(marks, lambda ms: slices(ms))


def slice_texts(slices: Column, parts: Column) -> Column:
    """Slices with their verbatim text: the token pieces joined, blanks behind left out."""

    def text_of(pieces: Column, s: Column) -> Column:
        joined = F.array_join(F.slice(pieces, s["from"] + 1, s["to"] - s["from"]), "")
        return F.rtrim(joined, F.lit(vocab.BLANKS))

    return bind(
        parts,
        lambda p: F.transform(
            slices,
            lambda s: F.struct(s["section"].alias("section"), text_of(p, s).alias("text")),
        ),
    )


def merge_sections(pieces: Column) -> Column:
    """One text per section name, repeats joined by a blank, in order of first appearance."""
    filled = F.filter(pieces, lambda p: F.coalesce(p["text"] != "", F.lit(False)))

    def merged(all_pieces: Column) -> Column:
        names = F.array_distinct(F.transform(all_pieces, lambda p: p["section"]))
        return F.transform(
            names,
            lambda n: F.struct(
                n.alias("section"),
                F.array_join(
                    F.transform(
                        F.filter(all_pieces, lambda p: p["section"].eqNullSafe(n)),
                        lambda p: p["text"],
                    ),
                    " ",
                ).alias("text"),
            ),
        )

    return bind(filled, merged)


def section_documents(
    df: DataFrame,
    markers: Mapping[str, str],
    text: str = "text",
    out: str = "sections",
) -> DataFrame:
    """Adds ``ARRAY<STRUCT<section,text>>``, section starts given by marker words."""
    from reportweave.functions.labels import literal_map

    names = literal_map(markers)
    words = sorted(markers)
    columns = [c for c in df.columns if c != out]

    def label(token: Column) -> Column:
        # Few tokens are markers; only those are looked up.
        known = F.lower(token).isin(words)
        return F.when(known, F.try_element_at(names, F.lower(token))).otherwise(vocab.OUTSIDE)

    work = df.withColumn("_parts", tx.pieces(F.col(text)))
    work = work.withColumn("_labels", F.transform("_parts", lambda p: label(tx.token_of(p))))
    work = work.withColumn("_slices", bind(F.col("_labels"), lambda labels: section_slices(labels)))
    return work.select(
        *columns, settled(merge_sections(slice_texts(F.col("_slices"), F.col("_parts"))), out)
    )


def sections_from_labels(
    df: DataFrame,
    labels: str = "labels",
    text: str = "text",
    out: str = "sections",
    keep_prefix: bool = False,
) -> DataFrame:
    """Adds ``ARRAY<STRUCT<section,text>>`` from one label per token, such as a model gives.

    ``labels`` is an array column: ``O``, or the name of the section that starts at the token.
    Tokens are those of ``functions.text.words``; a text whose labels differ in number is an
    error, a null array counts as empty.
    """
    columns = [c for c in df.columns if c != out]
    given = F.coalesce(F.col(labels), F.array().cast("array<string>"))
    problem = F.raise_error(F.lit("as many labels as tokens are needed")).cast("array<string>")
    work = df.withColumn("_parts", tx.pieces(F.col(text)))
    work = work.withColumn(
        "_labels", F.when(F.size(given) == F.size("_parts"), given).otherwise(problem)
    )
    work = work.withColumn(
        "_slices", bind(F.col("_labels"), lambda l: section_slices(l, keep_prefix))
    )
    return work.select(
        *columns, settled(merge_sections(slice_texts(F.col("_slices"), F.col("_parts"))), out)
    )


def assemble_sections(
    pieces: DataFrame, doc_id: str, section: str = "section", order: str = "ord", text: str = "text"
) -> DataFrame:
    """``doc_id, section, ord, text`` from a long table of section pieces.

    Pieces of one section are joined by a blank in order; empty pieces are skipped.
    """
    return (
        pieces.where(F.col(text) != "")
        .groupBy(doc_id, section)
        .agg(
            F.min(order).alias(order),
            F.array_sort(F.collect_list(F.struct(order, text))).alias("_pieces"),
        )
        .select(
            doc_id,
            section,
            order,
            F.array_join(F.transform("_pieces", lambda p: p[text]), " ").alias(text),
        )
    )


def section_columns(
    sections: DataFrame, doc_id: str, names: Sequence[str] = vocab.SECTIONS
) -> DataFrame:
    """One row per document with one nullable text column per section."""
    return sections.groupBy(doc_id).agg(
        *[F.max(F.when(F.col("section") == n, F.col("text"))).alias(n) for n in names]
    )


# ---------------------------------------------------------------- section columns to labels


def _section_array(names: Sequence[str]) -> Column:
    return F.array(
        *[F.struct(F.lit(n).alias("section"), F.col(n).alias("text")) for n in names]
    )


def section_labels(
    df: DataFrame,
    names: Sequence[str] = vocab.SECTIONS,
    limit: int | None = None,
) -> DataFrame:
    """Adds ``tokens`` and ``labels`` for training a section tagger.

    Sections come in fixed order; the first token of section k is labelled k (1 to 5), every
    other token 0. A missing section has no tokens. ``limit`` cuts both to limit - 1.
    """
    per_section = [F.coalesce(tx.words(F.col(n)), F.array().cast("array<string>")) for n in names]

    def marks(words: Column, k: int) -> Column:
        return F.transform(words, lambda _, i: F.when(i == 0, F.lit(k)).otherwise(F.lit(0)))

    tokens = F.concat(*per_section)
    labels = F.concat(*[marks(w, k) for k, w in enumerate(per_section, start=1)])
    if limit is not None:
        tokens, labels = tx.truncate(tokens, limit - 1), tx.truncate(labels, limit - 1)
    return df.withColumn("tokens", tokens).withColumn("labels", labels)


def section_offsets(
    df: DataFrame, names: Sequence[str] = vocab.SECTIONS, out: str = "marks"
) -> DataFrame:
    """Adds the joined text and its section marks: ``ARRAY<STRUCT<label,start,end>>``.

    Sections are joined by one blank in fixed order, missing and empty ones are skipped; the
    mark of a section is its first token.
    """

    def marks(filled: Column) -> Column:
        starts = running_sum(F.transform(filled, lambda s: F.length(s["text"]) + 1))

        def one(s: Column, stop: Column) -> Column:
            lead = tx.leading_blanks(s["text"])
            start = stop - F.length(s["text"]) - 1 + lead
            first = F.regexp_extract(s["text"], vocab.TOKEN_PATTERN, 1)
            return F.struct(
                s["section"].alias("label"),
                start.alias("start"),
                (start + F.length(first)).alias("end"),
            )

        return F.zip_with(filled, starts, one)

    filled = F.filter(
        _section_array(names), lambda s: F.coalesce(s["text"] != "", F.lit(False))
    )
    return df.withColumn(out, bind(filled, marks)).withColumn(
        "text", F.array_join(F.transform(filled, lambda s: s["text"]), " ")
    )
