"""Label functions: spelling, names, ids, classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions.arrays import bind


def normalise_label(label: Column, separator: str = "_") -> Column:
    """One spelling for labels: one separator, and ``opthalm`` for ``ophthalm``."""
    other = "-" if separator == "_" else "_"
    return F.replace(F.translate(label, other, separator), F.lit("ophthalm"), F.lit("opthalm"))


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(mapping: Mapping[str, str]) -> Column:
    """Constant map, written as one SQL expression: a call per entry would be slow to build."""
    return F.expr(f"map({', '.join(sql_text(x) for pair in mapping.items() for x in pair)})")


def literal_array(values: Sequence[str]) -> Column:
    """Constant array, written as one SQL expression."""
    return F.expr(f"array({', '.join(sql_text(v) for v in values)})")


def map_label(label: Column, names: Mapping[str, str], strict: bool = True) -> Column:
    """Display name of a label; an unknown label is an error unless ``strict`` is off."""
    name = F.try_element_at(literal_map(names), label)
    if not strict:
        return name
    problem = F.raise_error(F.concat(F.lit("unknown label: "), label)).cast("string")
    return F.when(label.isNull(), F.lit(None)).otherwise(F.coalesce(name, problem))


def normality_class(
    missing: Column, comparative: Column, normal: Column, normal_for_age: Column
) -> Column:
    """Class of a report from four nullable flags; the later flag wins, none set is abnormal."""
    return (
        F.when(normal_for_age, "IS_NORMAL_FOR_AGE")
        .when(normal, "IS_NORMAL")
        .when(comparative, "IS_COMPARATIVE")
        .when(missing, "IS_MISSING")
        .otherwise("ABNORMAL")
    )


def first_choice(accept: Column) -> Column:
    """First accepted option, null when there is none."""
    return F.get(accept, F.lit(0))


def encode(labels: Column, vocabulary: Column) -> Column:
    """Ids of labels: their place in the vocabulary array, 0 first.

    The vocabulary must be a column: Spark allows no subquery inside an array function.

    Most tags are the outside tag, so its id is looked up once per row.
    """

    def ids(names: Column) -> Column:
        return bind(
            F.array_position(names, F.lit(vocab.OUTSIDE)).cast("int") - 1,
            lambda outside: F.transform(
                labels,
                lambda t: F.when(t == vocab.OUTSIDE, outside).otherwise(
                    F.array_position(names, t).cast("int") - 1
                ),
            ),
        )

    return bind(vocabulary, ids)


def decode(ids: Column, vocabulary: Column) -> Column:
    """Labels of ids; masked positions give null."""
    return bind(vocabulary, lambda names: F.transform(ids, lambda i: F.get(names, i)))


def argmax_index(scores: Column) -> Column:
    """Place of the largest score, 0 first, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def argmax_label(scores: Column, names: Sequence[str]) -> Column:
    return F.get(literal_array(names), argmax_index(scores))


def argmax_probability(scores: Column) -> Column:
    """Softmax value of the largest score."""
    total = bind(
        F.array_max(scores),
        lambda top: F.aggregate(
            scores, F.lit(0.0), lambda acc, s: acc + F.exp(s.cast("double") - top.cast("double"))
        ),
    )
    return F.lit(1.0) / total


def first_piece_labels(word_ids: Column, labels: Column) -> Column:
    """Training labels per sub-token: the first piece of a word carries its label.

    Special tokens (null word) and later pieces carry the mask value.
    """
    masked = F.lit(vocab.MASKED_LABEL)
    return bind(
        labels,
        lambda tags: bind(
            word_ids,
            lambda words: F.transform(
                words,
                lambda w, i: F.when(w.isNull(), masked)
                .when((i > 0) & w.eqNullSafe(F.get(words, i - 1)), masked)
                .otherwise(F.get(tags, w)),
            ),
        ),
    )


def keep_labels(labels: Column, keep: Sequence[str]) -> Column:
    return F.array_intersect(labels, literal_array(keep))
