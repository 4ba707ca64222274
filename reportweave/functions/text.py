"""Text functions: tokens with offsets, filters, blanks, masking."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions.arrays import bind, running_sum


# ---------------------------------------------------------------- tokens


def pieces(text: Column) -> Column:
    """``ARRAY<STRING>``: every token with the blanks behind it; leading blanks are left out."""
    body = F.ltrim(F.coalesce(text, F.lit("")), F.lit(vocab.BLANKS))
    return F.regexp_extract_all(body, F.lit(vocab.JAVA_PIECE_PATTERN), F.lit(0))


def leading_blanks(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return F.length(whole) - F.length(F.ltrim(whole, F.lit(vocab.BLANKS)))


def token_of(piece: Column) -> Column:
    """The token of a piece, which is the piece without the blanks behind it."""
    return F.rtrim(piece, F.lit(vocab.BLANKS))


def words(text: Column) -> Column:
    """``ARRAY<STRING>``: the tokens of a text, without offsets."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(vocab.JAVA_TOKEN_PATTERN), F.lit(0))


def tokens(text: Column) -> Column:
    """``ARRAY<STRUCT<tok,start,end>>``: tokens with code point offsets, end exclusive.

    Pieces cover the text after its leading blanks, so a piece starts where the piece before
    it stops. Row-local: the text is never shuffled to number its tokens.
    """

    def located(parts: Column, lead: Column) -> Column:
        def one(piece: Column, stop: Column) -> Column:
            tok = token_of(piece)
            start = lead + stop - F.length(piece)
            return F.struct(
                tok.alias("tok"), start.alias("start"), (start + F.length(tok)).alias("end")
            )

        return F.zip_with(parts, running_sum(F.transform(parts, F.length)), one)

    return bind(pieces(text), lambda p: bind(leading_blanks(text), lambda n: located(p, n)))


def locate_spans(parts: Column, lead: Column, spans: Column) -> Column:
    """Text, ``start`` and ``end`` for token spans, in the order of ``spans``.

    ``spans``: structs with ``tok_start`` and ``tok_end`` (end exclusive), sorted and disjoint.
    Only the distances between neighbouring spans are summed, not the length of every token.
    """

    def first_token(k: Column) -> Column:
        return F.when(k < 0, F.lit(0)).otherwise(F.get(spans, k)["tok_start"])

    def gap(span: Column, k: Column) -> Column:
        begin = first_token(k - 1)
        return F.length(F.array_join(F.slice(parts, begin + 1, span["tok_start"] - begin), ""))

    def surface(span: Column) -> Column:
        joined = F.array_join(
            F.slice(parts, span["tok_start"] + 1, span["tok_end"] - span["tok_start"]), ""
        )
        return F.rtrim(joined, F.lit(vocab.BLANKS))

    def place(span: Column, offset: Column) -> Column:
        word = surface(span)
        start = lead + offset
        return F.struct(
            word.alias("word"), start.alias("start"), (start + F.length(word)).alias("end")
        )

    return F.zip_with(spans, running_sum(F.transform(spans, gap)), place)


# ---------------------------------------------------------------- nulls, blanks, filters


def fill_null(text: Column, value: str = "") -> Column:
    return F.coalesce(text, F.lit(value))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.ltrim(text, F.lit(vocab.BLANKS)) == "")


def blank_placeholder(text: Column) -> Column:
    """Blank or missing text becomes a placeholder; the placeholder is also what comes out."""
    return F.when(is_blank(text), F.lit(vocab.PLACEHOLDER)).otherwise(text)


def length_between(text: Column, low: int, high: int) -> Column:
    """Both ends exclusive; a missing text is no match."""
    return F.coalesce((F.length(text) < high) & (F.length(text) > low), F.lit(False))


def contains_pattern(text: Column, pattern: str) -> Column:
    """Regular expression found anywhere; a missing text is no match."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


def missing_tokens_to_null(value: Column) -> Column:
    """CSV cells that stand for a missing value become null."""
    return F.when(~value.isin(list(vocab.NULL_TOKENS)), value)


# ---------------------------------------------------------------- truncation and masking


def truncate(values: Column, limit: int) -> Column:
    """First ``limit`` elements (model input length)."""
    return F.slice(values, F.lit(1), F.lit(limit))


def mask_ranges(text: Column, spans: Column) -> Column:
    """Text without the character ranges ``spans`` (structs ``start``, ``end``), any order.

    Ranges may overlap: a kept segment lies between the furthest end so far and the next
    start. The text is cut into characters once, so the work grows with its length only.
    A missing text stays missing.
    """

    def furthest_ends(ordered: Column) -> Column:
        # running maximum by doubling, as in running_sum
        def round_(best: Column, k: Column) -> Column:
            return F.transform(
                best,
                lambda v, i: F.greatest(
                    v, F.get(best, i - F.call_function("shiftleft", F.lit(1), k))
                ),
            )

        ends = F.transform(ordered, lambda s: s["end"])
        rounds = F.ceil(F.log2(F.size(ordered))).cast("int")
        return F.when(F.size(ordered) < 2, ends).otherwise(
            F.aggregate(F.sequence(F.lit(0), rounds - 1), ends, round_)
        )

    def cut(chars: Column, from_: Column, to: Column) -> Column:
        return F.array_join(F.slice(chars, from_ + 1, F.greatest(to - from_, F.lit(0))), "")

    def kept(ordered: Column, ends: Column, chars: Column) -> Column:
        heads = F.transform(
            ordered,
            lambda s, k: cut(chars, F.coalesce(F.get(ends, k - 1), F.lit(0)), s["start"]),
        )
        last = F.coalesce(F.get(ends, F.size(ends) - 1), F.lit(0))
        tail = cut(chars, last, F.size(chars))
        return F.concat(F.array_join(heads, ""), tail)

    masked = bind(
        F.array_sort(F.coalesce(spans, F.array().cast("array<struct<start:int,end:int>>"))),
        lambda ordered: bind(
            furthest_ends(ordered),
            lambda ends: bind(F.split(text, ""), lambda chars: kept(ordered, ends, chars)),
        ),
    )
    untouched = spans.isNull() | (F.size(spans) == 0)
    return F.when(text.isNull() | untouched, text).otherwise(masked)


def mask_pattern(text: Column, pattern: str) -> Column:
    """Text without every match of a pattern."""
    return F.regexp_replace(text, pattern, "")


# ---------------------------------------------------------------- dumps


def section_dump(text: Column, sections: Column) -> Column:
    """Readable dump: the text, then every section under its name, in order of appearance."""
    blocks = F.transform(sections, lambda s: F.concat(s["section"], F.lit("\n"), s["text"]))
    return F.concat(
        F.coalesce(text, F.lit("")), F.lit("\n\n"), F.array_join(blocks, "\n\n")
    )


def slice_text(text: Column, start: Column, end: Column) -> Column:
    """Characters ``[start, end)`` of a text."""
    return F.substring(text, start + 1, end - start)


def in_any(value: Column, options: Iterable[str]) -> Column:
    return value.isin(list(options))
