"""Long texts for models with a length limit: overlapping windows, each with a zone it owns.

Windows begin and end between tokens. Every token lies in the zone of exactly one window, with
half the overlap as context on either side, so what a model finds in a zone is what it would
find in the whole text as long as it looks no further than that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions import text as tx
from reportweave.functions.arrays import bind, running_sum

Weight = Callable[[Column], Column]


def window_bounds(
    number: Column, limit: int, overlap: int, weights: Column | None = None, spare: int = 0
) -> Column:
    """``ARRAY<STRUCT<first,stop,own_first,own_stop>>``: token ranges of windows and of their zones.

    ``number`` is the number of tokens. A window holds at most ``limit`` of them, or of their
    ``weights`` (an array: how many sub-tokens each has). Tokens are cut into blocks of half the
    overlap; a window is a run of blocks that owns all but its outermost two. A block may pass
    its size by one token less than that token's weight, for which ``spare`` leaves room: with
    tokens of up to ``spare + 1`` sub-tokens no window is longer than ``limit``. No tokens, no windows.
    """
    block = overlap // 2
    width = (limit - spare) // block if block else 0
    if width < 3:
        raise ValueError("a limit must leave room for one and a half overlaps")
    every = F.sequence(F.lit(0), number - 1, F.lit(block))
    if weights is not None:
        # A block begins where the weight so far passes a multiple of its size.
        def begins(sums: Column) -> Column:
            of = lambda i: F.floor(F.coalesce(F.get(sums, i - 1), F.lit(0)) / block)
            return F.filter(
                F.sequence(F.lit(0), number - 1), lambda i: (i == 0) | (of(i) != of(i - 1))
            )

        every = bind(running_sum(weights), begins)

    def windows(starts: Column) -> Column:
        blocks = F.size(starts)
        last = F.greatest(F.ceil((blocks - 2) / (width - 2)).cast("int"), F.lit(1)) - 1
        at = lambda b: F.coalesce(F.get(starts, b.cast("int")), number)
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda w: F.struct(
                at(w * (width - 2)).alias("first"),
                at(w * (width - 2) + width).alias("stop"),
                F.when(w == 0, F.lit(0)).otherwise(at(w * (width - 2) + 1)).alias("own_first"),
                F.when(w == last, number).otherwise(at((w + 1) * (width - 2) + 1)).alias("own_stop"),
            ),
        )

    none = F.array().cast("array<struct<first:int,stop:int,own_first:int,own_stop:int>>")
    return F.when(number > 0, bind(every, windows)).otherwise(none)


def text_windows(
    text: Column, limit: int, overlap: int, weight: Weight | None = None, spare: int = 0
) -> Column:
    """``ARRAY<STRUCT<text,offset,own_from,own_to>>``: windows of a text with character offsets.

    ``offset`` is where the window begins in the text; its zone holds what begins in
    ``[own_from, own_to)``. ``weight`` gives the number of sub-tokens of a token. All windows
    together are cut in one pass over the text's pieces.
    """

    def cut(parts: Column, ends: Column, lead: Column, bounds: Column) -> Column:
        number = F.size(parts)
        offset = lambda i: lead + F.coalesce(F.get(ends, i - 1), F.lit(0))
        far = F.lit(2**31 - 1)
        return F.transform(
            bounds,
            lambda b: F.struct(
                F.rtrim(
                    F.array_join(F.slice(parts, b["first"] + 1, b["stop"] - b["first"]), ""),
                    F.lit(vocab.BLANKS),
                ).alias("text"),
                offset(b["first"]).alias("offset"),
                F.when(b["own_first"] == 0, F.lit(0)).otherwise(offset(b["own_first"])).alias("own_from"),
                F.when(b["own_stop"] == number, far).otherwise(offset(b["own_stop"])).alias("own_to"),
            ),
        )

    def located(parts: Column) -> Column:
        weights = F.transform(parts, lambda p: weight(tx.token_of(p))) if weight else None
        return bind(
            running_sum(F.transform(parts, F.length)),
            lambda ends: bind(
                tx.leading_blanks(text),
                lambda lead: bind(
                    window_bounds(F.size(parts), limit, overlap, weights, spare),
                    lambda bounds: cut(parts, ends, lead, bounds),
                ),
            ),
        )

    return bind(tx.pieces(text), located)


def stitch_spans(windows: Column, found: Column) -> Column:
    """Spans of the whole text from one array of spans per window (``start`` and ``end`` within it).

    A span counts where it begins in the window's own zone; its repeats in other windows go.
    """

    def owned(w: Column, spans: Column) -> Column:
        begins = lambda s: s["start"] + w["offset"]
        mine = F.filter(spans, lambda s: (begins(s) >= w["own_from"]) & (begins(s) < w["own_to"]))
        return F.transform(
            mine,
            lambda s: s.withField("start", begins(s)).withField("end", s["end"] + w["offset"]),
        )

    return F.flatten(F.zip_with(windows, found, owned))


def stitch_labels(bounds: Column, found: Column) -> Column:
    """Labels of all tokens from one array of labels per window: each window gives its own zone's.

    A window with another number of labels than tokens is an error.
    """
    problem = F.raise_error(F.lit("as many labels as tokens are needed")).cast("array<string>")

    def owned(b: Column, labels: Column) -> Column:
        zone = F.slice(labels, b["own_first"] - b["first"] + 1, b["own_stop"] - b["own_first"])
        return F.when(F.size(labels) == b["stop"] - b["first"], zone).otherwise(problem)

    return F.flatten(F.zip_with(bounds, found, owned))
