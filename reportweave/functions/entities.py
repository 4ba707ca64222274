"""Entities of one report: phrase lookup, assertion status, tags and counts.

Every function is a column expression over the row's own arrays, so annotating a table needs
one scan and no shuffle, and works on a streaming table as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions import text as tx
from reportweave.functions.arrays import bind, first_not, running_flags, running_max
from reportweave.functions.labels import literal_array, sql_text

ENTITY_TYPE = (
    "struct<entity_group:string,score:double,word:string,start:int,end:int,negated:boolean,"
    "tok_start:int,tok_end:int>"
)


@dataclass(frozen=True)
class NegationRules:
    """Trigger phrases, and the labels they apply to."""

    preceding: Sequence[str] = ()
    following: Sequence[str] = ()
    termination: Sequence[str] = ()
    pseudo: Sequence[str] = ()
    sentence_ends: Sequence[str] = vocab.SENTENCE_ENDS
    eligible: Sequence[str] = field(default=vocab.NEGATABLE)

    def phrases(self) -> dict[str, str]:
        kinds = ("preceding", "following", "termination", "pseudo")
        return {p: kind for kind in kinds for p in getattr(self, kind)}

    def wanted(self) -> set[str]:
        """Words the rules look at: heads of trigger phrases and sentence ends."""
        return {p.split(" ")[0] for p in self.phrases()} | set(self.sentence_ends)


# ---------------------------------------------------------------- phrase lookup


def first_words(phrases: Iterable[str]) -> set[str]:
    return {p.split(" ")[0] for p in phrases}


def wanted_words(tokens: Column, wanted: Iterable[str]) -> Column:
    """Tokens whose lower-case form is in a fixed set: ``ARRAY<STRUCT<i,w>>``.

    The one pass over all tokens; everything after it works on these few.
    """
    return F.filter(
        F.transform(tokens, lambda t, i: F.struct(i.alias("i"), F.lower(t).alias("w"))),
        lambda h: h["w"].isin(sorted(wanted)),
    )


def free_flags(candidates: Column) -> Column:
    """Greedy choice among spans sorted by start, one per start: a taken span blocks its tokens."""

    def free(stop: Column, c: Column) -> Column:
        return c["tok_start"] >= stop

    return running_flags(
        candidates,
        F.lit(0),
        lambda stop, c: F.when(free(stop, c), c["tok_end"]).otherwise(stop),
        free,
    )


def flagged(values: Column, flags: Column) -> Column:
    """Elements whose flag is set."""
    return bind(flags, lambda f: F.filter(values, lambda _, k: F.get(f, k)))


def longest_phrases(tokens: Column, hits: Column, phrases: Mapping[str, str]) -> Column:
    """Longest phrase at every hit: ``ARRAY<STRUCT<label,tok_start,tok_end>>``, may overlap."""
    by_length: dict[int, dict[str, str]] = {}
    for phrase, label in phrases.items():
        by_length.setdefault(len(phrase.split(" ")), {})[phrase] = label
    heads = sorted(first_words(phrases))

    def entries(length: int) -> Column:
        pairs = [
            f"{sql_text(phrase)}, named_struct('label', {sql_text(label)}, 'n', {length})"
            for phrase, label in by_length[length].items()
        ]
        return F.expr(f"map({', '.join(pairs)})")

    def longest_at(words: Column, hit: Column) -> Column:
        def surface(length: int) -> Column:
            rest = [F.lower(F.get(words, hit["i"] + k)) for k in range(1, length)]
            return F.concat_ws(" ", hit["w"], *rest) if rest else hit["w"]

        found = F.coalesce(
            *[F.try_element_at(entries(n), surface(n)) for n in sorted(by_length, reverse=True)]
        )
        return bind(
            found,
            lambda f: F.when(
                f.isNotNull(),
                F.struct(
                    f["label"].alias("label"),
                    hit["i"].alias("tok_start"),
                    (hit["i"] + f["n"]).alias("tok_end"),
                ),
            ),
        )

    own = F.filter(hits, lambda h: h["w"].isin(heads))
    return bind(
        tokens,
        lambda words: F.filter(
            F.transform(own, lambda h: longest_at(words, h)), lambda c: c.isNotNull()
        ),
    )


# ---------------------------------------------------------------- assertion status

# Events on the token axis packed into one sortable number: position, kind, length.
_BOUNDARY, _PRECEDING, _FOLLOWING = 0, 2, 3
_LENGTH_BITS, _KIND_BITS = 16, 2


def _event(pos: Column, kind: Column | int, length: Column | int) -> Column:
    kind = F.lit(kind) if isinstance(kind, int) else kind
    length = F.lit(length) if isinstance(length, int) else length
    scale = F.lit(2**_KIND_BITS).cast("bigint")
    return (pos * scale + kind) * F.lit(2**_LENGTH_BITS) + length


def _kind(event: Column) -> Column:
    return F.shiftright(event, _LENGTH_BITS).bitwiseAND(F.lit(2**_KIND_BITS - 1))


def _pos(event: Column) -> Column:
    return F.shiftright(event, _LENGTH_BITS + _KIND_BITS)


def _end(event: Column) -> Column:
    return _pos(event) + event.bitwiseAND(F.lit(2**_LENGTH_BITS - 1))


def scope_events(hits: Column, triggers: Column, sentence_ends: Sequence[str]) -> Column:
    """Boundaries and triggers of a text in token order."""

    def trigger_kind(t: Column) -> Column:
        return (
            F.when(t["label"] == "termination", _BOUNDARY)
            .when(t["label"] == "preceding", _PRECEDING)
            .when(t["label"] == "following", _FOLLOWING)
        )

    live = F.filter(triggers, lambda t: t["label"] != "pseudo")
    ends = F.filter(hits, lambda h: h["w"].isin(list(sentence_ends)))
    return F.sort_array(
        F.concat(
            F.transform(ends, lambda h: _event(h["i"] + 1, _BOUNDARY, 0)),
            F.transform(
                live,
                lambda t: _event(t["tok_start"], trigger_kind(t), t["tok_end"] - t["tok_start"]),
            ),
        )
    )


_FAR = 2**62


def _flags_of_runs(runs: Column, size: Column) -> Column:
    """``size`` flags, set in the ranges ``from`` to ``to`` (exclusive), whose ends never fall."""

    def flags(every: Column) -> Column:
        done = lambda j: F.coalesce(F.get(every, j - 1)["to"], F.lit(0))

        def run(r: Column, j: Column) -> Column:
            begin = F.least(F.greatest(r["from"], done(j)), r["to"])
            return F.concat(
                F.array_repeat(F.lit(False), begin - done(j)),
                F.array_repeat(F.lit(True), r["to"] - begin),
            )

        rest = F.array_repeat(F.lit(False), size - done(F.size(every)))
        return F.concat(F.flatten(F.transform(every, run)), rest)

    return bind(runs, flags)


def triggered_marks(events: Column, marks: Column) -> Column:
    """One flag per mark: a trigger of its segment reaches it. ``marks`` are sorted and disjoint.

    Boundaries cut the text into segments. A preceding trigger reaches the marks that start behind
    it, a following one those that end before it does, and neither one that ends behind the
    segment. Both reach a range of marks, so what is searched for is the ends of the range of
    every trigger, of which there are few, and no state is carried from event to event.
    """

    def reached(bounds: Column, all_marks: Column, e: Column, following: bool) -> Column:
        def within(at: Column) -> Column:
            stop = F.coalesce(F.get(bounds, at), F.lit(_FAR))
            if following:
                begin = F.coalesce(F.get(bounds, at - 1), F.lit(0))
                outside = lambda m: m["tok_start"] < begin
                inside = lambda m: (m["tok_end"] <= stop) & (m["tok_end"] < _end(e))
            else:
                outside = lambda m: m["tok_start"] <= _pos(e)
                inside = lambda m: m["tok_end"] <= stop
            return F.struct(
                first_not(all_marks, outside).alias("from"), first_not(all_marks, inside).alias("to")
            )

        return bind(first_not(bounds, lambda b: b <= _pos(e)), within)

    def reach(bounds: Column, all_events: Column, all_marks: Column, following: bool) -> Column:
        wanted = _FOLLOWING if following else _PRECEDING
        runs = F.transform(
            F.filter(all_events, lambda e: _kind(e) == wanted),
            lambda e: reached(bounds, all_marks, e, following),
        )
        return _flags_of_runs(runs, F.size(all_marks))

    def flags(all_events: Column, all_marks: Column) -> Column:
        bounds = F.transform(F.filter(all_events, lambda e: _kind(e) == _BOUNDARY), _pos)
        return bind(
            bounds,
            lambda b: F.zip_with(
                reach(b, all_events, all_marks, False),
                reach(b, all_events, all_marks, True),
                lambda left, right: left | right,
            ),
        )

    return bind(events, lambda evs: bind(marks, lambda all_marks: flags(evs, all_marks)))


# ---------------------------------------------------------------- overlap with negation spans


def first_overlap_negated(entities: Column, spans: Column, closed: bool = True) -> Column:
    """Entities with ``negated`` set by the first overlapping span, in list order.

    The first overlap decides even when it says "asserted"; no overlap means not negated.
    Ends are compared as closed by default, so spans that touch do match. In spans that are
    sorted by start, the first overlap is the first one that ends late enough: a search in the
    running maximum of the ends. Spans in any other order are compared with every entity.
    """

    def overlap(e: Column, s: Column) -> Column:
        if closed:
            return (e["start"] <= s["end"]) & (s["start"] <= e["end"])
        return (e["start"] < s["end"]) & (s["start"] < e["end"])

    def flags(first: Callable[[Column], Column]) -> Column:
        says = lambda e, s: overlap(e, s) & (s["entity_group"] == "negated")
        return F.transform(
            entities,
            lambda e: e.withField(
                "negated", bind(first(e), lambda s: F.coalesce(says(e, s), F.lit(False)))
            ),
        )

    def searched(all_spans: Column, ends: Column) -> Column:
        def too_early(e: Column) -> Callable[[Column], Column]:
            reached = lambda end: end >= e["start"] if closed else end > e["start"]
            return lambda end: ~F.coalesce(reached(end), F.lit(False))

        return flags(lambda e: F.get(all_spans, first_not(ends, too_early(e))))

    def compared(all_spans: Column) -> Column:
        return flags(lambda e: F.get(F.filter(all_spans, lambda s: overlap(e, s)), F.lit(0)))

    def disordered(all_spans: Column) -> Column:
        before = lambda i: F.get(all_spans, i - 1)["start"]
        falls = F.transform(
            all_spans,
            lambda s, i: s["start"].isNull() | F.coalesce(s["start"] < before(i), F.lit(False)),
        )
        return F.exists(falls, lambda f: f)

    return bind(
        spans,
        lambda all_spans: F.when(disordered(all_spans), compared(all_spans)).otherwise(
            bind(
                running_max(F.transform(all_spans, lambda s: s["end"])),
                lambda ends: searched(all_spans, ends),
            )
        ),
    )


# ---------------------------------------------------------------- filters and label sets


def asserted_labels(
    entities: Column, keep: Iterable[str] | None = None, ignore_negation: bool = False
) -> Column:
    """Distinct labels of the entities that are not negated, sorted."""

    def wanted(e: Column) -> Column:
        test = F.lit(True) if ignore_negation else ~e["negated"]
        return test & e["entity_group"].isin(list(keep)) if keep is not None else test

    labels = F.transform(F.filter(entities, wanted), lambda e: e["entity_group"])
    return F.array_sort(F.array_distinct(labels))


def has_label(entities: Column, label: str) -> Column:
    return F.exists(entities, lambda e: e["entity_group"] == label)


# ---------------------------------------------------------------- tags


def iob_tags(entities: Column, n_tokens: Column) -> Column:
    """One tag per token from sorted, disjoint token spans: runs of O between B-/I- runs."""
    outside = F.lit(vocab.OUTSIDE)

    def stop_before(ents: Column, k: Column) -> Column:
        return F.when(k == 0, F.lit(0)).otherwise(F.get(ents, k - 1)["tok_end"])

    def run(ents: Column, e: Column, k: Column) -> Column:
        gap = F.array_repeat(outside, e["tok_start"] - stop_before(ents, k))
        inside = F.array_repeat(
            F.concat(F.lit("I-"), e["entity_group"]), e["tok_end"] - e["tok_start"] - 1
        )
        return F.concat(gap, F.array(F.concat(F.lit("B-"), e["entity_group"])), inside)

    def tags(ents: Column) -> Column:
        tail = F.array_repeat(outside, n_tokens - stop_before(ents, F.size(ents)))
        return F.concat(F.flatten(F.transform(ents, lambda e, k: run(ents, e, k))), tail)

    return bind(entities, tags)


def assertion_entities(entities: Column) -> Column:
    """Entities relabelled as ``asserted`` or ``negated``."""
    return F.transform(
        entities,
        lambda e: e.withField(
            "entity_group", F.when(e["negated"], "negated").otherwise("asserted")
        ),
    )


def clear_tags(tags: Column, tokens: Column, substrings: Sequence[str]) -> Column:
    """Tags set to O where the token contains one of the substrings (case counts)."""

    def hit(tok: Column) -> Column:
        test = F.lit(False)
        for s in substrings:
            test = test | F.contains(tok, F.lit(s))
        return test

    return F.zip_with(tags, tokens, lambda t, tok: F.when(hit(tok), vocab.OUTSIDE).otherwise(t))


# ---------------------------------------------------------------- counts


def domain_count_columns(codes: str, domains: Sequence[str] = vocab.DOMAINS) -> list[Column]:
    """``asserted_x`` and ``denied_x`` for every domain, zero where there is none.

    ``codes`` names a column made by ``domain_codes``.
    """
    columns = []
    for flag, prefix in ((0, "asserted_"), (1, "denied_")):
        for k, label in enumerate(domains):
            code = 2 * (k + 1) + flag
            count = F.expr(f"aggregate({codes}, 0L, (n, c) -> if(c = {code}, n + 1L, n))")
            columns.append(count.alias(prefix + label))
    return columns


def domain_codes(entities: Column, domains: Sequence[str] = vocab.DOMAINS) -> Column:
    """One number per entity for label and assertion; labels outside the list are left out."""
    names = literal_array(domains)
    codes = F.transform(
        entities,
        lambda e: F.array_position(names, e["entity_group"]).cast("int") * 2
        + e["negated"].cast("int"),
    )
    return F.filter(codes, lambda c: c >= 2)
