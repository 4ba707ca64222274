"""The reader's own model, run in batches.

The one place where Python runs on the executors: a language model cannot be written with
Spark's functions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportweave.functions import entities as en
from reportweave.functions import labels as lb
from reportweave.functions import text as tx
from reportweave.operators import windows as wn
from reportweave.operators.sections import sections_from_labels

SPAN_TYPE = "array<struct<entity_group:string,score:double,word:string,start:int,end:int>>"
Predict = Callable[[Sequence[str]], Sequence[Sequence[Mapping[str, object]]]]

#: Spans go back to Spark as soon as so many are held, and not with the whole Arrow batch.
HELD_SPANS = 10_000


def model_spans(
    loads: Sequence[Callable[[], Predict]], batch_size: int = 32
) -> Callable[[Column], Column]:
    """Column function for span models: one array of spans per model, in fields ``m0, m1, ...``.

    ``loads`` build the models once per Python worker; each maps a list of texts to one list of
    spans per text, with the keys of ``SPAN_TYPE``. Texts cross to Python once for all models, in
    Arrow batches, and are handed on in slices of ``batch_size``. The column counts as
    nondeterministic, so that no later step makes Spark run the models a second time.
    """
    @F.pandas_udf(", ".join(f"m{i} {SPAN_TYPE}" for i in range(len(loads))))
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        models = [load() for load in loads]
        for texts in batches:
            for found in _spans_in_parts(models, [[t] for t in texts], batch_size):
                yield _frame([spans for (spans,) in rows] for rows in found)

    return predict.asNondeterministic()


def _frame(found: Iterable[list]) -> pd.DataFrame:
    """A column of objects per model."""
    return pd.DataFrame({f"m{i}": pd.Series(f, dtype=object) for i, f in enumerate(found)})


def _spans_of(model: Predict, texts: list[str]) -> list[list[dict]]:
    """One list of spans per text."""
    keys = ("entity_group", "score", "word", "start", "end")
    found = [[{k: s.get(k) for k in keys} for s in doc] for doc in model(texts)]
    if len(found) != len(texts):
        raise ValueError(f"the model gave spans for {len(found)} of {len(texts)} texts")
    return found


def _spans_in_parts(
    models: Sequence[Predict], rows: Sequence[Sequence[str]], batch_size: int
) -> Iterator[list[list[list[list[dict]]]]]:
    """The spans of some rows after the other: by model, row and text of the row.

    A part ends with the row that brings it to ``HELD_SPANS`` spans. Models get ``batch_size``
    texts at a time, over the borders of rows and parts.
    """
    sizes = [len(texts) for texts in rows]
    texts = [t for row in rows for t in row]
    spans: list[list[list[dict]]] = [[] for _ in models]
    first = held = 0
    for at in range(0, len(texts), batch_size):
        for found, model in zip(spans, models, strict=True):
            some = _spans_of(model, texts[at : at + batch_size])
            held += sum(map(len, some))
            found += some
        if held < HELD_SPANS:
            continue
        stop, done = first, 0
        while stop < len(sizes) and done + sizes[stop] <= len(spans[0]):
            done += sizes[stop]
            stop += 1
        if stop > first:
            yield [_regrouped(found[:done], sizes[first:stop]) for found in spans]
            spans, first = [found[done:] for found in spans], stop
            held = sum(len(s) for found in spans for s in found)
    if first < len(sizes) or not sizes:
        yield [_regrouped(found, sizes[first:]) for found in spans]


def _regrouped(found: list, sizes: Sequence[int]) -> list[list]:
    ends = list(accumulate(sizes, initial=0))
    return [found[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def model_window_spans(
    loads: Sequence[Callable[[], Predict]], batch_size: int = 32
) -> Callable[[Column], Column]:
    """As ``model_spans`` for an array of windows of each text: one array of spans per window.

    The windows of all texts of an Arrow batch go to the models together, so that a model
    always gets batches of ``batch_size`` inputs of bounded length.
    """

    @F.pandas_udf(", ".join(f"m{i} array<{SPAN_TYPE}>" for i in range(len(loads))))
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        models = [load() for load in loads]
        for rows in batches:
            for found in _spans_in_parts(models, rows.tolist(), batch_size):
                yield _frame(found)

    return predict.asNondeterministic()


LabelTokens = Callable[[Sequence[Sequence[str]]], Sequence[Sequence[str]]]


def model_labels(
    load: Callable[[], LabelTokens], batch_size: int = 32
) -> Callable[[Column], Column]:
    """Column function for a model that gives one label per token; as ``model_spans`` otherwise."""

    @F.pandas_udf("array<string>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for rows in batches:
            labels: list[list[str]] = []
            for at in range(0, len(rows), batch_size):
                part = [list(tokens) for tokens in rows.iloc[at : at + batch_size]]
                labels += [list(found) for found in model(part)]
            yield pd.Series(labels, index=rows.index, dtype=object)

    return predict.asNondeterministic()


def model_window_labels(
    load: Callable[[], LabelTokens], batch_size: int = 32
) -> Callable[[Column], Column]:
    """As ``model_labels`` for an array of windows (token lists) of each text."""

    @F.pandas_udf("array<array<string>>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for rows in batches:
            sizes = [len(windows) for windows in rows]
            inputs = [list(w) for windows in rows for w in windows]
            found: list[list[str]] = []
            for at in range(0, len(inputs), batch_size):
                found += [list(labels) for labels in model(inputs[at : at + batch_size])]
            yield pd.Series(_regrouped(found, sizes), index=rows.index, dtype=object)

    return predict.asNondeterministic()


Classify = Callable[[Sequence[str]], Sequence[Mapping[str, object]]]


def model_class(load: Callable[[], Classify], batch_size: int = 32) -> Callable[[Column], Column]:
    """Column function for a text classifier: a struct of ``label`` and ``score`` per text.

    ``load`` builds the model once per Python worker; it maps a list of texts to one mapping with
    ``label`` and ``score`` per text. A text for which it gives none has a null label and score.
    """

    @F.pandas_udf("label string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for texts in batches:
            found: list[Mapping[str, object]] = []
            for at in range(0, len(texts), batch_size):
                found += [c or {} for c in model(texts.iloc[at : at + batch_size].tolist())]
            if len(found) != len(texts):
                raise ValueError(f"the model gave {len(found)} classes for {len(texts)} texts")
            yield pd.DataFrame({
                "label": pd.Series([c.get("label") for c in found], dtype=object),
                "score": pd.Series([c.get("score") for c in found], dtype=float),
            })

    return predict.asNondeterministic()


def classify_with_model(
    df: DataFrame,
    load: Callable[[], Classify],
    text: str = "text",
    label: str = "label",
    score: str = "score",
    batch_size: int = 32,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Adds ``label`` and ``score`` by the reader's own text classifier.

    Blank and missing texts reach the model as the placeholder; the text column stays as it is.
    ``names`` renames labels; one without a name is an error.
    """
    columns = [c for c in df.columns if c not in (label, score)]
    given = model_class(load, batch_size)(tx.blank_placeholder(F.col(text)))
    found = df.select(*columns, given.alias("_class"))
    shown = F.col("_class.label") if names is None else lb.map_label(F.col("_class.label"), names)
    return found.select(*columns, shown.alias(label), F.col("_class.score").alias(score))


def section_with_model(
    df: DataFrame,
    load: Callable[[], LabelTokens],
    text: str = "text",
    out: str = "sections",
    batch_size: int = 32,
    keep_prefix: bool = False,
    limit: int | None = None,
    overlap: int = 64,
    weight: wn.Weight | None = None,
    spare: int = 0,
) -> DataFrame:
    """Adds sections by a model that labels tokens: ``O``, or the section that starts there.

    With ``limit`` the model gets no more tokens (or sub-tokens by ``weight``) at a time; long
    texts go in overlapping windows, and each token's label comes from the window that owns it.
    """
    columns = [c for c in df.columns if c != out]
    if limit is None:
        labelled = df.withColumn("_label", model_labels(load, batch_size)(tx.words(F.col(text))))
    else:
        work = df.withColumn("_words", tx.words(F.col(text)))
        weights = F.transform("_words", weight) if weight else None
        work = work.withColumn(
            "_bounds", wn.window_bounds(F.size("_words"), limit, overlap, weights, spare)
        )
        cut = F.transform("_bounds", lambda b: F.slice("_words", b["first"] + 1, b["stop"] - b["first"]))
        work = work.withColumn("_given", model_window_labels(load, batch_size)(cut))
        labelled = work.withColumn("_label", wn.stitch_labels(F.col("_bounds"), F.col("_given")))
    return sections_from_labels(labelled, "_label", text, out, keep_prefix).select(*columns, out)


def annotate_with_models(
    df: DataFrame,
    ner: Callable[[], Predict],
    negation: Callable[[], Predict],
    text: str = "text",
    out: str = "ents",
    batch_size: int = 32,
    closed: bool = True,
) -> DataFrame:
    """Adds entities of an entity model, negated by the first overlapping span of a second model.

    Blank texts become the placeholder first, in the text column too. Works on streams.
    """
    filled = df.withColumn(text, tx.blank_placeholder(F.col(text)))
    found = filled.withColumn("_found", model_spans([ner, negation], batch_size)(F.col(text)))
    return found.withColumn(out, _negated("_found.m0", F.col("_found.m1"), closed)).drop("_found")


def _negated(entities: str | Column, spans: Column, closed: bool) -> Column:
    return en.first_overlap_negated(
        F.transform(
            entities,
            lambda e: F.struct(
                *[e[k].alias(k) for k in ("entity_group", "score", "word", "start", "end")],
                F.lit(False).alias("negated"),
            ),
        ),
        spans,
        closed,
    )


def annotate_windows(
    df: DataFrame,
    ner: Callable[[], Predict],
    negation: Callable[[], Predict],
    text: str = "text",
    out: str = "ents",
    limit: int = 512,
    overlap: int = 64,
    weight: wn.Weight | None = None,
    spare: int = 0,
    batch_size: int = 32,
    closed: bool = True,
) -> DataFrame:
    """``annotate_with_models`` for models that take ``limit`` tokens: no part of a text is lost.

    Texts go to the models in windows that overlap by ``overlap`` tokens. A span belongs to the
    window in whose zone it begins, and overlap between entities and negation spans is decided on
    the whole text. The result is that of a model without a limit if its spans are no longer than
    half the overlap and hang on no more context. ``weight`` counts the sub-tokens of a token
    (then ``limit`` and ``overlap`` are in sub-tokens); special tokens that the model adds must be
    left out of ``limit``. Both models are one Python step. Works on streams.
    """
    filled = df.withColumn(text, tx.blank_placeholder(F.col(text)))
    cut = filled.withColumn(
        "_windows", wn.text_windows(F.col(text), limit, overlap, weight, spare)
    )
    given = model_window_spans([ner, negation], batch_size)(F.transform("_windows", lambda w: w["text"]))
    found = cut.withColumn("_found", given)
    spans = [wn.stitch_spans(F.col("_windows"), F.col(f"_found.m{i}")) for i in (0, 1)]
    return found.withColumn(out, _negated(spans[0], spans[1], closed)).drop("_windows", "_found")
