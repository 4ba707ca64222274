"""Scores against human labels.

Label lists have a fixed vocabulary (``keep``), so per-label counts are sums over rows spread by
a constant, summed before the shuffle; the tables of scores behind them have one row per label.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions.labels import literal_array
from reportweave.operators import alignment


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def binarise_labels(
    df: DataFrame,
    keep: Sequence[str] = vocab.EVALUATION_PATHOLOGIES,
    gold: str = "gold",
    pred: str = "pred",
    doc_id: str = "doc_id",
    classes: str = "gold",
) -> DataFrame:
    """``doc_id, label, gold, pred``: one row per document and class.

    Classes are the labels seen in any gold list; labels predicted only are dropped, so they
    count nowhere. ``classes='keep_list'`` takes the whole keep list.
    """
    rows = df.withColumn("_classes", _class_array(df, keep, gold, classes)).select(
        doc_id,
        F.explode(
            F.transform(
                "_classes",
                lambda l: F.struct(
                    l.alias("label"),
                    F.coalesce(F.array_contains(gold, l), F.lit(False)).alias("gold"),
                    F.coalesce(F.array_contains(pred, l), F.lit(False)).alias("pred"),
                ),
            )
        ).alias("r"),
    )
    return rows.select(doc_id, "r.*")


def _class_array(df: DataFrame, keep: Sequence[str], gold: str, classes: str) -> Column:
    """Sorted classes as one array: a constant, or a scalar over the gold lists."""
    names = literal_array(sorted(keep))
    if classes == "keep_list":
        return names
    # One flag per label of the keep list: the aggregate is as wide as the list, whatever the data.
    seen = df.agg(
        F.filter(
            F.array(
                *[
                    F.when(F.bool_or(F.array_contains(gold, k)), F.lit(k))
                    for k in sorted(keep)
                ]
            ),
            lambda l: l.isNotNull(),
        )
    )
    return seen.scalar()


def multilabel_confusion(
    df: DataFrame,
    keep: Sequence[str] = vocab.EVALUATION_PATHOLOGIES,
    gold: str = "gold",
    pred: str = "pred",
    classes: str = "gold",
) -> DataFrame:
    """``label, tn, fp, fn, tp`` over all documents, counted in one aggregate without more rows."""

    def cell(label: str) -> Column:
        g, p = (F.coalesce(F.array_contains(c, label), F.lit(False)) for c in (gold, pred))
        return F.struct(
            F.lit(label).alias("label"),
            F.count_if(~g & ~p).alias("tn"),
            F.count_if(~g & p).alias("fp"),
            F.count_if(g & ~p).alias("fn"),
            F.count_if(g & p).alias("tp"),
        )

    counts = df.agg(F.array(*[cell(label) for label in keep]).alias("a")).select(F.inline("a"))
    return counts.where(F.col("tp") + F.col("fn") > 0) if classes == "gold" else counts


def specificity(confusion: DataFrame) -> DataFrame:
    """``label, specificity`` per label and as micro, macro and weighted average.

    A label that every document holds has no negatives: null, and so are macro and weighted
    averages over it.
    """
    per_label = confusion.withColumn(
        "specificity", _ratio(F.col("tn"), F.col("tn") + F.col("fp"))
    ).withColumn("support", F.col("tp") + F.col("fn"))
    spec, support = F.col("specificity"), F.col("support")
    complete = F.count(spec) == F.count("*")
    averages = per_label.agg(
        F.array(
            F.struct(
                F.lit("micro avg").alias("label"),
                _ratio(F.sum("tn"), F.sum(F.col("tn") + F.col("fp"))).alias("specificity"),
            ),
            F.struct(F.lit("macro avg").alias("label"), F.when(complete, F.avg(spec)).alias("specificity")),
            F.struct(
                F.lit("weighted avg").alias("label"),
                F.when(complete, _ratio(F.sum(spec * support), F.sum(support))).alias("specificity"),
            ),
        ).alias("a")
    )
    return per_label.select("label", "specificity").unionByName(
        averages.select(F.inline("a"))
    )


def multilabel_report(
    df: DataFrame,
    keep: Sequence[str] = vocab.EVALUATION_PATHOLOGIES,
    gold: str = "gold",
    pred: str = "pred",
    classes: str = "gold",
) -> DataFrame:
    """``label, precision, recall, f1, support`` per label and as four averages.

    A ratio over zero is 0. The samples average is the mean of per-document scores.
    """
    return report_of(evaluation_state(df, keep, gold, pred), keep, classes).drop("specificity", "sensitivity")


def domain_metrics(
    df: DataFrame,
    keep: Sequence[str] = vocab.EVALUATION_PATHOLOGIES,
    gold: str = "gold",
    pred: str = "pred",
    classes: str = "gold",
) -> DataFrame:
    """The multilabel report with sensitivity and specificity attached.

    The samples average has neither. ``df`` is read once.
    """
    return report_of(evaluation_state(df, keep, gold, pred), keep, classes)


def evaluation_state(
    df: DataFrame,
    keep: Sequence[str] = vocab.EVALUATION_PATHOLOGIES,
    gold: str = "gold",
    pred: str = "pred",
) -> DataFrame:
    """``gold, pred, n``: how many documents have which two sets of kept labels.

    All scores follow from it, so ``df`` is read once, and states of parts or days add up with
    ``merge_states``. Documents are summed before the shuffle. Null lists are empty.
    """
    names = literal_array(sorted(keep))
    held = lambda c: F.coalesce(
        F.array_sort(F.array_intersect(F.col(c), names)), F.array().cast("array<string>")
    )
    return df.groupBy(held(gold).alias("gold"), held(pred).alias("pred")).agg(F.count("*").alias("n"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all documents from the states of their parts, which share no document."""
    merged = states[0]
    for state in states[1:]:
        merged = merged.unionByName(state)
    return merged.groupBy("gold", "pred").agg(F.sum("n").alias("n"))


def report_of(
    state: DataFrame, keep: Sequence[str] = vocab.EVALUATION_PATHOLOGIES, classes: str = "gold"
) -> DataFrame:
    """The rows of ``domain_metrics`` from an ``evaluation_state`` over the same ``keep``.

    Classes that gold has nowhere do not count, which is known when all states are read: the classes
    are an aggregate over the state first, and Spark reuses the shuffle behind it.
    """
    n = F.col("n")
    count = lambda hit: F.coalesce(F.sum(F.when(hit, n)), F.lit(0))

    def cell(label: str) -> Column:
        g, p = F.array_contains("gold", label), F.array_contains("pred", label)
        return F.struct(
            F.lit(label).alias("label"), count(~g & ~p).alias("tn"), count(~g & p).alias("fp"),
            count(g & ~p).alias("fn"), count(g & p).alias("tp"),
        )

    # One row per document set; the classes stand beside it as one small array.
    # The filter keeps the counts in the plan of the classes, so that both sides are one shuffle.
    known = state.withColumn("_classes", _class_array(state.where("n > 0"), keep, "gold", classes)).select(
        "gold", F.array_intersect("pred", "_classes").alias("pred"), "n", "_classes"
    )
    hits, n_gold, n_pred = F.size(F.array_intersect("gold", "pred")), F.size("gold"), F.size("pred")
    mean = lambda score: _or_zero(F.sum(score * n) / F.sum(n))
    totals = known.agg(
        F.array(*[cell(label) for label in sorted(keep)]).alias("cells"),
        F.first("_classes").alias("_classes"),
        F.struct(
            mean(_or_zero(_ratio(hits, n_pred))).alias("precision"),
            mean(_or_zero(_ratio(hits, n_gold))).alias("recall"),
            mean(_or_zero(_ratio(2 * hits, n_gold + n_pred))).alias("f1"),
            F.coalesce(F.sum(n_gold * n), F.lit(0)).alias("support"),
        ).alias("samples"),
    ).select(
        F.filter("cells", lambda c: F.array_contains(F.col("_classes"), c["label"])).alias("cells"), "samples"
    )

    # A few labels: what follows is arithmetic in one row.
    def scores(label: Column, tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
        return F.struct(
            label.alias("label"),
            _or_zero(_ratio(tp, tp + fp)).alias("precision"),
            _or_zero(_ratio(tp, tp + fn)).alias("recall"),
            _or_zero(_ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
            (tp + fn).cast("bigint").alias("support"),
            _ratio(tn, tn + fp).alias("specificity"),
            _or_zero(_ratio(tp, tp + fn)).alias("sensitivity"),
        )

    one = totals.select(
        "cells", "samples",
        F.transform("cells", lambda c: scores(c["label"], c["tp"], c["fp"], c["fn"], c["tn"])).alias("lines"),
    )
    total = lambda f: F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, c: a + c[f])
    support = F.aggregate("lines", F.lit(0).cast("bigint"), lambda a, r: a + r["support"])

    def average(name: str, weight) -> Column:
        weights = F.aggregate("lines", F.lit(0.0), lambda a, r: a + weight(r))
        mean_of = lambda f: _ratio(F.aggregate("lines", F.lit(0.0), lambda a, r: a + r[f] * weight(r)), weights)
        return F.struct(
            F.lit(name).alias("label"),
            *[(_or_zero(mean_of(f)) if name == "weighted avg" else mean_of(f)).alias(f) for f in ("precision", "recall", "f1")],
            support.alias("support"),
            mean_of("specificity").alias("specificity"),
            (_or_zero(mean_of("recall")) if name == "weighted avg" else mean_of("recall")).alias("sensitivity"),
        )

    none = F.lit(None).cast("double")
    samples = F.struct(
        F.lit("samples avg").alias("label"),
        *[F.col(f"samples.{f}").alias(f) for f in ("precision", "recall", "f1", "support")],
        none.alias("specificity"), none.alias("sensitivity"),
    )
    extra = F.array(
        scores(F.lit("micro avg"), total("tp"), total("fp"), total("fn"), total("tn")),
        average("macro avg", lambda r: F.lit(1.0)),
        average("weighted avg", lambda r: r["support"].cast("double")),
        samples,
    )
    return one.select(F.inline(F.concat("lines", extra)))


def class_report(df: DataFrame, gold: str = "gold", pred: str = "pred") -> DataFrame:
    """``label, precision, recall, f1, support``: one class per row of ``df``.

    Classes, then accuracy (in all three columns), macro and weighted average.
    """
    cells = df.groupBy(F.col(gold).alias("g"), F.col(pred).alias("p")).agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("g").eqNullSafe(F.col("p")), F.col("n")).otherwise(zero)
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("g").alias("label"), hit.alias("tp"), F.col("n").alias("support"),
                    zero.alias("predicted"),
                ),
                F.struct(
                    F.col("p").alias("label"), zero.alias("tp"), zero.alias("support"),
                    F.col("n").alias("predicted"),
                ),
            )
        )
    )
    tp, support, predicted = F.sum("tp"), F.sum("support"), F.sum("predicted")
    per_class = sides.groupBy("label").agg(
        _or_zero(_ratio(tp, predicted)).alias("precision"),
        _or_zero(_ratio(tp, support)).alias("recall"),
        _or_zero(_ratio(2 * tp, predicted + support)).alias("f1"),
        support.alias("support"),
        tp.alias("tp"),
    )
    accuracy = _or_zero(_ratio(F.sum("tp"), F.sum("support")))
    weighted = lambda c: _or_zero(_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")))

    def line(name: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), F.sum("support").alias("support"),
        )

    averages = per_class.agg(
        F.array(
            line("accuracy", accuracy, accuracy, accuracy),
            line("macro avg", F.avg("precision"), F.avg("recall"), F.avg("f1")),
            line("weighted avg", weighted("precision"), weighted("recall"), weighted("f1")),
        ).alias("a")
    ).select(F.inline("a"))
    return per_class.drop("tp").unionByName(averages)


def label_errors(
    df: DataFrame,
    keep: Sequence[str] = vocab.EVALUATION_PATHOLOGIES,
    gold: str = "gold",
    pred: str = "pred",
    ents: str | None = None,
    doc_id: str = "doc_id",
    classes: str = "gold",
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, label, kind`` of every false positive and false negative.

    ``carry`` are further columns to keep, such as the text of the document.

    With ``ents``, the asserted entities of the keep list as ``(word, entity_group)`` too.
    Both lists sit in the row, so no join is needed.
    """
    kept = literal_array(keep) if classes == "keep_list" else _class_array(
        df, keep, gold, classes
    )
    columns = [doc_id, *carry]
    if ents is not None:
        df = df.withColumn(
            "found",
            F.transform(
                F.filter(ents, lambda e: ~e["negated"] & e["entity_group"].isin(list(keep))),
                lambda e: F.struct(e["word"].alias("word"), e["entity_group"].alias("entity_group")),
            ),
        )
        columns.append("found")

    def errors(a: str, b: str, kind: str) -> Column:
        return F.transform(
            F.array_intersect(F.array_except(a, b), F.col("_classes")),
            lambda l: F.struct(l.alias("label"), F.lit(kind).alias("kind")),
        )

    both = F.concat(errors(pred, gold, "false_positive"), errors(gold, pred, "false_negative"))
    return (
        df.withColumn("_classes", kept)
        .select(*columns, F.explode(both).alias("e"))
        .select(*columns, "e.*")
    )


def gold_vs_pred(
    df: DataFrame, keep: Sequence[str] = vocab.EVALUATION_PATHOLOGIES,
    gold: str = "gold", pred: str = "pred", doc_id: str = "doc_id", carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, label, prediction``: both lists reduced to the keep list and sorted.

    ``carry`` are further columns to keep, such as the text of the document.
    """
    names = literal_array(keep)
    pick = lambda c: F.array_sort(F.array_intersect(c, names))
    return df.select(doc_id, *carry, pick(gold).alias("label"), pick(pred).alias("prediction"))


def span_scores(gold: DataFrame, pred: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``label, tp, fp, fn, precision, recall, f1`` for exactly equal spans; ``all`` is overall.

    ``gold`` and ``pred``: ``doc_id, start, end, label``. One grouping of the stacked spans
    instead of an outer join.
    """
    key = [doc_id, "start", "end", "label"]
    side = lambda df, g, p: df.select(*key, F.lit(g).alias("g"), F.lit(p).alias("p"))
    spans = (
        side(gold, 1, 0).unionByName(side(pred, 0, 1))
        .groupBy(*key).agg(F.max("g").alias("g"), F.max("p").alias("p"))
    )
    long = spans.select(F.explode(F.array(F.col("label"), F.lit("all"))).alias("label"), "g", "p")
    return _span_ratios(long.groupBy("label").agg(*_span_counts()))


def _span_counts() -> list[Column]:
    return [
        F.count_if((F.col("g") == 1) & (F.col("p") == 1)).alias("tp"),
        F.count_if((F.col("g") == 0) & (F.col("p") == 1)).alias("fp"),
        F.count_if((F.col("g") == 1) & (F.col("p") == 0)).alias("fn"),
    ]


def _span_ratios(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "label", "tp", "fp", "fn",
        _or_zero(_ratio(tp, tp + fp)).alias("precision"),
        _or_zero(_ratio(tp, tp + fn)).alias("recall"),
        _or_zero(_ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    )


def tokenised_span_scores(
    gold: DataFrame, pred: DataFrame, on_difference: str = "error",
    tokens: str = "tokens", spans: str = "ents", label: str = "entity_group", doc_id: str = "doc_id",
) -> DataFrame:
    """``span_scores`` where the two sides were tokenised, or spaced, in their own way.

    ``gold`` and ``pred``: a document per row, ``doc_id``, its tokens (strings) and its spans
    (``tok_start``, ``tok_end``, label). Spans are equal if they cover the same characters, blanks
    left out. A document whose characters differ between the sides is an error, or is left out of
    the scores with ``on_difference='skip'``; one that only one side has counts as it is. Null
    tokens are none, null spans are none.
    """
    if on_difference not in ("error", "skip"):
        raise ValueError(f"on_difference: {on_difference}")
    held = F.coalesce(F.col(tokens), F.array().cast("array<string>"))
    side = lambda df: df.select(
        doc_id,
        F.sha2(alignment.solid(F.array_join(held, "", "")), 256).alias("_characters"),
        alignment.common_spans(held, F.col(spans), label).alias("_spans"),
    )
    gold, pred = side(gold), side(pred)
    if on_difference == "error":
        return _scores_or_error(gold, pred, doc_id)
    digests = gold.select(doc_id, "_characters").unionByName(pred.select(doc_id, "_characters"))
    differ = digests.groupBy(doc_id).agg(
        F.min("_characters").alias("low"), F.max("_characters").alias("high")
    ).where("low <> high").select(doc_id)
    gold, pred = (df.join(differ, doc_id, "left_anti") for df in (gold, pred))
    long = lambda df: df.select(doc_id, F.inline("_spans"))
    return span_scores(long(gold), long(pred), doc_id)


def _scores_or_error(gold: DataFrame, pred: DataFrame, doc_id: str) -> DataFrame:
    """``span_scores`` of ``_spans``, an error if the ``_characters`` of a document differ.

    Each document adds a row with its characters to the rows of its spans, so that one grouping
    finds equal spans and different documents, and both sides are worked out once.
    """
    # Numbers of 60 bits, as Spark groups by hashing only where what it keeps has a fixed width.
    quarters = range(4)
    digits = lambda k: F.conv(F.substring("_characters", 15 * k + 1, 15), 16, 10).cast("bigint")
    whole = F.struct(
        F.lit(True).alias("_whole"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"),
        F.lit(None).cast("string").alias("label"), *[digits(k).alias(f"_{k}") for k in quarters],
    )
    spans = F.transform("_spans", lambda s: F.struct(
        F.lit(False).alias("_whole"), s["start"].alias("start"), s["end"].alias("end"),
        s["label"].alias("label"), *[F.lit(None).cast("bigint").alias(f"_{k}") for k in quarters],
    ))
    rows = F.inline(F.concat(F.array(whole), F.coalesce(spans, F.array())))
    side = lambda df, g, p: df.select(doc_id, F.lit(g).alias("g"), F.lit(p).alias("p"), rows)
    found = side(gold, 1, 0).unionByName(side(pred, 0, 1)).groupBy(
        doc_id, "_whole", "start", "end", "label"
    ).agg(
        *[F.max(F.when(~F.col("_whole"), F.col(c))).alias(c) for c in ("g", "p")],
        *[F.min(f"_{k}").alias(f"low{k}") for k in quarters],
        *[F.max(f"_{k}").alias(f"high{k}") for k in quarters],
    )
    everywhere = F.lit("all")
    labels = F.when(F.col("_whole"), F.array(everywhere)).otherwise(F.array(F.col("label"), everywhere))
    other = reduce(or_, [F.col(f"low{k}") != F.col(f"high{k}") for k in quarters])
    differs = F.when(other, F.col(doc_id).cast("string"))
    counts = found.select(F.explode(labels).alias("label"), "g", "p", differs.alias("_differs")).groupBy(
        "label"
    ).agg(*_span_counts(), F.min("_differs").alias("_differs"))
    # A few rows, one per label: the first document that differs is known to each of them.
    first = F.min("_differs").over(Window.partitionBy(F.lit(0)))
    problem = F.raise_error(F.concat(F.lit("the sides have different characters in document "), F.col("_first")))
    some = (F.col("tp") + F.col("fp") + F.col("fn")) > 0
    checked = counts.withColumn("_first", first).where(
        F.when(~some, F.lit(False))
        .when(F.col("_first").isNotNull(), problem.cast("boolean"))
        .otherwise(F.lit(True))
    )
    return _span_ratios(checked)
