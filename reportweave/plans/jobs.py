"""Whole jobs: the operators chained as a user of report tables runs them.

Every job takes and returns DataFrames with a ``doc_id``; files are read and written by
``reportweave.sources``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions import entities as en
from reportweave.functions import labels as lb
from reportweave.functions import text as tx
from reportweave.operators import annotation, counts, evaluation, sampling, sections, tasks
from reportweave.sources.stored import store

# What finds the entities of a text column: phrases, or a function that adds ``ents``.
Annotator = Mapping[str, str] | Callable[[DataFrame], DataFrame]

# Texts whose labels are to be trained out, and the tokens cleared in them (fixed values).
FEATURES_OF_CONCERN = "sinusitis|Infection Risk"
CLEARED_TOKENS = ("Infection", "sinusitis")



def _with_entities(
    df: DataFrame,
    annotator: Annotator,
    rules: en.NegationRules | None,
    text: str,
    by_phrases: Callable[..., DataFrame] = annotation.assertions,
) -> DataFrame:
    """``df`` with ``ents``. A function gets and returns the whole rows, its text in ``text``."""
    if isinstance(annotator, Mapping):
        return by_phrases(df, annotator, rules, text)
    named = annotator(df.withColumnRenamed(text, "text") if text != "text" else df)
    return named.withColumnRenamed("text", text) if text != "text" else named


# ---------------------------------------------------------------- production


def mask_reports(reports: DataFrame, masked: Column, out: str = "report_body_masked") -> DataFrame:
    """Reports with a masked body, e.g. ``mask_pattern(col('report_body'), ...)``."""
    return reports.withColumn(out, masked)


def extract_domains(
    reports: DataFrame,
    annotator: Annotator,
    rules: en.NegationRules | None = None,
    text: str = "report_body_masked",
) -> DataFrame:
    """Every report with 92 domain counts. One pass over the table, no shuffle.

    ``annotator``: phrases (with ``rules``), or a function such as a use of
    ``annotate_with_models``; the user's models then run once per text.
    """
    return counts.domain_counts_wide(_with_entities(reports, annotator, rules, text))


# ---------------------------------------------------------------- training sets


def segmentation_training_set(reports: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """A sample with missing sections as empty text, split 80/10/10."""
    sample = sampling.simple_sample(reports, size, ["doc_id"], seed)
    filled = sample.fillna("", subset=[c for c in ("Narrative", *vocab.SECTIONS) if c in sample.columns])
    return sampling.exact_split(filled, ["doc_id"], seed)


def _clustered_sample(
    reports: DataFrame, size: int, seed: int, clusters: int, on_missing: str
) -> DataFrame:
    """``size // clusters`` reports with replacement from every map cluster."""
    placed = sampling.cluster_strata(
        reports, "_X", "_Y", k=clusters, seed=seed, on_missing=on_missing
    )
    return sampling.bootstrap_sample(placed, ["cluster_id"], size // clusters, ["doc_id"], seed)


def _tagged(
    sample: DataFrame, phrases: Mapping[str, str], rules: en.NegationRules | None, text: str
) -> DataFrame:
    filled = sample.withColumn(text, tx.fill_null(F.col(text)))
    return annotation.annotate(filled, phrases, rules, text, keep_tokens="tokens")


def entity_training_set(
    reports: DataFrame,
    phrases: Mapping[str, str],
    size: int,
    seed: int = 42,
    clusters: int = 100,
    on_missing: str = "error",
    text: str = "Narrative",
) -> DataFrame:
    """``doc_id, draw, tokens, ner_tags`` with entity tags."""
    sample = _clustered_sample(reports, size, seed, clusters, on_missing)
    tags = en.iob_tags(F.col("ents"), F.size("tokens"))
    return _tagged(sample, phrases, None, text).select(
        "doc_id", "cluster_id", "draw", "tokens", tags.alias("ner_tags")
    )


def negation_training_set(
    reports: DataFrame,
    phrases: Mapping[str, str],
    rules: en.NegationRules,
    size: int,
    seed: int = 42,
    clusters: int = 100,
    on_missing: str = "error",
    text: str = "Narrative",
) -> DataFrame:
    """``doc_id, draw, tokens, ner_tags`` with the tags ``asserted`` and ``negated``."""
    sample = _clustered_sample(reports, size, seed, clusters, on_missing)
    tagged = _tagged(sample, phrases, rules, text)
    tags = en.iob_tags(en.assertion_entities(F.col("ents")), F.size("tokens"))
    return tagged.select("doc_id", "cluster_id", "draw", "tokens", tags.alias("ner_tags"))


def fine_tuning_set(
    reports: DataFrame,
    phrases: Mapping[str, str],
    size: int,
    seed: int = 42,
    text: str = "Narrative",
) -> DataFrame:
    """Texts with features of concern, their labels cleared from the tokens concerned."""
    concerned = reports.where(tx.contains_pattern(F.col(text), FEATURES_OF_CONCERN))
    sample = sampling.simple_bootstrap(concerned, size, ["doc_id"], seed)
    tags = en.iob_tags(F.col("ents"), F.size("tokens"))
    cleared = en.clear_tags(tags, F.col("tokens"), CLEARED_TOKENS)
    return _tagged(sample, phrases, None, text).select(
        "doc_id", "draw", "tokens", cleared.alias("ner_tags")
    )


# ---------------------------------------------------------------- records for people


def prospective_tasks(
    counted: DataFrame,
    annotator: Annotator,
    rules: en.NegationRules | None,
    total: int,
    seed: int = 42,
    domains: Sequence[str] = vocab.EVALUATION_PATHOLOGIES,
    quota: int | None = None,
    text: str = "report_body",
    length: tuple[int, int] = (30, 1000),
) -> DataFrame:
    """Pre-filled choice records from an even sample over domains.

    ``counted``: reports with domain counts. The quota per domain is the total over all
    evaluation domains, also when fewer are sampled, unless given.
    """
    readable = counted.where(tx.length_between(F.col(text), *length))
    each = quota if quota is not None else total // len(vocab.EVALUATION_PATHOLOGIES)
    columns = {d: f"asserted_{d}" for d in domains}
    sample = sampling.even_domain_sample(readable, columns, each, ["doc_id"], seed)
    picked = sample.select("doc_id", "domain", text)
    found = _with_entities(picked, annotator, rules, text, annotation.annotate)
    usable = found.where(~en.has_label(F.col("ents"), vocab.EXCLUDED_FROM_EVALUATION))
    return tasks.choice_tasks(usable, text=text, carry=["doc_id", "domain"])


def section_review_tasks(
    reports: DataFrame, markers: Mapping[str, str], size: int, seed: int = 42,
    text: str = "Narrative", length: tuple[int, int] = (30, 1500),
) -> DataFrame:
    """Readable dumps of a text and its sections."""
    readable = reports.where(tx.length_between(F.col(text), *length))
    sample = sampling.simple_sample(readable, size, ["doc_id"], seed)
    found = sections.section_documents(sample, markers, text)
    return found.select("doc_id", tx.section_dump(F.col(text), F.col("sections")).alias("text"))


def segmentation_tasks(
    reports: DataFrame, size: int, seed: int = 42, length: tuple[int, int] = (30, 1500)
) -> DataFrame:
    """Joined section texts with section marks and tokens."""
    readable = reports.where(tx.length_between(F.col("Narrative"), *length))
    sample = sampling.simple_sample(readable, size, ["doc_id"], seed)
    marked = sections.section_offsets(sample).withColumn("tokens", tx.tokens(F.col("text")))
    return tasks.document_tasks(marked, carry=["doc_id"])


# ---------------------------------------------------------------- evaluation


def pair_predictions(left: DataFrame, right: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Two predictions for the same documents, side by side."""
    return left.join(right, doc_id)


def gold_and_predicted(
    gold: DataFrame,
    found: DataFrame,
    keep: Sequence[str] = vocab.EVALUATION_PATHOLOGIES,
    ignore_negation: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, gold, pred, ents`` from accepted choice records and annotated documents.

    ``carry`` are further columns of ``found`` to keep, such as the text.
    """
    labels = F.transform("accept", lambda l: lb.normalise_label(l))
    gold = tasks.accepted(gold).select("doc_id", lb.keep_labels(labels, keep).alias("gold"))
    pred = en.asserted_labels(F.col("ents"), keep, ignore_negation)
    return pair_predictions(gold, found.select("doc_id", pred.alias("pred"), "ents", *carry))


def evaluate_domains(scored: DataFrame, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Metrics per label, and the documents that went wrong with what was found in them.

    ``carry`` are columns of ``scored`` that stand beside an error, such as the text of the report.
    Both results read what was scored, so it is stored: models run once per text.
    """
    scored = store(scored, "scored-documents")
    return evaluation.domain_metrics(scored), evaluation.label_errors(scored, ents="ents", carry=carry)
