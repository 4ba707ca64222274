"""Counts per document: domains, and entity x location x assertion triplets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportweave import vocab
from reportweave.functions import entities as en
from reportweave.functions.labels import literal_array


def domain_counts(
    mentions: DataFrame, domains: Sequence[str] = vocab.DOMAINS, doc_id: str = "doc_id"
) -> DataFrame:
    """Long form: ``doc_id, entity_group, negated, n`` for labels of the list."""
    return (
        mentions.where(F.col("entity_group").isin(list(domains)))
        .groupBy(doc_id, "entity_group", "negated")
        .agg(F.count("*").alias("n"))
    )


def domain_counts_wide(
    df: DataFrame, ents: str = "ents", domains: Sequence[str] = vocab.DOMAINS
) -> DataFrame:
    """Adds ``asserted_x`` and ``denied_x`` per domain to every row; rows without entities get 0."""
    keep = [F.col(c) for c in df.columns if c != ents]
    coded = df.select(*keep, en.domain_codes(F.col(ents), domains).alias("_codes"))
    return coded.select(*keep, *en.domain_count_columns("_codes", domains))


def triplet_counts(
    mentions: DataFrame,
    relations: DataFrame,
    on_other: str = "error",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id, entity, location, negated, n``.

    Every pathology or descriptor mention counts once for the unknown location, linked or not,
    and once per related location entity. ``relations``: ``doc_id, ent_pos, target_group``
    with one row per distinct target entity. A target that is no location is an error, or is
    left out with ``on_other='skip'``.
    """
    findings = mentions.where(F.col("entity_group").isin(list(vocab.TENSOR_ENTITIES)))
    is_location = F.col("target_group").isin(list(vocab.LOCATIONS))
    if on_other == "skip":
        relations = relations.where(is_location)
        location = F.col("target_group")
    else:
        problem = F.raise_error(
            F.concat(F.lit("related entity is not a location: "), F.col("target_group"))
        ).cast("string")
        location = F.when(is_location, F.col("target_group")).otherwise(problem)
    targets = relations.groupBy(doc_id, "ent_pos").agg(F.collect_list(location).alias("_targets"))
    unknown = F.array(F.lit(vocab.TENSOR_LOCATIONS[0]))
    return (
        findings.join(targets, [doc_id, "ent_pos"], "left")
        .select(
            doc_id,
            F.col("entity_group").alias("entity"),
            "negated",
            F.explode_outer(
                F.concat(unknown, F.coalesce("_targets", F.array().cast("array<string>")))
            ).alias("location"),
        )
        .groupBy(doc_id, "entity", "location", "negated")
        .agg(F.count("*").alias("n"))
    )


def _position(value: Column, names: Sequence[str]) -> Column:
    return F.array_position(literal_array(names), value).cast("int") - 1


def triplet_tensor(docs: DataFrame, counts: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document with its dense tensor, flattened: ``ARRAY<INT>`` of 1,080 cells.

    Cell ``x * 40 + y * 2 + z`` for entity x, location slot y and assertion z. Documents
    without findings keep zeros.
    """
    per_entity = len(vocab.TENSOR_LOCATIONS) * 2
    cell = (
        _position(F.col("entity"), vocab.TENSOR_ENTITIES) * per_entity
        + _position(F.col("location"), vocab.TENSOR_LOCATIONS) * 2
        + F.col("negated").cast("int")
    )
    filled = counts.groupBy(doc_id).agg(
        F.map_from_entries(F.collect_list(F.struct(cell, F.col("n").cast("int")))).alias("_cells")
    )
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(vocab.TENSOR_CELLS - 1)),
        lambda i: F.coalesce(F.try_element_at(F.col("_cells"), i), F.lit(0)),
    )
    return docs.select(doc_id).join(filled, doc_id, "left").select(doc_id, dense.alias("tensor"))
