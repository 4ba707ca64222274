"""Mentions against negation spans, both as long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 256


def _blocks(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / BLOCK), F.floor(end / BLOCK)))


def mention_negation(
    mentions: DataFrame, spans: DataFrame, closed: bool = True, doc_id: str = "doc_id"
) -> DataFrame:
    """Mentions with ``negated`` from the first overlapping span in span order.

    ``mentions``: ``doc_id, ent_pos, start, end, ...``; ``spans``: ``doc_id, neg_pos,
    entity_group, start, end``. The first overlap decides, also when it says "asserted"; none
    means not negated. Spans that touch overlap, unless ``closed`` is off.

    Both sides are cut into blocks of 256 characters and joined on document and block, so a
    mention meets the spans near it and never all spans of a long document.
    """
    op = (lambda a, b: a <= b) if closed else (lambda a, b: a < b)
    left = mentions.drop("negated")
    carried = [c for c in left.columns if c not in (doc_id, "ent_pos")]
    left = left.withColumn("_block", _blocks(F.col("start"), F.col("end")))
    right = spans.select(
        doc_id,
        "neg_pos",
        F.col("entity_group").alias("_group"),
        F.col("start").alias("_start"),
        F.col("end").alias("_end"),
    ).withColumn("_block", _blocks(F.col("_start"), F.col("_end")))
    overlap = op(F.col("l.start"), F.col("r._end")) & op(F.col("r._start"), F.col("l.end"))
    same_block = (F.col(f"l.{doc_id}") == F.col(f"r.{doc_id}")) & (
        F.col("l._block") == F.col("r._block")
    )
    met = left.alias("l").join(right.alias("r"), same_block & overlap, "left").select(
        "l.*", F.col("r.neg_pos"), F.col("r._group")
    )
    # A mention over two blocks comes twice; without a span there its position is null.
    return met.groupBy(doc_id, "ent_pos").agg(
        *[F.first(c).alias(c) for c in carried],
        F.coalesce(F.min_by("_group", "neg_pos") == "negated", F.lit(False)).alias("negated"),
    )


def overlapping_pairs(mentions: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Neighbouring mentions that overlap; an empty result means the spans are disjoint."""
    by_start = Window.partitionBy(doc_id).orderBy("start", "end")
    furthest = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    return mentions.withColumn("previous_end", furthest).where(
        F.col("previous_end") > F.col("start")
    )
