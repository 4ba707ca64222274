"""Long tables from nested columns: one row per token or per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportweave.functions import text as tx


def token_table(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, i, tok, start, end`` — written row by row, without a shuffle."""
    return df.select(doc_id, F.posexplode(tx.tokens(F.col(text))).alias("i", "t")).select(
        doc_id,
        F.col("i").cast("bigint").alias("i"),
        F.col("t.tok").alias("tok"),
        F.col("t.start").cast("bigint").alias("start"),
        F.col("t.end").cast("bigint").alias("end"),
    )


def mention_table(df: DataFrame, ents: str = "ents", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, ent_pos, entity_group, score, word, start, end, negated, tok_start, tok_end``."""
    return df.select(doc_id, F.posexplode(ents).alias("ent_pos", "e")).select(
        doc_id,
        F.col("ent_pos").cast("bigint").alias("ent_pos"),
        "e.entity_group",
        "e.score",
        "e.word",
        F.col("e.start").cast("bigint").alias("start"),
        F.col("e.end").cast("bigint").alias("end"),
        "e.negated",
        F.col("e.tok_start").cast("bigint").alias("tok_start"),
        F.col("e.tok_end").cast("bigint").alias("tok_end"),
    )
