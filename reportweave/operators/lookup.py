"""Lookup joins that stay even when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportweave.functions.labels import sql_text

HOT_KEYS = 10_000
MAX_VALUES = 100_000


def phrase_table(spark: SparkSession, phrases: Mapping[str, str]) -> DataFrame:
    """``phrase, label`` from a short literal list; its size is known to the optimizer."""
    rows = [
        f"named_struct('phrase', {sql_text(p)}, 'label', {sql_text(label)})"
        for p, label in phrases.items()
    ]
    return spark.range(1).select(F.expr(f"inline(array({', '.join(rows)}))"))


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the matching row of ``table`` (unique on ``keys``); others are dropped.

    A plain join: Spark broadcasts a table below its own threshold, also one that only turns out
    small at run time, and splits the partition of a frequent key in a larger join.
    """
    return rows.join(table, list(keys))


def heaviest(table: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """The rows of the 10,000 heaviest keys, few enough to broadcast."""
    return table.orderBy(F.col(weight).desc(), *keys).limit(HOT_KEYS)


def weighted_lookup(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str
) -> DataFrame:
    """``rows`` with the values of ``table`` (unique on ``keys``), null where there is no match.

    ``weight`` says how often a key is expected. The 10,000 heaviest keys are broadcast, a
    fixed bound; the other keys are joined by a shuffle. Rows settled by the broadcast carry a
    spreading number, match nothing in the second join and land on all partitions evenly.
    """
    values = [c for c in table.columns if c not in keys and c != weight]
    hot = heaviest(table, keys, weight).select(*keys, F.struct(*values).alias("_hot"))
    cold = table.select(*keys, F.struct(*values).alias("_cold"), F.lit(0).alias("_spread"))
    marked = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_spread",
        F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(*rows.columns), F.lit(100_000)).cast("int") + 1
        ),
    )
    joined = marked.join(cold, [*keys, "_spread"], "left")
    return joined.select(
        *rows.columns, F.coalesce(F.col("_hot"), F.col("_cold")).alias("_value")
    ).select(*rows.columns, "_value.*")


def bounded_values(df: DataFrame, column: str, limit: int = MAX_VALUES) -> Column:
    """The distinct values of a column, sorted, as one scalar array; nulls are none.

    For classes, tags and other columns with few values. More than ``limit`` are an error that
    names the column, raised before they are gathered in one place.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    problem = F.raise_error(F.lit(f"column {column} has more than {limit} values"))
    return values.limit(limit + 1).agg(F.array_sort(F.collect_list("value")).alias("v")).select(
        F.when(F.size("v") > limit, problem.cast(f"array<{df.schema[column].dataType.simpleString()}>")).otherwise(F.col("v"))
    ).scalar()
