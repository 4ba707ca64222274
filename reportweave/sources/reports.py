"""Report tables in CSV."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportweave.functions.text import missing_tokens_to_null
from reportweave.sources.schemas import REPORT_TYPES

_QUOTING = {"header": True, "multiLine": True, "escape": '"', "quote": '"'}


def read_reports(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    types: Mapping[str, str] = REPORT_TYPES,
    index: str | None = None,
) -> DataFrame:
    """Columns of a report file by name, typed, with missing-value words as null.

    Only the header is read to find the names; no pass infers types. Cells that do not fit
    their type become null. ``index`` renames the first, unnamed column and keeps it.
    """
    raw = spark.read.options(**_QUOTING).csv(path)
    if index is not None:
        raw = raw.withColumnRenamed(raw.columns[0], index)
    wanted = list(columns or raw.columns)
    if index is not None and index not in wanted:
        wanted = [index, *wanted]
    missing = [c for c in wanted if c not in raw.columns]
    if missing:
        raise ValueError(f"columns not in {path}: {missing}")

    def typed(name: str):
        value = missing_tokens_to_null(F.col(f"`{name}`"))
        return (value.try_cast(types[name]) if name in types else value).alias(name)

    return raw.select(*[typed(c) for c in wanted])


def land_reports(reports: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """Store reports as parquet, once, with a document id.

    CSV with line breaks in cells cannot be split, parquet can; the id is fixed by storing it.
    """
    if doc_id not in reports.columns:
        reports = reports.withColumn(doc_id, F.monotonically_increasing_id())
    reports.write.mode("overwrite").parquet(path)


def write_reports(df: DataFrame, path: str, split: str | None = None) -> None:
    """CSV with header; one folder per split when a split column is named."""
    writer = df.write.mode("overwrite").options(
        header=True,
        escape='"',
        quote='"',
        # Spark would trim blanks at the ends of a cell.
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    (writer.partitionBy(split) if split else writer).csv(path)


def read_split(
    spark: SparkSession, path: str, split: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One part of a table written with a split column."""
    return read_reports(spark, f"{path}/split={split}", columns)
