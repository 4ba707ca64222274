"""JSON lines, JSON metrics and pattern files."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines that are no JSON come back in ``_corrupt_record``."""
    return (
        spark.read.schema(f"{schema}, _corrupt_record string")
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
        .json(path)
    )


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metric rows as JSON; a score table is a few rows, so one file."""
    metrics.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_errors(errors: DataFrame, path: str) -> None:
    """Error rows in one folder per label and kind."""
    errors.write.mode("overwrite").partitionBy("label", "kind").json(path)


def read_patterns(spark: SparkSession, path: str) -> dict[str, Sequence[dict]]:
    """Dependency patterns by name. The file shapes the plan, so it is read on the driver."""
    return json.loads(spark.read.text(path, wholetext=True).head()[0])
