"""Annotation of a stream of reports.

Annotation and counting are row-local, so the batch functions run on a stream unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from reportweave.functions.entities import NegationRules
from reportweave.operators.annotation import assertions
from reportweave.operators.counts import domain_counts_wide


def read_report_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def domain_count_stream(
    reports: DataFrame, phrases: Mapping[str, str], rules: NegationRules, text: str = "text"
) -> DataFrame:
    return domain_counts_wide(assertions(reports, phrases, rules, text))


def write_stream(df: DataFrame, path: str, checkpoint: str):
    """Parquet files, each input row exactly once; started for what is there, then stopped."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
