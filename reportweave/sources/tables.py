"""Parquet tables (the stored form of every data set here)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_locally(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores in a session on one machine; on a cluster ``df`` as it is.

    Test files have one row group, which one task reads. On a cluster tables have row groups
    enough, and no text is moved for this.
    """
    context = df.sparkSession.sparkContext
    if not context.master.startswith("local["):
        return df
    return df.repartition(2 * context.defaultParallelism)


def save_dataset(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def load_dataset(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
