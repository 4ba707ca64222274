"""Exact deduplication against a persistent index of digests.

The index is a table bucketed and sorted by digest. Every delivery of documents is reduced to
one row per digest, matched with the index by a sort-merge anti-join, and what is new is
appended. Deliveries therefore never move the index: only the delivery's digests are shuffled,
into the index's own buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportweave.sources.stored import store
from reportweave.sources.tables import read_table

INDEX_BUCKETS = 32


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the text in UTF-8, lowercase hex; a null text counts as empty."""
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


class DigestIndex:
    """Digests seen so far, each with the id of the row that stays.

    ``name`` is a table of the session's catalog, so it lives in the warehouse folder that all
    machines share. A new name starts an empty index.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int = INDEX_BUCKETS) -> None:
        self.spark, self.name, self.buckets = spark, name, buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        """``digest, keep_id``."""
        return self.spark.table(self.name)

    def append(self, rows: DataFrame) -> None:
        (
            rows.select("digest", "keep_id")
            .repartition(self.buckets, "digest")
            .write.mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )

    def deliver(self, digests: DataFrame) -> None:
        """Takes a delivery (``id, digest``) in: of equal new digests the largest id stays.

        A digest that the index already holds keeps its earlier row. A delivery that was taken
        in before changes nothing, so a failed job can be run again.
        """
        firsts = digests.groupBy("digest").agg(F.max("id").alias("keep_id"))
        if self.exists():
            firsts = firsts.hint("merge").join(self.read().hint("merge"), "digest", "left_anti")
            firsts = store(firsts, "new-digests")  # a table cannot be read while it is written
        self.append(firsts)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def digests_of(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(id).alias("id"), text_digest(text).alias("digest"))


def deduplicate(
    docs: DataFrame, id: str = "doc_id", text: str = "text", buckets: int = INDEX_BUCKETS
) -> DataFrame:
    """``id, digest, keep_id, group_size, kept`` for every row of ``docs``.

    Of rows with equal texts the one with the largest id stays. The rows go through a new index
    in two deliveries, larger ids first, as a corpus that grows would. Null ids come last: one
    is kept only where no equal text has an id. Rows that repeat an id and its text are all
    marked as kept, since they are the same document. No rows give no rows.
    """
    spark = docs.sparkSession
    digests = store(digests_of(docs, id, text), "digests")
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}", buckets)
    middle = digests.agg(((F.min("id") + F.max("id")) / 2).cast("bigint")).scalar()
    later = F.coalesce(F.col("id") > middle, F.lit(False))
    index.deliver(digests.where(later))
    index.deliver(digests.where(~later))
    sizes = digests.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = store(sizes.join(index.read(), "digest"), "digest-groups")
    index.drop()
    # Both sides are plain shuffles, so that a digest with many rows can be split.
    return digests.join(groups, "digest").select(
        "id",
        "digest",
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
    )


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns; rows that repeat an id and its text stay once.

    A document is its id and its text: rows that share an id, or have none, stay for every text
    that ``deduplicate`` keeps of them.
    """
    # One key that is never null: repeats go before the shuffle, and the join uses that same shuffle.
    document = lambda i, digest: F.concat_ws(":", digest, i.cast("string")).alias("document")
    kept = deduplicate(docs, id, text).where("kept").select(document(F.col("id"), F.col("digest"))).distinct()
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        document(F.col(id), text_digest(text)),
    )
    return own.dropDuplicates(["document"]).join(kept, "document", "left_semi").select("row.*")


def op4_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return deduplicate(read_table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.col("digest").alias("text_sha256"),
    )


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
