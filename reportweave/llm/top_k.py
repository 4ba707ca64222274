"""Exact top-k search by inner product, with a ball tree per shard.

Vectors are dealt to shards by a hash of their id, so hot vectors spread. A task sorts a shard's
vectors before the queries sent to it, builds the tree, and streams the queries through it in
blocks. Every query searches its own shard first; the kth score found there goes with it to all
other shards, where it prunes from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportweave.llm.ball_tree import BallTree
from reportweave.sources.stored import store
from reportweave.sources.tables import read_table

SHARD_ROWS = 8_192
QUERY_BLOCK = 512
_KEYS = ("dim", "shard")


def usable(vector: str) -> Column:
    """Neither null nor holding a null or a value that is not finite."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(fine(x), F.lit(False)))


def whole_numbers(vector: str, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component, in double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def _search(rows: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score`` from ``rows (dim, shard, asks, id, floor, v)``, asks last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        tree: BallTree | None = None
        for batch in batches:
            for key, asks, part in _parts(batch):
                if key != at:
                    at, held, tree = key, [], None
                ids = part.column("id").to_numpy()
                vectors = part.column("v").flatten().to_numpy().reshape(len(ids), key[0])
                if not asks:
                    held.append((ids, vectors))
                    continue
                if not held:
                    continue
                if tree is None:
                    tree = BallTree(
                        np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]), k + 1
                    )
                floor = part.column("floor").to_numpy()
                for a in range(0, len(ids), QUERY_BLOCK):
                    own = ids[a : a + QUERY_BLOCK]
                    found = tree.search(own, vectors[a : a + QUERY_BLOCK], k, floor[a : a + QUERY_BLOCK])
                    flat = [(int(q), i, s) for q, pairs in zip(own, found, strict=True) for s, i in pairs]
                    columns = list(zip(*flat, strict=True)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
                    )

    dealt = rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS, "asks", "id")
    return dealt.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], bool, pa.RecordBatch]]:
    """Runs of rows of one shard and one side."""
    if not batch.num_rows:
        return
    dim, shard, asks = (batch.column(c).to_numpy() for c in (*_KEYS, "asks"))
    changed = (dim[1:] != dim[:-1]) | (shard[1:] != shard[:-1]) | (asks[1:] != asks[:-1])
    cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
    for begin, stop in zip(cuts[:-1], cuts[1:], strict=True):
        yield (int(dim[begin]), int(shard[begin])), bool(asks[begin]), batch.slice(begin, stop - begin)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows for every query row.

    The score is the inner product of the scaled, floored components, a whole number; ties go to
    the smaller id. ``is_query`` is a condition on ``id``. Vectors that are null or hold null or
    not finite components take no part, nor do rows with a null id; vectors of different length
    are not compared. Of rows with one id, the one with the smallest vector counts. Scores beyond
    64 bits stay at the limit. With fewer than ``k`` other rows all come; no rows give no rows.
    """
    clean = vectors.where(F.col(id).isNotNull() & usable(vector)).select(
        F.col(id).cast("bigint").alias("id"), whole_numbers(vector, scale).alias("v"), is_query.alias("asks")
    )
    once = store(
        clean.groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
        .withColumn("dim", F.size("v")),
        "vectors",
    )
    sizes = store(
        once.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards")), "shards"
    )
    dealt = once.join(sizes, "dim").withColumn(
        "shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int")
    )
    low = F.lit(-(2**63)).cast("bigint")
    points = dealt.select("dim", "shard", F.lit(0).alias("asks"), "id", low.alias("floor"), "v")
    queries = dealt.where("asks")
    at_home = queries.select("dim", "shard", F.lit(1).alias("asks"), "id", low.alias("floor"), "v")
    home = store(_search(points.unionByName(at_home), k), "home-results")

    kth = home.groupBy(F.col("query_id").alias("id")).agg(
        F.when(F.count("*") >= k, F.min("score")).alias("floor")
    )
    others = queries.select("dim", F.col("shard").alias("home"), "shards", "id", "v").join(kth, "id", "left")
    sent = others.select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(1).alias("asks"),
        "id", F.coalesce("floor", low).alias("floor"), "v", "home",
    ).where("shard <> home").drop("home")
    away = _search(points.unionByName(sent), k)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        home.unionByName(away).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op6_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(read_table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5"""
