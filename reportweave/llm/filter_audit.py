"""Audit of how filters interact when they are applied one after another in any order.

A document's outcome in every order follows from its mask alone: the set of filters it fails.
Spark counts documents by part and mask, so what is left to combine is small: a mask matrix
(masks by filters, 0 where the mask fails a filter and infinite elsewhere) and a position matrix
(orders by filters, the inverse of each order as a permutation). Their min-plus product is the
step at which a mask goes in an order. Counts per step are scattered by it with the weights of
the masks, and a failed filter placed after it is redundant.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportweave.sources.tables import read_table

MAX_FILTERS = 6  # 720 orders and 64 masks; the work grows with the factorial

BLANKS = "\t\n\v\f\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
MARKS = "[#$%&*|]"


def mask_matrix(filters: int) -> np.ndarray:
    """Masks by filters: 0 where bit f of the mask is set (the filter fails), else infinite."""
    bits = (np.arange(2**filters)[:, None] >> np.arange(filters)) & 1
    return np.where(bits == 1, 0.0, np.inf)


def orders_of(filters: int) -> np.ndarray:
    """All orders as rows of filter numbers."""
    return np.array(list(permutations(range(filters))), int)


def removal_steps(masks: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Masks by orders: the step (from 0) at which a mask is removed, infinite if it stays.

    The min-plus product of the mask matrix with the inverse permutations of the orders.
    """
    positions = np.argsort(orders, axis=1)
    return (masks[:, None, :] + positions[None, :, :]).min(axis=2)


def step_counts(weights: np.ndarray, names: str) -> dict[str, np.ndarray]:
    """Counts by part, order and step from ``weights`` (counters, parts, masks).

    Every counter gets ``removed``; the first one (documents) also gets the others.
    """
    filters = len(names)
    masks, orders = mask_matrix(filters), orders_of(filters)
    steps = removal_steps(masks, orders)
    fails = np.isfinite(masks)
    counters, parts, _ = weights.shape
    removed = np.zeros((counters, parts, len(orders), filters), np.int64)
    redundant = np.zeros((parts, len(orders), filters), np.int64)
    for order, row in enumerate(orders):
        step = steps[:, order]
        gone = np.flatnonzero(np.isfinite(step))
        scattered = removed[:, :, order, :]
        np.add.at(scattered, (slice(None), slice(None), step[gone].astype(int)), weights[:, :, gone])
        for at, name in enumerate(row):
            redundant[:, order, at] = weights[0][:, fails[:, name] & (step < at)].sum(axis=1)
    shares = np.zeros((parts, filters), np.int64)
    np.add.at(shares, (slice(None), orders), removed[0])
    only = weights[0][:, 1 << orders]
    kept = weights[0].sum(axis=1)[:, None, None] - removed[0].cumsum(axis=2)
    return {
        "kept": kept, "removed": removed[0], "redundant": redundant, "unique_fails": only,
        "lost": removed[1:], "shapley": shares[:, orders],
    }


def audit_filters(
    docs: DataFrame, part: Column, failures: Mapping[str, Column], losses: Mapping[str, Column]
) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails``, a count per loss, ``shapley``.

    ``failures`` names the filters, one letter each, and says which documents fail them (null:
    passes); ``losses`` names counters of removed documents and says which count. One row per
    part, order of the letters and step from 1, zeros included. A null part counts as the empty
    string. Documents are counted by part and mask before the shuffle, so a part may hold any
    share of them; the numbers then made per part do not grow with the documents. Repeated rows
    count each; no rows give no rows; other columns are ignored.
    """
    names = "".join(failures)
    if len(names) != len(failures) or not 1 <= len(names) <= MAX_FILTERS:
        raise ValueError(f"filters must be 1 to {MAX_FILTERS} single letters, not {list(failures)}")
    mask = sum(
        (F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(failures.values())), F.lit(0)
    )
    cells = docs.select(
        F.coalesce(part, F.lit("")).alias("part"), mask.alias("mask"),
        *[F.when(counts, 1).otherwise(0).alias(f"loss{i}") for i, counts in enumerate(losses.values())],
    ).groupBy("part", "mask").agg(
        F.count("*").alias("n"), *[F.sum(f"loss{i}").alias(f"loss{i}") for i in range(len(losses))]
    )
    counters = ["n", *[f"loss{i}" for i in range(len(losses))]]
    of_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *counters)).alias("cells"))

    lost = list(losses)
    columns = ["kept", "removed", "redundant", "unique_fails", *lost, "shapley"]
    letters = np.array(["".join(names[i] for i in row) for row in orders_of(len(names))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_part = len(letters) * len(names)
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                weights = np.zeros((len(counters), batch.num_rows, 2 ** len(names)), np.int64)
                found = batch["cells"]
                row = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy())
                inner = found.flatten()
                masks = inner.field("mask").to_numpy()
                for i, counter in enumerate(counters):
                    weights[i, row, masks] = inner.field(counter).to_numpy()
                counts = step_counts(weights, names)
                counts |= dict(zip(lost, counts.pop("lost"), strict=True))
                frame = pd.DataFrame({
                    "part": np.repeat(np.array(batch["part"].to_pylist(), object), per_part),
                    "filter_order": np.tile(np.repeat(letters, len(names)), batch.num_rows),
                    "step": np.tile(np.arange(1, len(names) + 1, dtype=np.int32), batch.num_rows * len(letters)),
                    **{c: counts[c].reshape(-1) for c in columns},
                })
                yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    kinds = ", ".join(f"`{c}` bigint" for c in columns)
    return of_part.mapInArrow(count, f"part string, filter_order string, step int, {kinds}")


def quality_failures(
    docs: DataFrame, id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``id``, the struct ``carry`` of those columns and booleans ``A`` to ``E`` for every row.

    A: under 50 words; B: under 65 percent of the words distinct; C: over 5 percent capital A-Z;
    D: a mark of ``#$%&*|``; E: the text of a smaller id. A null text is empty: it fails A, and E
    where a smaller id has an empty or null text. A row without an id has no smaller one and
    passes E; rows that repeat an id are not copies of each other. Texts are read whole. Equal
    texts meet as digests: the smallest id of a digest is a pre-aggregated minimum, and each row
    looks for its own pair of digest and id, which the copies of a hot text do not share.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(body.cast("binary"), 256).alias("digest")
    words = F.array_remove(F.split(F.translate(body, BLANKS, " " * len(BLANKS)), " "), "")
    capitals = F.length(body) - F.length(F.translate(body, CAPITALS, ""))
    number, distinct = F.size("words").cast("bigint"), F.size(F.array_distinct("words")).cast("bigint")
    rows = docs.select(
        F.col(id).alias("id"), F.struct(*[F.col(c) for c in carry]).alias("carry"), digest,
        words.alias("words"), capitals.cast("bigint").alias("capitals"),
        F.length(body).cast("bigint").alias("size"), body.rlike(MARKS).alias("D"),
    ).select(
        "id", "carry", "digest", (number < MIN_WORDS).alias("A"),
        (100 * distinct < DISTINCT_PERCENT * number).alias("B"),
        (100 * F.col("capitals") > CAPITAL_PERCENT * F.col("size")).alias("C"), "D",
    )
    firsts = docs.select(F.col(id).alias("id"), digest).groupBy("digest").agg(F.min("id").alias("id"))
    found = rows.join(firsts.withColumn("first", F.lit(True)), ["digest", "id"], "left")
    copied = F.col("id").isNotNull() & F.col("first").isNull()
    return found.select("id", "carry", "A", "B", "C", "D", copied.alias("E"))


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "source", "text")
    labels = read_table(spark, sf, "labels").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    checked = quality_failures(docs, carry=("source",))
    labelled = checked.join(labels.withColumnRenamed("doc_id", "id"), "id", "left")
    return audit_filters(
        labelled,
        F.col("carry.source"),
        {name: F.col(name) for name in "ABCDE"},
        {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")},
    )


SQL = """
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), f AS (
  SELECT part,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f
      WHEN 'A' THEN len(words) < 50
      WHEN 'B' THEN 100 * len(list_distinct(words)) < 65 * len(words)
      WHEN 'C' THEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text)
      WHEN 'D' THEN regexp_matches(text, '[#$%&*|]')
      ELSE coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) END) AS fails,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) IS TRUE AS good,
    doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) IS TRUE AS toxic
  FROM w
), g AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, substr(o, s, 1) AS letter, n, good, toxic,
         fails, len(list_filter(fails, lambda f: instr(o, f) < s)) AS before
  FROM g, orders, range(1, 6) AS r(s)
), counted AS (
  SELECT part, filter_order, step, letter,
    sum(n) FILTER (before = 0 AND NOT list_contains(fails, letter)) AS kept,
    sum(n) FILTER (before = 0 AND list_contains(fails, letter)) AS removed,
    sum(n) FILTER (before > 0 AND list_contains(fails, letter)) AS redundant,
    sum(n) FILTER (fails = [letter]) AS unique_fails,
    sum(good) FILTER (before = 0 AND list_contains(fails, letter)) AS good_lost,
    sum(toxic) FILTER (before = 0 AND list_contains(fails, letter)) AS toxic_lost
  FROM steps GROUP BY ALL
)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
  CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, letter), 0) AS BIGINT) AS shapley
FROM counted"""
