"""Placement of documents in shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table. The shards
take turns, each claiming the first slot of its order that is still free, until the table is
full. So all shards hold nearly the same number of slots, and when a shard comes or goes most
slots stay where they are. A key's place is one lookup: hash to a slot, slot to a shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportweave.sources.tables import read_table

TABLE_SIZE = 65_537  # a prime; also the bound of what is broadcast
SHARDS = tuple(f"shard-{i:03d}" for i in range(256))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(shard: str, size: int) -> tuple[int, int]:
    """Offset and step of a shard's walk over the table; a prime size makes it reach all slots."""
    digest = hashlib.sha256(shard.encode()).digest()
    offset = int.from_bytes(digest[:8], "big") % size
    step = int.from_bytes(digest[8:16], "big") % (size - 1) + 1
    return offset, step


def fill_table(shards: Sequence[str] | Mapping[str, int], size: int = TABLE_SIZE) -> list[str]:
    """The shard of every slot. With a mapping, a shard claims ``weight`` slots per turn."""
    weights = dict(shards) if isinstance(shards, Mapping) else dict.fromkeys(shards, 1)
    if not weights or any(w < 1 for w in weights.values()):
        raise ValueError("at least one shard, and weights of 1 or more")
    if not _is_prime(size) or size < sum(weights.values()):
        raise ValueError("the table size must be a prime not below the sum of the weights")
    table: list[str | None] = [None] * size
    walks = {shard: list(preference(shard, size)) for shard in sorted(weights)}
    left = size
    while True:
        for shard, walk in walks.items():
            for _ in range(weights[shard]):
                while table[walk[0]] is not None:
                    walk[0] = (walk[0] + walk[1]) % size
                table[walk[0]] = shard
                left -= 1
                if not left:
                    return table  # type: ignore[return-value]


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key's text form; a null key has the slot of the empty text."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(size)).cast("int")


def place(
    rows: DataFrame,
    key: str = "doc_id",
    shards: Sequence[str] | Mapping[str, int] = SHARDS,
    size: int = TABLE_SIZE,
    slot: str = "slot",
    shard: str = "shard",
) -> DataFrame:
    """``rows`` with ``slot`` and ``shard``; columns of those names are replaced.

    A null key has a slot like any other; repeated rows share theirs and no rows give no rows.

    The lookup table has ``size`` rows whatever the input, and is broadcast: no row moves. Equal
    keys share a shard, so choose a key without hot values, such as the document's id.
    """
    filled = pd.DataFrame({"_slot": range(size), "_shard": fill_table(shards, size)})
    table = rows.sparkSession.createDataFrame(filled, "_slot int, _shard string")
    kept = [c for c in rows.columns if c not in (slot, shard)]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    joined = rows.select(whole, slot_of(F.col(key), size).alias("_slot")).join(F.broadcast(table), "_slot")
    return joined.select("row.*", F.col("_slot").alias(slot), F.col("_shard").alias(shard))


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 8, shard: str = "shard") -> None:
    """One folder per shard, each written by several tasks, so a large shard is no bottleneck."""
    spread = F.pmod(F.xxhash64("slot"), F.lit(files_per_shard))
    placed.repartition(F.col(shard), spread).write.mode("overwrite").partitionBy(shard).parquet(path)


def op2_sharding(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return place(docs, "doc_id")
