"""Exact, repeatable samples and splits.

Rows are ordered by a digest of seed and id. The digest is uniform, so the first hex digits
cut every group into up to 65,536 even buckets. Counting rows per bucket (a small table, summed
before the shuffle) tells which buckets hold the wanted ranks. Rows are joined and ranked by
group and bucket, never by group alone, so no group, however large, meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportweave.functions import keys

DRAW_BLOCK = 10_000  # draws that one task makes at a time


def _keyed(df: DataFrame, ids: Sequence[str], seed: int | str, key_of: Sequence[str]) -> DataFrame:
    return df.withColumn("_key", keys.sample_key(seed, *[F.col(c) for c in key_of])).withColumn(
        "_bucket", keys.key_bucket(F.col("_key"))
    )


def _bucket_counts(keyed: DataFrame, groups: Sequence[str]) -> DataFrame:
    """``groups, _bucket, _n, _before, _total``: at most 65,536 rows per group."""
    counts = keyed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*groups)
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("bigint"))
    ).withColumn("_total", F.sum("_n").over(group))


def _join_buckets(keyed: DataFrame, wanted: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows of ``keyed`` in the buckets of ``wanted``; a null group is a group as well."""
    names = [*groups, "_bucket"]
    other = wanted.select(
        *[F.col(c).alias(f"_w_{i}") for i, c in enumerate(names)],
        *[c for c in wanted.columns if c not in names],
    )
    same = F.lit(True)
    for i, c in enumerate(names):
        same = same & F.col(c).eqNullSafe(F.col(f"_w_{i}"))
    return keyed.join(other, same).drop(*[f"_w_{i}" for i in range(len(names))])


# ---------------------------------------------------------------- samples per group


def stratified_sample(
    df: DataFrame,
    by: Sequence[str],
    n: int,
    ids: Sequence[str],
    seed: int | str,
    on_short: str = "error",
    key_of: Sequence[str] | None = None,
) -> DataFrame:
    """``n`` rows of every group, without replacement; with equal ids still exactly ``n``.

    A group with fewer rows is an error, or is taken whole with ``on_short='take_all'``. Rows
    without a group form a group.
    """
    keyed = _keyed(df, ids, seed, key_of or ids)
    counts = _bucket_counts(keyed, by)
    if on_short == "error":
        problem = F.raise_error(
            F.concat(F.lit("group with too few rows: "), F.concat_ws(",", *by))
        ).cast("bigint")
        counts = counts.withColumn("_n", F.when(F.col("_total") < n, problem).otherwise(F.col("_n")))
    wanted = counts.where((F.col("_before") < n) & (F.col("_n") > 0)).select(
        *by, "_bucket", (F.lit(n) - F.col("_before")).alias("_need")
    )
    order = Window.partitionBy(*by, "_bucket").orderBy("_key", *ids)
    return (
        _join_buckets(keyed, wanted, by)
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= F.col("_need"))
        .drop("_key", "_bucket", "_need", "_rank")
    )


def bootstrap_sample(
    df: DataFrame,
    by: Sequence[str],
    n: int,
    ids: Sequence[str],
    seed: int | str,
) -> DataFrame:
    """``n`` draws from every group, with replacement; adds ``draw`` (0 to n-1).

    A draw picks a rank of its group. Draws are made in blocks spread over the tasks; a rank is
    found in the bucket counts by a join on blocks of ranks, then only rows of drawn buckets are
    ranked and joined. No draws (``n`` = 0) give no rows.
    """
    if n == 0:
        return df.where(F.lit(False)).withColumn("draw", F.lit(0).cast("bigint"))
    keyed = _keyed(df, ids, seed, ids)
    counts = _bucket_counts(keyed, by)
    width = F.greatest(F.ceil(F.col("_total") / keys.BUCKETS), F.lit(1)).cast("bigint")
    blocks = counts.withColumn(
        "_block",
        F.explode(
            F.sequence(
                F.floor(F.col("_before") / width),
                F.floor((F.col("_before") + F.col("_n") - 1) / width),
            )
        ),
    )
    draw_key = keys.sample_key(f"draw:{seed}", *[F.col(c) for c in by], F.col("draw"))
    first = F.explode(F.sequence(F.lit(0), F.lit(n - 1), F.lit(DRAW_BLOCK)))
    last = F.least(F.col("_first") + DRAW_BLOCK - 1, F.lit(n - 1))
    totals = counts.groupBy(*by).agg(F.max("_total").alias("_total"))
    draws = (
        totals.withColumn("_first", first)
        .repartition(*by, "_first")
        .withColumn("draw", F.explode(F.sequence(F.col("_first"), last)))
        .withColumn("draw", F.col("draw").cast("bigint"))
        .withColumn("_slot", F.pmod(keys.key_number(draw_key), F.col("_total")))
        .withColumn("_block", F.floor(F.col("_slot") / width))
        .drop("_total", "_first")
        .withColumnsRenamed({c: f"_d_{i}" for i, c in enumerate(by)} | {"_block": "_d_block"})
    )
    same = F.col("_block") == F.col("_d_block")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_d_{i}"))
    located = (
        draws.join(blocks, same)
        .where(
            (F.col("_slot") >= F.col("_before"))
            & (F.col("_slot") < F.col("_before") + F.col("_n"))
        )
        .select(*by, "_bucket", "draw", (F.col("_slot") - F.col("_before") + 1).alias("_at"))
    )
    order = Window.partitionBy(*by, "_bucket").orderBy("_key", *ids)
    drawn = located.select(*by, "_bucket").distinct()
    ranked = _join_buckets(keyed, drawn, by).withColumn(
        "_rank", F.row_number().over(order).cast("bigint")
    )
    found = _join_buckets(ranked, located.withColumnRenamed("_at", "_wanted_rank"), by)
    return found.where(F.col("_rank") == F.col("_wanted_rank")).drop(
        "_key", "_bucket", "_rank", "_wanted_rank"
    )


def even_domain_sample(
    df: DataFrame,
    counts: dict[str, str],
    quota: int,
    ids: Sequence[str],
    seed: int | str,
) -> DataFrame:
    """Up to ``quota`` rows for every domain whose count column is above 0; adds ``domain``.

    ``counts``: domain to count column. A row may come back once per domain it holds.
    """
    present = F.filter(
        F.array(
            *[
                F.when(F.col(column) > 0, F.lit(domain))
                for domain, column in counts.items()
            ]
        ),
        lambda d: d.isNotNull(),
    )
    long = df.withColumn("domain", F.explode(present))
    return stratified_sample(
        long, ["domain"], quota, ids, seed, on_short="take_all", key_of=["domain", *ids]
    )


# ---------------------------------------------------------------- samples of a whole table


def simple_sample(df: DataFrame, n: int, ids: Sequence[str], seed: int | str) -> DataFrame:
    """``n`` rows of the table, without replacement; the whole table if it has fewer.

    With equal ids still exactly ``n``. At most 65,536 bucket numbers are broadcast, so that
    rows outside the sample do not move.
    """
    keyed = _keyed(df, ids, seed, ids)
    counts = _bucket_counts(keyed.select("_bucket").withColumn("_all", F.lit(0)), ["_all"])
    wanted = counts.where(F.col("_before") < n).select(
        "_bucket", (F.lit(n) - F.col("_before")).alias("_need")
    )
    order = Window.partitionBy("_bucket").orderBy("_key", *ids)
    return (
        keyed.join(F.broadcast(wanted), "_bucket")
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= F.col("_need"))
        .drop("_key", "_bucket", "_need", "_rank")
    )


def simple_bootstrap(df: DataFrame, n: int, ids: Sequence[str], seed: int | str) -> DataFrame:
    """``n`` draws from the whole table, with replacement; adds ``draw``."""
    return bootstrap_sample(df.withColumn("_all", F.lit(0)), ["_all"], n, ids, seed).drop("_all")


def shuffle_rows(df: DataFrame, ids: Sequence[str], seed: int | str) -> DataFrame:
    """Rows in random but repeatable order (a range-partitioned sort)."""
    return df.orderBy(keys.sample_key(seed, *[F.col(c) for c in ids]), *ids)


# ---------------------------------------------------------------- exact splits


def _key_at_ranks(df: DataFrame, ids: Sequence[str], seed: int | str, ranks) -> Column:
    """Scalar array with the ``(key, ids)`` of the rows at given ranks; rank 0 gives null."""
    keyed = _keyed(df.select(*ids), ids, seed, ids)
    counts = _bucket_counts(keyed.withColumn("_all", F.lit(0)), ["_all"])
    wanted = F.posexplode(F.array(*[r.cast("bigint") for r in ranks(F.col("_total"))]))
    cuts = (
        counts.select("_bucket", "_before", "_n", wanted.alias("_cut", "_at"))
        .where((F.col("_before") < F.col("_at")) & (F.col("_at") <= F.col("_before") + F.col("_n")))
        .select("_cut", "_bucket", (F.col("_at") - F.col("_before")).alias("_need"))
    )
    order = Window.partitionBy("_cut", "_bucket").orderBy("_key", *ids)
    # One row per cut point: the broadcast has as many rows as the split has borders.
    rows = (
        keyed.join(F.broadcast(cuts), "_bucket")
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == F.col("_need"))
        .agg(F.map_from_entries(F.collect_list(F.struct("_cut", F.struct("_key", *ids)))).alias("m"))
    )
    n_cuts = len(ranks(F.lit(0)))
    return rows.select(
        F.array(*[F.try_element_at("m", F.lit(k)) for k in range(n_cuts)])
    ).scalar()


def exact_split(
    df: DataFrame,
    ids: Sequence[str],
    seed: int | str,
    test_size: float = 0.2,
    dev_share: float = 0.5,
    out: str = "split",
) -> DataFrame:
    """Adds ``split``: train, dev or test, in exact sizes.

    The held-out part has ``ceil(test_size * n)`` rows, of which ``ceil(dev_share * m)`` are
    test. With ``dev_share=1`` there is no dev part (a plain two-way split). Rows with equal ids
    fall on one side together, so the sizes are exact for unique ids only.
    """

    def borders(total: Column) -> list[Column]:
        held_out = F.ceil(F.lit(float(test_size)) * total)
        test = F.ceil(F.lit(float(dev_share)) * held_out)
        return [total - held_out, total - test]

    cut = _key_at_ranks(df, ids, seed, borders)
    row = F.struct(keys.sample_key(seed, *[F.col(c) for c in ids]).alias("_key"), *ids)
    inside = lambda k: F.coalesce(row <= F.get(cut, F.lit(k)), F.lit(False))
    return df.withColumn(
        out, F.when(inside(0), "train").when(inside(1), "dev").otherwise("test")
    )


# ---------------------------------------------------------------- strata


def grid_strata(df: DataFrame, x: str, y: str, width: float, out: str = "cell") -> DataFrame:
    """Grid cell of a 2-D position."""
    cell = lambda c: F.floor(F.col(c) / F.lit(float(width))).cast("string")
    return df.withColumn(out, F.concat_ws(":", cell(x), cell(y)))


def cluster_strata(
    df: DataFrame,
    x: str,
    y: str,
    k: int = 100,
    seed: int = 42,
    on_missing: str = "error",
    out: str = "cluster_id",
) -> DataFrame:
    """KMeans cluster of a 2-D position. Missing positions are an error or are left out."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    handle = "skip" if on_missing == "skip" else "error"
    assembler = VectorAssembler(inputCols=[x, y], outputCol="_position", handleInvalid=handle)
    placed = assembler.transform(df)
    model = KMeans(k=k, seed=seed, featuresCol="_position", predictionCol=out).fit(
        placed.select("_position")
    )
    return model.transform(placed).drop("_position")
