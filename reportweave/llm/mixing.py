"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells (one per combination of source, language and topic). The token
weights of the cells are raked to the target share of every source, language and topic in turn,
never above what a cell holds. A document is kept with the probability that its cell keeps of its
tokens, decided by a digest of its id, so the sample is the same on every run.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reportweave.functions import keys
from reportweave.sources.stored import store
from reportweave.sources.tables import read_table

MAX_CELLS = 100_000  # more combinations are an error; the cells can be broadcast
ROUNDS = 12
BUDGET = 0.6  # share of all tokens to keep
SEED = "mix-1"

# Production targets: exponents below 1 flatten the natural shares of a dimension.
FLATTEN = {"source": 0.7, "lang": 0.8, "topic": 0.9}

_TABLE, _LIST = " | ", "\n- "


def token_count(text: Column) -> Column:
    """Words between ASCII blanks; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("bigint")


def topic_of(text: Column) -> Column:
    """Coarse topic by the form of a text: tables, lists, much shouting, or prose."""
    return (
        F.when(F.contains(text, F.lit(_TABLE)), "table")
        .when(F.contains(text, F.lit(_LIST)), "list")
        .when(F.contains(text, F.lit("!!")), "shout")
        .otherwise("prose")
    )


def _checked(cells: DataFrame, limit: int) -> DataFrame:
    size = cells.agg(F.count("*")).scalar()
    message = F.lit(f"more than {limit} combinations of source, language and topic")
    return cells.where(F.when(size > limit, F.raise_error(message).cast("boolean")).otherwise(True))


def rake(
    cells: DataFrame,
    targets: Mapping[str, float | Mapping[str, float]],
    budget: float = BUDGET,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``cells`` with ``probability``: the share of each cell's ``tokens`` to keep.

    ``targets`` gives for each dimension column an exponent of its natural shares, or the wanted
    shares by value; values not named share the rest in their natural proportion. ``budget`` is
    the share of all tokens to keep. Weights start at the natural amounts and are raked to one
    dimension after the other, at most to what a cell holds: where a target asks for more than
    there is, all of it is kept. Cells without tokens get ``budget`` itself.
    """
    total = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    wanted = cells
    for dim, target in targets.items():
        sums = cells.groupBy(dim).agg(F.sum("tokens").alias("_sum"))
        everything = Window.partitionBy(F.lit(0))
        if isinstance(target, Mapping):
            named = F.create_map(*[F.lit(x) for item in target.items() for x in item])
            share = F.try_element_at(named, F.col(dim))
            rest = F.sum(F.when(share.isNull(), F.col("_sum"))).over(everything)
            share = F.coalesce(share, F.lit(1 - sum(target.values())) * F.col("_sum") / rest)
        else:
            power = F.pow(F.col("_sum").cast("double"), F.lit(float(target)))
            share = F.when(F.col("_sum") > 0, power).otherwise(0.0)
        share = share / F.sum(share).over(everything)
        shares = sums.withColumn("_share", share).select(
            F.col(dim), F.col("_share").alias(f"_share_{dim}")
        )
        wanted = wanted.join(F.broadcast(shares), dim)
    wanted = store(
        wanted.withColumn("_all", total * F.lit(budget)).withColumn(
            "_weight", F.col("tokens") * F.lit(float(budget))
        ),
        "mix-cells",
    )
    raked = wanted
    for _ in range(rounds):
        for dim in targets:
            have = F.sum("_weight").over(Window.partitionBy(dim))
            scaled = F.col("_weight") * F.col("_all") * F.col(f"_share_{dim}") / have
            raked = raked.withColumn(
                "_weight",
                F.when(have > 0, F.least(scaled, F.col("tokens").cast("double"))).otherwise(0.0),
            )
        raked = store(raked, "mix-round")  # a few rows; keeps the plan short
    kept = F.when(F.col("tokens") > 0, F.col("_weight") / F.col("tokens")).otherwise(float(budget))
    return raked.select(*cells.columns, kept.alias("probability"))


def mix(
    docs: DataFrame,
    dims: Mapping[str, Column],
    tokens: Column,
    targets: Mapping[str, float | Mapping[str, float]],
    id: str = "doc_id",
    budget: float = BUDGET,
    rounds: int = ROUNDS,
    seed: str = SEED,
    max_cells: int = MAX_CELLS,
) -> DataFrame:
    """``row`` (a document's own columns), ``cell`` (its dimensions), ``tokens``, ``probability``
    and ``kept`` for every row of ``docs``.

    ``dims`` are the expressions of the dimensions, ``tokens`` the size of a document. A null
    dimension counts as the empty string. Rows with equal ids are kept or dropped together; all
    rows with a null id too. No rows give no rows. Texts are read in place, in a second scan:
    only the cells move.
    """
    names = [f"_{name}" for name in dims]
    columns = [
        F.coalesce(c.cast("string"), F.lit("")).alias(f"_{name}") for name, c in dims.items()
    ]
    summed = docs.select(*columns, tokens.alias("_tokens")).groupBy(*names)
    cells = store(summed.agg(F.sum("_tokens").alias("tokens")), "mix-sums")
    raked = rake(
        _checked(cells, max_cells), {f"_{k}": v for k, v in targets.items()}, budget, rounds
    ).select(*names, "probability")
    uniform = keys.uniform(seed, F.coalesce(F.col(id).cast("string"), F.lit("")))
    own = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    return (
        docs.select(own, *columns, tokens.alias("tokens"), uniform.alias("_uniform"))
        .join(F.broadcast(raked), names)
        .select(
            "row",
            F.struct(*[F.col(f"_{name}").alias(name) for name in dims]).alias("cell"),
            "tokens",
            "probability",
            (F.col("_uniform") < F.col("probability")).alias("kept"),
        )
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The production mixture of ``documents``: by source, language and topic."""
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(F.col("text"))}
    return mix(docs, dims, token_count(F.col("text")), FLATTEN)


def keep_mixed(docs: DataFrame) -> DataFrame:
    """The documents of the production mixture, with their own columns."""
    return mix_documents(docs).where("kept").select("row.*")


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mix_documents(read_table(spark, sf, "documents").select("doc_id", "text", "lang", "source"))
    return mixed.select(
        "row.doc_id",
        "cell.source",
        "cell.lang",
        "cell.topic",
        F.col("tokens").alias("n_tokens"),
        F.round("probability", 6).alias("probability"),
        "kept",
    )


def _sql() -> str:
    """The same raking with one subquery for every dimension of every round."""
    parts = [f"""
docs AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
         CASE WHEN contains(text, '{_TABLE}') THEN 'table'
              WHEN contains(text, chr(10) || '- ') THEN 'list'
              WHEN contains(text, '!!') THEN 'shout' ELSE 'prose' END AS topic,
         coalesce(length(regexp_replace(regexp_replace(text, '[^ \\t-\\r]+', 'x', 'g'),
                                        '[ \\t-\\r]+', '', 'g')), 0) AS n_tokens
  FROM documents),
cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL)"""]
    for dim, power in FLATTEN.items():
        parts.append(f"""
share_{dim} AS (
  SELECT {dim}, p / sum(p) OVER () AS share_{dim}
  FROM (SELECT {dim}, CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens), {power}) ELSE 0 END AS p
        FROM cells GROUP BY {dim}))""")
    joins = " ".join(f"JOIN share_{dim} USING ({dim})" for dim in FLATTEN)
    parts.append(f"""
w0 AS MATERIALIZED (
  SELECT *, {BUDGET} * tokens AS w, {BUDGET} * sum(tokens) OVER () AS everything FROM cells {joins})""")
    n = 0
    for _ in range(ROUNDS):
        for dim in FLATTEN:
            parts.append(f"""
w{n + 1} AS MATERIALIZED (
  SELECT * EXCLUDE (have) REPLACE (CASE WHEN have > 0 THEN least(w * everything * share_{dim} / have, tokens)
                         ELSE 0 END AS w)
  FROM (SELECT *, sum(w) OVER (PARTITION BY {dim}) AS have FROM w{n}))""")
            n += 1
    return f"""
WITH {",".join(parts)},
p AS (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN w / tokens ELSE {BUDGET} END AS p FROM w{n})
SELECT doc_id, source, lang, topic, n_tokens::BIGINT AS n_tokens, round(p, 6) AS probability,
       ('0x' || substr(md5('{SEED}:' || doc_id), 1, 8))::BIGINT / 4294967296.0 < p AS kept
FROM docs JOIN p USING (source, lang, topic)"""


SQL = _sql()
