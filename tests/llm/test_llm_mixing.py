import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from reportweave.llm import mixing as mx

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _source string, tokens string, probability string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, s, 0, "x", "x", "x") for i, t, g, s in rows], SCHEMA)


def test_query(against_sql):
    against_sql("op9_mixing")
    against_sql("op9_mixing", "/root/testdata/sf0.01")


def test_raking_against_numpy(spark):
    rng = np.random.default_rng(1)
    tokens = rng.integers(1_000, 5_000, (4, 3))
    rows = [(f"a{i}", f"b{j}", int(tokens[i, j])) for i in range(4) for j in range(3)]
    cells = spark.createDataFrame(rows, "a string, b string, tokens bigint")
    targets = {"a": 0.5, "b": {"b0": 0.5}}
    got = {(r.a, r.b): r.probability for r in mx.rake(cells, targets, budget=0.4, rounds=20).collect()}
    rest = tokens.sum(axis=0) / tokens[:, 1:].sum() * 0.5
    share_a, share_b = tokens.sum(axis=1) ** 0.5, np.array([0.5, rest[1], rest[2]])
    share_a = share_a / share_a.sum()
    weight = tokens * 0.4
    for _ in range(20):
        weight = np.minimum(weight * (0.4 * tokens.sum() * share_a / weight.sum(axis=1))[:, None], tokens)
        weight = np.minimum(weight * (0.4 * tokens.sum() * share_b / weight.sum(axis=0))[None, :], tokens)
    for i in range(4):
        for j in range(3):
            assert np.isclose(got[f"a{i}", f"b{j}"], weight[i, j] / tokens[i, j])
    assert np.allclose(weight.sum(axis=0) / weight.sum(), share_b, atol=1e-3)


def test_edges(spark):
    rows = [(1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, None, None, None), (3, "", "", ""), (None, "x", "fr", "t"), (4, "w " * 100_000, "en", "t")]
    mixed = mx.mix_documents(docs(spark, rows)).collect()
    assert len(mixed) == len(rows)
    assert len({r.kept for r in mixed if r.row.doc_id == 1}) == 1
    assert all(0 <= r.probability <= 1 for r in mixed)
    assert {r.tokens for r in mixed} == {2, 0, 1, 100_000}
    assert mx.keep_mixed(docs(spark, rows)).columns == docs(spark, rows).columns
    assert mx.keep_mixed(docs(spark, rows).where("false")).count() == 0


def test_sample_follows_the_probabilities(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("source"),
    )
    got = mx.mix(rows, {"source": F.col("source")}, mx.token_count(F.col("text")), {"source": {"hot": 0.5, "cold": 0.5}}, budget=0.5)
    shares = {r["source"]: r["share"] for r in got.groupBy("cell.source").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert abs(shares["hot"] - 0.75) < 0.02 and abs(shares["cold"] - 0.375) < 0.02


def test_too_many_cells_and_plan(spark, small):
    rows = docs(spark, [(i, "a", "en", f"s{i}") for i in range(20)])
    with pytest.raises(PySparkException, match="more than 10"):
        mx.mix(rows, {"source": F.col("source")}, F.lit(1), {"source": 1.0}, max_cells=10).collect()
    plan = mx.op9_mixing(spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
