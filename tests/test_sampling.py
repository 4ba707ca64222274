"""Samples and splits against plain sorting by the same key."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from reportweave.functions import keys
from reportweave.operators import sampling


def key(*parts):
    return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()


@pytest.fixture(scope="module")
def rows(spark):
    # One group holds most of the rows.
    return spark.range(700).select(
        "id", F.when(F.col("id") < 500, "hot").when(F.col("id") < 697, "warm").otherwise("rare").alias("g"))


GROUPS = {"hot": range(0, 500), "warm": range(500, 697), "rare": range(697, 700)}


@pytest.mark.parametrize("n", [0, 1, 3, 60, 300, 499])
def test_stratified_takes_the_first_n_by_key(rows, n):
    got = sampling.stratified_sample(rows, ["g"], n, ["id"], 9, "take_all").collect()
    for g, ids in GROUPS.items():
        expected = sorted(ids, key=lambda i: (key(9, i), i))[:n]
        assert sorted(r.id for r in got if r.g == g) == sorted(expected)


def test_short_group_is_an_error_by_default(rows):
    with pytest.raises(Exception, match="too few rows"):
        sampling.stratified_sample(rows, ["g"], 4, ["id"], 9).collect()


def test_many_groups_and_rows_without_a_group(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") >= 4, F.col("id") % 5_000).alias("g"))
    got = sampling.stratified_sample(rows, ["g"], 2, ["id"], 9, "take_all")
    sizes = {r.g: r["count"] for r in got.groupBy("g").count().collect()}
    assert len(sizes) == 5_001 and set(sizes.values()) == {2}
    assert sampling.bootstrap_sample(rows, ["g"], 2, ["id"], 9).count() == 2 * 5_001


def test_rows_are_ranked_by_bucket(rows):
    for sample in (
        sampling.stratified_sample(rows, ["g"], 3, ["id"], 9), sampling.simple_sample(rows, 450, ["id"], 9)
    ):
        plan = sample._jdf.queryExecution().executedPlan().toString()
        ranks = [line for line in plan.split("\n") if "row_number()" in line and "Window" in line]
        assert ranks and all("_bucket" in line for line in ranks)


def test_equal_ids_count_once_each(spark):
    rows = spark.range(20_000).select((F.col("id") % 500).alias("id"), F.lit("x").alias("g"))
    assert sampling.simple_sample(rows, 100, ["id"], 1).count() == 100
    assert sampling.stratified_sample(rows, ["g"], 15_000, ["id"], 1).count() == 15_000


def test_bootstrap_draws_the_row_at_the_drawn_rank(rows, monkeypatch):
    monkeypatch.setattr(sampling, "DRAW_BLOCK", 7)
    got = sampling.bootstrap_sample(rows, ["g"], 40, ["id"], 5).collect()
    assert len(got) == 120 and {r.draw for r in got} == set(range(40))
    for r in got:
        order = sorted(GROUPS[r.g], key=lambda i: (key(5, i), i))
        slot = int(key("draw:5", r.g, r.draw)[:8], 16) % len(order)
        assert order[slot] == r.id
    none = sampling.bootstrap_sample(rows, ["g"], 0, ["id"], 5)
    assert none.count() == 0 and none.columns == ["id", "g", "draw"]


def test_bootstrap_from_one_row(spark):
    one = spark.range(1)
    assert sampling.simple_bootstrap(one, 7, ["id"], 1).count() == 7


@pytest.mark.parametrize("n", [0, 1, 100, 699, 700, 900])
def test_simple_sample_takes_the_first_n_by_key(rows, n):
    expected = sorted(sorted(range(700), key=lambda i: (key(3, i), i))[:n])
    assert sorted(r.id for r in sampling.simple_sample(rows, n, ["id"], 3).collect()) == expected


@pytest.mark.parametrize("n", [0, 1, 2, 10, 11, 333])
@pytest.mark.parametrize("share", [0.5, 1.0])
def test_exact_split_sizes(spark, n, share):
    got = sampling.exact_split(spark.range(n), ["id"], 4, dev_share=share).collect()
    held = math.ceil(0.2 * n)
    test = math.ceil(share * held)
    sizes = {"train": n - held, "dev": held - test, "test": test}
    assert {s: sum(r.split == s for r in got) for s in sizes} == sizes
    order = sorted(range(n), key=lambda i: (key(4, i), i))
    assert {r.id for r in got if r.split == "train"} == set(order[: n - held])
    assert {r.id for r in got if r.split == "test"} == set(order[n - test :])


def test_split_does_not_shuffle_its_rows(spark):
    plan = sampling.exact_split(spark.range(100), ["id"], 4)._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main and "Window" not in main


def test_even_domains_repeat_a_row_per_domain(spark):
    df = spark.createDataFrame([(i, 1 if i < 4 else 0, 1) for i in range(20)], "id bigint, a int, b int")
    got = sampling.even_domain_sample(df, {"A": "a", "B": "b"}, 6, ["id"], 2).collect()
    assert sum(r.domain == "A" for r in got) == 4 and sum(r.domain == "B" for r in got) == 6


def test_clusters_and_missing_positions(spark):
    rows = [(i, float(i % 3) * 10, 0.0) for i in range(30)] + [(99, None, 1.0)]
    df = spark.createDataFrame(rows, "id bigint, _X double, _Y double")
    got = sampling.cluster_strata(df, "_X", "_Y", k=3, on_missing="skip").collect()
    assert len(got) == 30 and len({(r._X, r.cluster_id) for r in got}) == 3
    with pytest.raises(Exception):
        sampling.cluster_strata(df, "_X", "_Y", k=3).collect()


def test_uniform_numbers(spark):
    got = [r[0] for r in spark.range(500).select(keys.uniform(1, F.col("id"))).collect()]
    assert all(0 <= u < 1 for u in got) and 0.4 < sum(got) / 500 < 0.6
