import math
import random

import pytest
from pyspark.sql import functions as F

from reportweave.llm import top_k as tk

SCHEMA = "vec_id bigint, embedding array<float>, id string, v string, floor string"


def plain(rows, k=5):
    ok = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(256 * x) for x in v]
        ok[i] = min(ok.get(i, ints), ints)
    out = []
    for q, v in ok.items():
        if q % 5:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ok.items() if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, **more):
    frame = spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in tk.top_k(frame, F.col("vec_id") % 5 == 0, **more).collect())


def test_query(against_sql):
    against_sql("op6_exact_top_k")


@pytest.mark.parametrize("shard_rows", [40, 10_000])
def test_against_brute_force(spark, shard_rows):
    rng = random.Random(7)
    near = lambda c: [c + round(rng.gauss(0, 0.2), 2) for _ in range(6)]
    rows = [(i, near(rng.choice([-1, 0, 2]))) for i in range(400)]
    rows += [(i, [0.5] * 6) for i in range(400, 700)]  # one hot vector: many ties
    rows += [(700, None), (705, [1.0, None] * 3), (710, [float("nan")] * 6), (715, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(720, []), (725, []), (730, [1.0]), (735, [2.0, 1.0]), (740, [-0.001] * 6), (0, rows[0][1])]
    assert run(spark, rows, shard_rows=shard_rows) == plain(rows)


def test_large_numbers_are_exact(spark):
    rows = [(i, [float(2**20 + i), float(2**21 - i), 1.0]) for i in range(30)]
    assert run(spark, rows) == plain(rows)


def test_empty_and_few(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, [1.0, 2.0])]) == []
    assert run(spark, [(5, [1.0, 2.0]), (6, [1.0, 1.0])]) == [(5, 1, 6, 256 * 256 * 3)]
