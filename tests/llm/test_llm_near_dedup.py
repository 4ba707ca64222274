import random

import brute
import numpy as np
import pytest

from reportweave.llm import near_dedup as nd
from reportweave.llm import sketch
from reportweave.llm.components import connected_components

SCHEMA = "doc_id bigint, text string, id string, n string, regs string"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in texts], SCHEMA)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10_000)}"
    return words


def groups(seed):
    """Stars of near copies around originals that hold a shared passage, and some oddities."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for size in (60, 25, 8, 3, 2):
        base = [f"w{rng.randrange(3_000)}" for _ in range(rng.choice([12, 60, 150]))] + passage
        texts += [" ".join(edited(rng, base, rng.randrange(0, len(base) // 7 + 2))) for _ in range(size)]
    texts += [" ".join([f"w{rng.randrange(3_000)}" for _ in range(20)] + passage) for _ in range(40)]
    texts += ["", " \t\n", "one", "ONE", "one two", "One\ftwo", "É à", "é à", "a b c d e f g h i j", "a b c d e f g h i x"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("width", "seed"), [(2, 1), (5, 2)])
def test_against_all_pairs(spark, width, seed):
    texts = groups(seed)
    wanted = brute.near_duplicates(dict(texts), width)
    got = nd.near_duplicates(table(spark, texts), width=width).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == wanted
    assert all(r.kept == (r.id == r.component_id) for r in got)
    kept = nd.keep_one(table(spark, texts), width=width)
    assert kept.columns == SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in wanted.items() if i == c)


def test_small_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_ROWS", 7)
    monkeypatch.setattr(nd, "BLOCK_SHINGLES", 500)
    texts = groups(5)
    got = nd.near_duplicates(table(spark, texts), width=2).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(dict(texts), 2)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, long), (4, long + " end"), (5, long.upper()), (None, long), (3, long), (6, "x" * 3_000_000)]
    got = nd.near_duplicates(table(spark, rows)).collect()
    assert len(got) == len(rows)
    found = {(r.id, r.component_id, r.kept) for r in got}
    assert found == {
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 3, False), (5, 3, False), (None, None, True), (6, 6, True)
    }
    assert nd.near_duplicates(table(spark, rows).where("false")).count() == 0
    assert nd.near_duplicates(table(spark, [(1, None), (2, "")])).count() == 2


def test_estimate_and_collision_correction():
    rng = np.random.default_rng(1)
    for n, share in ((40, 0.8), (500, 0.8), (500, 0.5), (5_000, 0.0)):
        errors = []
        for _ in range(30):
            common, one, two = np.split(rng.integers(0, 2**63, n * 2, np.uint64), [round(n * share), round(n * (1 + share) / 2)])
            two = two[: len(one)]
            a, b = (np.unique(np.concatenate([common, x])) for x in (one, two))
            agree = (sketch.registers(a) == sketch.registers(b)).mean()
            truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append(sketch.estimated_jaccard(np.array([agree]), np.array([len(a)]), np.array([len(b)]))[0] - truth)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_sets_across_windows(monkeypatch):
    text = " ".join(f"word{i % 997}" for i in range(5_000))
    plain = list(sketch.shingle_sets([text, "", None, "a b", text], 3))
    monkeypatch.setattr(sketch, "WINDOW", 512)
    cut = list(sketch.shingle_sets([text, "", None, "a b", text], 3))
    assert all(np.array_equal(a, b) for a, b in zip(plain, cut, strict=True))
    assert [len(s) for s in plain] == [len(brute.shingle_set(t, 3)) for t in (text, "", None, "a b", text)]


def test_components_against_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(i, i + 1) for i in range(400, 480)] + [(500, 500), (1000, 999), (1000, 998)]
    got = connected_components(spark.createDataFrame([*links, (None, 1)], "a bigint, b bigint"))
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.id: r.component for r in got.collect()} == brute.components(nodes, [(a, b) for a, b in links if a != b])


def test_keep_one_loses_no_text_of_a_shared_id(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, b), (5, a), (5, b + " more"), (None, a + " end"), (None, "alone"), (7, b), (7, b), (8, "")]
    kept = sorted((r.doc_id or -1, r.text) for r in nd.keep_one(table(spark, rows)).collect())
    assert kept == sorted([(1, b), (5, a), (-1, "alone"), (8, "")])
    first = nd.keep_one(table(spark, [(None, a), (None, a + " x"), (2, a), (2, a)])).collect()
    assert [(r.doc_id, r.text) for r in first] == [(2, a), (2, a)]
    assert nd.keep_one(table(spark, rows).where("false")).count() == 0


def test_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = nd.op3_minhash_near_dedup(spark, small).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_duplicates(texts, 2)
