import hashlib
from collections import Counter

import pytest

from reportweave.llm import sharding as sh


def plain_fill(shards, size):
    """Whole preference lists, filled in turns."""
    lists = {}
    for s in shards:
        d = hashlib.sha256(s.encode()).digest()
        offset, skip = int.from_bytes(d[:8], "big") % size, int.from_bytes(d[8:16], "big") % (size - 1) + 1
        lists[s] = [(offset + j * skip) % size for j in range(size)]
        assert len(set(lists[s])) == size
    table = {}
    while len(table) < size:
        for s in sorted(shards):
            if len(table) < size:
                table[next(x for x in lists[s] if x not in table)] = s
    return [table[i] for i in range(size)]


def test_fill_against_brute_force():
    for n in (1, 2, 7):
        shards = [f"s{i}" for i in range(n)]
        assert sh.fill_table(shards, 101) == plain_fill(shards, 101)


def test_balance_weights_and_little_movement():
    before = sh.fill_table([f"s{i}" for i in range(20)])
    counts = Counter(before)
    assert max(counts.values()) - min(counts.values()) <= 1
    after = sh.fill_table([f"s{i}" for i in range(19)])
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != "s19")
    assert moved < 0.12 * len(before)
    heavy = Counter(sh.fill_table({"a": 3, "b": 1}, 10_007))
    assert abs(heavy["a"] / heavy["b"] - 3) < 0.01


def test_bad_arguments():
    for shards, size in (([], 101), (["a"], 100), ({"a": 0}, 101), ([f"s{i}" for i in range(9)], 7)):
        with pytest.raises(ValueError):
            sh.fill_table(shards, size)


def test_place(spark, small, tmp_path):
    schema = "doc_id bigint, slot string, shard int, text string"
    rows = spark.createDataFrame([(1, "x", 1, "t"), (1, "y", 2, None), (None, None, None, ""), (2, "", 0, "long" * 9999)], schema)
    placed = sh.place(rows, shards=["a", "b", "c"], size=101)
    got = placed.collect()
    table = sh.fill_table(["a", "b", "c"], 101)
    assert len(got) == 4 and all(table[r.slot] == r.shard for r in got)
    assert len({r.slot for r in got if r.doc_id == 1}) == 1
    assert sh.place(rows.where("false")).count() == 0
    sh.write_shards(placed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    plan = sh.op2_sharding(spark, small)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "BroadcastHashJoin" in plan and "Exchange hash" not in plan
