import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportweave.llm import filter_audit as fa

SCHEMA = "doc_id bigint, source string, text string, id string, carry string, part string, n string"


def brute(docs, good, toxic):
    """Every order applied to every document, one after another."""
    texts = [(i, s or "", t or "") for i, s, t in docs]

    def fails(i, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out = set()
        if len(words) < 50:
            out.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            out.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
            out.add("C")
        if any(c in "#$%&*|" for c in text):
            out.add("D")
        if i is not None and any(j is not None and j < i and u == text for j, _, u in texts):
            out.add("E")
        return out

    failed = [(i, part, fails(i, text)) for i, part, text in texts]
    rows = {}
    for part in {p for _, p, _ in failed}:
        inside = [(i, f) for i, p, f in failed if p == part]
        sums = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = inside
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                sums[name] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in f for _, f in inside) - len(gone),
                    sum(f == {name} for _, f in inside), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(sums[order[step - 1]])
    return rows


def documents():
    rng = random.Random(3)
    texts = [None, "", "AB cd", "x\u000by z #", "ÀÉ É", "word " * 60, " ".join(f"w{i}" for i in range(50)),
             " ".join(f"W{i}" for i in range(90)), "a|b", " ".join(f"v{i}" for i in range(49)), "q " * 100_000]
    rows = [(i, rng.choice(["a", "b", None, ""]), rng.choice(texts)) for i in range(80)]
    return rows + [rows[5], (None, "a", "AB cd"), (None, "hot", None), (7, "b", "AB cd"), (200, "é", texts[6])]


def audited(spark, docs, good, toxic):
    table = spark.createDataFrame([(*d, "x", "y", "z", "w") for d in docs], SCHEMA)
    checked = fa.quality_failures(table, carry=("source",))
    return fa.audit_filters(
        checked, F.col("carry.source"), {c: F.col(c) for c in "ABCDE"},
        {"good_lost": F.col("id").isin(*good), "toxic_lost": F.col("id").isin(*toxic)},
    )


def test_against_every_order_applied(spark):
    docs, good, toxic = documents(), {1, 5, 9, 12}, {2, 5, 30}
    got = audited(spark, docs, good, toxic).collect()
    wanted = brute(docs, good, toxic)
    assert len(got) == len(wanted)
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in got} == wanted


def test_empty_table_and_bad_filters(spark):
    assert audited(spark, [(1, "a", "b")], {0}, {0}).where("false").count() == 0
    table = spark.createDataFrame([], SCHEMA)
    assert fa.audit_filters(table, F.col("source"), {"X": F.col("text").isNull()}, {}).count() == 0
    with pytest.raises(ValueError, match="single letters"):
        fa.audit_filters(table, F.col("source"), {"long": F.lit(True)}, {})
    with pytest.raises(ValueError, match="single letters"):
        fa.audit_filters(table, F.col("source"), {c: F.lit(True) for c in "ABCDEFG"}, {})


def test_two_filters_and_null_failures(spark):
    rows = spark.createDataFrame([("p", True, None), ("p", True, True), ("p", None, False)], "part string, x boolean, y boolean")
    got = fa.audit_filters(rows, F.col("part"), {"X": F.col("x"), "Y": F.col("y")}, {}).collect()
    assert {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in got} == {
        ("XY", 1): (1, 2, 0, 1, 3), ("XY", 2): (1, 0, 1, 0, 1),
        ("YX", 1): (2, 1, 0, 0, 1), ("YX", 2): (1, 1, 1, 1, 3),
    }


def test_min_plus_ranks():
    masks, orders = fa.mask_matrix(3), fa.orders_of(3)
    steps = fa.removal_steps(masks, orders)
    for mask, order in itertools.product(range(8), range(len(orders))):
        at = [k for k, f in enumerate(orders[order]) if mask >> f & 1]
        assert steps[mask, order] == (at[0] if at else np.inf)


def test_query(against_sql):
    against_sql("op12_filter_audit")
