import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from reportweave.llm import collocations as co

SCHEMA = "doc_id bigint, text string, lang string, prefix string, part string, n string"


def brute(rows, min_count=3, longest=3, percent=50):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, f in counts.items():
        wanted = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        for p, a in wanted.items():
            around = [b for q, b in wanted.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= percent * a for b in around):
                continue
            score, _, left, right = min(
                (10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            out[lang, " ".join(p)] = (a, left, right, n[lang], score)
    return out


def texts(seed, number=120):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "Ünder", "a-b", "x\u001cy", "w1", "w2", "w3", "z"]
    rows = []
    for _ in range(number):
        body = "".join(
            rng.choice(vocabulary) + rng.choice([" ", " ", " ", " ", "  ", "\t", ". ", "\n", "!", " "])
            for _ in range(rng.randrange(0, 60))
        )
        rows.append((body, rng.choice(["en", "en", "de", None, "und"])))
    return [*rows, (None, "en"), ("", "xx"), (" .,", "yy"), ("one two", "zz"), *rows[:20], ("a b " * 20_000, "en")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", "y", "z") for i, (t, g) in enumerate(rows)], SCHEMA)


def as_dict(found):
    return {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in found.collect()}


@pytest.mark.parametrize(("longest", "bits"), [(3, 1 << 16), (4, 64), (2, 1 << 16)])
def test_against_brute_force(spark, longest, bits):
    rows = texts(longest)
    found = co.mine_phrases(table(spark, rows), min_count=3, longest=longest, bitmap_bits=bits)
    assert as_dict(found) == brute(rows, longest=longest)


def test_split_prefixes_and_small_slices_change_nothing(spark, monkeypatch):
    rows = texts(9)
    wanted = brute(rows)
    everything = co._hot
    monkeypatch.setattr(co, "_hot", lambda phrases, total: everything(phrases, 0))
    assert as_dict(co.mine_phrases(table(spark, rows).repartition(3), min_count=3)) == wanted


def test_merge_of_one_prefix_over_many_slices():
    pa = co.pa
    part = lambda *entries: co._pack(
        ["en"], pa.array(["p"]), np.array([0]), np.array([0, len(entries)]),
        pa.array([w for w, _ in entries]), np.array([n for _, n in entries]),
    )
    merged = co._merged(pa.concat_batches([part(("", 2), ("b", 1)), part(("a", 5)), part(("b", 2**40), ("", 1))]))
    assert merged.num_rows == 1
    found = dict(zip(merged[3][0].as_py().split(b" "), np.frombuffer(merged[4][0].as_py(), "<i8").tolist(), strict=True))
    assert found == {b"": 3, b"a": 5, b"b": 2**40 + 1}


def test_scores_are_exact_beyond_64_bits(spark):
    rows = spark.createDataFrame([(999_999_999_999_999, 999_999_999_999_999, 999_999_999_999_998), (10**14, 10**14 + 1, 10**14)], "a bigint, l bigint, r bigint")
    found = [r[0] for r in rows.select(co._score("a", "l", "r")).collect()]
    assert found == [10**6 * r.a * r.a // (r.l * r.r) for r in rows.collect()]


def test_empty_and_ranks(spark):
    assert co.mine_phrases(table(spark, [("a", "en")]).where("false")).count() == 0
    assert co.mine_phrases(table(spark, [(None, None), ("", "en")])).count() == 0
    rows = [("b a", "en")] * 3 + [("a b", "en")] * 3 + [("é a", "en")] * 3
    ranked = co.strongest(co.mine_phrases(table(spark, rows), min_count=3), 2).collect()
    assert [(r.rank, r.phrase) for r in sorted(ranked, key=lambda r: r.rank)] == [(1, "é a"), (2, "a b")]


def test_query(against_sql):
    against_sql("op11_collocations")
    against_sql("op11_collocations", "/root/testdata/sf0.01")
