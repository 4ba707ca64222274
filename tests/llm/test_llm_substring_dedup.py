import random
import re

import pytest

from reportweave.llm import substring_dedup as sd
from reportweave.llm import words
from reportweave.llm.automaton import SuffixAutomaton

SCHEMA = "doc_id bigint, text string, id string, key string, spans string, words string, place string"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(docs, window):
    """Rows with distinct ids, in their order."""
    seen, out = set(), {}
    for i, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        w = split(text)
        gone = set()
        for at in range(len(w) - window + 1):
            run = tuple(w[at : at + window])
            if run in seen:
                gone.update(range(at, at + window))
            seen.add(run)
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def table(spark, docs):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d", "e") for i, t in docs], SCHEMA)


def result(found):
    rows = found.collect()
    for r in rows:
        assert r.n_removed == sum(s.last - s.first + 1 for s in r.spans)
        assert all(a.last + 1 < b.first for a, b in zip(r.spans, r.spans[1:], strict=False))
    return {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rows}


def corpus(seed, vocabulary=400):
    rng = random.Random(seed)
    word = lambda: rng.choice([f"w{rng.randrange(vocabulary)}", "É", "x y", "W1", " "])
    passages = [[word() for _ in range(n)] for n in (6, 19, 20, 21, 35, 60, 200)]
    docs = []
    for _ in range(90):
        parts = [rng.choice([rng.choice(passages), [word() for _ in range(rng.randrange(1, 40))]]) for _ in range(rng.randrange(1, 6))]
        if rng.random() < 0.2:
            parts.append(["again"] * rng.randrange(1, 70))
        flat = [w for p in parts for w in p]
        docs.append("".join(w + rng.choice([" ", " ", "\n", "\t ", "\u000b"]) for w in flat))
    docs += [docs[3], docs[4] + " tail", "", None, " \t", "short one", docs[3]]
    rng.shuffle(docs)
    return [(7 * k + 1, t) for k, t in enumerate(docs)]


@pytest.mark.parametrize(
    ("seed", "options"),
    [(1, {}), (2, {"hot_anchor": 1}), (3, {"hot_anchor": 4, "shard_words": 50}), (4, {"window": 5, "anchor": 2}),
     (5, {"window": 3, "anchor": 3, "shard_words": 10}), (6, {"window": 1, "anchor": 1})],
)
def test_against_brute_force(spark, monkeypatch, seed, options):
    docs = corpus(seed, 40 if "window" in options else 400)
    got = result(sd.remove_repeats(table(spark, docs).repartition(5), **options))
    assert got == brute(docs, options.get("window", 20))


def test_few_words_that_meet_in_small_groups(spark):
    """All anchors are shared: windows differ by their contexts only."""
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(10, 120)))) for i in range(60)]
    for hot in (3, 10_000):
        assert result(sd.remove_repeats(table(spark, docs), window=12, anchor=4, hot_anchor=hot)) == brute(docs, 12)


def test_heavy_anchors_are_dealt_in_parts(spark, monkeypatch):
    docs = corpus(12)
    monkeypatch.setattr(sd, "SAMPLE_SHARE", 1)
    rows = sd._rows(table(spark, docs), "doc_id", "text")
    heavy = sd._heavy_anchors(rows, 20, 6)
    assert 0 < len(heavy) <= sd.HEAVY_SHARE
    salts = {r.salt for r in sd._anchor_rows(rows, 20, 6, heavy).collect()}
    assert len(salts) > 10
    assert result(sd.remove_repeats(table(spark, docs))) == brute(docs, 20)


def test_null_repeated_and_missing_ids(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(5, "x " + passage), (5, "x " + passage), (None, passage), (None, passage + " y"), (9, "z " + passage), (9, "q")]
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in sd.remove_repeats(table(spark, docs)).collect()]
    assert sorted(rows, key=repr) == sorted([
        (5, 31, 0, "x " + passage), (5, 31, 0, "x " + passage), (None, 30, 30, ""), (None, 31, 30, "y"),
        (9, 31, 30, "z"), (9, 1, 0, "q"),
    ], key=repr)
    two = sd.remove_repeats(table(spark, [(1, "a " + passage), (1, "b " + passage)])).collect()
    assert sorted(r.n_removed for r in two) == [0, 30]


def test_long_text_and_empty_table(spark):
    long = " ".join(f"w{i % 70_001}" for i in range(140_000))
    got = result(sd.remove_repeats(table(spark, [(2, long), (1, "a")])))
    assert got[2][:2] == (140_000, 69_999) and got[1] == (1, 0, "a")
    assert sd.remove_repeats(table(spark, [(1, "a")]).where("false")).count() == 0
    assert sd.remove_repeats(table(spark, [(1, None), (2, "b")])).count() == 2
    with pytest.raises(ValueError, match="anchor"):
        sd.remove_repeats(table(spark, [(1, "a")]), window=4, anchor=5)


def test_small_reference_is_broadcast(spark, monkeypatch):
    docs = corpus(11)
    reference = [split(t) for _, t in docs[:10]]
    found = sd.remove_known(table(spark, docs), table(spark, docs[:10]), window=20)
    known = {tuple(w[k : k + 20]) for w in reference for k in range(len(w) - 19)}
    for i, (n, removed, kept) in result(found).items():
        w = split(dict(docs)[i])
        gone = {k + j for k in range(len(w) - 19) if tuple(w[k : k + 20]) in known for j in range(20)}
        assert (n, removed, kept) == (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    monkeypatch.setattr(sd, "MAX_REFERENCE_WORDS", 10)
    with pytest.raises(ValueError, match="too long"):
        sd.remove_known(table(spark, docs), table(spark, docs[:10]))


def test_automaton_against_all_substrings():
    rng = random.Random(2)
    for _ in range(60):
        sequences = [[rng.randrange(rng.choice([2, 4])) for _ in range(rng.randrange(0, 25))] for _ in range(4)]
        grown, added = SuffixAutomaton(), set()
        for s in sequences:
            for end, n in enumerate(grown.matching_statistics(s)):
                assert n == max((k for k in range(end + 2) if k == 0 or tuple(s[end + 1 - k : end + 1]) in added))
            grown.add(s)
            added |= {tuple(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
        assert len(grown.steps) <= 2 * sum(map(len, sequences)) + 1


def test_groups_keep_all_rows():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"t": ["x" * 10] * 50})
    for limit in (1, 30, 10_000):
        assert sum(g.num_rows for g in words.groups([batch, batch.slice(0, 0), batch], limit)) == 100


def test_query(against_sql):
    against_sql("op13_substring_dedup")
    against_sql("op13_substring_dedup", "/root/testdata/sf0.01")
