import base64
import struct

import brute
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as cp
from reportweave.llm import bpe, mixing
from reportweave.llm.registry import CORPUS_QUERIES, CORPUS_SQL


def as_rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_on_their_inputs(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = [(9_001, None, "en", "src0", 0), (9_002, "12 34", "en", "src0", 5), (9_003, "", None, None, 0)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema)).cache()
    before = as_rows(docs)

    after = as_rows(cp.identify_language(spark, docs, small))
    assert not {9_001, 9_002, 9_003} & set(after) and len(after) >= 0.98 * (len(before) - 3)
    docs = spark.createDataFrame(list(after.values()), docs.schema)

    last = {}
    for i, r in after.items():
        last[r.text] = max(i, last.get(r.text, i))
    unique = as_rows(cp.drop_copies(spark, docs, small))
    assert set(unique) == set(last.values())
    docs = spark.createDataFrame(list(unique.values()), docs.schema)

    near = brute.near_duplicates({i: r.text for i, r in unique.items()}, 5)
    apart = as_rows(cp.drop_near_copies(spark, docs, small))
    assert set(apart) == {i for i, (_, c) in near.items() if i == c}
    docs = spark.createDataFrame(list(apart.values()), docs.schema)

    mixed = as_rows(cp.mix_sources(spark, docs, small))
    marked = {r.row.doc_id: r for r in mixing.mix_documents(docs).collect()}
    assert set(marked) == set(apart) and set(mixed) == {i for i, r in marked.items() if r.kept}
    assert all(mixed[i] == apart[i] for i in mixed)
    docs = spark.createDataFrame(list(mixed.values()), docs.schema)

    path = public_tokenizers.path(cp.RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, r in as_rows(cp.encode(spark, docs, small)).items():
        ids = enc.encode_ordinary(mixed[i].text)
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids)


def test_run_and_names(spark, small):
    assert [name for name, _ in cp.STAGES] == ["language_id", "exact_dedup", "minhash_near_dedup", "mixing", "byte_bpe"]
    got = cp.run(spark, small)
    assert got.columns == ["doc_id", "n_tokens", "ids"] and 0 < got.count() < 200
    assert sorted(int(n[2:].split("_")[0]) for n in CORPUS_QUERIES) == list(range(1, 14))
    assert set(CORPUS_SQL) <= set(CORPUS_QUERIES)


def test_stages_on_an_empty_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("false")
    for _, stage in cp.STAGES:
        assert stage(spark, docs, small).count() == 0


def test_stages_take_extra_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(40).selectExpr(
        "*", "'x' AS id", "'x' AS digest", "'x' AS kept", "'x' AS tokens", "'x' AS lang_pred", "'x' AS row",
        "'x' AS _language", "'x' AS _kept_id", "'x' AS _own_digest", "'x' AS _slot", "'x' AS second", "'x' AS key"
    ).cache()
    for _, stage in cp.STAGES[:4]:
        found = stage(spark, docs, small)
        assert found.columns == docs.columns and found.count() > 0


def test_ids_that_do_not_decode_to_the_text(spark, small, monkeypatch):
    docs = spark.createDataFrame([(1, "one text"), (2, None), (3, "")], "doc_id bigint, text string")
    assert cp.encode(spark, docs, small).count() == 3
    monkeypatch.setattr(bpe, "encode_text", lambda text, raw, pattern: [0, 1])
    with pytest.raises(Exception, match="do not decode"):
        cp.encode(spark, docs, small).collect()
