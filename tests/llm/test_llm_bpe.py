import base64
import hashlib
import random
import struct

import public_tokenizers
import tiktoken

from reportweave.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RAW = bpe.read_ranks(PATH)
PIECES = ["a", "B", "é", "1", "٣", " ", "\n", "\t", "'", "'s", "!", "-", "。", "漢", "字", "  ", "🙂", "\x1c", "don't", " x", "한", "\r\n", "_", "　"]


def whole():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_safe_parts_give_the_same_ids():
    plain, rng = whole(), random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 300)))
        if rng.random() < 0.2:
            text += " " * rng.randint(1000, 2500) + rng.choice(["", "x", "\n", "!"]) + text
        ids = []
        for part, single in bpe.safe_parts(text, rng.choice([1, 5, 40])):
            ids += bpe.encodings(RAW, PATTERN)[single].encode_ordinary(part)
        assert ids == plain.encode_ordinary(text)


def test_runs_that_the_regex_engine_cannot_take():
    for text in (" " * 2_000_000 + "x", "x" + "\n" * 1_500_000, "ab" * 300_000, "word " * 100_000):
        ids = bpe.encode_text(text, RAW, PATTERN)
        assert whole().decode_bytes(ids) == text.encode()


def test_edges(spark):
    schema = "doc_id bigint, text string, ids string, n_tokens string"
    texts = ["hello <|endoftext|> world", None, "", "漢字 🙂", "a b " * 40_000, "hello <|endoftext|> world"]
    rows = spark.createDataFrame([(i if i else None, t, "clash", "clash") for i, t in enumerate(texts)], schema)
    got = bpe.encode_documents(rows, PATH, PATTERN, decode=True).collect()
    for row, text in zip(sorted(got, key=lambda r: r.doc_id or 0), texts, strict=True):
        ids = whole().encode_ordinary(text or "")
        assert row.n_tokens == len(ids)
        assert bytes(row.ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert bytes(row.decoded) == (text or "").encode()
    assert bpe.encode_documents(rows.where("false"), PATH, PATTERN).count() == 0
    odd = spark.createDataFrame([(bytearray(struct.pack("<2I", 220, 128)),), (None,), (bytearray(),)], "ids binary")
    decoded = [r.decoded for r in bpe.decode_ids(odd, PATH, PATTERN).collect()]
    assert bytes(decoded[0]) == whole().decode_bytes([220, 128]) and decoded[1] is None and bytes(decoded[2]) == b""


def test_query(spark, small):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = bpe.op5_byte_bpe(spark, small).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = whole().encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
